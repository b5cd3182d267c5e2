"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_OWN_FOLDERS: dict[str, str] = {}  # by application, for local sessions without the setting


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own.

    ``shared`` is the folder for stored steps.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("firnline")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small tables with costly rows: keep all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    spark = (builder.config(CHECKPOINT_DIR, shared) if shared else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder intermediate tables go to.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of this machine: executors of a cluster could not reach one.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application in _OWN_FOLDERS:
        return _OWN_FOLDERS[application]
    folder = _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="firnline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # made here, so removed here
    return folder


def stage(df: DataFrame, name: str, rebalance: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage for results that several consumers need; the table outlives lost executors. ``rebalance`` deals the
    rows out first, for a source of few large partitions.
    """
    df = df.hint("rebalance") if rebalance else df
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(stored: DataFrame) -> None:
    """Delete a table that ``stage`` wrote, once nothing will read it any more."""
    jvm, conf = stored.sparkSession._jvm, stored.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    path.getFileSystem(conf).delete(path, True)
