"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 256
#: Bytes of a batch that travels between Spark and Python, however long the texts are.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at ``BATCH_BYTES`` as well as at their number of rows, for the rest of the session.

    Spark's own bound by rows alone would put ten thousand texts of any length into the memory of a task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return what this worker has freed to the system, so that it doesn't keep the peak of every task it ever ran."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across the tasks it serves."""
    return sys.modules.setdefault("_firnline_worker_cache", types.ModuleType("cache")).__dict__


def per_batch(make: Callable[[], Callable[..., pa.Array]], kind: str):
    """An Arrow UDF of result type ``kind``: ``make()`` runs once a task, what it returns once for every few rows of
    a batch, so that no more than ``ROWS`` texts are Python objects at a time.

    It counts as non-deterministic, so that Spark evaluates it once however often its fields are used.
    """
    bounded_batches(SparkSession.active())

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        act = make()
        for x in batches:
            parts = [act(x.slice(i, ROWS)) for i in range(0, max(1, len(x)), ROWS)]
            yield pa.concat_arrays(parts)
        del act
        give_back()

    return F.arrow_udf(one, kind).asNondeterministic()


def text_of(c: str | Column) -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
