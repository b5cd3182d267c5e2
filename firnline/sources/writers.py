"""Stage outputs written to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.functions.time import month_start


STATION_BUCKETS = 16


def table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), csv: bool = False) -> None:
    """Parquet, or CSV with a header; replaces what is there."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if csv:
        writer.csv(path, header=True)
    else:
        writer.parquet(path)


def station_daily(daily: DataFrame, path: str) -> None:
    """Daily readings partitioned by month and clustered by station, as look-ups want them."""
    months = daily.withColumn("month", month_start(F.col("day")))
    # A month of every station fits a task many times over; AQE splits one that does not.
    months.hint("rebalance", "month").sortWithinPartitions(
        "month", "station_triplet", "day"
    ).write.mode("overwrite").partitionBy("month").parquet(path)


def station_daily_bucketed(daily: DataFrame, name: str, path: str, buckets: int = STATION_BUCKETS) -> DataFrame:
    """Daily readings as the table ``name``, bucketed by station and sorted by day inside a bucket; the table.

    What groups or joins by station reads it without an exchange. Buckets should follow the table: 1 GB each is good.
    """
    # One writer a bucket, so one file.
    daily.repartition(buckets, "station_triplet").write.mode("overwrite").bucketBy(buckets, "station_triplet").sortBy(
        "station_triplet", "day"
    ).option("path", path).saveAsTable(name)
    return daily.sparkSession.table(name)


def elevation_grid(cells: DataFrame, path: str) -> None:
    """Cells partitioned by tile."""
    cells.hint("rebalance", "tile_row", "tile_col").write.mode("overwrite").partitionBy(
        "tile_row", "tile_col"
    ).parquet(path)


def text_report(texts: DataFrame, path: str, column: str = "text") -> None:
    texts.select(column).write.mode("overwrite").text(path, lineSep="\n\n")
