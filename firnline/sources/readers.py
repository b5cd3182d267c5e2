"""Tables read from landed files, each with its explicit schema."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firnline import fixed_values as fv
from firnline import schemas
from firnline.functions.measure import nans_to_null
from firnline.functions.text import null_if_in
from firnline.functions.time import to_time
from firnline.operators.cleaning import quoted, stations_from_records


def csv(
    spark: SparkSession, path: str, schema: T.StructType, na_tokens: list[str] = fv.NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Missing-value tokens become null before a cell gets its type.

    A typed cell that does not parse raises. ``multi_line`` is for cells that hold line breaks; such
    files are read whole by one task.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
    cells = spark.read.schema(as_text).csv(
        path, header=True, enforceSchema=False, multiLine=multi_line, escape='"', mode="FAILFAST"
    )

    def typed(field: T.StructField):
        value = null_if_in(quoted(field.name), na_tokens)
        if isinstance(field.dataType, T.TimestampNTZType):
            value = to_time(value)
        return value.cast(field.dataType).alias(field.name)

    return nans_to_null(cells.select(*[typed(f) for f in schema]))


def stations_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stations from a landed payload: a JSON array, or one record per line without
    ``multi_line``. Records that cannot be parsed or used are skipped."""
    records = spark.read.schema(schemas.STATION_RECORD).json(
        path, multiLine=multi_line, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_corrupt_record",
    )
    return stations_from_records(records.filter(F.col("_corrupt_record").isNull()))


def station_daily(
    spark: SparkSession, path: str,
    first: datetime.date | None = None, last: datetime.date | None = None,
) -> DataFrame:
    """Daily readings from a Parquet table partitioned by ``month``, optionally a date range.

    The range is also put on the month, so partitions outside it are not listed.
    """
    table = spark.read.schema(
        T.StructType([*schemas.STATION_DAILY.fields, T.StructField("month", T.DateType())])
    ).parquet(path)
    if first is not None:
        table = table.filter(
            (F.col("month") >= F.lit(first.replace(day=1))) & (F.col("day") >= F.lit(first))
        )
    if last is not None:
        table = table.filter((F.col("month") <= F.lit(last)) & (F.col("day") <= F.lit(last)))
    return nans_to_null(table.drop("month"))


def elevation_grid(spark: SparkSession, path: str) -> DataFrame:
    """Elevation cells from a Parquet table partitioned by tile; a join on the tile prunes."""
    cells = spark.read.schema(schemas.ELEVATION_GRID).parquet(path)
    return nans_to_null(cells.select(*schemas.ELEVATION_GRID.names))  # partition columns are read last


def parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return nans_to_null(spark.read.schema(schema).parquet(path))
