"""Queries by name, each with an SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline.catalog.tables import Tables, open_tables
from firnline.catalog.twins import with_views
from firnline.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under a name, with its twin."""
    def add(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(open_tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = with_views(sql)
        return function
    return add


def with_place(ordered: DataFrame) -> DataFrame:
    """Number the rows of a sorted frame in the order it has, so that the order can be checked.

    Sorting leaves the order in the partitions: a row's place is its place in its partition after
    the rows of the partitions before, which are few numbers.
    """
    stored = stage(ordered.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    partition = F.shiftright("__at", 33)
    earlier = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = stored.groupBy(partition.alias("__part")).agg(F.count("*").alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("__part", partition).join(F.broadcast(before), "__part").withColumn(
        "place", (F.col("__before") + inside + 1).cast("int")
    ).drop("__part", "__at", "__before")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def day_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def time_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, dates and times as text, for comparison across engines."""
    made = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.round(c, 6)
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        made.append(c.alias(name))
    return df.select(*made)
