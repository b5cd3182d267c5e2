"""Line dedup by site-relative frequency: lines that too large a share of a host's pages carry are boilerplate.

Per host (``source``), the pages that hold a line are counted and divided by the host's pages; equal pages of a host
are one page, so that a page copied many times isn't taken for boilerplate. A line is dropped from every page of the
host if the share is above ``ratio`` and at least ``least`` pages hold it. Lines travel as 64-bit hashes with 32 check
bits, never as text; equal pages and the counts are merged before they are shuffled.

At most (lines of the host's pages) / ``ratio`` lines can be above the ratio, whatever the number of pages, so the flagged
lines of a host fit in one array. Their total is measured: up to ``BROADCAST`` entries they are broadcast,
beyond that they are joined on (host, salt), which splits a host with a third of all pages.

Cases: blank lines are kept and not counted; a line that a page repeats counts once for the page and is dropped
at each place; a null host is a host of its own; null texts stay null, texts that lose all lines become empty; hosts with
few pages lose nothing below ``least`` pages; repeated rows are equal pages; an empty table gives an empty result; extra
columns ride along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.session import stage

RATIO = 0.05
LEAST = 3
BROADCAST = 500_000
SALTS = 32


def line_key(line: Column) -> Column:
    """96 bits of the trimmed line."""
    return F.struct(F.xxhash64(F.trim(line)).alias("a"), F.hash(F.trim(line)).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, key, pages, total): the lines above the ratio."""
    site = F.coalesce(F.col(host), F.lit("")).alias("host")
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), line_key))
    pages = (docs.select(site, F.xxhash64(F.coalesce("text", F.lit(""))).alias("page"), lines.alias("keys"))
             .groupBy("host", "page").agg(F.first("keys").alias("keys")))
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    counts = (pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key")
              .agg(F.count("*").alias("pages")).filter(F.col("pages") >= least))
    # Counted lines on the left: a host's many lines can be split, its total is one row.
    return counts.join(totals, "host").filter(F.col("pages") > ratio * F.col("total"))


def without_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least: int = LEAST,
                        broadcast: int = BROADCAST) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``."""
    flagged = stage(boilerplate(docs, host, ratio, least).groupBy("host")
                    .agg(F.collect_set("key").alias("flagged")), "boilerplate")
    size = flagged.agg(F.coalesce(F.sum(F.size("flagged")), F.lit(0)).alias("n")).first()["n"]
    own = "__firnline_"
    given = docs.withColumns({own + "host": F.coalesce(F.col(host), F.lit(""))})
    keys = flagged.select(F.col("host").alias(own + "host"), F.col("flagged").alias(own + "flagged"))
    if size <= broadcast:
        joined = given.join(F.broadcast(keys), own + "host", "left")
    else:
        given = given.withColumn(own + "salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
        keys = keys.withColumn(own + "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = given.join(keys, [own + "host", own + "salt"], "left")
    kept = F.array_join(F.filter(F.split("text", "\n", -1),
                                 lambda x: ~F.array_contains(own + "flagged", line_key(x))), "\n")
    text = F.when(F.col(own + "flagged").isNull(), F.col("text")).otherwise(kept)
    return joined.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])
