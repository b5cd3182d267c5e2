"""Repeatable train/test splits, folds and samples in hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.operators.ranking import (
    first_by_hash,
    hash_order,
    last_digests,
    position_by_hash,
)


def _drawn(df: DataFrame, key: Column | str, seed: int) -> DataFrame:
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    return df.withColumn("__draw", hash_order(key.cast("string"), F.lit(str(seed))))


def test_quotas(df: DataFrame, label: str, share: float = fv.TEST_SHARE) -> DataFrame:
    """Test rows per label: ceil(share × rows) in all, shared out by largest remainder."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = W.partitionBy()  # one row per label
    exact = F.col("n") * F.ceil(F.sum("n").over(everything) * share) / F.sum("n").over(everything)
    floors = counts.select(
        label,
        F.ceil(F.sum("n").over(everything) * share).alias("wanted"),
        F.floor(exact).alias("base"),
        (exact - F.floor(exact)).alias("rest"),
    )
    by_rest = W.orderBy(F.desc("rest"), label)
    extra = F.row_number().over(by_rest) <= F.col("wanted") - F.sum("base").over(everything)
    return floors.select(label, (F.col("base") + F.when(extra, 1).otherwise(0)).alias("quota"))


def stratified(
    df: DataFrame, label: str, key: str, share: float = fv.TEST_SHARE, seed: int = fv.SEED
) -> DataFrame:
    """Add ``is_test``: the first rows of each label in hash order, up to its quota.

    ``key`` is unique; labels are few.
    """
    drawn = _drawn(df, key, seed)
    last = last_digests(drawn, "__draw", test_quotas(df, label, share), [label])
    # One cut per label: rows are marked where they are, nothing is shuffled.
    return drawn.join(F.broadcast(last), label, "left").withColumn(
        "is_test", F.coalesce(F.col("__draw") <= F.col("last"), F.lit(False))
    ).drop("__draw", "last")


def plain(df: DataFrame, key: str, share: float = fv.TEST_SHARE, seed: int = fv.SEED) -> DataFrame:
    """Add ``is_test`` without strata: ceil(share × rows) rows in hash order."""
    drawn = _drawn(df, key, seed)
    quota = df.agg(F.ceil(F.count("*") * share).alias("quota"))
    last = last_digests(drawn, "__draw", quota).select("last").scalar()
    return drawn.withColumn(
        "is_test", F.coalesce(F.col("__draw") <= last, F.lit(False))
    ).drop("__draw")


def folds(
    df: DataFrame, label: str, key: str, count: int = fv.FOLDS, seed: int = fv.SEED
) -> DataFrame:
    """Add ``fold``: rows of each label dealt out in turn, in hash order."""
    placed = position_by_hash(_drawn(df, key, seed), "__draw", "__position", [label])
    return placed.withColumn(
        "fold", ((F.col("__position") - 1) % count).cast("int")
    ).drop("__draw", "__position")


def sample(df: DataFrame, key: str, rows: int, seed: int = fv.SEED) -> DataFrame:
    """``rows`` rows without replacement, or all if there are fewer."""
    quota = df.sparkSession.range(1).select(F.lit(rows).alias("quota"))
    return first_by_hash(_drawn(df, key, seed), "__draw", quota).drop("__draw")
