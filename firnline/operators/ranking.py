"""Order-dependent results without a single-task window.

A window with no partition key, or with one as coarse as a label, sends all its rows to one task.
Here rows carry a *bucket* that grows with the sort order and takes few distinct values (a hash
prefix, a slice of a score range). Totals per bucket are small whatever the data size; their
running sum gives each bucket its starting offset, and the window runs inside buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# 16**4 buckets: their totals stay a few MB, and 10**12 rows put 15 million in each.
HASH_DIGITS = 4


def running_totals(
    df: DataFrame,
    bucket: str,
    order: Sequence[str],
    measures: Sequence[str],
    within: Sequence[str] = (),
    descending: bool = False,
    suffix: str = "_running",
) -> DataFrame:
    """Add the inclusive running sum of each measure in the given order.

    ``bucket`` must be monotone in ``order`` and have a bounded number of values, ``within`` a
    bounded number of groups: the per-bucket totals are broadcast on that ground. ``order`` must
    be unique inside ``within``.
    """
    def sort(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    earlier = W.partitionBy(*within).orderBy(sort(bucket)).rowsBetween(W.unboundedPreceding, -1)
    keys = [*within, bucket]
    offsets = (
        df.groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *keys,
            *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"__{m}") for m in measures],
        )
    )
    inside = (
        W.partitionBy(*keys).orderBy(*map(sort, order)).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        df.join(F.broadcast(offsets), keys)
        .withColumns(
            {m + suffix: F.sum(m).over(inside) + F.col(f"__{m}") for m in measures}
        )
        .drop(*[f"__{m}" for m in measures])
    )


def hash_order(*parts: Column | str) -> Column:
    """Hex digest of the parts: a repeatable random order shared with other SQL engines."""
    return F.md5(F.concat_ws("|", *parts))


def position_by_hash(
    df: DataFrame, digest: str, name: str = "position", within: Sequence[str] = ()
) -> DataFrame:
    """Number rows 1, 2, … by a unique digest, separately in each of a few groups."""
    numbered = df.withColumns(
        {"__bucket": F.substring(digest, 1, HASH_DIGITS), "__one": F.lit(1).cast("long")}
    )
    ranked = running_totals(numbered, "__bucket", [digest], ["__one"], within, suffix="_pos")
    return ranked.withColumnRenamed("__one_pos", name).drop("__bucket", "__one")


def last_digests(df: DataFrame, digest: str, quotas: DataFrame, within: Sequence[str] = ()):
    """Digest of the row that fills each group's ``quota``, found without sorting all rows.

    Bucket totals name the one prefix the quota is filled in, and only that bucket is ranked.
    Groups whose quota is zero or above their row count are absent. ``quotas`` has one row per
    group, few groups; without groups it is a single row.
    """
    # `quotas` and the totals are small by construction: groups × buckets at most.
    bucketed = df.select(*within, digest, F.substring(digest, 1, HASH_DIGITS).alias("__bucket"))
    upto = W.partitionBy(*within).orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)
    totals = (
        bucketed.groupBy(*within, "__bucket")
        .agg(F.count("*").alias("__n"))
        .withColumn("__end", F.sum("__n").over(upto))
    )
    if within:
        quoted = totals.join(F.broadcast(quotas.select(*within, "quota")), [*within])
    else:
        quoted = totals.withColumn("quota", quotas.select("quota").scalar())
    edge = (
        quoted.withColumn("__left", F.col("quota") - (F.col("__end") - F.col("__n")))
        .filter((F.col("__left") > 0) & (F.col("__left") <= F.col("__n")))
        .select(*within, "__bucket", "__left")
    )
    inside = W.partitionBy(*within, "__bucket").orderBy(digest)
    return (
        bucketed.join(F.broadcast(edge), [*within, "__bucket"])
        .withColumn("__pos", F.row_number().over(inside))
        .filter(F.col("__pos") == F.col("__left"))
        .select(*within, F.col(digest).alias("last"))
    )


def first_by_hash(df: DataFrame, digest: str, quotas: DataFrame) -> DataFrame:
    """The rows with the smallest digests, as many as the single row of ``quotas`` says.

    A plain filter once the last digest to keep is known: the rows themselves are never moved.
    The input is read three times, so it should be cheap to recompute or staged.
    """
    last = last_digests(df, digest, quotas).select("last").scalar()
    # Nothing fills the quota when everything fits, or when nothing is wanted.
    wanted = quotas.select("quota").scalar() > 0
    return df.filter(wanted & (F.col(digest) <= F.coalesce(last, F.lit("~"))))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark keeps one row per key in each map task before it shuffles (``WindowGroupLimit``), so a
    key that holds much of the input stays cheap.
    """
    return smallest_per_key(df, keys, order, 1)


def smallest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int,
    rank: str | None = None,
) -> DataFrame:
    """The first ``k`` rows of every key, optionally with their rank."""
    position = rank or "__rank"
    ranked = df.withColumn(
        position, F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    ).filter(F.col(position) <= k)
    return ranked if rank else ranked.drop(position)
