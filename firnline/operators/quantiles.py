"""Exact quantiles by sketch-bracketed selection, without holding or storing a column.

One pass builds a mergeable quantile sketch per group. Its error is bounded, so the sketch's values a little below and a
little above each wanted quantile bracket it. A second pass counts what lies below each bracket and gathers, per
distinct value, only what lies inside (all values of a group of at most ``ACCURACY``); the wanted ranks are among those.
Both passes combine before they shuffle, and what moves in the second is the brackets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline.operators.cleaning import quoted

#: The sketch's rank error is 1 / ACCURACY of the rows; brackets reach out three times as far.
ACCURACY = 10_000
REACH = 3.0


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.nanvl(quoted(c).cast("double"), F.lit(None)).alias("value"))
          for c in columns]
    )
    return df.select(F.inline(cells))


def selected(
    values: DataFrame, probabilities: Sequence[float], also: Mapping[str, Column] | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """(feature, *also, q0, q1, …): quantiles of ``value`` per ``feature``, with linear interpolation between neighbouring ranks.

    ``also`` names further aggregates of ``value`` to take in the first pass. Null values count nowhere; a feature
    without values has null quantiles. ``feature`` is not null itself (a struct may hold a null).
    """
    reach = REACH / accuracy
    sides = [(p - reach, p + reach) for p in probabilities]
    asked = sorted({min(max(x, 0.0), 1.0) for pair in sides for x in pair})
    first = values.groupBy("feature").agg(
        F.count("value").alias("__total"),
        F.percentile_approx("value", asked, F.lit(accuracy)).alias("__edges"),
        *[c.alias(n) for n, c in (also or {}).items()],
    )

    def edge(x: float, beyond: float) -> Column:
        if not 0.0 < x < 1.0:
            return F.lit(beyond)
        # Few values are all gathered: there a bracket would be narrower than the step to the next rank.
        return F.when(F.col("__total") > accuracy, F.col("__edges")[asked.index(x)]).otherwise(F.lit(beyond))

    brackets = F.array(*[
        F.struct(F.lit(i).alias("i"), edge(low, float("-inf")).alias("low"), edge(high, float("inf")).alias("high"))
        for i, (low, high) in enumerate(sides)
    ])
    known = values.filter(F.col("value").isNotNull()).join(
        first.select("feature", "__total", brackets.alias("__brackets")), "feature")
    counted = (
        known.select("feature", "value", "__total", F.inline("__brackets")).filter(F.col("value") <= F.col("high"))
        # All that lies below a bracket is one row, null.
        .groupBy("feature", "i", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value"))
        .agg(F.count("*").alias("n"), F.max("__total").alias("total"))
    )
    upto = F.sum("n").over(W.partitionBy("feature", "i").orderBy(F.asc_nulls_first("value")))
    at = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("i") + 1) * (F.col("total") - 1)

    def holds(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("value")))

    found = counted.select("feature", "i", "value", "n", at.alias("at"), upto.alias("upto")).groupBy("feature", "i").agg(
        holds(F.floor("at")).alias("below"), holds(F.ceil("at")).alias("above"), F.max("at").alias("at"))
    # A sketch outside its bound would leave a rank outside its bracket: that is an error, never another value.
    exact = F.when(F.col("below").isNull() | F.col("above").isNull(), F.raise_error(F.lit("a quantile fell outside its bracket"))
                   .cast("double")).otherwise(F.col("below") + (F.col("above") - F.col("below")) * (F.col("at") - F.floor("at")))
    wide = found.select("feature", "i", exact.alias("q")).groupBy("feature").agg(*[
        F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probabilities))])
    return first.drop("__total", "__edges").join(wide, "feature", "left")


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(feature, probability, quantile); a column without values has no row."""
    found = selected(_long(df, columns), probabilities)
    cells = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col(f"q{i}").alias("quantile"))
                      for i, p in enumerate(probabilities)])
    return found.select("feature", F.inline(cells)).filter(F.col("quantile").isNotNull())


def quantiles_by(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float], also: Mapping[str, Column] | None = None
) -> DataFrame:
    """(group, *also, q0, q1, …): the quantiles of a value in every group, null being a group of its own.

    ``also`` are further aggregates, over a column named ``value``; with them, groups without a value have a row too.
    """
    values = df.select(
        F.struct(quoted(group).alias("g")).alias("feature"),
        F.nanvl(quoted(value).cast("double"), F.lit(None)).alias("value"),
    )
    wide = selected(values if also else values.filter(F.col("value").isNotNull()), probabilities, also)
    return wide.select(F.col("feature.g").alias(group), *[c for c in wide.columns if c != "feature"])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each column, a row per column."""
    listed = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    found = selected(_long(df, columns), [0.25, 0.5, 0.75], {
        "count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"),
        "min": F.min("value"), "max": F.max("value"),
    })
    return listed.join(found, "feature", "left").select(
        "feature", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", F.col("q0").alias("q25"),
        F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max"
    )
