"""Counts, statistics and distributions that describe a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.operators.cleaning import in_box, quoted
from firnline.operators.nearest import PLACE
from firnline.operators.quantiles import quantiles_by


def value_counts(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value."""
    kept = df if with_null else df.filter(quoted(column).isNotNull())
    return kept.groupBy(quoted(column)).count().orderBy(F.desc("count"), quoted(column))


def value_counts_by_key(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNotNull()).groupBy(quoted(column)).count().orderBy(
        quoted(column)
    )


def reindexed(counts: DataFrame, column: str, order: Sequence[str], fill: int | None = 0):
    """One row per listed value in list order; absent ones get ``fill``, others are dropped."""
    listed = counts.sparkSession.createDataFrame(
        list(enumerate(order)), f"ordinal int, `{column}` string"
    )
    joined = listed.join(counts, column, "left")
    if fill is not None:
        others = [c for c in counts.columns if c != column]
        joined = joined.fillna(fill, subset=others)
    return joined.orderBy("ordinal")


def top_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values; ties go to the smaller value."""
    return value_counts(df, column).limit(n).select(quoted(column))


def in_top_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    # n rows at most are broadcast.
    return df.join(F.broadcast(top_groups(df, column, n)), column, "left_semi")


def date_span(df: DataFrame, ts: str = "Date") -> DataFrame:
    days = F.expr(f"timestampdiff(DAY, min({ts}), max({ts}))")
    return df.agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), days.alias("days"),
        (days / 365.0).alias("years"),
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys are equal."""
    per_key = df.groupBy(*[quoted(k) for k in keys]).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def group_stats(df: DataFrame, group: str | Column, value: str) -> DataFrame:
    """Mean, median and count per group, highest mean first; null is a group."""
    shown = group if isinstance(group, str) else "group"
    grouped = df.select((quoted(group) if isinstance(group, str) else group).alias(shown), quoted(value).alias("__v"))
    found = quantiles_by(grouped, shown, "__v", [0.5], {"mean": F.avg("value"), "count": F.count("value")})
    return found.select(quoted(shown), "mean", F.col("q0").alias("median"), "count").orderBy(F.desc("mean"))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count and percent per column, in one pass."""
    total = F.count("*")
    return _per_column(
        df, columns,
        {"present": lambda c: F.count(c), "percent": lambda c: F.count(c) / total * 100.0},
    )


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percent per column that has nulls, worst first."""
    total = F.count("*")
    return (
        _per_column(
            df, columns,
            {
                "missing": lambda c: F.count_if(c.isNull()),
                "percent": lambda c: F.count_if(c.isNull()) / total * 100.0,
            },
        )
        .filter(F.col("missing") > 0)
        .orderBy(F.desc("percent"), "feature")
    )


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One aggregation over all columns, turned into a row per column."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"),
                     *[make(quoted(c)).alias(n) for n, make in measures.items()])
            for c in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per label, and how many negatives there are per positive."""
    counts = df.groupBy(label).agg(F.count("*").alias("count"))
    # One row per label by now.
    everything = W.partitionBy()
    total = F.sum("count").over(everything)
    per_label = {
        v: F.sum(F.when(F.col(label) == v, F.col("count"))).over(everything) for v in (0, 1)
    }
    return counts.select(
        label, "count", (F.col("count") / total * 100.0).alias("percent"),
        (per_label[0] / per_label[1]).alias("negatives_per_positive"),
    )


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = rows / (labels × rows of the label).

    Totals come from a small aggregate, not from a window over a label's rows.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = W.partitionBy()
    weights = counts.select(
        label,
        (F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))).alias("weight"),
    )
    # One row per class label.
    return df.join(F.broadcast(weights), label)


def pivot(
    df: DataFrame, row: str, column: str, values: Sequence, aggregate: Column,
    fill: int | None = None, drop_absent: bool = False,
) -> DataFrame:
    """Cross-tabulation over a fixed list of column values.

    ``drop_absent`` removes columns whose value never occurs, at the price of a small query over
    the listed values.
    """
    table = df.groupBy(row).pivot(column, list(values)).agg(aggregate)
    if fill is not None:
        table = table.fillna(fill)
    if drop_absent:
        seen = {
            r[0] for r in df.select(column).filter(F.col(column).isin(list(values))).distinct()
            .limit(len(values)).collect()
        }
        table = table.drop(*[str(v) for v in values if v not in seen])
    return table


def histogram(
    df: DataFrame, value: str, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins over [min, max] per group, the last one closed, empty ones included.

    ``by`` must have few groups; their ranges are broadcast.
    """
    ranges = df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    edges = ranges.select(
        *by, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    ).select(
        *by, "bin",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / float(bins)).alias("low"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / float(bins)).alias("high"),
    )
    filled = df.filter(F.col(value).isNotNull())
    if by:
        binned = filled.join(F.broadcast(ranges), [*by])
    else:
        binned = filled.withColumns(
            {"lo": ranges.select("lo").scalar(), "hi": ranges.select("hi").scalar()}
        )
    index = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(
            F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * float(bins)) + 1,
            F.lit(bins),
        )
    )
    counts = (
        binned.withColumn("bin", index.cast("int")).groupBy(*by, "bin")
        .agg(F.count("*").alias("count"))
    )
    return edges.join(counts, [*by, "bin"], "left").fillna(0, subset=["count"])


def boxplot(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at the furthest values within 1.5 IQR, and outlier count per group.

    The whiskers take a third pass, since they depend on the quartiles.
    """
    rows = df.filter(quoted(value).isNotNull())
    box = quantiles_by(rows, group, value, [0.25, 0.5, 0.75]).toDF(group, "q1", "median", "q3")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(box, group).groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count("*").alias("count"),
    )


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value and its count; ties go to the smaller value."""
    return value_counts(df, column).limit(1)


def out_of_bounds(df: DataFrame) -> DataFrame:
    outside = F.count_if(~in_box(F.col("Longitude"), F.col("latitude")))
    return df.agg(outside.alias("outside"), (outside == 0).alias("all_inside"))


def distinct_sketches(df: DataFrame, things: Mapping[str, Column], by: Mapping[str, Column], precision: int = 14) -> DataFrame:
    """(*by, rows, a sketch per thing): what each group needs for approximate counts of distinct things.

    Stored once, sketches of any set of groups can be merged; a sketch is at most 2 ** precision bytes.
    """
    return df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(c, F.lit(precision)).alias(n) for n, c in things.items()],
    )


def distinct_estimates(sketches: DataFrame, things: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, rows, a count per thing): the union of the sketches in each group; off by about 1 % at precision 14."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        *[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in things],
    )


def scope_estimate(df: DataFrame, ts: str = "Date") -> DataFrame:
    """Look-ups and rows a build over these reports implies."""
    return df.agg(
        F.count("*").alias("reports"),
        F.count_distinct(F.to_date(ts)).alias("days"),
        F.count_distinct(*[quoted(c) for c in PLACE]).alias("places"),
        F.count_distinct(*[quoted(c) for c in PLACE], F.col(ts)).alias("place_times"),
        F.count_distinct(F.year(ts)).alias("years"),
        F.floor(F.count("*") * 2.0).cast("long").alias("negatives_wanted"),
        F.floor(F.count("*") * 3.0).cast("long").alias("training_rows"),
    )


def insights(df: DataFrame, ts: str = "Date") -> DataFrame:
    """One row of headline facts, from two passes: plain aggregates, and rows per value of each column.

    The second counts (column, value) pairs, combined before they are shuffled; the number of its values and the most frequent one
    (the smaller of equals) say the rest.
    """
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def of(name: str, value: Column, numeric: bool) -> Column:
        return F.struct(
            F.lit(name).alias("name"), (value.cast("double") if numeric else number).alias("number"),
            (text if numeric else value.cast("string")).alias("text"),
        )

    pairs = F.array(
        of("month", F.month(ts), True), of("region", F.col("Area"), False), of("aspect", F.col("Aspect"), False),
        of("size", F.col("avalanche_size"), True), of("day", F.unix_date(F.to_date(ts)), True),
        of("year", F.year(ts), True),
        of("place", F.concat_ws("|", *[quoted(c).cast("string") for c in PLACE]), False),
    )
    values = df.select(F.inline(pairs)).filter(F.coalesce(F.col("number").cast("string"), "text").isNotNull())
    per_value = values.groupBy("name", "number", "text").agg(F.count("*").alias("n"))
    best = per_value.groupBy("name").agg(
        F.count("*").alias("values"),
        F.min(F.struct((-F.col("n")).alias("less"), "number", "text")).alias("top"),
    )

    def fact(name: str, what: str, kind: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col(what))).cast(kind)

    names = F.array(*[F.lit(m) for m in fv.MONTHS])
    facts = best.agg(
        *[F.coalesce(fact(n, "values", "long"), F.lit(0)).alias(f"{n}_values") for n in ("day", "year", "place", "region")],
        *[fact(n, "top.number", "double").alias(f"{n}_top") for n in ("month", "size")],
        *[fact(n, "top.text", "string").alias(f"{n}_top") for n in ("region", "aspect")],
        *[(-fact(n, "top.less", "long")).alias(f"{n}_rows") for n in ("month", "region", "aspect", "size")],
    )
    total = F.count("*")
    plain = df.agg(
        total.alias("reports"),
        F.avg("avalanche_size").alias("mean_size"),
        (F.count("Aspect") / total * 100.0).alias("aspect_percent"),
        (F.count("Type") / total * 100.0).alias("type_percent"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )
    # One row each: the facts come as one struct.
    return plain.withColumn("__facts", facts.select(F.struct("*")).scalar()).select("*", "__facts.*").select(
        "reports", F.col("day_values").alias("days"), F.col("year_values").alias("years"),
        F.col("place_values").alias("places"), F.col("region_values").alias("regions"),
        "mean_size", "aspect_percent", "type_percent", "first", "last",
        F.try_element_at(names, F.col("month_top").cast("int")).alias("peak_month"),
        F.col("month_rows").alias("peak_month_reports"),
        F.col("region_top").alias("peak_region"), F.col("region_rows").alias("peak_region_reports"),
        F.col("aspect_top").alias("peak_aspect"), F.col("aspect_rows").alias("peak_aspect_reports"),
        F.col("size_top").alias("peak_size"), F.col("size_rows").alias("peak_size_reports"),
    )
