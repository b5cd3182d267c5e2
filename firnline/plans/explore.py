"""The exploration report: each table a lazy DataFrame over clean reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.functions.time import month_start
from firnline.operators import profile


def with_calendar(reports: DataFrame, ts: str = "Date") -> DataFrame:
    return reports.withColumns(
        {
            "year": F.year(ts), "month": F.month(ts), "day_of_year": F.dayofyear(ts),
            "hour": F.hour(ts), "weekday": F.date_format(ts, "EEEE"),
        }
    )


def monthly_timeline(reports: DataFrame, ts: str = "Date") -> DataFrame:
    return reports.groupBy(month_start(F.col(ts)).alias("month")).count().orderBy("month")


def days_per_year(reports: DataFrame, ts: str = "Date") -> DataFrame:
    return reports.groupBy(F.year(ts).alias("year")).agg(
        F.count_distinct(F.to_date(ts)).alias("days")
    )


def report(reports: DataFrame) -> dict[str, DataFrame]:
    """Every table of the exploration, by name."""
    dated = with_calendar(reports)
    known_aspect = dated.filter(F.col("Aspect").isNotNull())
    valid_aspect = dated.filter(F.col("Aspect").isin(fv.COMPASS))
    top5 = profile.in_top_groups(dated, "Area", 5)
    months = list(range(1, 13))
    columns = ["Aspect", "Type", "Trigger", "Area", "avalanche_size"]
    return {
        "missing": profile.missing_profile(reports, reports.columns),
        "completeness": profile.completeness(reports, columns),
        "span": profile.date_span(reports),
        "by_year": profile.value_counts_by_key(dated, "year"),
        "by_month": profile.value_counts_by_key(dated, "month"),
        "by_day_of_year": profile.histogram(dated, "day_of_year", 52),
        "timeline": monthly_timeline(reports),
        "by_region": profile.value_counts(dated, "Area"),
        "by_size": profile.value_counts_by_key(dated, "avalanche_size"),
        "by_aspect": profile.reindexed(
            profile.value_counts(dated, "Aspect"), "Aspect", fv.COMPASS
        ),
        "by_type": profile.value_counts(dated, "Type").limit(10),
        "by_trigger": profile.value_counts(dated, "Trigger", with_null=True),
        "size_by_region": profile.group_stats(dated, "Area", "avalanche_size"),
        "size_by_aspect": profile.reindexed(
            profile.group_stats(known_aspect, "Aspect", "avalanche_size"),
            "Aspect", fv.COMPASS, fill=None,
        ),
        "size_by_month": profile.group_stats(dated, "month", "avalanche_size"),
        "size_box_by_month": profile.boxplot(dated, "month", "avalanche_size"),
        "size_box_by_aspect": profile.boxplot(valid_aspect, "Aspect", "avalanche_size"),
        "count_by_region_month": profile.pivot(
            top5, "Area", "month", months, F.count("avalanche_size"), fill=0, drop_absent=True
        ),
        "size_by_region_month": profile.pivot(
            top5, "Area", "month", months, F.avg("avalanche_size"), drop_absent=True
        ),
        "by_weekday": profile.reindexed(
            profile.value_counts(dated, "weekday"), "weekday", fv.WEEKDAYS, fill=None
        ),
        "by_hour": profile.value_counts_by_key(dated, "hour"),
        "scope": profile.scope_estimate(reports),
        "days_per_year": days_per_year(reports),
        "duplicates": profile.duplicate_count(reports, ["Longitude", "latitude", "Date"]),
        "out_of_bounds": profile.out_of_bounds(reports),
        "insights": profile.insights(reports),
    }
