"""Aggregation queries over reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.catalog.registry import day_text, query, r6, rounded, time_text, with_place
from firnline.catalog.tables import Tables
from firnline.operators import cleaning, model, profile, quantiles
from firnline.operators.nearest import PLACE
from firnline.plans import explore
from firnline.session import stage


@query("agg_count_rows", """
  select cast((select count(*) from v_clean_all) as bigint) as before,
    cast((select count(*) from v_reports) as bigint) as after""")
def _(t: Tables):
    """What was observed while the reports were written."""
    t.reports  # noqa: B018
    return cleaning.observed_row(t.spark, t.report_counts)


@query("agg_value_counts", """
  select "Type", count(*) as count from v_history where "Type" is not null group by 1""")
def _(t: Tables):
    return profile.value_counts(t.history, "Type")


@query("agg_value_counts_with_null", 'select "Trigger", count(*) as count from v_history group by 1')
def _(t: Tables):
    return profile.value_counts(t.history, "Trigger", with_null=True)


@query("agg_value_counts_by_key", """
  select cast(hour("Date") as int) as hour, count(*) as count from v_history group by 1""")
def _(t: Tables):
    return profile.value_counts_by_key(explore.with_calendar(t.history), "hour")


@query("agg_distinct_values", 'select distinct "Trigger" from v_history')
def _(t: Tables):
    return t.history.select("Trigger").distinct()


@query("agg_min_max", """
  select strftime(min("Date"), '%Y-%m-%d %H:%M:%S') as first,
    strftime(max("Date"), '%Y-%m-%d %H:%M:%S') as last, min("Longitude") as west,
    max("Longitude") as east, min(latitude) as south, max(latitude) as north from v_history""")
def _(t: Tables):
    return rounded(t.history.agg(
        F.min("Date").alias("first"), F.max("Date").alias("last"),
        F.min("Longitude").alias("west"), F.max("Longitude").alias("east"),
        F.min("latitude").alias("south"), F.max("latitude").alias("north"),
    ))


@query("agg_date_span", """
  select strftime(min("Date"), '%Y-%m-%d %H:%M:%S') as first,
    strftime(max("Date"), '%Y-%m-%d %H:%M:%S') as last,
    date_sub('day', min("Date"), max("Date")) as days,
    round(cast(date_sub('day', min("Date"), max("Date")) as double) / 365, 6) as years
  from v_history""")
def _(t: Tables):
    return rounded(profile.date_span(t.history))


@query("agg_count_distinct", """
  select count(distinct cast("Date" as date)) as days, count(distinct year("Date")) as years
  from v_history""")
def _(t: Tables):
    return t.history.agg(
        F.count_distinct(F.to_date("Date")).alias("days"),
        F.count_distinct(F.year("Date")).alias("years"),
    )


@query("agg_count_distinct_sketch", """
  select count(*) as reports, true as days_close, true as places_close, true as place_times_close from v_history""")
def _(t: Tables):
    """Sketches per month, merged over all months, against the exact counts: within 2 %."""
    day, place = F.to_date("Date"), F.struct(*PLACE)
    things = {"days": day, "places": place, "place_times": F.struct(*PLACE, "Date")}
    text = {n: F.to_json(F.struct(c.alias("v"))) for n, c in things.items()}
    per_month = stage(profile.distinct_sketches(t.history, text, {"month": F.trunc("Date", "month")}), "sketches")
    exact = t.history.agg(*[F.count_distinct(c).alias(f"exact_{n}") for n, c in things.items()])
    both = profile.distinct_estimates(per_month, list(things)).withColumns(
        {f"exact_{n}": exact.select(f"exact_{n}").scalar() for n in things})
    return both.select(F.col("rows").alias("reports"), *[
        (F.abs(F.col(n) - F.col(f"exact_{n}")) <= 0.02 * F.col(f"exact_{n}")).alias(f"{n}_close") for n in things])


@query("agg_distinct_tuples", 'select distinct "Longitude", latitude, "Area" from v_history')
def _(t: Tables):
    return t.history.select(*PLACE, "Area").distinct()


@query("agg_duplicate_count", """
  select cast(sum(n - 1) as bigint) as duplicates from (
    select count(*) as n from v_reports group by "Longitude", latitude, "Date")""")
def _(t: Tables):
    return profile.duplicate_count(t.reports, [*PLACE, "Date"])


@query("agg_group_stats", """
  select "Area", round(avg(avalanche_size), 6) as mean, median(avalanche_size) as median,
    count(avalanche_size) as count from v_history group by 1""")
def _(t: Tables):
    return rounded(profile.group_stats(t.history, "Area", "avalanche_size"))


@query("agg_scalar_stats", """
  select round(avg(avalanche_size), 6) as mean, median(avalanche_size) as median from v_history""")
def _(t: Tables):
    middle = quantiles.quantiles(t.history, ["avalanche_size"], [0.5]).select("quantile").scalar()
    return rounded(t.history.agg(F.avg("avalanche_size").alias("mean")).withColumn("median", middle))


_DESCRIBED = ["elevation", "slope", "avalanche_size", "snow_depth", "new_snow_24h", "swe", "temp"]


@query("agg_describe", " union all ".join(
    f"""select '{c}' as feature, count({c}) as count, round(avg({c}), 6) as mean,
      round(stddev_samp({c}), 6) as std, round(min({c}), 6) as min,
      round(quantile_cont({c}, 0.25::double), 6) as q25,
      round(quantile_cont({c}, 0.5::double), 6) as q50,
      round(quantile_cont({c}, 0.75::double), 6) as q75, round(max({c}), 6) as max
    from v_positives""" for c in _DESCRIBED))
def _(t: Tables):
    return rounded(quantiles.describe(t.positives, _DESCRIBED))


@query("agg_completeness", " union all ".join(
    f"""select '{c}' as feature, count({c}) as present,
      round(100 * cast(count({c}) as double) / count(*), 6) as percent from v_positives"""
    for c in [*fv.FEATURES, "wind_speed"]))
def _(t: Tables):
    return rounded(profile.completeness(t.positives, [*fv.FEATURES, "wind_speed"]))


@query("agg_missing_profile", """select * from (""" + " union all ".join(
    f"""select '{c}' as feature, count(*) - count("{c}") as missing,
      round(100 * cast(count(*) - count("{c}") as double) / count(*), 6) as percent from v_raw"""
    for c in ["Observation ID", "Date", "Longitude", "latitude", "Aspect", "Area",
              "Destructive Size", "Type", "Trigger"]) + ") where missing > 0")
def _(t: Tables):
    columns = [c for c in t.raw_reports.columns if c != "source_pos"]
    return rounded(profile.missing_profile(t.raw_reports, columns))


@query("agg_failed_count", """
  select cast(count_if(elevation is null) as bigint) as no_elevation,
    cast(count_if(slope is null) as bigint) as no_slope, count(*) as places from v_terrain""")
def _(t: Tables):
    """What was observed while the terrain of the places was written."""
    t.build.terrain  # noqa: B018
    return cleaning.observed_row(t.spark, t.build.terrain_counts)


@query("agg_class_balance", """
  select label, count(*) as count,
    round(100 * cast(count(*) as double) / sum(count(*)) over (), 6) as percent,
    round((select cast(count_if(label = 0) as double) / count_if(label = 1) from v_scores), 6)
      as negatives_per_positive
  from v_scores group by label""")
def _(t: Tables):
    return rounded(profile.class_balance(t.scores, "label"))


@query("agg_reports_per_unit", """
  select round(cast(count(*) as double) / count(distinct cast("Date" as date)), 6) as per_day,
    round(cast(count(*) as double) / (select count(*) from (
      select distinct "Longitude", latitude from v_history)), 6) as per_place
  from v_history""")
def _(t: Tables):
    return rounded(t.history.agg(
        (F.count("*") / F.count_distinct(F.to_date("Date"))).alias("per_day"),
        (F.count("*") / F.count_distinct(*PLACE)).alias("per_place"),
    ))


_TOP5 = """(select "Area" from v_history where "Area" is not null
  group by 1 order by count(*) desc, "Area" limit 5)"""
# The driver's areas number five; a finer one makes the cut bite.
_FINE = """(select *, "Area" || ' ' || cast(month("Date") % 3 as varchar) as fine from v_history
  where "Area" is not null)"""
_TOP5_FINE = f"(select fine from {_FINE} group by 1 order by count(*) desc, fine limit 5)"


def _fine(t: Tables):
    third = (F.month("Date") % 3).cast("string")
    return t.history.filter(F.col("Area").isNotNull()).withColumn(
        "fine", F.concat("Area", F.lit(" "), third)
    )


@query("join_semi_top_groups", f"select source_pos, fine from {_FINE} where fine in {_TOP5_FINE}")
def _(t: Tables):
    return profile.in_top_groups(_fine(t), "fine", 5).select("source_pos", "fine")


_MONTHS = range(1, 13)


@query("agg_pivot_count", f"""select "Area", """ + ", ".join(
    f"""cast(count_if(month("Date") = {m}) as bigint) as "{m}" """ for m in _MONTHS) +
    f'from v_history where "Area" in {_TOP5} group by 1')
def _(t: Tables):
    top = profile.in_top_groups(explore.with_calendar(t.history), "Area", 5)
    return profile.pivot(top, "Area", "month", _MONTHS, F.count("avalanche_size"), fill=0)


@query("agg_pivot_mean", """select "Area", """ + ", ".join(
    f"""round(avg(avalanche_size) filter (where month("Date") = {m}), 6) as "{m}" """
    for m in _MONTHS) + f'from v_history where "Area" in {_TOP5} group by 1')
def _(t: Tables):
    top = profile.in_top_groups(explore.with_calendar(t.history), "Area", 5)
    return rounded(profile.pivot(top, "Area", "month", _MONTHS, F.avg("avalanche_size")))


@query("agg_monthly_timeline", """
  select strftime(date_trunc('month', "Date"), '%Y-%m-%d') as month, count(*) as count
  from v_history group by 1""")
def _(t: Tables):
    return rounded(explore.monthly_timeline(t.history))


@query("agg_distinct_days_per_year", """
  select cast(year("Date") as int) as year, count(distinct cast("Date" as date)) as days
  from v_history group by 1""")
def _(t: Tables):
    return explore.days_per_year(t.history)


def _histogram_sql(source: str, value: str, bins: int, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    match = f"r.{by} = d.{by}" if by else "true"
    own = f"r.{by}, " if by else ""
    return f"""
  select {own}b.bin, round(lo + (hi - lo) * (b.bin - 1) / {bins}, 6) as low,
    round(lo + (hi - lo) * b.bin / {bins}, 6) as high,
    (select count(*) from {source} d where {match} and d.{value} is not null and
      least(cast(floor((d.{value} - lo) / (hi - lo) * {bins}) as int) + 1, {bins}) = b.bin) as count
  from (select {keys}cast(min({value}) as double) as lo, cast(max({value}) as double) as hi
    from {source} {'group by ' + by if by else ''}) r,
    (select cast(unnest(range(1, {bins + 1})) as int) as bin) b"""


@query("agg_histogram", _histogram_sql(
    '(select dayofyear("Date") as day_of_year from v_history)', "day_of_year", 52))
def _(t: Tables):
    return rounded(profile.histogram(explore.with_calendar(t.history), "day_of_year", 52))


@query("agg_histogram_by_label", _histogram_sql("v_scores", "score", 50, by="label"))
def _(t: Tables):
    return rounded(profile.histogram(t.scores, "score", 50, by=["label"]))


@query("agg_boxplot", """
  select month, q1, median, q3, min(case when inside then v end) as whisker_low,
    max(case when inside then v end) as whisker_high,
    cast(count_if(not inside) as bigint) as outliers, count(*) as count
  from (select d.month, d.v, q.q1, q.median, q.q3,
      d.v between q.q1 - 1.5 * (q.q3 - q.q1) and q.q3 + 1.5 * (q.q3 - q.q1) as inside
    from (select cast(month("Date") as int) as month,
        case when source_pos % 41 = 0 then 40 else avalanche_size end as v from v_history) d
    join (select month, quantile_cont(v, 0.25::double) as q1, quantile_cont(v, 0.5::double) as median,
        quantile_cont(v, 0.75::double) as q3
      from (select cast(month("Date") as int) as month,
        case when source_pos % 41 = 0 then 40 else avalanche_size end as v from v_history)
      group by 1) q on q.month = d.month)
  group by 1, 2, 3, 4""")
def _(t: Tables):
    # A few outsized values, so that there are outliers.
    size = F.when(F.col("source_pos") % 41 == 0, 40.0).otherwise(F.col("avalanche_size"))
    return profile.boxplot(
        explore.with_calendar(t.history).withColumn("avalanche_size", size),
        "month", "avalanche_size",
    )


@query("agg_mode", """
  select cast(month("Date") as int) as month, count(*) as count from v_history group by 1
  order by 2 desc, 1 limit 1""")
def _(t: Tables):
    return profile.mode_of(explore.with_calendar(t.history), "month")


@query("agg_out_of_bounds", """
  select cast(count_if(o) as bigint) as outside, count_if(o) = 0 as all_inside from (
    select not (latitude between 36.9 and 41.1 and "Longitude" between -109.1 and -102.0) as o
    from v_history)""")
def _(t: Tables):
    return profile.out_of_bounds(t.history)


@query("agg_scope_estimate", """
  select count(*) as reports, count(distinct cast("Date" as date)) as days,
    (select count(*) from (select distinct "Longitude", latitude from v_history)) as places,
    (select count(*) from (select distinct "Longitude", latitude, "Date" from v_history))
      as place_times,
    count(distinct year("Date")) as years, count(*) * 2 as negatives_wanted,
    count(*) * 3 as training_rows
  from v_history""")
def _(t: Tables):
    return profile.scope_estimate(t.history)


def _mode_sql(value: str, what: str) -> str:
    return (f"(select {what} from (select {value} as v, count(*) as n from v_history "
            f"where {value} is not null group by 1 order by 2 desc, 1 limit 1))")


@query("agg_quality_insights", f"""
  select count(*) as reports, count(distinct cast("Date" as date)) as days,
    count(distinct year("Date")) as years,
    (select count(*) from (select distinct "Longitude", latitude from v_history)) as places,
    count(distinct "Area") as regions, round(avg(avalanche_size), 6) as mean_size,
    round(100 * cast(count("Aspect") as double) / count(*), 6) as aspect_percent,
    round(100 * cast(count("Type") as double) / count(*), 6) as type_percent,
    strftime(min("Date"), '%Y-%m-%d %H:%M:%S') as first,
    strftime(max("Date"), '%Y-%m-%d %H:%M:%S') as last,
    ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][
      {_mode_sql('month("Date")', 'v')}] as peak_month,
    {_mode_sql('month("Date")', 'n')} as peak_month_reports,
    {_mode_sql('"Area"', 'v')} as peak_region, {_mode_sql('"Area"', 'n')} as peak_region_reports,
    {_mode_sql('"Aspect"', 'v')} as peak_aspect, {_mode_sql('"Aspect"', 'n')} as peak_aspect_reports,
    {_mode_sql('avalanche_size', 'v')} as peak_size,
    {_mode_sql('avalanche_size', 'n')} as peak_size_reports
  from v_history""")
def _(t: Tables):
    return rounded(profile.insights(t.history))


@query("agg_balanced_weights", """
  select label, round(sum(w), 6) as total_weight, round(min(w), 6) as weight from (
    select label, cast(count(*) over () as double)
      / (2 * count(*) over (partition by label)) as w from v_scores) group by 1""")
def _(t: Tables):
    return rounded(profile.balanced_weights(t.scores, "label").groupBy("label").agg(
        F.sum("weight").alias("total_weight"), F.min("weight").alias("weight")
    ))


@query("join_reindex_fill", """
  select cast(o as int) as ordinal, weekday, coalesce(n, 0) as count
  from (select unnest(range(0, 7)) as o, unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday',
    'Friday', 'Saturday', 'Sunday']) as weekday)
  left join (select dayname("Date") as w, count(*) as n from v_history
    where dayname("Date") <> 'Tuesday' group by 1) on w = weekday""")
def _(t: Tables):
    # One weekday is left out, so that there is a gap to fill.
    dated = explore.with_calendar(t.history).filter(F.col("weekday") != "Tuesday")
    return profile.reindexed(
        profile.value_counts(dated, "weekday"), "weekday", fv.WEEKDAYS
    )


@query("sort_desc_metric", """
  select "Aspect", mean, cast(row_number() over (order by mean desc, "Aspect") as int) as place
  from (select "Aspect", round(avg(avalanche_size), 6) as mean from v_history
    where "Aspect" is not null group by 1)""")
def _(t: Tables):
    means = rounded(
        profile.group_stats(t.history.filter(F.col("Aspect").isNotNull()), "Aspect",
                            "avalanche_size").select("Aspect", "mean")
    )
    return with_place(means.orderBy(F.desc("mean"), "Aspect"))


@query("limit_head", """
  select source_pos, strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", avalanche_size,
    cast(row_number() over (order by v_history."Date", source_pos) as int) as place from v_history
  order by v_history."Date", source_pos limit 10""")
def _(t: Tables):
    return with_place(rounded(
        t.history.orderBy("Date", "source_pos").limit(10)
        .select("source_pos", "Date", "avalanche_size")
    ))


_FEATURE_SQL = ", ".join(f"round({c}, 6) as {c}" for c in fv.FEATURES)
_ALL_FEATURES = " and ".join(f"{c} is not null" for c in fv.FEATURES)


@query("ml_prepare", f"""
  select "Observation ID", {_FEATURE_SQL}, avalanche_occurred, avalanche_size
  from v_training where {_ALL_FEATURES} and avalanche_size is not null""")
def _(t: Tables):
    return rounded(model.prepare(t.training).select(
        "Observation ID", *fv.FEATURES, "avalanche_occurred", "avalanche_size"
    ))


@query("join_label_by_row", f"""
  select "Observation ID", avalanche_occurred from v_training where {_ALL_FEATURES}""")
def _(t: Tables):
    return model.prepare(t.training, targets=()).select("Observation ID", "avalanche_occurred")


@query("scan_literal_scenarios", f"""
  select name, {_FEATURE_SQL} from (
    select "Observation ID" as name, {', '.join(fv.FEATURES)} from v_positives
    union all select * from (values """ + ", ".join(
        "('" + s[0] + "', " + ", ".join(f"{v}::double" for v in s[1:]) + ")" for s in fv.SCENARIOS
    ) + "))")
def _(t: Tables):
    observed = t.positives.select(F.col("Observation ID").alias("name"), *fv.FEATURES)
    return rounded(observed.unionByName(model.scenarios(t.spark)))
