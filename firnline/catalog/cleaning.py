"""Cleaning, projection and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.catalog.registry import query, r6, rounded, time_text
from firnline.catalog.tables import Tables
from firnline.functions import measure, text
from firnline.functions.time import to_time
from firnline.operators import cleaning, combine
from firnline.operators.nearest import with_station_lists
from firnline.catalog.twins import _STRIP, _cell

RAW_TEXT = ["Observation ID", "Date", "Longitude", "latitude", "Aspect", "Area",
            "Destructive Size", "Type", "Trigger"]


def _sql_columns(make) -> str:
    return ", ".join(f'{make(chr(34) + c + chr(34))} as "{c}"' for c in RAW_TEXT)


@query("clean_trim_strings", f"select source_pos, {_sql_columns(_STRIP.format)} from v_raw")
def _(t: Tables):
    return cleaning.trim_strings(t.raw_reports)


@query("clean_placeholder_null", f"select source_pos, {_sql_columns(_cell)} from v_raw")
def _(t: Tables):
    return cleaning.null_placeholders(cleaning.trim_strings(t.raw_reports))


@query("clean_numeric_coerce", f"""
  select source_pos, try_cast({_cell('"Longitude"')} as double) as "Longitude",
    try_cast({_cell('latitude')} as double) as latitude from v_raw""")
def _(t: Tables):
    cells = cleaning.null_placeholders(cleaning.trim_strings(t.raw_reports))
    return cleaning.coerce_numbers(
        cells.select("source_pos", "Longitude", "latitude"), ["Longitude", "latitude"]
    )


@query("clean_parse_date", """
  select source_pos, strftime(coalesce(try_cast("Date" as timestamp),
      strptime("Date", '%m/%d/%Y %H:%M')), '%Y-%m-%d %H:%M:%S') as parsed,
    strftime(try_cast("Longitude" as timestamp), '%Y-%m-%d %H:%M:%S') as lenient from v_raw""")
def _(t: Tables):
    return t.raw_reports.select(
        "source_pos", to_time(F.col("Date")).alias("parsed"),
        to_time(F.col("Longitude"), strict=False).alias("lenient"),
    ).select("source_pos", time_text("parsed").alias("parsed"),
             time_text("lenient").alias("lenient"))


@query("clean_drop_nulls", """
  select source_pos, "Longitude", latitude, "Area" from v_raw
  where "Longitude" is not null and latitude is not null and "Area" is not null""")
def _(t: Tables):
    return t.raw_reports.select("source_pos", "Longitude", "latitude", "Area").dropna(
        subset=["Longitude", "latitude", "Area"]
    )


@query("extract_size", """
  select source_pos, try_cast(nullif(regexp_extract("Destructive Size", 'D(\\d+\\.?\\d*)', 1), '')
    as double) as avalanche_size from v_raw""")
def _(t: Tables):
    return t.raw_reports.select(
        "source_pos",
        text.destructive_size(F.col("`Destructive Size`")).alias("avalanche_size"),
    )


_CLEAN_SQL = """
  select source_pos, "Observation ID", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date",
    "Longitude", latitude, "Aspect", "Area", avalanche_size, "Type", "Trigger", avalanche_occurred
  from {0}"""


@query("clean_reports", _CLEAN_SQL.format("v_clean_all"))
def _(t: Tables):
    return rounded(cleaning.clean_reports(t.raw_reports, natural_only=False))


@query("filter_trigger", _CLEAN_SQL.format("v_reports"))
def _(t: Tables):
    return rounded(cleaning.clean_reports(t.raw_reports))


@query("project_columns", """
  select "Observation ID", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", "Longitude", latitude,
    "Area", "Aspect", "Type", "Trigger", avalanche_size from v_history""")
def _(t: Tables):
    return rounded(combine.keep_columns(t.history))


@query("project_literal_label", """
  select source_pos, 1 as avalanche_occurred from v_history
  union all select source_pos, 0 from v_history""")
def _(t: Tables):
    keys = t.history.select("source_pos")
    return keys.select("source_pos", F.lit(1).alias("avalanche_occurred")).unionByName(
        keys.select("source_pos", F.lit(0).alias("avalanche_occurred"))
    )


@query("project_event_id", "select source_pos, unique_id from v_ids")
def _(t: Tables):
    return combine.with_event_id(t.reports).select("source_pos", "unique_id")


@query("project_replace_id",
       'select source_pos, unique_id as "Observation ID", avalanche_size from v_ids')
def _(t: Tables):
    return combine.replace_id(combine.with_event_id(t.reports)).select(
        "source_pos", "Observation ID", "avalanche_size"
    )


@query("filter_bbox", """
  select source_pos, "Longitude", latitude from v_history
  where latitude between 36.9 and 41.1 and "Longitude" between -109.1 and -102.0""")
def _(t: Tables):
    return t.history.filter(cleaning.in_box(F.col("Longitude"), F.col("latitude"))).select(
        "source_pos", "Longitude", "latitude"
    )


@query("filter_positive_size", """
  select "Observation ID", avalanche_size from v_training where avalanche_size > 0""")
def _(t: Tables):
    return t.training.filter(F.col("avalanche_size") > 0).select(
        "Observation ID", "avalanche_size"
    )


@query("filter_not_null", """
  select source_pos, "Aspect" from v_clean_all where "Aspect" is not null""")
def _(t: Tables):
    return cleaning.clean_reports(t.raw_reports, natural_only=False).filter(
        F.col("Aspect").isNotNull()
    ).select("source_pos", "Aspect")


@query("filter_in_list", """
  select source_pos, "Aspect" from v_history
  where "Aspect" in ('N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW')""")
def _(t: Tables):
    return t.history.filter(F.col("Aspect").isin(fv.COMPASS)).select("source_pos", "Aspect")


@query("project_round_columns", """
  select "Observation ID", round_even("Longitude", 4) as "Longitude",
    round_even(latitude, 4) as latitude, round_even(avalanche_size / 4, 1) as avalanche_size
  from v_history""")
def _(t: Tables):
    quarter = t.history.withColumn("avalanche_size", F.col("avalanche_size") / 4.0)
    return cleaning.round_columns(quarter).select(
        "Observation ID", "Longitude", "latitude", "avalanche_size"
    )


@query("project_unit_convert", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, round(depth_in * 2.54::double, 6) as depth_cm,
    round((temp_f - 32) * 5 / 9, 6) as temp_c,
    round(case when round_even(depth_in, 0) <> 0 then round_even(depth_in, 0) * 0.3048::double end, 6)
      as elevation_m
  from v_daily""")
def _(t: Tables):
    return rounded(t.daily.select(
        "station_triplet", "day",
        measure.inches_to_cm(F.col("depth_in")).alias("depth_cm"),
        measure.fahrenheit_to_celsius(F.col("temp_f")).alias("temp_c"),
        measure.feet_to_metres(F.rint("depth_in")).alias("elevation_m"),
    ))


@query("project_station_parse", """
  select station_triplet, split_part(station_triplet, ':', 1) as station_id,
    case when len(string_split(station_triplet || ':x', ':')) = 3
      then split_part(station_triplet, ':', 1) end as of_four_parts
  from v_stations""")
def _(t: Tables):
    triplet = F.col("station_triplet")
    return t.stations.select(
        triplet, text.station_number(triplet).alias("station_id"),
        text.station_number(F.concat(triplet, F.lit(":x"))).alias("of_four_parts"),
    )


@query("project_station_lists", "select * from v_station_lists")
def _(t: Tables):
    return with_station_lists(t.build.nearest)


@query("project_safety_band", """
  select station_triplet, case when r < 0.15 then '✓ Excellent (very safe)'
    when r < 0.25 then '✓ Good (safe)' when r < 0.35 then '⚠ Acceptable'
    else '✗ Too risky' end as rating
  from (select station_triplet, cast(count(*) - count(depth_in) as double) / count(*) as r
    from v_daily group by 1)""")
def _(t: Tables):
    """How often a station's depth is missing, rated as misses are."""
    rate = F.count_if(F.col("depth_in").isNull()) / F.count("*")
    return t.daily.groupBy("station_triplet").agg(rate.alias("rate")).select(
        "station_triplet", measure.miss_rate_rating(F.col("rate")).alias("rating")
    )


@query("project_risk_level", """
  select id, case when prediction >= 0.5 then 'HIGH DANGER'
      when prediction >= 0.5::double - 0.1::double then 'MODERATE' else 'LOW/SAFE' end as risk,
    case when prediction >= 0.5 then 'HIGH DANGER' else 'LOW/SAFE' end as risk_of_two
  from v_predictions""")
def _(t: Tables):
    p, threshold = F.col("prediction"), F.lit(0.5)
    return t.predictions.select(
        "id", measure.risk_level(p, threshold).alias("risk"),
        measure.risk_level(p, threshold, levels=2).alias("risk_of_two"),
    )


@query("set_union_by_name", """
  select "Observation ID", avalanche_occurred, avalanche_size, "Aspect" from v_training""")
def _(t: Tables):
    return t.training.select("Observation ID", "avalanche_occurred", "avalanche_size", "Aspect")


@query("fn_string", """
  select source_pos, upper(trim("Area")) as upper_area, replace("Area", '-', '_') as replaced,
    string_split("Area", '-')[1] as first_part,
    regexp_extract("Area", '[A-Z]+', 0) as letters,
    concat_ws(',', "Area", "Type") as joined,
    printf('%.1f', avalanche_size) as one_decimal, printf('NEG_%06d', source_pos) as padded
  from v_reports""")
def _(t: Tables):
    area = F.col("Area")
    return t.reports.select(
        "source_pos", F.upper(F.trim(area)).alias("upper_area"),
        F.replace(area, F.lit("-"), F.lit("_")).alias("replaced"),
        F.split(area, "-")[0].alias("first_part"),
        F.regexp_extract(area, "[A-Z]+", 0).alias("letters"),
        F.concat_ws(",", area, "Type").alias("joined"),
        text.fixed(F.col("avalanche_size"), 1).alias("one_decimal"),
        F.format_string("NEG_%06d", "source_pos").alias("padded"),
    )


@query("fn_date", """
  select source_pos, cast(year("Date") as int) as year, cast(month("Date") as int) as month,
    cast(dayofyear("Date") as int) as day_of_year, cast(hour("Date") as int) as hour,
    dayname("Date") as weekday, strftime("Date", '%Y-%m-%d') as day,
    strftime("Date" - interval 3 day, '%Y-%m-%d %H:%M:%S') as earlier,
    strftime(date_trunc('month', "Date"), '%Y-%m-%d') as month_start
  from v_history""")
def _(t: Tables):
    from firnline.functions.time import month_start, plus_days
    from firnline.plans.explore import with_calendar

    dated = with_calendar(t.history)
    return dated.select(
        "source_pos", "year", "month", "day_of_year", "hour", "weekday",
        F.date_format("Date", "yyyy-MM-dd").alias("day"),
        time_text(plus_days(F.col("Date"), F.lit(-3))).alias("earlier"),
        F.date_format(month_start(F.col("Date")), "yyyy-MM-dd").alias("month_start"),
    )


@query("fn_math", """
  select source_pos, round(sin(radians(latitude)), 6) as sine, round(cos(radians(latitude)), 6)
    as cosine, round(degrees(asin(latitude / 90)), 6) as arcsine,
    round(degrees(atan(latitude)), 6) as arctangent,
    round(degrees(atan2(latitude, "Longitude")), 6) as angle,
    round(sqrt(latitude), 6) as root, round(pow(latitude, 2), 6) as square,
    abs("Longitude") as magnitude,
    round(("Longitude" % 360 + 360) % 360, 6) as modulo, round_even(latitude, 1) as one_decimal,
    cast(floor("Longitude") as bigint) as floored, cast(sign("Longitude") as int) as signum
  from v_history""")
def _(t: Tables):
    lon, lat = F.col("Longitude"), F.col("latitude")
    return t.history.select(
        "source_pos", r6(F.sin(F.radians(lat))).alias("sine"),
        r6(F.cos(F.radians(lat))).alias("cosine"),
        r6(F.degrees(F.asin(lat / 90.0))).alias("arcsine"),
        r6(F.degrees(F.atan(lat))).alias("arctangent"),
        r6(F.degrees(F.atan2(lat, lon))).alias("angle"),
        r6(F.sqrt(lat)).alias("root"), r6(F.pow(lat, F.lit(2.0))).alias("square"),
        F.abs(lon).alias("magnitude"), r6(F.pmod(lon, F.lit(360.0))).alias("modulo"),
        measure.round_half_even(lat, 1).alias("one_decimal"), F.floor(lon).alias("floored"),
        F.signum(lon).cast("int").alias("signum"),
    )


@query("fn_conditional", """
  select source_pos, "Aspect" is null as no_aspect, coalesce("Type", 'unknown') as type_or_default,
    case when avalanche_size > 3 then 'large' when avalanche_size > 2 then 'middle'
      else 'small' end as class,
    case when source_pos % 13 <> 0 then avalanche_size end as number_or_null,
    case when source_pos % 13 <> 0 then avalanche_size else 0 end as number_or_zero
  from v_reports""")
def _(t: Tables):
    size = F.col("avalanche_size")
    noisy = F.when(F.col("source_pos") % 13 == 0, F.lit(float("nan"))).otherwise(size)
    return t.reports.select(
        "source_pos", F.col("Aspect").isNull().alias("no_aspect"),
        F.coalesce("Type", F.lit("unknown")).alias("type_or_default"),
        F.when(size > 3, "large").when(size > 2, "middle").otherwise("small").alias("class"),
        measure.nan_to_null(noisy).alias("number_or_null"),
        F.nanvl(noisy, F.lit(0.0)).alias("number_or_zero"),
    )


@query("fn_array", """
  select "Longitude", latitude, round(min(distance_km), 6) as nearest_km,
    arg_min(station_triplet, rn) as nearest, cast(count(*) as bigint) as stations,
    bool_or(distance_km = 0) as on_station,
    cast(coalesce(min(case when distance_km = 0 then rn end), 0) as bigint) as position_of_zero
  from v_near group by 1, 2""")
def _(t: Tables):
    stations = F.col("stations")
    distances = F.transform(stations, lambda s: s["distance_km"])
    return t.build.nearest.select(
        "Longitude", "latitude", r6(F.element_at(distances, 1)).alias("nearest_km"),
        stations[0]["station_triplet"].alias("nearest"),
        F.size(F.slice(stations, 1, 3)).cast("long").alias("stations"),
        F.exists(distances, lambda d: d == 0).alias("on_station"),
        F.array_position(distances, F.lit(0.0)).alias("position_of_zero"),
    )


@query("fn_json", """
  select event_id, cast(json_extract(props, '$.k') as bigint) as k,
    cast(coalesce(json_extract_string(props, '$.missing'), '0') as bigint) as missing_or_zero
  from events""")
def _(t: Tables):
    parsed = F.from_json("props", "k bigint, missing bigint")
    return t.read("events").select("event_id", parsed.alias("p")).select(
        "event_id", F.col("p.k").alias("k"),
        F.coalesce("p.missing", F.lit(0)).cast("long").alias("missing_or_zero"),
    )
