"""Terrain, nearest-station and weather queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline.catalog.registry import query, r6, rounded, with_place
from firnline.catalog.tables import GRID, GRID_COLS, Tables, _code
from firnline.catalog.twins import HAVERSINE, VIEWS, _readings, compass, stencil
from firnline.functions import measure
from firnline.operators import combine, negatives, ranking, terrain, weather
from firnline.operators.nearest import PLACE, nearest_stations
from firnline.sources import writers

_PLACE_SQL = '"Longitude", latitude'


@query("geo_haversine", f"""
  select "Longitude", latitude, rn as rank, round({HAVERSINE}, 6) as distance_km
  from v_near p join v_stations s using (station_id) where rn <= 3""".replace(
    "from v_near p", "from (select \"Longitude\", latitude, station_id, rn from v_near) p"))
def _(t: Tables):
    pairs = t.build.nearest.select(*PLACE, F.posexplode_outer("stations").alias("rank", "s")).select(
        *PLACE, (F.col("rank") + 1).cast("long").alias("rank"),
        F.col("s.station_id").alias("station_id"),
    )
    spots = t.stations.select(
        "station_id", F.col("longitude").alias("s_lon"), F.col("latitude").alias("s_lat")
    )
    distance = measure.haversine_km(
        F.col("Longitude"), F.col("latitude"), F.col("s_lon"), F.col("s_lat")
    )
    return pairs.join(spots, "station_id").select(
        *PLACE, "rank", r6(distance).alias("distance_km")
    )


@query("geo_point_to_cell", """
  select "Longitude", latitude, case when inside then "row" end as "row",
    case when inside then col end as col
  from (select *, "row" >= 0 and col >= 0 and col < 50
      and "row" < (select max("row") + 1 from v_grid) as inside from v_located)""")
def _(t: Tables):
    rows = t.cells.agg(F.max("row") + 1).scalar()
    return terrain.to_cell(t.places, GRID, rows, F.lit(GRID_COLS))


@query("geo_cell_size_m", """
  select "Longitude", latitude,
    round((111320 * cos(radians(latitude)) + 111320) / 2 * cast(0.14 as double), 6) as metres
  from v_places""")
def _(t: Tables):
    return t.places.select(
        *PLACE, r6(measure.cell_size_m(F.col("latitude"), GRID.dx)).alias("metres")
    )


@query("join_point_grid", """
  select p."Longitude", p.latitude, p."row", p.col, g.elevation
  from v_located p left join v_grid g on g."row" = p."row" and g.col = p.col""")
def _(t: Tables):
    return terrain.at_points(t.places, t.landed_cells, GRID)


@query("terrain_elevation", """
  select "Longitude", latitude, elevation from v_terrain""")
def _(t: Tables):
    found = terrain.at_points(t.places, t.cells, GRID)
    return found.select(
        *PLACE, terrain.elevation_of(F.col("elevation"), GRID).alias("elevation")
    )


@query("join_stencil_3x3", """
  select p."row", p.col, max(case when g."row" = p."row" and g.col = p.col then g.elevation end)
      as centre,
    case when count(case when g.elevation <> -32768 then 1 end) = 9 then
      sum(g.elevation * (g.col - p.col) * (2 - abs(g."row" - p."row"))) end as east,
    case when count(case when g.elevation <> -32768 then 1 end) = 9 then
      sum(g.elevation * (g."row" - p."row") * (2 - abs(g.col - p.col))) end as south
  from (select distinct "row", col from v_located) p
  join v_grid g on abs(g."row" - p."row") <= 1 and abs(g.col - p.col) <= 1
  group by 1, 2""")
def _(t: Tables):
    located = t.places.select(
        GRID.row(F.col("latitude")).alias("row"), GRID.col(F.col("Longitude")).alias("col")
    )
    return terrain.windows(located.distinct(), t.landed_cells, GRID)


@query("terrain_slope_aspect", """
  select "Longitude", latitude, round(slope, 6) as slope, round(aspect_degrees, 6) as aspect_degrees
  from v_terrain""")
def _(t: Tables):
    found = terrain.terrain_at(t.places, t.landed_cells, GRID)
    return rounded(found.select(*PLACE, "slope", "aspect_degrees"))


VIEWS["v_grid_rows"] = """
  select *, east - west as across, west + 2 * z + east as smooth from (
    select "row", col, elevation, z,
      case when lag(col) over side = col - 1 then lag(z) over side end as west,
      case when lead(col) over side = col + 1 then lead(z) over side end as east
    from (select *, case when elevation <> -32768 then elevation end as z from v_grid)
    window side as (partition by "row" order by col))"""
VIEWS["v_grid_gradient"] = """
  select "row", col, elevation, case when smooth is not null and gy is not null then gx / step end as dz_dx,
    case when smooth is not null and gx is not null then gy / step end as dz_dy
  from (select *, 8 * (111320 * cos(radians(cast(41 as double) - ("row" + 0.5::double) * cast(0.1 as double))) + 111320) / 2
        * cast(0.14 as double) as step,
      case when lag("row") over down = "row" - 1 then lag(across) over down end + 2 * across
        + case when lead("row") over down = "row" + 1 then lead(across) over down end as gx,
      case when lead("row") over down = "row" + 1 then lead(smooth) over down end
        - case when lag("row") over down = "row" - 1 then lag(smooth) over down end as gy
    from v_grid_rows window down as (partition by col order by "row"))"""
VIEWS["v_grid_angle"] = """
  select *, case when elevation <> -32768 and elevation >= -999 then elevation end as height,
    degrees(atan(sqrt(dz_dx * dz_dx + dz_dy * dz_dy))) as slope,
    case when dz_dx is null then null when dz_dx = 0 and dz_dy = 0 then 180 else degrees(atan2(dz_dy, -dz_dx)) end as angle
  from v_grid_gradient"""


@query("terrain_grid", f"""
  select "row", col, height as elevation, round(slope, 6) as slope, round(bearing, 6) as aspect_degrees,
    {compass('bearing')} as aspect_cardinal
  from (select *, case when angle > 90 then 450 - angle else 90 - angle end as bearing from v_grid_angle)""")
def _(t: Tables):
    """Every cell of the grid, with a margin of one cell from the neighbouring tiles."""
    return rounded(terrain.dense(t.landed_cells, GRID))


@query("terrain_compass_bearing", """
  select "Longitude", latitude, round(aspect_degrees, 6) as bearing from v_terrain_bearing
  where angle is not null""")
def _(t: Tables):
    located = t.places.withColumns(
        {"row": GRID.row(F.col("latitude")), "col": GRID.col(F.col("Longitude"))}
    )
    found = terrain.windows(located.select("row", "col").distinct(), t.landed_cells, GRID)
    step = measure.cell_size_m(F.col("latitude"), GRID.dx) * 8.0
    bearing = measure.bearing_of_gradient(F.col("east") / step, F.col("south") / step)
    return located.join(found.filter(F.col("east").isNotNull()), ["row", "col"]).select(
        *PLACE, r6(bearing).alias("bearing")
    )


@query("terrain_cardinal", """
  select "Longitude", latitude, aspect_cardinal as name from v_terrain""")
def _(t: Tables):
    found = terrain.terrain_at(t.places, t.landed_cells, GRID)
    return found.select(*PLACE, measure.compass_name(F.col("aspect_degrees")).alias("name"))


_HALF = "cast(0.25 as double)"
_NORTH = f"(cast(41 as double) - latitude - {_HALF}) / cast(0.1 as double)"
_SOUTH = f"(cast(41 as double) - latitude + {_HALF}) / cast(0.1 as double)"
_WEST = f"(\"Longitude\" - {_HALF} + 109) / cast(0.14 as double)"
_EAST = f"(\"Longitude\" + {_HALF} + 109) / cast(0.14 as double)"
VIEWS["v_boxed"] = f"""
  select *, r1 - r0 + 1 as tall, c1 - c0 + 1 as broad from (
    select *, cast(ceil({_NORTH} - 0.5::double) as int) as r0,
      cast(floor({_SOUTH} - 0.5::double) as int) as r1,
      cast(ceil({_WEST} - 0.5::double) as int) as c0,
      cast(floor({_EAST} - 0.5::double) as int) as c1
    from v_places)"""
VIEWS["v_middle"] = """
  select "Longitude", latitude, tall, broad, r0 + tall // 2 as "row", c0 + broad // 2 as col
  from v_boxed"""
stencil("v_patch", "v_middle")


@query("terrain_patch", """
  select "Longitude", latitude, elevation,
    case when ok then round(slope, 6) end as slope,
    case when ok then round(aspect_degrees, 6) end as aspect_degrees,
    case when ok then aspect_cardinal end as aspect_cardinal
  from (select p.*, m.tall >= 3 and m.broad >= 3 and p.elevation is not null as ok
    from v_patch p join v_middle m using ("Longitude", latitude))""")
def _(t: Tables):
    return rounded(terrain.patch(t.places, t.cells, GRID, half_width=0.25))


_KNN_SQL = """
  select "Longitude", latitude, rn as rank, station_id, station_triplet,
    round(distance_km, 6) as distance_km from v_near"""


def _ranked_stations(found):
    return found.select(*PLACE, F.posexplode_outer("stations").alias("rank", "s")).select(
        *PLACE, (F.col("rank") + 1).cast("long").alias("rank"), "s.station_id",
        "s.station_triplet", r6(F.col("s.distance_km")).alias("distance_km"),
    )


@query("join_knn_stations", _KNN_SQL)
def _(t: Tables):
    return _ranked_stations(nearest_stations(t.places, t.stations))


@query("join_knn_stations_array", _KNN_SQL)
def _(t: Tables):
    return _ranked_stations(nearest_stations(t.places, t.stations, method="array"))


@query("win_top_k", """
  select "Longitude", latitude, rn as rank, name, round(distance_km, 6) as distance_km
  from v_near_all where rn <= 5""")
def _(t: Tables):
    near = nearest_stations(t.places, t.stations, k=8).select(*PLACE, F.inline_outer("stations"))
    return ranking.smallest_per_key(
        near, PLACE, ["distance_km", "name"], 5, rank="rank"
    ).select(*PLACE, F.col("rank").cast("long").alias("rank"), "name",
             r6("distance_km").alias("distance_km"))


@query("join_station_lookup", """
  select e.event_id, s.station_triplet, s.name from events e
  join v_stations s on s.station_no = e.user_id""")
def _(t: Tables):
    first = ranking.first_per_key(
        t.stations.select("station_id", "station_triplet", "name"), ["station_id"], ["name"]
    )
    return t.read("events").select("event_id", _code(F.col("user_id")).alias("station_id")).join(
        first, "station_id"
    ).drop("station_id")


def _asked(t: Tables):
    return t.place_days.join(t.build.nearest, PLACE).select(
        *PLACE, "day", F.posexplode_outer("stations").alias("rank", "s")
    ).select(
        *PLACE, "day", "rank",
        F.col("s.station_triplet").alias("station_triplet"),
        F.col("s.distance_km").alias("distance_km"),
    )


@query("join_asof_exact_or_latest", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, round(snow_depth, 6) as snow_depth,
    round(swe, 6) as swe, round(temp, 6) as temp from v_readings""")
def _(t: Tables):
    return rounded(weather.look_up(_asked(t), t.landed_daily).drop("new_snow_24h"))


@query("join_asof_bucketed", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, round(snow_depth, 6) as snow_depth,
    round(new_snow_24h, 6) as new_snow_24h from v_readings""")
def _(t: Tables):
    """The same from a table bucketed by station, which is read without an exchange."""
    found = weather.look_up(_asked(t), t.bucketed_daily, buckets=writers.STATION_BUCKETS)
    return rounded(found.select("station_triplet", "day", "snow_depth", "new_snow_24h"))


_readings("v_past_readings", "v_keys", future=0)


@query("join_asof_without_future", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, round(snow_depth, 6) as snow_depth,
    round(swe, 6) as swe, round(temp, 6) as temp from v_past_readings""")
def _(t: Tables):
    return rounded(weather.look_up(_asked(t), t.landed_daily, allow_future=False).drop("new_snow_24h"))


@query("join_asof_24h_change", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, round(new_snow_24h, 6) as new_snow_24h
  from v_readings""")
def _(t: Tables):
    return rounded(
        weather.look_up(_asked(t), t.landed_daily).select("station_triplet", "day", "new_snow_24h")
    )


@query("join_memo_lookup", """
  select cast(count(*) as bigint) as lookups,
    cast((select count(*) from v_keys) as bigint) as unique_pairs,
    cast(count(*) - (select count(*) from v_keys) as bigint) as repeats
  from v_reports r join v_near n on r."Longitude" = n."Longitude" and r.latitude = n.latitude""")
def _(t: Tables):
    per_report = t.reports.select(*PLACE, F.to_date("Date").alias("day")).join(
        t.build.nearest, PLACE
    )
    return weather.look_up_counts(
        per_report.select("day", F.explode("stations").alias("s")).select(
            F.col("s.station_triplet").alias("station_triplet"), "day"
        )
    )


@query("agg_idw", """
  select "Longitude", latitude, strftime(day, '%Y-%m-%d') as day, round(snow_depth, 6) as snow_depth,
    round(new_snow_24h, 6) as new_snow_24h, round(swe, 6) as swe, round(temp, 6) as temp
  from v_weather""")
def _(t: Tables):
    return rounded(
        weather.interpolate(t.place_days, t.build.nearest, weather.station_days(t.landed_daily))
    )


@query("weather_table", """
  select w."Longitude", w.latitude, strftime(w.day, '%Y-%m-%d') as day,
    round(snow_depth, 6) as snow_depth, round(new_snow_24h, 6) as new_snow_24h,
    round(swe, 6) as swe, round(temp, 6) as temp, cast(null as double) as wind_speed,
    nearest_stations, nearest_distances
  from v_weather w join v_station_lists l
    on w."Longitude" = l."Longitude" and w.latitude = l.latitude""")
def _(t: Tables):
    return rounded(t.build.report_weather)


@query("win_latest_in_window", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day,
    last_value(depth_in) over (partition by station_triplet order by day
      range between interval 3 day preceding and interval 1 day following) as latest
  from v_daily""")
def _(t: Tables):
    # A station has one row per day, so a partition is as long as its record.
    near = W.partitionBy("station_triplet").orderBy(F.unix_date("day")).rangeBetween(-3, 1)
    return t.daily.select(
        "station_triplet", F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.last("depth_in").over(near).alias("latest"),
    )


@query("win_previous_row", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day,
    round(depth_in - lag(depth_in) over (partition by station_triplet order by day), 6) as change
  from v_daily""")
def _(t: Tables):
    by_day = W.partitionBy("station_triplet").orderBy("day")
    return rounded(t.daily.select(
        "station_triplet", "day",
        (F.col("depth_in") - F.lag("depth_in").over(by_day)).alias("change"),
    ))


_REPORT = 'r.source_pos, r."Longitude", r.latitude'


@query("join_terrain_left", f"""
  select {_REPORT}, t.elevation, round(t.slope, 6) as slope, t.aspect_cardinal
  from v_reports r left join v_terrain t
    on t."Longitude" = r."Longitude" and t.latitude = r.latitude""")
def _(t: Tables):
    joined = combine.join_terrain(t.reports, t.build.terrain)
    return rounded(
        joined.select("source_pos", *PLACE, "elevation", "slope", "aspect_cardinal")
    )


@query("join_weather_left", f"""
  select {_REPORT}, strftime(r."Date", '%Y-%m-%d %H:%M:%S') as "Date",
    round(w.snow_depth, 6) as snow_depth, round(w.temp, 6) as temp
  from v_reports r left join v_weather w on w."Longitude" = r."Longitude"
    and w.latitude = r.latitude and w.day = cast(r."Date" as date)""")
def _(t: Tables):
    keyed = t.reports.select("source_pos", *PLACE, "Date")
    # One weather row per report, keys repeated, as a stored weather table would hold them.
    per_report = combine.join_weather_by_day(keyed, t.build.report_weather).drop("source_pos")
    joined = combine.join_weather(keyed, per_report)
    return rounded(joined.select("source_pos", *PLACE, "Date", "snow_depth", "temp"))


@query("dedup_keep_first", """
  select unique_id, source_pos, avalanche_size, "Area" from v_events""")
def _(t: Tables):
    return combine.one_per_event(t.reports, ["source_pos"]).select(
        "unique_id", "source_pos", "avalanche_size", "Area"
    )


_EXAMPLE = """
  select "Observation ID", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", "Longitude", latitude,
    "Area", "Aspect", "Type", "Trigger", avalanche_size, avalanche_occurred, elevation,
    round(slope, 6) as slope, round(aspect_degrees, 6) as aspect_degrees, aspect_cardinal,
    round(snow_depth, 6) as snow_depth, round(new_snow_24h, 6) as new_snow_24h,
    round(swe, 6) as swe, round(temp, 6) as temp, wind_speed, nearest_stations, nearest_distances
  from {0}"""


@query("feature_table", _EXAMPLE.format("v_positives"))
def _(t: Tables):
    return rounded(t.build.positives)


@query("join_cross_candidates", """
  select "Longitude", latitude, "Area", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", draw
  from v_drawn""")
def _(t: Tables):
    return rounded(negatives.draws(t.positives))


@query("join_anti_known_events", """
  select "Longitude", latitude, "Area", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", draw
  from v_tried""")
def _(t: Tables):
    return rounded(negatives.without_known_events(negatives.draws(t.positives), t.positives))


@query("sample_negatives_counts", """
  select cast(count(*) * 2 as bigint) as wanted, cast(count(*) * 20 as bigint) as tried,
    (select count(*) from v_negatives) as made from v_positives""")
def _(t: Tables):
    return negatives.outcome(t.positives, t.training.filter(F.col("avalanche_occurred") == 0))


@query("join_anti_chosen", """
  select "Longitude", latitude, "Area", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", draw
  from v_attempts""")
def _(t: Tables):
    return rounded(negatives.attempts(t.positives))


@query("join_terrain_required", """
  select a.draw, a."Longitude", a.latitude, t.elevation, t.aspect_cardinal
  from v_attempts a join v_terrain t on t."Longitude" = a."Longitude" and t.latitude = a.latitude""")
def _(t: Tables):
    return negatives.with_terrain(negatives.attempts(t.positives), t.build.terrain).select(
        "draw", *PLACE, "elevation", "aspect_cardinal"
    )


@query("sample_negatives", _EXAMPLE.format("v_negatives"))
def _(t: Tables):
    return rounded(t.training.filter(F.col("avalanche_occurred") == 0))


@query("win_negative_ids", """
  select draw, 'NEG_' || lpad(cast(row_number() over (order by draw) - 1 as varchar), 6, '0')
    as "Observation ID" from v_attempts""")
def _(t: Tables):
    return negatives.number_negatives(negatives.attempts(t.positives)).select(
        "draw", "Observation ID"
    )


@query("set_distinct", """
  select distinct "Longitude", latitude, strftime("Date", '%Y-%m-%d') as day from v_reports""")
def _(t: Tables):
    return t.place_days.select(*PLACE, F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("sort_by_name", """
  select station_id, station_triplet, name,
    cast(row_number() over (order by name, station_id) as int) as place from v_stations""")
def _(t: Tables):
    ordered = t.stations.select("station_id", "station_triplet", "name").orderBy("name", "station_id")
    return with_place(ordered)
