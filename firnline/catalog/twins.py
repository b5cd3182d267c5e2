"""SQL twins of the tables in ``tables.py``, as common table expressions."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

def code(key: str) -> str:
    return f"(case when {key} % 13 = 5 then 'A' else '' end || {key})"


VIEWS["v_stations"] = f"""
  select {code('s_suppkey')} as station_id, {code('s_suppkey')} || ':CO:STN' as station_triplet,
    s_suppkey as station_no, s_name as name,
    cast(37050 + s_suppkey * 104729 % 3900 as double) / 1000 as s_lat,
    -cast(102050 + s_suppkey * 7919 % 6900 as double) / 1000 as s_lon,
    round_even(s_acctbal, 0) as elevation_ft
  from supplier"""

VIEWS["v_orders"] = """
  select *, o_orderkey as k,
    -cast(102050 + (case when o_custkey // 5 % 25 = 0 then o_custkey // 5 % 10 * 7919
      else o_custkey // 5 * 6007 end) % 6900 as double) / 1000 as lon,
    cast(37050 + (case when o_custkey // 5 % 25 = 0 then o_custkey // 5 % 10 * 104729
      else o_custkey // 5 * 3571 end) % 3900 as double) / 1000 as lat,
    case cast(o_orderkey % 9 as int) when 0 then 'N' when 1 then 'NE' when 2 then 'E'
      when 3 then 'SE' when 4 then 'S' when 5 then 'SW' when 6 then 'W' when 7 then 'NW'
      end as aspect_code,
    case cast(o_orderkey % 7 as int) when 0 then 'SS' when 1 then 'HS' when 2 then 'WL'
      when 3 then 'L' when 4 then 'WS' when 5 then 'C' end as type_code
  from orders"""

VIEWS["v_raw"] = """
  select k as source_pos, cast(k % 5000 as varchar) as "Observation ID",
    case when k % 101 = 0 then null
      when k % 4 = 1 then strftime(timestamp '2022-01-01 08:15:00' + k * 37 % 731 * interval 1 day,
        '%-m/%-d/%Y %-H:%M')
      else strftime(timestamp '2022-01-01 08:15:00' + k * 37 % 731 * interval 1 day,
        '%Y-%m-%d %H:%M:%S') end as "Date",
    case when k % 97 = 0 then ' - ' when k % 89 = 0 then 'abc'
      else ' ' || printf('%.3f', lon) || chr(9) end as "Longitude",
    case when k % 83 <> 0 then printf('%.3f', lat) end as latitude,
    case when k % 9 = 8 and k % 2 = 0 then '-' else aspect_code end as "Aspect",
    case when k % 103 <> 0 then o_orderpriority end as "Area",
    case when k % 11 = 1 then 'R3' when k % 11 = 2 then ' D1.5 ' when k % 11 = 3 then 'D2-D3'
      when k % 11 > 3 then printf('D%.1f', 1 + cast(k % 9 as double) / 2) end
      as "Destructive Size",
    case when k % 7 = 6 then '-' else type_code end as "Type",
    case when o_orderstatus = 'F' then 'N' when o_orderstatus = 'O' then 'U'
      when k % 2 = 1 then 'AS' end as "Trigger"
  from v_orders"""

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _cell(column: str) -> str:
    stripped = _STRIP.format(column)
    return f"case when {stripped} not in ('-', '') then {stripped} end"


VIEWS["v_clean_all"] = f"""
  select * from (
    select source_pos, {_cell('"Observation ID"')} as "Observation ID",
      coalesce(try_cast({_cell('"Date"')} as timestamp),
        strptime({_cell('"Date"')}, '%m/%d/%Y %H:%M')) as "Date",
      try_cast({_cell('"Longitude"')} as double) as "Longitude",
      try_cast({_cell('latitude')} as double) as latitude,
      {_cell('"Aspect"')} as "Aspect", {_cell('"Area"')} as "Area",
      try_cast(nullif(regexp_extract({_cell('"Destructive Size"')}, 'D(\\d+\\.?\\d*)', 1), '')
        as double) as avalanche_size,
      {_cell('"Type"')} as "Type", {_cell('"Trigger"')} as "Trigger", 1 as avalanche_occurred
    from v_raw)
  where "Longitude" is not null and latitude is not null and "Date" is not null
    and avalanche_size is not null and "Area" is not null"""

VIEWS["v_reports"] = """
  select * from v_clean_all where "Trigger" in ('N', 'U') or "Trigger" is null"""

VIEWS["v_history"] = """
  select k as source_pos, cast(k % 5000 as varchar) as "Observation ID",
    o_orderdate + k % 24 * interval 1 hour as "Date",
    case when k % 97 = 0 then lon - 8 else lon end as "Longitude", lat as latitude,
    aspect_code as "Aspect", case when k % 103 <> 0 then o_orderpriority end as "Area",
    1 + cast(k % 9 as double) / 2 as avalanche_size, type_code as "Type",
    case o_orderstatus when 'F' then 'N' when 'O' then 'U' end as "Trigger"
  from v_orders"""

VIEWS["v_daily"] = f"""
  select {code('user_id')} || ':CO:STN' as station_triplet, date '2022-01-01' + n as day,
    case when (user_id + n) % 17 <> 0 then depth_in end as depth_in, swe_in,
    case when (user_id + n) % 19 <> 0 then temp_f end as temp_f
  from (select user_id, cast(event_id * 7919 % 731 as int) as n,
      max(case when event_type <> 'error' then value end) as depth_in,
      min(value) as swe_in, max(value) - 20 as temp_f
    from events group by 1, 2)"""

VIEWS["v_grid"] = """
  select cast(p_partkey // 50 as int) as "row", cast(p_partkey % 50 as int) as col,
    cast(case when p_partkey % 53 = 0 then -32768 when p_partkey % 59 = 0 then null
      when p_partkey // 50 between 10 and 16 and p_partkey % 50 between 10 and 16 then 2000
      else 1500 + p_partkey * 37 % 2800 end as double) as elevation
  from part"""

VIEWS["v_places"] = """select distinct "Longitude", latitude from v_reports"""

VIEWS["v_place_days"] = """
  select distinct "Longitude", latitude, cast("Date" as date) as day from v_reports"""

_LON1, _LAT1 = 'radians("Longitude")', "radians(p.latitude)"
_LON2, _LAT2 = "radians(s.s_lon)", "radians(s.s_lat)"
HAVERSINE = f"""asin(sqrt(least(1, pow(sin(({_LAT2} - {_LAT1}) / 2), 2)
    + cos({_LAT1}) * cos({_LAT2}) * pow(sin(({_LON2} - {_LON1}) / 2), 2)))) * 2 * 6371"""

VIEWS["v_near_all"] = f"""
  select p."Longitude", p.latitude, s.station_id, s.station_triplet, s.name,
    {HAVERSINE} as distance_km,
    row_number() over (partition by p."Longitude", p.latitude order by {HAVERSINE}, s.name) as rn
  from v_places p, v_stations s"""

VIEWS["v_near"] = "select * from v_near_all where rn <= 3"

VIEWS["v_station_lists"] = """
  select "Longitude", latitude, string_agg(station_triplet, ',' order by rn) as nearest_stations,
    string_agg(printf('%.1f', round_even(distance_km, 1)), ',' order by rn) as nearest_distances
  from v_near group by 1, 2"""

VIEWS["v_asked"] = """
  select d."Longitude", d.latitude, d.day, n.rn, n.distance_km, n.station_triplet
  from v_place_days d join v_near n on d."Longitude" = n."Longitude" and d.latitude = n.latitude"""

VIEWS["v_keys"] = "select distinct station_triplet, day from v_asked"


def _readings(name: str, keys: str, future: int = 1) -> None:
    """Views of the look-ups for a table of (station_triplet, day)."""
    VIEWS[f"{name}_window"] = f"""
      select k.station_triplet, k.day, d.day as read_on, d.depth_in, d.swe_in, d.temp_f
      from {keys} k join v_daily d on d.station_triplet = k.station_triplet
        and d.day between k.day - 4 and k.day + {future}"""
    VIEWS[f"{name}_latest"] = f"""
      select * from {name}_window where read_on >= day - 3
      qualify row_number() over (partition by station_triplet, day
        order by read_on = day desc, read_on desc) = 1"""
    VIEWS[f"{name}_ranked"] = f"""
      select *, row_number() over (partition by station_triplet, day order by read_on desc) as rn
      from {name}_window where read_on <= day"""
    VIEWS[f"{name}_change"] = f"""
      select a.station_triplet, a.day, a.depth_in * cast(2.54 as double)
        - b.depth_in * cast(2.54 as double) as new_snow_24h
      from {name}_ranked a join {name}_ranked b
        on a.station_triplet = b.station_triplet and a.day = b.day and a.rn = 1 and b.rn = 2"""
    VIEWS[name] = f"""
      select k.station_triplet, k.day, l.depth_in * cast(2.54 as double) as snow_depth,
        c.new_snow_24h, l.swe_in * cast(2.54 as double) as swe, (l.temp_f - 32) * 5 / 9 as temp
      from {keys} k
      left join {name}_latest l on l.station_triplet = k.station_triplet and l.day = k.day
      left join {name}_change c on c.station_triplet = k.station_triplet and c.day = k.day"""


def idw(value: str) -> str:
    some = f"where {value} is not null"
    return (
        f"coalesce(arg_min({value}, rn) filter ({some} and distance_km = 0), "
        f"sum({value} / nullif(distance_km * distance_km, 0)) "
        f"/ sum(1 / nullif(distance_km * distance_km, 0)) filter ({some})) as {value}"
    )


def _interpolated(name: str, asked: str, readings: str) -> None:
    VIEWS[name] = f"""
      select "Longitude", latitude, a.day,
        {', '.join(idw(m) for m in ('snow_depth', 'new_snow_24h', 'swe', 'temp'))}
      from {asked} a left join {readings} r
        on a.station_triplet = r.station_triplet and a.day = r.day
      group by 1, 2, 3"""


_readings("v_readings", "v_keys")
_interpolated("v_weather", "v_asked", "v_readings")

VIEWS["v_located"] = """
  select "Longitude", latitude,
    cast(floor((cast(41 as double) - latitude) / cast(0.1 as double)) as int) as "row",
    cast(floor(("Longitude" + cast(109 as double)) / cast(0.14 as double)) as int) as col
  from v_places"""


def stencil(name: str, located: str) -> None:
    """Window of the cell each row of ``located`` lies in."""
    z = {}
    for dr in (-1, 0, 1):
        for dc in (-1, 0, 1):
            z[dr, dc] = f"max(case when g.\"row\" - p.\"row\" = {dr} and g.col - p.col = {dc} " \
                        "then g.elevation end)"
    east = f"({z[-1, 1]} + 2 * {z[0, 1]} + {z[1, 1]}) - ({z[-1, -1]} + 2 * {z[0, -1]} + {z[1, -1]})"
    south = f"({z[1, -1]} + 2 * {z[1, 0]} + {z[1, 1]}) - ({z[-1, -1]} + 2 * {z[-1, 0]} + {z[-1, 1]})"
    whole = "count(case when g.elevation <> -32768 then 1 end) = 9"
    VIEWS[f"{name}_window"] = f"""
      select p."Longitude", p.latitude, {z[0, 0]} as centre,
        case when {whole} then {east} end as east, case when {whole} then {south} end as south
      from {located} p left join v_grid g
        on abs(g."row" - p."row") <= 1 and abs(g.col - p.col) <= 1
      group by p."Longitude", p.latitude"""
    VIEWS[f"{name}_gradient"] = f"""
      select *, east / step as dz_dx, south / step as dz_dy from (
        select *, 8 * (111320 * cos(radians(latitude)) + 111320) / 2 * cast(0.14 as double) as step
        from {name}_window)"""
    VIEWS[f"{name}_angle"] = f"""
      select *, case when centre <> -32768 and centre >= -999 then centre end as elevation,
        degrees(atan(sqrt(dz_dx * dz_dx + dz_dy * dz_dy))) as slope,
        case when dz_dx is null then null when dz_dx = 0 and dz_dy = 0 then 180
          else degrees(atan2(dz_dy, -dz_dx)) end as angle
      from {name}_gradient"""
    VIEWS[f"{name}_bearing"] = f"""
      select *, case when angle > 90 then 450 - angle else 90 - angle end as aspect_degrees
      from {name}_angle"""
    VIEWS[name] = f"""
      select "Longitude", latitude, elevation, slope, aspect_degrees,
        {compass('aspect_degrees')} as aspect_cardinal
      from {name}_bearing"""


def compass(bearing: str) -> str:
    names = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
    cases = " ".join(f"when {i} then '{name}'" for i, name in enumerate(names))
    return f"case cast(floor(({bearing} % 360 + 22.5) / 45) as int) % 8 {cases} end"


stencil("v_terrain", "v_located")

VIEWS["v_ids"] = """
  select *, printf('%.6f', "Longitude") || '_' || printf('%.6f', latitude) || '_'
    || strftime("Date", '%Y%m%d_%H%M') as unique_id
  from v_reports"""

VIEWS["v_events"] = """
  select * from v_ids
  qualify row_number() over (partition by unique_id order by source_pos) = 1"""

VIEWS["v_positives"] = """
  select e.unique_id as "Observation ID", e."Date", e."Longitude", e.latitude, e."Area",
    e."Aspect", e."Type", e."Trigger", e.avalanche_size, e.avalanche_occurred,
    t.elevation, t.slope, t.aspect_degrees, t.aspect_cardinal,
    w.snow_depth, w.new_snow_24h, w.swe, w.temp, cast(null as double) as wind_speed,
    l.nearest_stations, l.nearest_distances
  from v_events e
  left join v_terrain t on t."Longitude" = e."Longitude" and t.latitude = e.latitude
  left join v_weather w on w."Longitude" = e."Longitude" and w.latitude = e.latitude
    and w.day = cast(e."Date" as date)
  left join v_station_lists l on l."Longitude" = e."Longitude" and l.latitude = e.latitude"""

VIEWS["v_span"] = """
  select min("Date") as first, max("Date") - interval 10 day as last,
    date_sub('day', min("Date"), max("Date") - interval 10 day) as days
  from v_positives"""

VIEWS["v_place_no"] = """
  select *, row_number() over (order by md5(printf('%.6f', round_even("Longitude", 6)) || '|'
      || printf('%.6f', round_even(latitude, 6)) || '|' || coalesce("Area", '') || '|42')) as place_no
  from (select distinct "Longitude", latitude, "Area" from v_positives)"""

VIEWS["v_draws"] = """
  select draw, cast('0x' || substr(draw, 1, 8) as bigint) % (select count(*) from v_place_no) + 1
      as place_no,
    cast('0x' || substr(draw, 9, 8) as bigint) % (select days + 1 from v_span) as day_no
  from (select md5("Observation ID" || '|' || attempt || '|42') as draw
    from (select "Observation ID", unnest(range(20)) as attempt from v_positives))
  where (select days from v_span) >= 0"""

VIEWS["v_drawn"] = """
  select l."Longitude", l.latitude, l."Area", s.first + d.day_no * interval 1 day as "Date", d.draw
  from v_draws d join v_place_no l using (place_no), v_span s"""

VIEWS["v_tried"] = """
  select * from v_drawn c
  where not exists (select 1 from v_positives p
    where round(p."Longitude", 6) = round(c."Longitude", 6)
      and round(p.latitude, 6) = round(c.latitude, 6)
      and cast(p."Date" as date) = cast(c."Date" as date))"""

VIEWS["v_attempts"] = """
  select * from v_tried
  qualify row_number() over (partition by "Longitude", latitude, "Date" order by draw) = 1"""

VIEWS["v_neg_asked"] = """
  select a."Longitude", a.latitude, a.day, n.rn, n.distance_km, n.station_triplet
  from (select distinct "Longitude", latitude, cast("Date" as date) as day from v_attempts) a
  join v_near n on a."Longitude" = n."Longitude" and a.latitude = n.latitude"""
VIEWS["v_neg_keys"] = "select distinct station_triplet, day from v_neg_asked"
_readings("v_neg_readings", "v_neg_keys")
_interpolated("v_neg_weather", "v_neg_asked", "v_neg_readings")

VIEWS["v_negatives"] = """
  select 'NEG_' || lpad(cast(row_number() over (order by draw) - 1 as varchar), 6, '0')
    as "Observation ID", "Date", "Longitude", latitude, "Area", cast(null as varchar) as "Aspect",
    cast(null as varchar) as "Type", cast(null as varchar) as "Trigger",
    cast(0 as double) as avalanche_size, 0 as avalanche_occurred,
    elevation, slope, aspect_degrees, aspect_cardinal, snow_depth, new_snow_24h, swe, temp,
    cast(null as double) as wind_speed, nearest_stations, nearest_distances
  from (
    select a.*, t.elevation, t.slope, t.aspect_degrees, t.aspect_cardinal,
      w.snow_depth, w.new_snow_24h, w.swe, w.temp, l.nearest_stations, l.nearest_distances
    from v_attempts a
    join v_terrain t on t."Longitude" = a."Longitude" and t.latitude = a.latitude
    join v_neg_weather w on w."Longitude" = a."Longitude" and w.latitude = a.latitude
      and w.day = cast(a."Date" as date)
    join v_station_lists l on l."Longitude" = a."Longitude" and l.latitude = a.latitude
    where w.snow_depth is not null
    qualify row_number() over (order by draw) <= (select count(*) * 2 from v_positives))"""

VIEWS["v_training"] = """
  select * from v_positives union all by name select * from v_negatives"""

VIEWS["v_scores"] = """
  select cast(l_returnflag = 'R' as int) as label,
    round_even((l_quantity / 50 * cast(0.6 as double)
      + case when l_returnflag = 'R' then cast(0.3 as double) else cast(0.1 as double) end)
      * 100, 0) / 100 as score
  from lineitem"""

VIEWS["v_labelled"] = "select doc_id as id, quality as label, toxic from labels"

FEATURES = ["elevation", "slope", "aspect_degrees", "snow_depth", "new_snow_24h", "swe", "temp"]

VIEWS["v_contributions"] = " union all ".join(
    f"""
  select vec_id as id, '{name}' as feature,
    cast(embedding[{9 + i}] as double) * 200 as value,
    case when cast(embedding[{17 + i}] as double) > -0.25 then cast(embedding[{1 + i}] as double)
      else 0 end as shap_value
  from embeddings"""
    for i, name in enumerate(FEATURES)
)

VIEWS["v_predictions"] = """
  select vec_id as id, cast(vec_id * 37 % 101 as double) / 100 as prediction from embeddings"""


def with_views(body: str) -> str:
    """The query with the views it uses, and theirs, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bv_\w+", text)) & VIEWS.keys() - needed:
            needed.add(name)
            visit(VIEWS[name])

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as ({sql})" for n, sql in VIEWS.items() if n in needed)
    return f"with {ctes}\n{body}"
