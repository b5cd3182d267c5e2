"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from firnline import schemas
from firnline.catalog.cleaning import RAW_TEXT, _sql_columns
from firnline.catalog.registry import query, rounded
from firnline.catalog.tables import Tables
from firnline.session import shared_folder
from firnline.sources import readers, writers


def _folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _csv_cell(column: str) -> str:
    # A cell of white space keeps it; none of the NA tokens occurs in these tables but ''.
    return f"nullif({column}, '')"


@query("scan_csv", f"select {_sql_columns(_csv_cell)} from v_raw")
def _(t: Tables):
    path = _folder(t, "reports-csv")
    t.raw_reports.select(*RAW_TEXT).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return readers.csv(t.spark, path, schemas.RAW_REPORTS)


@query("sink_table", """
  select "Observation ID", strftime("Date", '%Y-%m-%d %H:%M:%S') as "Date", "Longitude", latitude,
    "Area", avalanche_size, avalanche_occurred from v_reports""")
def _(t: Tables):
    path = _folder(t, "reports")
    kept = t.reports.select(
        "Observation ID", "Date", "Longitude", "latitude", "Area", "avalanche_size",
        "avalanche_occurred",
    )
    writers.table(kept, path)
    return rounded(readers.parquet(t.spark, path, kept.schema))


@query("scan_stations_json", """
  select station_id, station_triplet, name, s_lat as latitude, s_lon as longitude, elevation_ft,
    round(case when elevation_ft <> 0 then elevation_ft * 0.3048::double end, 6) as elevation_m,
    '' as county, '' as huc, true as active
  from v_stations where station_no % 7 <> 3
    and s_lat between 36.9 and 41.1 and s_lon between -109.1 and -102.0""")
def _(t: Tables):
    path = _folder(t, "stations-json")
    odd = F.regexp_replace("station_id", "A", "").cast("long") % 7 == 3
    t.stations.select(
        # Some codes lose a part and must be skipped.
        F.when(odd, F.concat("station_id", F.lit(":CO")))
        .otherwise(F.col("station_triplet")).alias("stationTriplet"),
        "name", "latitude", "longitude", F.col("elevation_ft").alias("elevation"),
    ).write.json(path)
    return rounded(readers.stations_json(t.spark, path, multi_line=False))


@query("scan_station_daily", """
  select station_triplet, strftime(day, '%Y-%m-%d') as day, depth_in, swe_in, temp_f from v_daily""")
def _(t: Tables):
    path = _folder(t, "daily")
    writers.station_daily(t.landed_daily, path)
    table = readers.station_daily(t.spark, path)
    return table.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("scan_elevation_grid", """
  select cast("row" // 16 as int) as tile_row, cast(col // 16 as int) as tile_col,
    "row", col, elevation from v_grid""")
def _(t: Tables):
    path = _folder(t, "grid")
    writers.elevation_grid(t.landed_cells, path)
    return readers.elevation_grid(t.spark, path)
