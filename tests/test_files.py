"""Sources and sinks."""

import datetime
import json

import pytest

from firnline import schemas
from firnline.operators import terrain
from firnline.sources import readers, writers


def test_csv_missing_tokens(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text(
        "station_id,station_triplet,name,latitude,longitude,elevation_ft,elevation_m,county,huc,"
        "active\n7,7:CO:STN,\"Ab, c\",39.5,-105.5,NA,,null,010203,true\n"
        "8,N/A,None,NaN,-105,9000,2743.2,Grand,nan,false\n")
    rows = readers.csv(spark, str(path), schemas.STATIONS).collect()
    assert tuple(rows[0]) == ("7", "7:CO:STN", "Ab, c", 39.5, -105.5, None, None, None, "010203",
                              True)
    assert tuple(rows[1]) == ("8", None, None, None, -105.0, 9000.0, 2743.2, "Grand", None, False)


def test_csv_bad_number_raises(spark, tmp_path):
    path = tmp_path / "daily.csv"
    path.write_text("station_triplet,day,depth_in,swe_in,temp_f\na,2024-01-01,deep,1,2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.csv(spark, str(path), schemas.STATION_DAILY).collect()


def test_station_payload(spark, tmp_path):
    def record(triplet, lat, lon, name, feet=10000.0):
        return {"stationTriplet": triplet, "name": name, "latitude": lat, "longitude": lon,
                "elevation": feet, "countyName": "Grand", "huc": "0102"}
    payload = [record("2:CO:STN", 39.0, -105.0, "Zed", 0), record("1:CO:STN", 39.0, -105.0, "Ace"),
               record("", 39.0, -105.0, "a"), record(None, 39.0, -105.0, "b"),
               record("3:CO", 39.0, -105.0, "c"), record("4:CO:STN", None, -105.0, "d"),
               record("5:CO:STN", 45.0, -105.0, "e"), record("x:CO:STN", 39.0, -105.0, "f"),
               record("6:CO:STN", 36.9, -109.1, "Mid", None)]
    path = tmp_path / "payload.json"
    path.write_text(json.dumps(payload))
    rows = readers.stations_json(spark, str(path)).collect()
    assert [r["name"] for r in rows] == ["Ace", "Mid", "Zed", "f"]
    assert [r["elevation_m"] for r in rows] == [pytest.approx(3048.0), None, None, pytest.approx(3048.0)]
    assert [r["station_id"] for r in rows] == ["1", "6", "2", "x"]
    assert rows[0]["active"] is True and rows[0]["huc"] == "0102"


def test_daily_range_prunes_months(spark, tmp_path):
    path = str(tmp_path / "daily")
    first = datetime.date(2024, 1, 1)
    rows = [("s", first + datetime.timedelta(days=i), float(i), 0.0, 0.0) for i in range(120)]
    writers.station_daily(spark.createDataFrame(rows, schemas.STATION_DAILY), path)
    read = readers.station_daily(
        spark, path, datetime.date(2024, 2, 10), datetime.date(2024, 3, 5))
    assert read.count() == 25 and read.columns == schemas.STATION_DAILY.names
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_grid_round_trip(spark, tmp_path):
    grid = terrain.Grid(x0=-106.0, dx=0.001, y0=40.0, dy=0.001, tile=4)
    cells = terrain.tiled(
        spark.range(100).selectExpr("int(id / 10) as row", "int(id % 10) as col",
                                    "double(id) as elevation"), grid)
    writers.elevation_grid(cells, str(tmp_path / "grid"))
    back = readers.elevation_grid(spark, str(tmp_path / "grid"))
    assert sorted(back.collect()) == sorted(cells.collect())


def test_table_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    writers.table(frame, str(tmp_path / "p"))
    writers.table(frame, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    writers.table(frame, str(tmp_path / "c"), csv=True)
    assert sorted(map(tuple, readers.csv(spark, str(tmp_path / "c"), frame.schema).collect())) == [
        (1, "a"), (2, None)]
