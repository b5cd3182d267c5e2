"""Look-ups by date, interpolation and nearest stations."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from firnline import schemas
from firnline.operators import nearest, weather

DAY = datetime.date(2024, 2, 10)


def shift(days):
    return DAY + datetime.timedelta(days=days)


def look_up(spark, readings, allow_future=True):
    rows = [("s", shift(o), d, 1.0 + o, 50.0 + o) for o, d in readings]
    daily = spark.createDataFrame(rows, schemas.STATION_DAILY)
    keys = spark.createDataFrame([("s", DAY)], "station_triplet string, day date")
    return weather.look_up(keys, daily, allow_future).first()


@pytest.mark.parametrize("readings, depth, change", [
    ([(-1, 10.0), (0, 12.0)], 12.0, 2.0),
    ([(-2, 8.0), (-1, 10.0), (1, 15.0)], 15.0, 2.0),
    ([(-3, 7.0)], 7.0, None),
    ([(-4, 7.0)], None, None),
    ([(-4, 5.0), (-2, 6.5)], 6.5, 1.5),
    ([(-1, 4.0), (0, None)], None, None),
    ([(1, 9.0)], 9.0, None),
    ([(-5, 1.0), (2, 2.0)], None, None),
])
def test_look_up(spark, readings, depth, change):
    row = look_up(spark, readings)
    cm = lambda v: None if v is None else pytest.approx(v * 2.54)
    assert row["snow_depth"] == cm(depth) and row["new_snow_24h"] == cm(change)


def test_a_null_reading_keeps_its_other_values(spark):
    row = look_up(spark, [(-1, 4.0), (0, None)])
    assert row["swe"] == pytest.approx(2.54) and row["temp"] == pytest.approx(10.0)


def test_without_future(spark):
    assert look_up(spark, [(-2, 8.0), (1, 15.0)], False)["snow_depth"] == pytest.approx(8 * 2.54)
    assert look_up(spark, [(1, 15.0)], False)["snow_depth"] is None


@pytest.mark.parametrize("values, distances, mean", [
    ((10.0, 20.0, 40.0), (1.0, 2.0, 4.0), 17.5 / 1.3125),
    ((None, 20.0, 40.0), (1.0, 2.0, 4.0), 24.0),
    ((None, None, None), (1.0, 2.0, 4.0), None),
    ((7.0, 9.0, 8.0), (0.0, 1.0, 2.0), 7.0),
    ((None, 9.0, 8.0), (0.0, 1.0, 2.0), 8.8),
    ((None, 9.0, 8.0), (0.0, 0.0, 2.0), 9.0),
    ((3.0, 9.0, 8.0), (0.0, 0.0, 2.0), 3.0),
])
def test_inverse_distance_mean(spark, values, distances, mean):
    rows = [(i, v, d) for i, (v, d) in enumerate(zip(values, distances))]
    frame = spark.createDataFrame(rows, "rank int, v double, d double")
    got = frame.agg(
        weather.inverse_distance_mean(F.col("v"), F.col("d"), F.col("rank"))
    ).first()[0]
    assert got == (None if mean is None else pytest.approx(mean))


def test_interpolation_stays_within_its_inputs(spark):
    random.seed(1)
    rows = [(g, i, random.choice([None, random.uniform(0, 9)]), random.uniform(0.1, 50))
            for g in range(200) for i in range(3)]
    frame = spark.createDataFrame(rows, "g int, rank int, v double, d double")
    mean = weather.inverse_distance_mean(F.col("v"), F.col("d"), F.col("rank"))
    off = frame.groupBy("g").agg(mean.alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    assert off.filter((F.col("m") < F.col("lo") - 1e-9) | (F.col("m") > F.col("hi") + 1e-9)
                      | (F.col("m").isNull() != F.col("lo").isNull())).count() == 0


def kilometres(lon1, lat1, lon2, lat2):
    lon1, lat1, lon2, lat2 = map(math.radians, (lon1, lat1, lon2, lat2))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin(
        (lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(a)))


def test_nearest_stations_both_ways(spark):
    random.seed(7)
    spots = [(random.uniform(-109, -102), random.uniform(37, 41)) for _ in range(60)]
    # Eight stations share one spot, some sit at the far ends of the world.
    spots += [(-105.5, 39.5)] * 8 + [(179.9, -10.0), (-179.9, 10.0), (0.0, 89.9), (0.0, -89.9)]
    stations = [(i, f"{i}:CO:STN", f"n{random.random()}", lat, lon)
                for i, (lon, lat) in enumerate(spots)]
    frame = spark.createDataFrame(
        stations,
        "station_id long, station_triplet string, name string, latitude double, longitude double",
    )
    places = [(random.uniform(-109, -102), random.uniform(37, 41)) for _ in range(40)]
    places += [(-105.5, 39.5), (180.0, 0.0), (-180.0, 0.0), (100.0, 89.0), (20.0, -50.0)]
    wanted = spark.createDataFrame(places, "Longitude double, latitude double")
    expected = {
        p: [s[0] for s in sorted(stations, key=lambda s: (
            round(kilometres(*p, s[4], s[3]), 6), s[2]))[:3]]
        for p in places
    }
    for method in ("array", "cubes"):
        found = nearest.nearest_stations(wanted, frame, method=method).collect()
        assert len(found) == len(places)
        for row in found:
            got = [s["station_id"] for s in row["stations"]]
            assert got == expected[(row["Longitude"], row["latitude"])], method


def test_fewer_stations_than_wanted(spark):
    frame = spark.createDataFrame(
        [(1, "1:CO:STN", "a", 39.0, -105.0)],
        "station_id long, station_triplet string, name string, latitude double, longitude double",
    )
    wanted = spark.createDataFrame([(-106.0, 40.0)], "Longitude double, latitude double")
    for method in ("array", "cubes"):
        assert len(nearest.nearest_stations(wanted, frame, method=method).first()["stations"]) == 1
