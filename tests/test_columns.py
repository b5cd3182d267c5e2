"""Column functions against hand-worked values."""

import math

import pytest
from pyspark.sql import functions as F

from firnline.functions import measure, text
from firnline.functions.time import to_time


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_strip_and_placeholders(spark):
    cells = [(" a\t",), (" -\n",), ("",), (" \t",), (None,), ("b c",)]
    got = values(spark, cells, "x string", text.cell(F.col("x")),
                 text.null_if_in(text.strip(F.col("x")), ["-", ""]))
    assert [g[0] for g in got] == ["a", None, None, None, None, "b c"]
    assert all(a == b for a, b in got)


def test_numbers(spark):
    cells = [(" -106.1 ",), ("-",), ("",), ("abc",), (None,), ("1e2",), ("12d",), ("NaN",),
             ("0x1p3",), (".5",), ("Infinity",)]
    got = [g[0] for g in values(spark, cells, "x string", text.to_number(F.col("x")))]
    assert got == [-106.1, None, None, None, None, 100.0, None, None, None, 0.5, None]


def test_sizes(spark):
    cells = [("D1",), ("D2.5",), ("D3-D4",), ("R3",), (None,), ("x D2",)]
    got = [g[0] for g in values(spark, cells, "x string", text.destructive_size(F.col("x")))]
    assert got == [1.0, 2.5, 3.0, None, None, 2.0]


def test_dates(spark):
    frame = spark.createDataFrame([("2024-01-02 03:04:05",), (None,), ("soon",)], "x string")
    lenient = [r[0] for r in frame.select(to_time(F.col("x"), strict=False)).collect()]
    assert lenient[0].isoformat() == "2024-01-02T03:04:05" and lenient[1:] == [None, None]
    with pytest.raises(Exception, match="not a date"):
        frame.select(to_time(F.col("x"))).collect()


def test_rounding_is_half_even(spark):
    rows = [(0.25, 1), (0.35, 1), (2.5, 0), (-0.25, 1), (-106.12345, 4)]
    frame = spark.createDataFrame(rows, "x double, d int")
    for (x, d), (got,) in zip(rows, frame.select("x").collect()):
        rounded = frame.filter(F.col("x") == x).select(
            measure.round_half_even(F.col("x"), d)
        ).first()[0]
        assert rounded == round(x * 10**d) / 10**d


def test_units(spark):
    got = values(spark, [(10.0,), (0.0,), (None,)], "x double", measure.inches_to_cm(F.col("x")),
                 measure.fahrenheit_to_celsius(F.col("x")), measure.feet_to_metres(F.col("x")))
    assert got[0][0] == 25.4 and got[0][2] == pytest.approx(3.048)
    assert got[1] == (0.0, pytest.approx(-160 / 9), None) and got[2] == (None, None, None)


@pytest.mark.parametrize("angle, bearing, name", [
    (-180, 270, "W"), (-90, 180, "S"), (-45, 135, "SE"), (0, 90, "E"), (45, 45, "NE"),
    (90, 0, "N"), (135, 315, "NW"), (180, 270, "W"),
])
def test_bearings(spark, angle, bearing, name):
    made = measure.bearing_of_angle(F.col("a"))
    assert values(spark, [(float(angle),)], "a double", made, measure.compass_name(made)) == [
        (float(bearing), name)
    ]


def test_compass_edges(spark):
    cells = [(22.4,), (22.5,), (337.5,), (359.9,), (360.0,), (None,)]
    got = [g[0] for g in values(spark, cells, "b double", measure.compass_name(F.col("b")))]
    assert got == ["N", "NE", "N", "N", "N", None]


def test_flat_ground_faces_west(spark):
    got = values(spark, [(0.0, 0.0), (None, None)], "x double, y double",
                 measure.bearing_of_gradient(F.col("x"), F.col("y")))
    assert got == [(270.0,), (None,)]


def test_haversine(spark):
    rows = [(-106.0, 39.0, -106.0, 39.0), (-106.0, 39.0, -105.0, 40.0)]
    got = values(spark, rows, "a double, b double, c double, d double",
                 measure.haversine_km(*[F.col(c) for c in "abcd"]))
    lon, lat = math.radians(1), math.radians(1)
    a = math.sin(lat / 2) ** 2 + math.cos(math.radians(39)) * math.cos(math.radians(40)) * math.sin(
        lon / 2) ** 2
    assert got[0][0] == 0.0
    assert got[1][0] == pytest.approx(2 * 6371 * math.asin(math.sqrt(a)), abs=1e-9)


def test_texts(spark):
    ts = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    got = values(spark, [(-106.1, 39.25)], "x double, y double",
                 text.event_id(F.col("x"), F.col("y"), ts))
    assert got == [("-106.100000_39.250000_20240102_0304",)]
    codes = [("663:CO:SNX",), ("663:CO",), ("a:b:c:d",), (None,)]
    got = values(spark, codes, "t string", text.station_number(F.col("t")))
    assert [g[0] for g in got] == ["663", None, None, None]


def test_risk_levels(spark):
    got = values(spark, [(0.5,), (0.45,), (0.39,)], "p double",
                 measure.risk_level(F.col("p"), F.lit(0.5)),
                 measure.risk_level(F.col("p"), F.lit(0.5), levels=2))
    assert got == [("HIGH DANGER", "HIGH DANGER"), ("MODERATE", "LOW/SAFE"),
                   ("LOW/SAFE", "LOW/SAFE")]


def test_title_case_follows_any_non_letter(spark):
    from firnline.functions.text import title_case

    names = ["new_snow_24h", "swe_2m", "temp", "ÉTÉ_2x3y", "a", "", "x1_y", "3rd's", "__", None]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in frame.select(title_case(F.col("n"))).collect()]
    assert got == [None if n is None else n.replace("_", " ").title() for n in names]
