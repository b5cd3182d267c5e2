"""What must not grow faster than the tables: candidates of places, draws that cannot be used, trees sent to rows."""

import datetime
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.operators import grid, nearest, negatives


def test_the_array_method_compares_each_place_with_few_stations(spark, monkeypatch):
    rng = random.Random(5)
    stations = spark.createDataFrame([(f"{i}", f"{i}:T", f"n{i % 40}", rng.uniform(-109, -102), rng.uniform(37, 41)) for i in range(3000)],
                                     "station_id string, station_triplet string, name string, longitude double, latitude double")
    places = spark.createDataFrame([(rng.uniform(-109, -102), rng.uniform(37, 41)) for _ in range(500)], "Longitude double, latitude double")
    seen = []
    compare = nearest._by_array
    monkeypatch.setattr(nearest, "_by_array", lambda left, here, spots, k: seen.append(
        left.join(here, ["level", "p_cube"]).join(spots, ["level", "s_cube"]).count()) or compare(left, here, spots, k))
    got = nearest.nearest_stations(places, stations, method="array").collect()
    assert 500 * 3 <= seen[0] <= 500 * nearest.FEW_STATIONS
    rows = {r[:2]: r.stations for r in nearest.nearest_stations(places, stations).collect()}
    assert rows == {r[:2]: r.stations for r in got} and len(rows) == 500


def test_the_array_method_without_stations(spark):
    stations = spark.createDataFrame([], "station_id string, station_triplet string, name string, longitude double, latitude double")
    places = spark.createDataFrame([(-105.0, 40.0)], "Longitude double, latitude double")
    assert nearest.nearest_stations(places, stations, method="array").first().stations == []


EVENT = "`Observation ID` string, Longitude double, latitude double, Area string, Date timestamp_ntz"


def _events(spark, n=60):
    rng = random.Random(9)
    first = datetime.datetime(2024, 1, 1, 8)
    return spark.createDataFrame([(f"e{i}", -105.0 - i % 6 / 100, 40.0, "a" if i % 4 else None, first + datetime.timedelta(days=rng.randint(0, 300)))
                                  for i in range(n)], EVENT)


def test_weather_is_only_looked_up_where_there_can_be_any(spark):
    """Two of six places answer: the draws kept are those of a search that asks everywhere."""
    events, asked = _events(spark).cache(), []
    ground = events.select(*nearest.PLACE).distinct().withColumn("elevation", F.lit(1.0))

    def sky(place_days):
        asked.append(place_days.filter("longitude < -105.015").count())
        return place_days.withColumn("snow_depth", F.when(F.col("Longitude") > -105.015, F.dayofyear("day").cast("double")))

    every, _ = negatives.usable_draws(events, ground, sky)
    assert sum(asked) > 0
    asked.clear()
    answering = ground.select(*nearest.PLACE).filter("longitude > -105.015")
    some, rounds = negatives.usable_draws(events, ground, sky, answering=answering)
    assert sum(asked) == 0
    wanted = 120
    first = [sorted(map(tuple, df.select("draw", *nearest.PLACE, "Area", "Date", "elevation", "snow_depth").collect()))[:wanted] for df in (every, some)]
    assert first[0] == first[1] and len(first[0]) > 20


def test_places_that_answer(spark):
    from firnline.plans.features import FeatureBuild
    build = FeatureBuild(None, None, None, None, None, [])
    places = [(-105.0, 40.0, ["a", "b"]), (-105.1, 40.0, ["b", "c"]), (-105.2, 40.0, ["c"]), (-105.3, 40.0, None)]
    build.__dict__["nearest"] = spark.createDataFrame(
        [(x, y, s and [(t,) for t in s]) for x, y, s in places], "Longitude double, latitude double, stations array<struct<station_triplet string>>")
    build.__dict__["readings"] = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0)], "station_triplet string, snow_depth double")
    assert sorted(r[0] for r in build.answering.collect()) == [-105.2, -105.1, -105.0]


def test_draws_move_once_for_known_events_and_repeats(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = _events(spark)
        drawn = negatives._draws(events, 2.0, 42, 10)
        base = drawn._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        plan = negatives.attempts(events)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The draws once, the known events once or twice.
    assert 2 <= plan.count("Exchange hashpartitioning") - base <= 3, plan
    assert dict(drawn.dtypes)["draw"] == "binary"


def test_grown_trees_are_packed_where_they_grow(spark):
    """As the rows of all nodes, shuffled and collected, would be."""
    gen = np.random.default_rng(3)
    x = gen.normal(size=(400, len(fv.FEATURES)))
    cuts = grid.cut_points(x)
    bins = np.column_stack([np.searchsorted(t, c) for t, c in zip(cuts, x.T)]).astype(np.uint8)
    event = (x[:, 0] + gen.normal(size=400) > 0).astype(float)
    nodes = grid.grown(bins, event, np.ones(400), 4, 6, 5, 3, gen)
    batch = grid.packed(nodes, 2, 10, 4, cuts).to_pylist()
    rows = [(2, int(t) + 10, int(i), int(a), int(b), int(f), float(cuts[f][k]) if f >= 0 else None, float(v))
            for t, i, a, b, f, k, v in zip(*(nodes[c] for c in ("tree", "id", "left", "right", "feature", "bin", "value")))]
    plain = grid.packed_trees(spark.createDataFrame(
        rows, "fit int, tree int, id int, left int, right int, feature int, threshold double, value double")).collect()
    assert batch == sorted((r.asDict() for r in plain), key=lambda r: r["tree"])
    forest = pa.Table.from_pylist(batch[::-1])
    for tree, wanted in zip(grid._in_order(forest), batch):
        assert np.array_equal(grid.walk(x, tree, [1, 3, 9]), grid.walk(x, wanted, [1, 3, 9]))


def test_trees_are_sent_to_few_groups():
    """All trees of a fit go to every batch of its rows: 60 times sf0.1 hold about 255,000 rows a fold."""
    assert 255_000 / grid.ROWS_PER_BATCH <= 2
