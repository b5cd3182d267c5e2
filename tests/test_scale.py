"""The operators that look at less: merged look-ups, halos, brackets, rounds of draws, cube pairs, nested forests."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline import schemas
from firnline.operators import cleaning, evaluate, explain, grid, model, nearest, negatives, profile, quantiles, terrain, weather
from firnline.sources import writers

FIRST = datetime.date(2023, 11, 20)


# --- look-ups by date -----------------------------------------------------------------------------------------

def plain_look_up(held, day, allow_future):
    """By definition: the day's reading, else the last of [d-3, d+1]; the last two of [d-4, d]."""
    at = lambda n: day + datetime.timedelta(days=n)
    if day in held:
        best = held[day]
    else:
        near = [at(n) for n in range(-3, 2 if allow_future else 1) if at(n) in held]
        best = held[max(near)] if near else (None, None, None)
    two = sorted((at(n) for n in range(-4, 1) if at(n) in held), reverse=True)[:2]
    change = None
    if len(two) == 2 and held[two[0]][0] is not None and held[two[1]][0] is not None:
        change = held[two[0]][0] * 2.54 - held[two[1]][0] * 2.54
    cm = lambda v: None if v is None else v * 2.54
    return cm(best[0]), change, cm(best[1]), None if best[2] is None else (best[2] - 32) * 5 / 9


@pytest.fixture(scope="module")
def readings():
    rng = random.Random(6)
    out = {}
    for s in range(12):
        days = sorted(rng.sample(range(120), rng.choice([3, 20, 60, 110])))
        out[f"s{s}"] = {FIRST + datetime.timedelta(days=d): tuple(rng.choice([None, float(rng.randint(0, 90))]) if rng.random() < 0.3
                                                                 else float(rng.randint(0, 90)) for _ in range(3)) for d in days}
    return out


def daily(spark, readings):
    return spark.createDataFrame([(s, d, *v) for s, held in readings.items() for d, v in held.items()], schemas.STATION_DAILY)


@pytest.mark.parametrize("allow_future", [True, False])
def test_merged_look_ups(spark, readings, allow_future):
    days = [FIRST + datetime.timedelta(days=n) for n in range(-8, 130)]
    keys = spark.createDataFrame([(s, d) for s in readings for d in days], "station_triplet string, day date")
    got = {(r.station_triplet, r.day): r for r in weather.look_up(keys, daily(spark, readings), allow_future).collect()}
    assert len(got) == len(readings) * len(days)
    for (station, day), r in got.items():
        wanted = plain_look_up(readings[station], day, allow_future)
        for ours, plain in zip((r.snow_depth, r.new_snow_24h, r.swe, r.temp), wanted):
            assert ours == (None if plain is None else pytest.approx(plain)), (station, day)


def test_each_day_is_answered_once_and_readings_move_once(spark, readings):
    found = weather.station_days(daily(spark, readings))
    assert found.groupBy(*weather.STATION_DAY).count().filter("count > 1").isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan


def test_bucketed_readings_do_not_move(spark, readings, tmp_path):
    table = writers.station_daily_bucketed(daily(spark, readings), "bucketed_for_test", str(tmp_path / "daily"), 4)
    found = weather.station_days(table, by_station=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    usual = weather.station_days(daily(spark, readings))
    assert sorted(map(str, found.collect())) == sorted(map(str, usual.collect()))
    keys = spark.createDataFrame([(s, FIRST) for s in readings], "station_triplet string, day date")
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.requireAllClusterKeysForCoPartition", "false")):
        spark.conf.set(name, value)
    try:
        plan = weather.look_up(keys, table, buckets=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition"):
            spark.conf.unset(name)
    # From the keys' scan on the plan is the readings' side.
    assert "Exchange" not in plan[plan.index("Scan ExistingRDD"):plan.index("Bucketed: true")]
    spark.sql("drop table bucketed_for_test")


# --- dense terrain --------------------------------------------------------------------------------------------

def test_every_cell_of_the_grid(spark):
    """Equal to the windows asked for cell by cell, across tile edges, gaps, readings below the floor and the border."""
    rng = random.Random(2)
    small = terrain.Grid(x0=-106.0, dx=0.001, y0=40.0, dy=0.001, tile=3)
    data = [(r, c, rng.choice([small.nodata, float("nan"), -2000.0]) if rng.random() < 0.06 else float(rng.randint(1, 9)))
            for r in range(11) for c in range(10) if (r, c) not in {(4, 4), (7, 2)}]
    cells = terrain.tiled(spark.createDataFrame(data, "row int, col int, elevation double"), small)
    got = {(r.row, r.col): r for r in terrain.dense(cells, small).collect()}
    assert got.keys() == {(r, c) for r, c, _ in data}
    places = spark.createDataFrame([(r, c, small.x0 + (c + 0.5) * small.dx, small.y0 - (r + 0.5) * small.dy) for r, c, _ in data],
                                   "r int, c int, Longitude double, latitude double")
    sloped = 0
    for p in terrain.terrain_at(places, cells, small).collect():
        r = got[p.r, p.c]
        sloped += p.slope is not None
        for name in ("elevation", "slope", "aspect_degrees"):
            plain = p[name]
            assert r[name] == (None if plain is None else pytest.approx(plain, abs=1e-9)), (p.r, p.c, name)
        assert r.aspect_cardinal == p.aspect_cardinal
    assert sloped > 20
    plan = terrain.dense(cells, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_tile_of_one_cell(spark):
    for tile in (1, 2, 64):
        small = terrain.Grid(x0=0.0, dx=1.0, y0=9.0, dy=1.0, tile=tile)
        cells = terrain.tiled(spark.createDataFrame([(r, c, float(r * c)) for r in range(4) for c in range(4)],
                                                    "row int, col int, elevation double"), small)
        got = terrain.dense(cells, small).filter("slope is not null").select("row", "col").collect()
        assert sorted(map(tuple, got)) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert terrain.dense(cells.limit(0), small).count() == 0


# --- quantiles ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_brackets_are_exact(spark, accuracy):
    rng = np.random.default_rng(4)
    groups = {"smooth": rng.standard_normal(5000), "ties": rng.integers(0, 5, 5000).astype(float), "one": np.array([7.0]),
              "two": np.array([1.0, 2.0]), "huge": np.concatenate([np.zeros(4000), [1e300, -1e300]]), "none": np.array([])}
    rows = [(g, float(v)) for g, data in groups.items() for v in data] + [("none", None), ("smooth", None)]
    frame = spark.createDataFrame(rows, "feature string, value double").repartition(7)
    asked = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.feature: r for r in quantiles.selected(frame, asked, {"n": F.count("value")}, accuracy).collect()}
    assert got.keys() == groups.keys() and got["none"].n == 0 and got["none"].q0 is None
    for g, data in groups.items():
        for i, p in enumerate(asked):
            if len(data):
                assert got[g][f"q{i}"] == pytest.approx(np.percentile(data, 100 * p), rel=1e-12), (g, p)


def test_many_rows_move_little(spark):
    """A million distinct values: the second pass keeps the brackets only."""
    frame = spark.range(1_000_000).select(F.lit("x").alias("feature"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("value"))
    data = np.arange(1_000_000) * 7919 % 1_000_003
    got = quantiles.selected(frame, [0.25, 0.5]).first()
    assert (got.q0, got.q1) == (np.percentile(data, 25), np.percentile(data, 50))


# --- observed counts and sketches -----------------------------------------------------------------------------

def test_observed_counts_take_no_job(spark, tmp_path):
    frame = spark.range(100).withColumn("k", F.col("id") % 4)
    seen_frame, seen = cleaning.observed(frame, before=F.count("*"), after=F.count_if(F.col("k") == 1))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "write")
    seen_frame.filter("k = 1").write.parquet(str(tmp_path / "kept"))
    spark.sparkContext.setJobGroup("after", "read")
    row = cleaning.observed_row(spark, seen)
    assert not tracker.getJobIdsForGroup("after") and tracker.getJobIdsForGroup("observed")
    assert row.first().asDict() == {"before": 100, "after": 25} and row.dtypes == [("before", "bigint"), ("after", "bigint")]


def test_sketches_merge_within_two_percent(spark):
    frame = spark.range(200_000).select((F.col("id") % 12).alias("month"), (F.col("id") * 31 % 50_021).alias("place"), F.lit(None).alias("none"))
    per_month = profile.distinct_sketches(frame, {"place": F.col("place"), "none": F.col("none").cast("string")}, {"month": F.col("month")})
    assert per_month.count() == 12
    got = profile.distinct_estimates(per_month, ["place", "none"]).first()
    exact = frame.select("place").distinct().count()
    assert abs(got.place - exact) < 0.02 * exact and got.rows == 200_000 and got.none == 0
    halves = profile.distinct_estimates(per_month.withColumn("half", F.col("month") % 2), ["place"], ["half"])
    assert halves.count() == 2


# --- nearest stations -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("shape", ["spread", "clusters", "same spot", "few", "poles"])
def test_cube_pairs_equal_all_pairs(spark, shape):
    rng = random.Random(shape)
    def spot():
        if shape == "clusters":
            at = rng.choice([(-105.0, 40.0), (-104.99, 40.01), (10.0, -30.0)])
            return at[0] + rng.gauss(0, 1e-3), at[1] + rng.gauss(0, 1e-3)
        if shape == "poles":
            return rng.uniform(-180, 180), rng.choice([-1, 1]) * rng.uniform(85, 90)
        return rng.uniform(-109, -102), rng.uniform(37, 41)
    spots = [spot() for _ in range({"few": 2}.get(shape, 700))]
    if shape == "same spot":
        spots = spots[:20] + [spots[0]] * 200
    stations = spark.createDataFrame([(f"i{i:04d}", f"t{i}", f"n{i % 50:02d}", y, x) for i, (x, y) in enumerate(spots)],
                                     "station_id string, station_triplet string, name string, latitude double, longitude double")
    places = spark.createDataFrame(list({*[spot() for _ in range(120)], spots[0]}), "Longitude double, latitude double")
    def rows(method):
        return {(r.Longitude, r.latitude): [(s.distance_km, s.name, s.station_id) for s in r.stations]
                for r in nearest.nearest_stations(places, stations, method=method).collect()}
    assert rows("cubes") == rows("array")


def test_cube_pairs_plan(spark):
    stations = spark.range(300).select(F.col("id").cast("string").alias("station_id"), F.lit("t").alias("station_triplet"),
                                       F.lit("n").alias("name"), (37 + F.rand(1) * 4).alias("latitude"), (-109 + F.rand(2) * 7).alias("longitude"))
    places = spark.range(300).select((-109 + F.rand(3) * 7).alias("Longitude"), (37 + F.rand(4) * 4).alias("latitude"))
    plan = nearest.nearest_stations(places, stations)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 8, plan
    empty = nearest.nearest_stations(places, stations.limit(0))
    assert empty.count() == 300 and empty.filter("stations is not null").isEmpty()
    assert nearest.nearest_stations(places.limit(0), stations).count() == 0


# --- negatives ------------------------------------------------------------------------------------------------

def test_rounds_choose_what_all_attempts_would(spark):
    places = [(-105.0 - i / 100, 39.0 + i / 100) for i in range(30)]
    known = spark.createDataFrame(
        [(f"e{i}", datetime.datetime(2023, 1, 1, 8) + datetime.timedelta(days=i * 7 % 300), *places[i % 30], "a") for i in range(200)],
        "`Observation ID` string, Date timestamp_ntz, Longitude double, latitude double, Area string").cache()
    ground = spark.createDataFrame([(*p, 1.0, 2.0, 3.0, "N") for p in places[:25]],
                                   "Longitude double, latitude double, elevation double, slope double, aspect_degrees double, aspect_cardinal string")
    asked = []

    def sky(days):
        asked.append(days.count())
        # Weather is missing on two days of three.
        return days.withColumn("snow_depth", F.when(F.dayofyear("day") % 3 == 0, 1.0))

    usable, rounds = negatives.usable_draws(known, ground, sky)
    quota = 400
    assert sum(r["usable"] for r in rounds) == usable.count() >= quota and len(rounds) > 1
    assert rounds[0]["from"] == 0 and all(a["to"] == b["from"] for a, b in zip(rounds, rounds[1:]))
    every = negatives.with_terrain(negatives.attempts(known), ground).withColumn("day", F.to_date("Date")).filter(F.dayofyear("day") % 3 == 0)
    first = lambda df: sorted(r.draw for r in df.select("draw").collect())[:quota]
    assert first(usable) == first(every)
    # A third survives, so three draws a negative are needed; all attempts would be ten.
    assert sum(asked) < 0.5 * negatives.attempts(known).count()


# --- forests --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 7)).round(2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.standard_normal(600) * 0.5 > 0).astype(int)
    rows = [(str(i), int(y[i]), *map(float, x[i])) for i in range(600)]
    return spark.createDataFrame(rows, f"`Observation ID` string, {model.LABEL} int, " + ", ".join(f"{c} double" for c in fv.FEATURES))


def test_cut_forests(spark, labelled, tmp_path):
    """Walking stored trees gives what the model itself and a plain walk of its nodes give."""
    fitted = model.train_classifier(labelled, numTrees=7, maxDepth=9, minInstancesPerNode=3)
    fitted.stages[-1].write().save(str(tmp_path / "forest"))
    nodes = explain.forest_nodes(str(tmp_path / "forest"), spark).withColumn("fit", F.lit(5))
    held = labelled.withColumn("fit", F.lit(5))
    got = {(r.trees, r.depth): r for r in grid.nested_counts(held, grid.packed_trees(nodes), [2, 7], [1, 4, 9], fv.FEATURES, model.LABEL).collect()}
    by_tree = {}
    for r in nodes.collect():
        by_tree.setdefault(r.tree, {})[r.id] = r
    rows = labelled.collect()

    def told(tree, row, depth):
        node = by_tree[tree][0]
        while depth and node.left >= 0:
            node = by_tree[tree][node.left if row[fv.FEATURES[node.feature]] <= node.threshold else node.right]
            depth -= 1
        return node.value

    for (trees, depth), r in got.items():
        said = [sum(told(t, row, depth) for t in range(trees)) > trees / 2 for row in rows]
        events = [row[model.LABEL] == 1 for row in rows]
        assert (r.rows, r.events, r.hits, r.alarms) == (
            600, sum(events), sum(a and b for a, b in zip(said, events)), sum(a and not b for a, b in zip(said, events)))
    own = model.score(fitted, labelled).filter("danger").count()
    assert got[7, 9].hits + got[7, 9].alarms == own


def test_search_scores_every_row(labelled):
    settings = {"numTrees": [3, 6], "maxDepth": [2, 5, None], "minInstancesPerNode": [2, 20], "balanced": [True, False]}
    fitted, results = model.tune(labelled, "Observation ID", settings, folds=3)
    rows = results.collect()
    assert len(rows) == 2 * 3 * 2 * 2 and {r.rows for r in rows} == {600}
    assert {r.depth for r in rows} == {2, 5, None} and all(0 <= r.recall <= 1 and 0 <= r.precision <= 1 for r in rows)
    best = max(r.recall for r in rows)
    assert best > 0.7
    assert evaluate.roc_auc(model.score(fitted, labelled).select(F.col(model.LABEL).alias("label"), "score")).first().auc > 0.8


@pytest.mark.parametrize("min_leaf,depth", [(1, 30), (5, 4)])
def test_grown_trees_are_sound(min_leaf, depth):
    """Every tree against its own bootstrap sample: numbers, leaf sizes, shares, and the greatest gain at the root."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 3)).round(1)
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.standard_normal(300) > 0).astype(float)
    w = np.where(y == 1, 2.0, 0.5)
    cuts = grid.cut_points(x)
    bins = np.column_stack([np.searchsorted(t, c) for t, c in zip(cuts, x.T)]).astype(np.uint8)
    assert bins.max() < grid.BINS and all(((x[:, i] <= cuts[i][5]) == (bins[:, i] <= 5)).all() for i in range(3))
    nodes = grid.grown(bins, y, w, 4, depth, min_leaf, 3, np.random.default_rng(9))
    drawn = np.random.default_rng(9).poisson(1.0, (4, 300))
    for t in range(4):
        mine = {int(i): k for k, i in enumerate(nodes["id"]) if nodes["tree"][k] == t}
        assert sorted(mine) == list(range(len(mine)))
        todo, seen = [(0, np.arange(300), 0)], 0
        while todo:
            i, rows, level = todo.pop()
            k, n = mine[i], drawn[t][rows]
            seen += 1
            assert nodes["value"][k] == pytest.approx((n * w[rows] * y[rows]).sum() / max((n * w[rows]).sum(), 1e-300))
            if nodes["left"][k] < 0:
                continue
            assert level < depth
            left = bins[rows, nodes["feature"][k]] <= nodes["bin"][k]
            assert n[left].sum() >= min_leaf and n[~left].sum() >= min_leaf
            todo += [(int(nodes["left"][k]), rows[left], level + 1), (int(nodes["right"][k]), rows[~left], level + 1)]
        assert seen == len(mine)

        def impurity(side):
            m, h = (drawn[t] * w)[side].sum(), (drawn[t] * w * y)[side].sum()
            return 2 * h * (1 - h / m) if m else 0.0

        gains = {(f, b): -impurity(bins[:, f] <= b) - impurity(bins[:, f] > b) for f in range(3) for b in range(grid.BINS)
                 if min(drawn[t][bins[:, f] <= b].sum(), drawn[t][bins[:, f] > b].sum()) >= min_leaf}
        root = mine[0]
        assert gains[int(nodes["feature"][root]), int(nodes["bin"][root])] == pytest.approx(max(gains.values()))


def test_leaves_in_several_passes(spark, labelled, tmp_path, monkeypatch):
    fitted = model.train_classifier(labelled, numTrees=5, maxDepth=6, minInstancesPerNode=5)
    model.save(fitted, str(tmp_path / "m"), 0.5)
    scored = model.score(fitted, labelled)
    whole = explain.explain(fitted, f"{tmp_path}/m/model", scored, "Observation ID")
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "hashpartitioning" not in plan
    first = {(r["Observation ID"], r.feature): r.shap_value for r in whole.collect()}
    monkeypatch.setattr(explain, "LEAVES_PER_PASS", 20)
    monkeypatch.setattr(explain, "LEAVES_PER_TABLE", 7)
    again = {(r["Observation ID"], r.feature): r.shap_value
             for r in explain.explain(fitted, f"{tmp_path}/m/model", scored, "Observation ID").collect()}
    assert first.keys() == again.keys() and len(first) == 600 * 7
    assert all(math.isclose(first[k], again[k], abs_tol=1e-12) for k in first)
    closes = {r["Observation ID"]: r.score for r in scored.collect()}
    base = whole.first().base_value
    for name, score in closes.items():
        assert sum(first[name, f] for f in fv.FEATURES) + base == pytest.approx(score, abs=1e-6)


# --- threshold curves -----------------------------------------------------------------------------------------

def test_even_thresholds_are_placed_exactly(spark):
    ordered = evaluate.evenly_spaced(0.1, 0.9, 50)
    values = [*ordered, *[np.nextafter(t, s) for t in ordered for s in (0, 1)], 0.0, 1.0, -5.0, 5.0, float("nan"), None, 0.5]
    frame = spark.createDataFrame([(None if v is None else float(v),) for v in values], "score double")
    got = [r[0] for r in frame.select(evaluate._reached(ordered)).collect()]
    wanted = [0 if v is None else len(ordered) if math.isnan(v) else sum(v >= t for t in ordered) for v in values]
    assert got == wanted
