"""Models are fitted on all training rows, however many there are."""

import hashlib
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.catalog import QUERIES, models, registry
from firnline.operators import grid, model

ROWS = 3_000  # a fifth is held out, more than 2,000 are left


class _Tables(types.SimpleNamespace):
    __hash__ = object.__hash__


def _tables(spark):
    """A training table whose label follows one feature."""
    gen = np.random.default_rng(4)
    x = gen.normal(size=(ROWS, len(fv.FEATURES)))
    label = (x[:, 1] + gen.normal(0, 0.3, ROWS) > 0.4).astype(int)
    rows = [(f"r{i}", int(y), float(y), *map(float, v)) for i, (y, v) in enumerate(zip(label, x))]
    columns = ", ".join(f"{c} double" for c in fv.FEATURES)
    training = spark.createDataFrame(rows, f"`Observation ID` string, {model.LABEL} int, {model.SIZE} double, {columns}")
    return _Tables(spark=spark, training=training)


@pytest.mark.parametrize("name", [
    "ml_train_classifier", "explain_chain", "ml_feature_importance", "ml_holdout_metrics", "ml_score", "ml_score_scenarios",
    "sink_model",
])
def test_the_classifier_is_fitted_on_all_training_rows(spark, monkeypatch, name):
    tables, fitted, fit = _tables(spark), [], model.train_classifier
    monkeypatch.setattr(registry, "open_tables", lambda *_: tables)
    monkeypatch.setattr(fv, "FOREST", {"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 10})

    def counted(train, **settings):
        fitted.append(train.count())
        return fit(train, **settings)

    monkeypatch.setattr(models.model, "train_classifier", counted)
    got = QUERIES[name](spark, "anywhere").collect()
    assert fitted == [ROWS - ROWS // 5]
    assert len(got) == {"explain_chain": ROWS // 5, "ml_score": ROWS // 5, "ml_feature_importance": len(fv.FEATURES),
                        "ml_score_scenarios": len(fv.SCENARIOS), "sink_model": 1}.get(name, 5)


SMALL_GRID = {"numTrees": [1], "maxDepth": [3], "minInstancesPerNode": [10], "balanced": [False]}


@pytest.mark.parametrize("name", ["ml_grid_scores", "ml_grid_search"])
def test_trees_grow_on_all_training_rows(spark, monkeypatch, name):
    """The events are the last rows in hash order, which a sample of 200,000 rows in that order would not hold."""
    rows, events = 252_000, 1_000
    last = sorted(hashlib.md5(f"{i}|42".encode()).hexdigest() for i in range(rows))[-events]
    label = (F.md5(F.concat(F.col("id").cast("string"), F.lit("|42"))) >= last).cast("int")
    training = spark.range(rows).select(F.col("id").cast("string").alias("Observation ID"), label.alias(model.LABEL),
                                        *[label.cast("double").alias(c) for c in fv.FEATURES])
    tables, search = _Tables(spark=spark, training=training), model.search
    monkeypatch.setattr(registry, "open_tables", lambda *_: tables)
    monkeypatch.setattr(models.model, "search", lambda train, key: search(train, key, SMALL_GRID, 2))
    got = QUERIES[name](spark, "anywhere").collect()
    assert [r.rows for r in got] == [rows - rows // 5] and rows - rows // 5 > 200_000
    assert [r.recall for r in models._searched(tables).collect()] == [1.0]


def _folded(spark, rows=240):
    gen = np.random.default_rng(6)
    x = gen.normal(size=(rows, len(fv.FEATURES)))
    label = (x[:, 0] + x[:, 3] + gen.normal(0, 0.5, rows) > 0.5).astype(int)
    weight = rows / (2 * np.bincount(label)[label])
    columns = ", ".join(f"{c} double" for c in fv.FEATURES)
    return x, label, spark.createDataFrame(
        [(i % 3, int(y), float(w), *map(float, v)) for i, (y, w, v) in enumerate(zip(label, weight, x))],
        f"fold int, {model.LABEL} int, weight double, {columns}").coalesce(1)


def test_rows_walk_trees_where_they_grow(spark, monkeypatch):
    """What is stored are sums of held-out rows; neither trees nor copies of the rows move."""
    stored, stage = [], grid.stage
    monkeypatch.setattr(grid, "stage", lambda df, name: (stored.append(df.columns), stage(df, name))[1])
    settings = {"numTrees": [2, 4], "maxDepth": [2, None], "minInstancesPerNode": [5], "balanced": [True, False]}
    assert grid.nested_search(_folded(spark)[2], settings, 3, model.LABEL).count() == 8
    assert stored == [["fit", "begin", "upto", "part", "sums"]]


def test_tasks_and_parts_do_not_change_the_search(spark, monkeypatch):
    settings = {"numTrees": [3, 7, 10], "maxDepth": [2, 5, None], "minInstancesPerNode": [3, 20], "balanced": [True, False]}
    folded = _folded(spark)[2]
    monkeypatch.setattr(grid, "ENTRIES", 2 * 240)  # two trees grow together
    found = []
    for trees, part in ((100, 1000), (2, 1000), (4, 17)):
        monkeypatch.setattr(grid, "TREES_PER_TASK", trees)
        monkeypatch.setattr(grid, "ROWS_PER_BATCH", part)
        found.append(sorted(map(str, grid.nested_search(folded, settings, 3, model.LABEL).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 36


@pytest.mark.parametrize("min_leaf", [1, 5])
def test_words_walk_as_their_rows_do(spark, min_leaf):
    x, label, _ = _folded(spark)
    cuts = grid.cut_points(x)
    bins = np.column_stack([np.searchsorted(t, c) for t, c in zip(cuts, x.T)]).astype(np.uint8)
    nodes = grid.grown(bins, label.astype(float), np.where(label == 1, 1.5, 0.7), 3, 30, min_leaf, 3, np.random.default_rng(1))
    batch = grid.packed(nodes, 0, 0, 3, cuts).to_pylist()
    depths = [0, 1, 3, 4, 9, 30]
    for k, tree in enumerate(batch):
        mine = np.flatnonzero(nodes["tree"] == k)
        held = {c: nodes[c][mine] for c in ("left", "feature", "bin", "value")}
        assert np.array_equal(nodes["id"][mine], np.arange(len(mine)))
        assert np.array_equal(grid.walk_words(grid.words(bins, label), held, depths), grid.walk(x, tree, depths))
    with pytest.raises(ValueError):
        grid.words(np.zeros((1, 12), dtype=np.uint8), np.zeros(1, dtype=int))
