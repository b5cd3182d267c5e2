"""Models, their storage, and attributions against the definition."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.operators import evaluate, explain, model
from firnline.plans import train
from firnline.sources import writers


@pytest.fixture(scope="module")
def training(spark):
    random.seed(2)
    rows = []
    for i in range(900):
        x = [random.gauss(0, 1) for _ in fv.FEATURES]
        event = int(x[4] + 0.5 * x[1] + random.gauss(0, 0.4) > 0.5)
        rows.append((f"r{i}", event, float(event) * (1 + abs(x[3])), *x))
    columns = ", ".join(f"{c} double" for c in fv.FEATURES)
    return spark.createDataFrame(
        rows, f"`Observation ID` string, {model.LABEL} int, {model.SIZE} double, {columns}")


@pytest.fixture(scope="module")
def parts(training):
    return train.held_out(training, "Observation ID")


@pytest.fixture(scope="module")
def forest(parts):
    return model.train_classifier(parts[0], numTrees=7, maxDepth=4)


@pytest.fixture(scope="module")
def saved(forest, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "package")
    model.save(forest, path, 0.45)
    return path


def test_the_forest_learns(forest, parts):
    assert evaluate.roc_auc(train.score_table(forest, parts[1])).first()["auc"] > 0.85


def test_package_round_trip(forest, saved, parts):
    loaded, meta = model.load(saved)
    row = meta.first()
    assert row["optimal_threshold"] == 0.45 and row["feature_cols"] == fv.FEATURES
    assert row["model_type"] == "RandomForestClassifier" and row["tuned"]
    key = ["Observation ID", "score"]
    assert sorted(model.score(loaded, parts[1]).select(key).collect()) == sorted(
        model.score(forest, parts[1]).select(key).collect())


def by_definition(trees, x):
    """Shapley values by summing over all subsets of features, tree by tree."""
    n = len(x)

    def value(node, subset):
        if node.numDescendants() == 0:
            stats = node.impurityStats().stats()
            return stats[1] / (stats[0] + stats[1])
        at = node.split().featureIndex()
        if at in subset:
            left = x[at] <= node.split().threshold()
            return value(node.leftChild() if left else node.rightChild(), subset)
        a, b = (sum(c.impurityStats().stats()) for c in (node.leftChild(), node.rightChild()))
        return (a * value(node.leftChild(), subset) + b * value(node.rightChild(), subset)) / (a + b)

    total = [0.0] * n
    for tree in trees:
        worth = {s: value(tree._call_java("rootNode"), set(s))
                 for k in range(n + 1) for s in itertools.combinations(range(n), k)}
        for i in range(n):
            for s in worth:
                if i not in s:
                    weight = (math.factorial(len(s)) * math.factorial(n - len(s) - 1)
                              / math.factorial(n))
                    total[i] += weight * (worth[tuple(sorted((*s, i)))] - worth[s]) / len(trees)
    return total


def test_contributions(forest, saved, parts):
    rows = model.score(forest, parts[1]).limit(30)
    long = explain.explain(forest, f"{saved}/model", rows, "Observation ID").collect()
    assert len(long) == 30 * 7
    scores = {r["Observation ID"]: r for r in rows.collect()}
    for name, row in scores.items():
        mine = [r for r in long if r["Observation ID"] == name]
        assert sum(r["shap_value"] for r in mine) + mine[0]["base_value"] == pytest.approx(
            row["score"], abs=1e-6)
    name, row = next(iter(scores.items()))
    mine = {r["feature"]: r["shap_value"] for r in long if r["Observation ID"] == name}
    wanted = by_definition(forest.stages[-1].trees, [row[f] for f in fv.FEATURES])
    assert np.allclose([mine[f] for f in fv.FEATURES], wanted, atol=1e-9)


def test_size_model(training):
    fitted, test = model.train_size_regressor(
        training, "Observation ID", maxIter=3, maxDepth=2)
    assert evaluate.regression(fitted.transform(test), model.SIZE).first()["rmse"] > 0
    few = training.filter(F.col(model.SIZE) > 0).limit(50)
    assert model.train_size_regressor(few, "Observation ID") is None


def test_full_grid_size():
    assert len(model.grid_settings()) == 3 * 4 * 3 * 2


def test_tuning(training):
    grid = {"numTrees": [3], "maxDepth": [2, None], "minInstancesPerNode": [10],
            "balanced": [True, False]}
    tuned = train.tune(training, "Observation ID", grid)
    assert tuned.settings.count() == 4 and tuned.threshold in fv.SWEEP_THRESHOLDS
    assert set(tuned.scores.columns) == {"label", "score"}


def test_scenarios(forest):
    got = model.score_scenarios(forest, 0.5).collect()
    assert [r["name"] for r in got] == [s[0] for s in fv.SCENARIOS]
    assert {r["prediction"] for r in got} <= {"DANGER", "SAFE"}


def contributions(spark):
    rows = [
        (1, "slope", 36.5, 0.17), (1, "swe", 14.2, 0.06), (1, "snow_depth", 151.0, 0.02), (1, "elevation", 2912.0, 0.005),
        (1, "new_snow_24h", 4.4, -0.11), (1, "temp", -10.6, -0.04), (1, "aspect_degrees", 247.0, 0.0),
    ]
    return spark.createDataFrame(rows, "id long, feature string, value double, shap_value double")


WORDED = {
    0.31: """
🟢 **AVALANCHE RISK: LOW/SAFE (31%)**
(Decision threshold: 0.50)
{0}
**Recommendation:**
  ✓ LOW DANGER. Normal caution advised.
  38% below danger threshold.""",
    0.46: """
🟡 **AVALANCHE RISK: MODERATE (46%)**
(Decision threshold: 0.50)
{0}
**Recommendation:**
  ⚠️ CONSIDERABLE DANGER. Careful snowpack evaluation required.
  Conditions approaching unsafe levels.""",
    0.83: """
🔴 **AVALANCHE RISK: HIGH DANGER (83%)**
(Decision threshold: 0.50)
{0}
**Recommendation:**
  ⚠️ DANGEROUS CONDITIONS. Avoid all avalanche terrain.
  Model is 66% above safety threshold.""",
}
FACTORS = """
**Factors INCREASING risk:**
  🔺 Slope: 36.5 (steep slope - HIGH IMPACT) [+0.17]
  🔺 Swe: 14.2 [+0.06]
  🔺 Snow Depth: 151.0 (very deep snowpack) [+0.02]

**Factors DECREASING risk:**
  🔻 New Snow 24H: 4.4 (minimal new snow) [-0.11]
  🔻 Temp: -10.6 (cold temps - stable snow) [-0.04]
"""


@pytest.mark.parametrize("p", list(WORDED))
def test_explanation_text(spark, tmp_path, p):
    predictions = spark.createDataFrame([(1, p)], "id long, prediction double")
    texts = explain.texts(contributions(spark), predictions, "id", 0.5)
    wanted = WORDED[p].format(FACTORS)
    assert texts.first()["text"] == wanted
    writers.text_report(texts, str(tmp_path / "text"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "text"), wholetext=True).collect()]
    assert [t.rstrip("\n") for t in lines if t] == [wanted]


def test_a_zero_contribution_is_in_neither_list(spark):
    ranked = explain.with_impact(explain.ranked(contributions(spark), "id")).collect()
    assert {r["feature"] for r in ranked} == {"slope", "swe", "snow_depth", "new_snow_24h", "temp"}
    zero = explain.with_impact(contributions(spark)).filter("shap_value = 0").first()
    assert zero["impact"] == "↓ DECREASES RISK"


def test_waterfall_ends_at_the_prediction(spark):
    got = explain.waterfall(contributions(spark), "id", F.lit(0.3)).orderBy(
        F.abs("shap_value"), "feature").collect()
    assert got[0]["start"] == pytest.approx(0.3)
    assert got[-1]["end"] == pytest.approx(0.3 + 0.105)
