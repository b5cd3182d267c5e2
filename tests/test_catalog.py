"""Every query against its twin, and the shape of the plans."""

import pytest

from compare import database, difference
from firnline.catalog import QUERIES, TWINS

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return {folder: database(folder) for folder in (SMALL, LARGER)}


# The smallest tables hold no example with all features.
COMPLETE = {"terrain_compass_bearing", "ml_prepare", "filter_not_null", "join_label_by_row"}
MODELS = [n for n in TWINS if n.startswith(("ml_train", "ml_feature", "ml_score", "ml_grid", "scan_model", "sink_model",
                                            "explain_con", "explain_chain"))]


@pytest.mark.parametrize("name", MODELS)
def test_model_twin(spark, db, name):
    assert difference(QUERIES[name](spark, LARGER), db[LARGER], TWINS[name]) is None


def test_held_out_figures(spark):
    """What the models do on rows they were not fitted on."""
    report = {r["class"]: r for r in QUERIES["ml_holdout_metrics"](spark, LARGER).collect()}
    assert all(0 <= r.auc <= 1 for r in report.values()) and report["accuracy"].f1 is not None
    size = QUERIES["ml_size_metrics"](spark, LARGER).first()
    assert size.rows > 20 and size.rmse > 0 and size.mae <= size.rmse and size.r2 <= 1
    scores = QUERIES["ml_grid_scores"](spark, LARGER).collect()
    assert len(scores) == 72 and len({r.recall for r in scores}) > 10


@pytest.mark.parametrize("name", [n for n in TWINS if n not in MODELS])
def test_twin(spark, db, name):
    folder = LARGER if name in COMPLETE else SMALL
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "ArrowEvalPython", "MapInPandas"):
        assert slow not in plan, slow
    assert difference(result, db[folder], TWINS[name]) is None


def test_exploration_report(spark):
    from firnline.catalog.tables import open_tables
    from firnline.plans import explore

    tables = explore.report(open_tables(spark, SMALL).history)
    assert len(tables) == 26
    for name, table in tables.items():
        assert table.columns and (table.count() or name == "missing"), name


def test_training_build(spark):
    from firnline.catalog.tables import open_tables

    t = open_tables(spark, SMALL)
    built = t.build.training()
    assert sorted(map(str, built.collect())) == sorted(map(str, t.training.select(*built.columns).collect()))


def test_readings_are_pruned(spark):
    from firnline.catalog.tables import open_tables
    from firnline.operators import weather

    t = open_tables(spark, SMALL)
    kept = weather.needed_readings(t.stored_daily, t.build.nearest, t.place_days)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "LeftSemi" in plan


def test_every_twin_has_a_query():
    assert TWINS.keys() <= QUERIES.keys()


def test_columns_are_pruned(spark):
    plan = QUERIES["agg_monthly_timeline"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
