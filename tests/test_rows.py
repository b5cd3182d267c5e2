"""Ordering, sampling, quantiles, evaluation and joins against plain Python."""

import datetime
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import schemas
from firnline.operators import (
    cleaning, combine, evaluate, negatives, profile, quantiles, ranking, split,
)


def digest(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@pytest.mark.parametrize("quota", [0, 1, 7, 499, 500, 900])
def test_first_by_hash(spark, quota):
    frame = spark.range(500).withColumn("draw", ranking.hash_order(F.col("id").cast("string")))
    quotas = spark.range(1).select(F.lit(quota).alias("quota"))
    got = {r["id"] for r in ranking.first_by_hash(frame, "draw", quotas).collect()}
    assert got == set(sorted(range(500), key=digest)[:quota])


def test_position_by_hash(spark):
    frame = spark.range(300).select(
        "id", (F.col("id") % 2).alias("label"), ranking.hash_order(F.col("id").cast("string"))
        .alias("draw"),
    )
    got = ranking.position_by_hash(frame, "draw", "at", ["label"]).collect()
    for label in (0, 1):
        order = sorted((i for i in range(300) if i % 2 == label), key=digest)
        assert {r["id"]: r["at"] for r in got if r["label"] == label} == {
            i: n + 1 for n, i in enumerate(order)
        }


def test_stratified_split(spark):
    frame = spark.range(403).withColumn("label", (F.col("id") % 7 == 0).cast("int"))
    got = split.stratified(frame, "label", "id").groupBy("label").agg(
        F.count_if("is_test").alias("test"), F.count("*").alias("n")).collect()
    assert sum(r["test"] for r in got) == 81
    for r in got:
        assert abs(r["test"] - 0.2 * r["n"]) < 1


def test_folds_are_even(spark):
    frame = spark.range(403).withColumn("label", (F.col("id") % 7 == 0).cast("int"))
    sizes = split.folds(frame, "label", "id").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["label"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_one_hot_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3 * 0).alias("k"), "id")
    plan = ranking.first_per_key(frame, ["k"], ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quantiles_and_describe(spark):
    random.seed(3)
    rows = [(random.choice([None, 5.0, random.gauss(0, 9)]), float(i % 4), None)
            for i in range(2000)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["feature"]: r for r in quantiles.describe(frame, ["a", "b", "c"]).collect()}
    for i, name in enumerate("ab"):
        data = np.array([r[i] for r in rows if r[i] is not None])
        row = got[name]
        assert row["count"] == len(data) and row["std"] == pytest.approx(data.std(ddof=1))
        for q, field in ((25, "q25"), (50, "q50"), (75, "q75")):
            assert row[field] == pytest.approx(np.percentile(data, q))
    assert got["c"]["count"] == 0 and got["c"]["q50"] is None


def test_scores_golden(spark):
    scores = spark.createDataFrame(
        [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "label int, score double")
    assert evaluate.roc_auc(scores).first()["auc"] == pytest.approx(0.875)
    swept = {r["threshold"]: r for r in evaluate.sweep(scores).collect()}
    at = swept[0.4]
    assert (at["recall"], at["fn"], at["fn_rate"]) == (1.0, 0, 0.0)
    assert at["precision"] == pytest.approx(2 / 3) and at["f1"] == pytest.approx(0.8)
    assert evaluate.confusion(scores, 0.4).first().asDict() == {"tn": 1, "fp": 1, "fn": 0, "tp": 2}
    best = evaluate.best_threshold(evaluate.sweep(scores)).first()
    assert best["threshold"] == min(t for t, r in swept.items()
                                    if r["fn_rate"] < 0.25 and r["f1"] == best["f1"])


def test_auc_does_not_change_under_monotone_maps(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(500)]
    scores = spark.createDataFrame(rows, "label int, score double")
    squared = scores.withColumn("score", F.col("score") * F.col("score"))
    first, second = (evaluate.roc_auc(s).first()["auc"] for s in (scores, squared))
    pairs = [(p, n) for lp, p in rows if lp for ln, n in rows if not ln]
    won = sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs)
    assert first == pytest.approx(second) == pytest.approx(won)


def test_no_safe_threshold_takes_the_lowest_miss_rate(spark):
    scores = spark.createDataFrame([(1, 0.1), (1, 0.25), (0, 0.9)], "label int, score double")
    assert evaluate.best_threshold(evaluate.sweep(scores)).first()["threshold"] == 0.2


def test_clean_reports(spark):
    base = ("1", "2024-01-05 08:15:00", " -106.1 ", "39.5", " N ", "Front", "D2", "SS", "N")
    def with_(**change):
        row = dict(zip(schemas.RAW_REPORTS.names, base))
        return tuple({**row, **{k.replace("_", " "): v for k, v in change.items()}}.values())
    rows = [base, with_(Longitude="-"), with_(latitude="abc"), with_(Area=None),
            with_(Destructive_Size="R3"), with_(Trigger="AS"), with_(Trigger=None),
            with_(Date=None), with_(Destructive_Size="D3-D4", Trigger="U", Aspect="-")]
    got = cleaning.clean_reports(spark.createDataFrame(rows, schemas.RAW_REPORTS)).collect()
    assert len(got) == 3
    assert {r["Trigger"] for r in got} == {"N", "U", None}
    assert [r["avalanche_size"] for r in got if r["Trigger"] == "U"] == [3.0]
    assert [r["Aspect"] for r in got if r["Trigger"] == "U"] == [None]
    assert all(r["Longitude"] == -106.1 and r["avalanche_occurred"] == 1 for r in got)


def test_fan_out_gives_the_same_final_rows(spark):
    """Joining repeated weather rows and dropping duplicates after equals dropping them first."""
    day = datetime.datetime(2024, 1, 5, 8)
    reports = spark.createDataFrame(
        [(i, -106.0 - i % 3, 39.0, day, float(i)) for i in range(12)],
        "source_pos long, Longitude double, latitude double, Date timestamp_ntz, size double")
    weather = reports.select("Longitude", "latitude", "Date").withColumn(
        "temp", F.col("Longitude") * 2)
    key = ["Longitude", "latitude", "Date"]
    fanned = reports.join(weather, key, "left")
    assert fanned.count() == 48
    late = combine.one_per_event(fanned, ["source_pos"])
    early = combine.join_weather(combine.one_per_event(reports, ["source_pos"]), weather)
    columns = sorted(late.columns)
    assert sorted(late.select(columns).collect()) == sorted(early.select(columns).collect())


def positives(spark):
    random.seed(11)
    rows = [(f"r{i}", -106.0 - random.randint(0, 9) / 10, 39.0 + random.randint(0, 3) / 10,
             random.choice(["A", "B"]),
             datetime.datetime(2024, 1, 1, 8) + datetime.timedelta(days=random.randint(0, 40)))
            for i in range(150)]
    return spark.createDataFrame(
        rows, "`Observation ID` string, Longitude double, latitude double, Area string, Date timestamp_ntz")


def test_attempts_meet_no_known_event(spark):
    known = positives(spark)
    tried = negatives.attempts(known, ratio=1.0, per_negative=3).collect()
    events = {(round(r["Longitude"], 6), round(r["latitude"], 6), r["Date"].date()) for r in known.collect()}
    days = [(r["Longitude"], r["latitude"], r["Date"]) for r in tried]
    assert tried and len(set(days)) == len(days)
    assert not {(round(a, 6), round(b, 6), d.date()) for a, b, d in days} & events
    last = max(r["Date"] for r in known.collect()) - datetime.timedelta(days=10)
    assert max(d for _, _, d in days) <= last


def test_partition_count_does_not_matter(spark):
    known = positives(spark)
    seen = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        tried = negatives.number_negatives(negatives.attempts(known.repartition(int(n)), 1.0))
        seen.add(tuple(sorted((r["Observation ID"], r["draw"]) for r in tried.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1


def test_duplicate_count_treats_nulls_as_equal(spark):
    frame = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert profile.duplicate_count(frame, ["a", "b"]).first()[0] == 1


def test_pivot_can_drop_absent_columns(spark):
    frame = spark.createDataFrame([("x", 1), ("x", 3), ("y", 1)], "g string, m int")
    table = profile.pivot(frame, "g", "m", [1, 2, 3], F.count("m"), fill=0, drop_absent=True)
    assert table.columns == ["g", "1", "3"]
    assert sorted(map(tuple, table.collect())) == [("x", 1, 1), ("y", 1, 0)]


def test_histogram_closes_its_last_bin(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 10)], "v double")
    got = [r["count"] for r in profile.histogram(frame, "v", 5).orderBy("bin").collect()]
    assert got == list(np.histogram([0, 1, 2, 3, 10], 5)[0])


def test_outliers_do_not_fill_one_slice(spark):
    """One huge value, and many scores below a thousandth: slices follow the counts."""
    from firnline.operators import evaluate, quantiles

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(100_000).select(
            (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") / 1e9).alias("score"))
        slices = evaluate.per_score(rows).groupBy("slice").count().collect()
        assert len(slices) == 4 and max(r["count"] for r in slices) < 40_000
        auc = evaluate.roc_auc(rows).first()["auc"]
        assert abs(auc - 0.5) < 0.01
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    values = spark.range(1001).select(F.when(F.col("id") == 1000, 1e300).otherwise(F.col("id")).alias("v"))
    got = {r["probability"]: r["quantile"] for r in quantiles.quantiles(values, ["v"], [0.25, 0.5, 1.0]).collect()}
    assert got == {0.25: 250.0, 0.5: 500.0, 1.0: 1e300}


def test_quantiles_per_group_keep_null(spark):
    from firnline.operators import quantiles

    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, None), ("b", float("nan"))], "g string, v double")
    got = {r["g"]: r["q0"] for r in quantiles.quantiles_by(frame, "g", "v", [0.5]).collect()}
    assert got == {"a": 1.5, None: 5.0}


def test_dates_in_other_forms(spark):
    from firnline.functions.time import to_time

    rows = ["2024-01-05 08:15:00", "1/5/2024 8:15", "1/5/2024", "01/05/2024 08:15:30 PM", "1/5/2024 12:01 am", "05.01.2024", None]
    frame = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in frame.select(to_time(F.col("t"), strict=False, formats=["dd.MM.yyyy"])).collect()]
    d = datetime.datetime
    assert got == [d(2024, 1, 5, 8, 15), d(2024, 1, 5, 8, 15), d(2024, 1, 5), d(2024, 1, 5, 20, 15, 30), d(2024, 1, 5, 0, 1),
                   d(2024, 1, 5), None]
    bad = spark.createDataFrame([("13/45/2024 8:15",)], "t string")
    assert bad.select(to_time(F.col("t"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="not a date"):
        bad.select(to_time(F.col("t"))).collect()


def test_nan_is_missing(spark):
    from firnline.operators import weather

    rows = [("a", 1, 2.0, float("nan")), ("a", 2, 4.0, 10.0)]
    frame = spark.createDataFrame(rows, "p string, rank int, km double, v double")
    mean = weather.inverse_distance_mean(F.col("v"), F.col("km"), F.col("rank"))
    assert frame.groupBy("p").agg(mean.alias("m")).first()["m"] == 10.0
