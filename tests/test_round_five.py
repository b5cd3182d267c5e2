"""What moves less than it did: raw reports, draws, station lists of negatives; and scores that are worked out once."""

import datetime

from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.catalog import models, tables
from firnline.operators import model, negatives


def test_orders_are_dealt_before_they_become_texts(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 2, "F", "5-LOW")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(tables, "stage", lambda df, name: df)
    raw = tables.Tables(spark, str(tmp_path)).raw_reports
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Repartition") > plan.index("Destructive Size")
    assert raw.count() == 1


EVENT = "`Observation ID` string, Longitude double, latitude double, Area string, Date timestamp_ntz"


def _events(spark, n=40):
    first = datetime.datetime(2024, 1, 1, 8)
    return spark.createDataFrame(
        [(f"e{i}", -105.0 - i % 4 / 100, 40.0, "a", first + datetime.timedelta(days=i * 7)) for i in range(n)], EVENT)


def test_draws_move_as_bytes_and_any_text_stays(spark):
    events = _events(spark)
    day = datetime.datetime(2025, 1, 1, 8)
    texts = ["ab", "AB", "abc", "zz", "", None, "0123456789abcdef0123456789abcdef"]
    drawn = spark.createDataFrame([(-105.0, 40.0, "a", day, d) for d in texts], "Longitude double, latitude double, Area string, Date timestamp_ntz, draw string")
    known = drawn.limit(1).withColumn("Date", F.lit(datetime.datetime(2024, 1, 1, 8)).cast("timestamp_ntz"))
    left = negatives.without_known_events(drawn.unionByName(known), events)
    assert left.columns == drawn.columns and left.dtypes == drawn.dtypes
    assert sorted(map(str, (r.draw for r in left.collect()))) == sorted(map(str, texts))
    assert "unhex(" in left._jdf.queryExecution().optimizedPlan().toString()


def test_station_lists_come_to_the_chosen_only(spark):
    events = _events(spark).cache()
    places = events.select("Longitude", "latitude").distinct()
    station = F.struct(F.lit(1.25).alias("distance_km"), F.lit("n").alias("name"), F.lit("1").alias("station_id"), F.lit("1:CO:STN").alias("station_triplet"))
    nearest = places.withColumn("stations", F.when(F.col("Longitude") > -105.025, F.array(station)).otherwise(F.array()))
    ground = places.withColumn("elevation", F.lit(1.0))

    def sky(days):
        return days.withColumn("snow_depth", F.lit(1.0))

    def listed(days):
        return negatives.with_station_lists(sky(days).join(nearest, ["Longitude", "latitude"]))

    late = negatives.negatives(events, ground, sky, nearest=nearest)
    early = negatives.negatives(events, ground, listed)
    assert late.columns == early.columns and "nearest_stations" in late.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, early.collect())) and late.count() == 80


def test_scores_are_counted_without_a_second_walk(spark):
    rows = spark.createDataFrame([(*(float(i + j) for j in range(len(fv.FEATURES))), i % 2) for i in range(60)],
                                 ", ".join(f"{c} double" for c in fv.FEATURES) + f", {model.LABEL} int")
    scored = model.score(model.train_classifier(rows, numTrees=2, maxDepth=2), rows)
    found = models._probabilities(scored)
    assert found.first()[0] == 60
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "UDF" in line], plan
