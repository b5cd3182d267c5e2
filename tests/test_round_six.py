"""Draws move as their digests, and meet known days and terrain where they are dealt by coordinates."""

import datetime
import hashlib
import re

from pyspark.sql import functions as F

from firnline.operators import negatives
from firnline.operators.nearest import PLACE

EVENT = "`Observation ID` string, Longitude double, latitude double, Area string, Date timestamp_ntz"
FIRST = datetime.datetime(2024, 1, 1, 8, 15)


def _events(spark, n=60):
    """Places of several areas, two of them equal at six decimals, one without an area and one without a longitude."""
    places = [(-105.0, "a"), (-105.0, "b"), (-105.0, None), (-105.01, "a"), (-105.0100000001, "a"), (None, "a")]
    rows = [(f"e{i}", places[i % 6][0], 40.0, places[i % 6][1], FIRST + datetime.timedelta(days=i * 7 % 60)) for i in range(n)]
    return rows, spark.createDataFrame(rows, EVENT)


def _md5(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def test_attempts_are_those_of_a_plain_search(spark):
    rows, events = _events(spark)
    areas = sorted({r[1:4] for r in rows}, key=lambda p: _md5(*[f"{c:.6f}" for c in p[:2] if c is not None], p[2] or "", "42"))
    span = (max(r[4] for r in rows) - FIRST).days - 10

    def spot(lon, lat, when):
        return None if lon is None else (round(lon, 6), round(lat, 6), when.date())

    known, first = {spot(r[1], r[2], r[4]) for r in rows} - {None}, {}
    for draw in sorted(_md5(r[0], str(k), "42") for r in rows for k in range(20)):
        lon, lat, area = areas[int(draw[:8], 16) % len(areas)]
        when = FIRST + datetime.timedelta(days=int(draw[8:16], 16) % (span + 1))
        if spot(lon, lat, when) not in known:
            first.setdefault((lon, lat, when), (lon, lat, area, when, draw))
    # Two exact places that are one at six decimals share a digest but for their numbers, so either may have either.
    def plain(found):
        return sorted(map(str, ((lon and round(lon, 6), lat, area, when, draw) for lon, lat, area, when, draw in found)))

    got = plain(map(tuple, negatives.attempts(events).collect()))
    # A draw at one of the two falls with an earlier draw there; the other of the two may have been first in the plain search.
    apart = [line for line in plain(first.values()) if "-105.01," not in line]
    assert apart == [line for line in got if "-105.01," not in line] and len(apart) > 50
    assert any("None" in line for line in got) and any("-105.01," in line for line in got)


def test_known_days_hold_for_places_equal_at_six_decimals(spark):
    rows, events = _events(spark)
    known = {(r[4].date()) for r in rows if r[1] and round(r[1], 6) == -105.01}
    tried = [r for r in negatives.attempts(events).collect() if r.Longitude and round(r.Longitude, 6) == -105.01]
    assert len({r.Longitude for r in tried}) == 2 and len(known) > 10
    assert not {r.Date.date() for r in tried} & known


def _plan(spark, made):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return made()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _moved(plan):
    """What lies right below each exchange that draws go through."""
    below = re.findall(r"Exchange hashpartitioning.*\n[^\w]*Project \[(.*draw#\d+)\]", plan)
    return [re.sub(r"#\d+L?", "", columns) for columns in below]


def test_draws_move_as_digests(spark):
    _, events = _events(spark)
    plan = _plan(spark, lambda: negatives.attempts(events))
    later, first = _moved(plan)
    assert later == "Longitude, latitude, Area, draw"
    assert re.fullmatch(r"coalesce\(unhex\(md5\(.*\) AS draw", first) and first.count(" AS ") == 1
    # A digest is worked out once.
    assert plan.count("md5(") == 1


def test_terrain_meets_draws_where_they_are(spark):
    _, events = _events(spark)
    ground = events.select(*PLACE).distinct().withColumn("elevation", F.lit(1.0))
    plain = _plan(spark, lambda: negatives.attempts(events)).count("Exchange hashpartitioning")
    own = _plan(spark, lambda: ground.dropDuplicates(PLACE)).count("Exchange hashpartitioning")
    found = _plan(spark, lambda: negatives.with_terrain(negatives.attempts(events), ground))
    # The terrain is dealt out as it is made distinct, and for the join; the draws are not dealt again.
    assert found.count("Exchange hashpartitioning") - plain <= own + 1, found
    assert len(_moved(found)) == 2, found
