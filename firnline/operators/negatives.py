"""Days without an event at known places, drawn in a repeatable random order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions.text import degrees_text
from firnline.functions.time import plus_days
from firnline.operators.combine import keep_columns
from firnline.operators.nearest import PLACE, with_station_lists
from firnline.operators.ranking import (
    first_by_hash,
    first_per_key,
    hash_order,
    position_by_hash,
)
from firnline.operators.weather import MEASURES
from firnline.session import release, stage


def target_count(
    positives: DataFrame, ratio: float = fv.NEGATIVE_RATIO, times: int = 1
) -> DataFrame:
    """One row, ``quota``: how many negatives to draw, times a factor."""
    wanted = F.floor(F.count("*") * F.lit(ratio)).cast("long") * times
    return positives.agg(wanted.alias("quota"))


def attempts_per_positive(ratio: float, per_negative: int) -> int:
    return math.ceil(ratio * per_negative)


def draws(
    positives: DataFrame, ratio: float = fv.NEGATIVE_RATIO, seed: int = fv.SEED,
    per_negative: int = fv.ATTEMPTS_PER_NEGATIVE, lag_days: int = fv.REPORTING_LAG_DAYS,
) -> DataFrame:
    """Random places and days, ``ratio`` × ``per_negative`` for each positive, each with its ``draw``.

    A draw is the digest of the positive's id, the attempt and the seed. Two parts of it pick a known place (by its
    number in hash order) and a day from the first event to ``lag_days`` before the last. So the work follows the
    positives, however many places and days there are. Days keep the first event's time of day.
    """
    return _readable(_draws(positives, ratio, seed, per_negative, lag_days))


def _places(positives: DataFrame, seed: int) -> DataFrame:
    """The known places, stored, with their numbers (``__place``) in hash order."""
    known = positives.select(*PLACE, "Area").distinct().withColumn(
        "__digest",
        hash_order(degrees_text(F.col("Longitude")), degrees_text(F.col("latitude")),
                   F.coalesce("Area", F.lit("")), F.lit(str(seed))),
    )
    return stage(position_by_hash(known, "__digest", "__place").drop("__digest"), "places")


def _digests(positives: DataFrame, ratio: float, seed: int, per_negative: int, lag_days: int, upto: Column | None) -> DataFrame:
    """The digests of all draws as 16 bytes, half of their text, since draws are what moves; those below ``upto``."""
    tried = F.sequence(F.lit(0), F.lit(attempts_per_positive(ratio, per_negative) - 1))
    drawn = (
        positives.select("Observation ID", F.explode(tried).alias("__attempt"))
        .filter(_days(positives, lag_days) >= 0)
        .select(hash_order(F.col("Observation ID"), F.col("__attempt").cast("string"), F.lit(str(seed)))
                .alias("draw"))
    )
    drawn = drawn if upto is None else drawn.filter(F.col("draw") < upto)
    # Never null, and said to be so, here and in the place's number: a filter on that would work every digest out twice.
    return drawn.select(F.coalesce(F.unhex("draw"), F.lit(b"")).alias("draw"))


def _days(positives: DataFrame, lag_days: int) -> Column:
    return positives.agg(
        F.expr(f"timestampdiff(DAY, min(Date), max(Date) - interval '{lag_days}' day)")
    ).scalar()


def _number(start: int) -> Column:
    """The number that four bytes of a draw spell."""
    return F.conv(F.hex(F.substring("draw", start, 4)), 16, 10).cast("long")


def _place_number(count: int) -> Column:
    """The number of the place a draw picks."""
    return F.coalesce(_number(1) % F.lit(count).cast("long") + 1, F.lit(0).cast("long"))


def _day_number(positives: DataFrame, lag_days: int) -> Column:
    return (_number(5) % (_days(positives, lag_days) + 1)).cast("int")


def _date(positives: DataFrame, lag_days: int) -> Column:
    """The day a draw picks, at the first event's time of day."""
    return plus_days(positives.agg(F.min("Date")).scalar(), _day_number(positives, lag_days))


def _draws(
    positives: DataFrame, ratio: float, seed: int, per_negative: int, lag_days: int = fv.REPORTING_LAG_DAYS,
) -> DataFrame:
    """``draws`` with the digest as bytes. Place and day follow from it, so it alone moves to the places."""
    numbered = _places(positives, seed)
    drawn = _digests(positives, ratio, seed, per_negative, lag_days, None)
    return drawn.join(numbered, _place_number(numbered.count()) == F.col("__place")).select(
        *PLACE, "Area", _date(positives, lag_days).alias("Date"), "draw")


def _readable(drawn: DataFrame) -> DataFrame:
    return drawn.withColumn("draw", F.lower(F.hex("draw")))


_SPOT = {"__lon": "Longitude", "__lat": "latitude", "__day": "Date"}


def _spot_day() -> dict[str, Column]:
    """Coordinates at six decimals, and the day."""
    return {name: F.to_date(c) if name == "__day" else F.round(c, 6) for name, c in _SPOT.items()}


def _unknown(candidate_days: DataFrame, positives: DataFrame) -> DataFrame:
    known = positives.select(*[c.alias(n) for n, c in _spot_day().items()]).distinct()
    return candidate_days.withColumns(_spot_day()).join(known, list(_SPOT), "left_anti")


def without_known_events(candidate_days: DataFrame, positives: DataFrame) -> DataFrame:
    """Drop places and days on which an event is known, coordinates compared at six decimals.

    A ``draw`` that is a digest's text moves as its bytes, half of it; any other text moves as it is.
    """
    if dict(candidate_days.dtypes).get("draw") != "string":
        return _unknown(candidate_days, positives).drop(*_SPOT)
    digest = F.coalesce(F.lower(F.hex(F.unhex("draw"))) == F.col("draw"), F.lit(False))
    packed = candidate_days.withColumns(
        {"__bytes": F.when(digest, F.unhex("draw")), "draw": F.when(~digest, F.col("draw"))})
    left = _unknown(packed, positives).withColumn("draw", F.coalesce(F.lower(F.hex("__bytes")), "draw"))
    return left.drop("__bytes", *_SPOT)


def one_per_place_day(candidate_days: DataFrame) -> DataFrame:
    """Of draws of the same place and day, the first stays."""
    return first_per_key(candidate_days, [*PLACE, "Date"], ["draw"])


def with_terrain(candidate_days: DataFrame, terrain: DataFrame) -> DataFrame:
    """Candidates whose place has terrain, with it."""
    return candidate_days.join(terrain.dropDuplicates(PLACE), PLACE)


def _known_days(positives: DataFrame) -> DataFrame:
    """Per place the days on which an event is known there, at six decimals; stored. A list is as long as the calendar at most."""
    per_place = positives.select(*PLACE, F.to_date("Date").alias("day")).groupBy(*PLACE).agg(F.collect_set("day").alias("__days"))
    same = W.partitionBy(*[F.round(c, 6) for c in PLACE])
    return stage(
        per_place.withColumn("__days", F.array_distinct(F.flatten(F.collect_list("__days").over(same)))), "known-days")


def attempts(
    positives: DataFrame, ratio: float = fv.NEGATIVE_RATIO, seed: int = fv.SEED,
    per_negative: int = fv.ATTEMPTS_PER_NEGATIVE, upto: Column | None = None, places: DataFrame | None = None,
) -> DataFrame:
    """The draws that get looked at: less known events and repeats. Nothing here touches weather.

    ``upto`` leaves draws from there on out; it changes nothing about the draws before it, since the first of equal
    places and days is the one that stays. ``places`` leaves draws elsewhere out.

    Draws move twice: as bare digests to the place numbers they pick, where repeats fall and the place joins; then to the
    coordinates, which places of several areas share, in runs of equal places that compress to little more than the
    digests. The known days meet them there, and so does what else is joined by coordinates.
    """
    lag_days = fv.REPORTING_LAG_DAYS
    numbered = _places(positives, seed)
    number, day, date = _place_number(numbered.count()), _day_number(positives, lag_days), _date(positives, lag_days)
    # Numbers are those among all places, whichever are asked for.
    asked = numbered if places is None else numbered.join(places.select(*PLACE).distinct(), PLACE, "left_semi")
    dealt = _digests(positives, ratio, seed, per_negative, lag_days, upto).repartition(number)
    picked = first_per_key(dealt.withColumns({"__place": number, "__day": day}), ["__place", "__day"], ["draw"])
    placed = picked.drop("__day").join(asked, "__place").select(*PLACE, "Area", "draw")
    known = F.coalesce(F.array_contains("__days", F.to_date("Date")), F.lit(False))
    free = placed.join(_known_days(positives), PLACE, "left").withColumn("Date", date).filter(~known)
    return _readable(first_per_key(free.select(*PLACE, "Area", "Date", "draw"), [*PLACE, "Date"], ["draw"]))


def outcome(
    positives: DataFrame, made: DataFrame, ratio: float = fv.NEGATIVE_RATIO,
    per_negative: int = fv.ATTEMPTS_PER_NEGATIVE,
) -> DataFrame:
    """One row: how many negatives were wanted, how many places and days were tried, how many came of it."""
    tried = F.count("*") * attempts_per_positive(ratio, per_negative)
    return positives.agg(
        F.floor(F.count("*") * F.lit(ratio)).cast("long").alias("wanted"), tried.cast("long").alias("tried")
    ).withColumn("made", made.agg(F.count("*")).scalar())


def number_negatives(chosen: DataFrame) -> DataFrame:
    """Sequential ids NEG_000000, … in the order drawn."""
    return position_by_hash(chosen, "draw", "__position").withColumn(
        "Observation ID", F.format_string("NEG_%06d", F.col("__position") - 1)
    ).drop("__position")


def digest_at(share: float) -> str:
    """The digest that a ``share`` of all digests lies below."""
    return f"{round(min(max(share, 0.0), 1.0) * (1 << 52)):013x}" if share < 1.0 else "g"


def usable_draws(
    positives: DataFrame, terrain: DataFrame, place_day_weather, ratio: float = fv.NEGATIVE_RATIO,
    seed: int = fv.SEED, spare: float = 1.1, answering: DataFrame | None = None,
) -> tuple[DataFrame, list[dict]]:
    """Candidates with terrain and weather, at least the quota of them or all there are, and a record of the rounds.

    Draws are taken in the order of their digests. The first round takes a little over the quota; the share of it that
    survived says how many the next one needs for the shortfall. So weather is looked up for little more than what is
    needed, not for every attempt, and the first of the quota are the same as if all had been tried. ``answering`` are the
    places where there can be a snow depth at all: draws elsewhere fall before anything moves.
    """
    total = positives.count()
    quota, tries = math.floor(total * ratio), total * attempts_per_positive(ratio, fv.ATTEMPTS_PER_NEGATIVE)
    rounds, parts, made, begin = [], [], 0, 0.0
    while not rounds or (made < quota and begin < 1.0):
        # Of the draws tried so far a share survived; none known yet counts as all.
        survive = made / (begin * tries) if made else 1.0 if not rounds else 0.5 / 2 ** len(rounds)
        end = min(1.0, begin + spare * (quota - made) / max(1.0, survive * tries)) if tries else 1.0
        # Read twice: for the look-up and to join it.
        tried = stage(
            attempts(positives, ratio, seed, upto=F.lit(digest_at(end)), places=answering)
            .filter(F.col("draw") >= digest_at(begin)).withColumns({"day": F.to_date("Date"), "draw": F.unhex("draw")}), "tried")
        weather = place_day_weather(tried.select(*PLACE, "day").distinct())
        part = stage(
            _readable(with_terrain(tried.join(weather.filter(F.col("snow_depth").isNotNull()), [*PLACE, "day"]).drop("day"), terrain)),
            "negative-candidates",
        )
        release(tried)
        gained = part.count()
        rounds.append({"from": begin, "to": end, "draws": round((end - begin) * tries), "usable": gained})
        parts.append(part)
        made, begin = made + gained, end
    usable = parts[0]
    for part in parts[1:]:
        usable = usable.unionByName(part)
    return usable, rounds


def negatives(
    positives: DataFrame, terrain: DataFrame, place_day_weather,
    ratio: float = fv.NEGATIVE_RATIO, seed: int = fv.SEED, answering: DataFrame | None = None,
    nearest: DataFrame | None = None,
) -> DataFrame:
    """``ratio`` × positives rows of label 0, or as many as the attempts yield.

    ``positives`` should be stored. ``place_day_weather(place_days)`` returns weather columns for distinct (Longitude,
    latitude, day). Candidates are staged: the final cut and the numbering read them again. ``nearest`` gives the chosen
    their station lists once they are numbered, so that these texts do not move with every candidate.
    """
    usable, _ = usable_draws(positives, terrain, place_day_weather, ratio, seed, answering=answering)
    chosen = first_by_hash(usable, "draw", target_count(positives, ratio))
    blank = F.lit(None).cast("string")
    labelled = number_negatives(chosen).withColumns(
        {
            "Aspect": blank,
            "Type": blank,
            "Trigger": blank,
            "avalanche_size": F.lit(0.0),
            "avalanche_occurred": F.lit(0),
            "wind_speed": F.lit(None).cast("double"),
        }
    )
    return keep_columns(labelled if nearest is None else with_station_lists(labelled.join(nearest, PLACE)))


def training_table(positives: DataFrame, negative_rows: DataFrame) -> DataFrame:
    return positives.unionByName(negative_rows, allowMissingColumns=True)


def shuffled(df: DataFrame, key: str, seed: int = fv.SEED) -> DataFrame:
    """A repeatable random row order, for a file that is read top to bottom."""
    return df.orderBy(hash_order(F.col(f"`{key}`"), F.lit(str(seed))), f"`{key}`")
