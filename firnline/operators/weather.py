"""Daily station readings looked up by date, and their interpolation to places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions import measure
from firnline.operators.nearest import PLACE, with_station_lists

STATION_DAY = ["station_triplet", "day"]
MEASURES = ["snow_depth", "new_snow_24h", "swe", "temp"]


def station_days(daily: DataFrame, allow_future: bool = True, by_station: bool = False) -> DataFrame:
    """What each station says about each day that has a reading near it.

    For day d: the reading of d when there is one, even if its values are null, else the last
    reading in [d-3, d+1]; and the depth change between the last two readings in [d-4, d].
    ``allow_future=False`` leaves d+1 out, as a model trained for forecasting should.

    A merge of readings with the days between them: readings are dealt by (station, month), those of a month's
    last days and its first day also to the neighbouring month. In order of days each reading knows the one before and the
    one after it, and answers for its own day and the days up to the next reading that it can matter to, so both
    look-ups come from one ordered pass and a reading is shuffled once. Days without any reading near them are
    absent; a left join on (station, day) gives nulls for them. Of repeated readings of a day the largest values count.

    ``by_station`` says that the table is bucketed by station, so that it needs no dealing at all.
    """
    back, ahead = fv.CHANGE_DAYS_BEFORE, fv.READING_DAYS_AFTER

    def month(day: Column) -> Column:
        return F.trunc(day, "month")

    # The months with a day that this reading can matter to.
    near = F.array_distinct(F.array(
        month(F.date_sub("day", ahead)), month(F.col("day")), month(F.date_add("day", back))))
    sent = measure.nans_to_null(daily).select("station_triplet", "day", "depth_in", "swe_in", "temp_f", F.explode(near).alias("span"))
    if not by_station:
        sent = sent.repartition("station_triplet", "span")
    once = sent.groupBy("station_triplet", "span", "day").agg(*[F.max(c).alias(c) for c in ("depth_in", "swe_in", "temp_f")])
    in_order = W.partitionBy("station_triplet", "span").orderBy("day")
    own, other = F.struct("depth_in", "swe_in", "temp_f"), F.struct("day", "depth_in", "swe_in", "temp_f")
    beside = once.select(
        "station_triplet", "span", "day", own.alias("own"),
        F.lag(F.struct("day", "depth_in")).over(in_order).alias("prev"), F.lead(other).over(in_order).alias("next"),
    )
    last = F.least(F.date_add("day", back), F.coalesce(F.date_sub("next.day", 1), F.date_add("day", back)))
    # The day before a reading is the reading's own business where nothing earlier reaches it.
    lone = F.col("prev").isNull() | (F.col("prev.day") < F.date_sub("day", ahead + back))
    first = F.when(lone & F.lit(allow_future), F.date_sub("day", ahead)).otherwise(F.col("day"))
    asked = beside.select(
        "station_triplet", "span", F.col("day").alias("read_on"), "own", "prev", "next",
        F.explode(F.sequence(first, last)).alias("day"),
    ).filter(month(F.col("day")) == F.col("span"))

    def pick(name: str) -> Column:
        chain = F.when(F.col("day") <= F.col("read_on"), F.col("own")[name])
        if allow_future:
            chain = chain.when(F.col("next.day") == F.date_add("day", ahead), F.col("next")[name])
        return chain.when(F.col("day") <= F.date_add("read_on", fv.READING_DAYS_BEFORE), F.col("own")[name])

    both = (F.col("day") >= F.col("read_on")) & (F.col("prev.day") >= F.date_sub("day", back))
    change = measure.inches_to_cm(F.col("own.depth_in")) - measure.inches_to_cm(F.col("prev.depth_in"))
    return asked.select(
        *STATION_DAY,
        measure.inches_to_cm(pick("depth_in")).alias("snow_depth"),
        F.when(both, change).alias("new_snow_24h"),
        measure.inches_to_cm(pick("swe_in")).alias("swe"),
        measure.fahrenheit_to_celsius(pick("temp_f")).alias("temp"),
    )


def needed_readings(daily: DataFrame, nearest: DataFrame, place_days: DataFrame) -> DataFrame:
    """The daily readings that can matter to ``place_days``: of stations in ``nearest``, near the days asked for.

    The days' range also bounds ``month`` when the table has that partition column, so other months are not read.
    """
    span = place_days.agg(
        F.date_sub(F.min("day"), fv.CHANGE_DAYS_BEFORE).alias("first"),
        F.date_add(F.max("day"), fv.READING_DAYS_AFTER).alias("last"),
    )
    first, last = span.select("first").scalar(), span.select("last").scalar()
    kept = daily.filter((F.col("day") >= first) & (F.col("day") <= last))
    if "month" in daily.columns:
        kept = kept.filter((F.col("month") >= F.trunc(first, "month")) & (F.col("month") <= last)).drop("month")
    stations = nearest.select(F.explode("stations.station_triplet").alias("station_triplet")).distinct()
    return kept.join(stations, "station_triplet", "left_semi")


def look_up(keys: DataFrame, daily: DataFrame, allow_future: bool = True, buckets: int = 0) -> DataFrame:
    """Readings for each distinct (station_triplet, day) of ``keys``.

    ``buckets`` is how many a table bucketed by station has: keys are then dealt like it, and readings stay where they are
    if ``spark.sql.requireAllClusterKeysForCoPartition`` is false.
    """
    asked = keys.select(*STATION_DAY)
    asked = asked.repartition(buckets, "station_triplet") if buckets else asked
    return asked.distinct().join(station_days(daily, allow_future, buckets > 0), STATION_DAY, "left")


def look_up_counts(lookups: DataFrame) -> DataFrame:
    """How many look-ups, distinct (station, day) pairs and repeats there are."""
    per_pair = lookups.groupBy(*STATION_DAY).agg(F.count("*").alias("n"))
    return per_pair.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lookups"),
        F.count("*").alias("unique_pairs"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
    )


def inverse_distance_mean(value: Column, distance: Column, rank: Column, power: int = fv.IDW_POWER):
    """Aggregate: mean of the values that are neither null nor NaN, weighted by 1 / distance ** power.

    A value at distance zero wins outright, the one of lowest rank if there are several.
    """
    value = measure.nan_to_null(value)
    at_zero = value.isNotNull() & (distance == 0)
    weight = F.when((distance != 0) & value.isNotNull(), 1.0 / F.pow(distance, F.lit(power)))
    exact = F.min_by(value, F.when(at_zero, rank))
    return F.when(F.max(at_zero), exact).otherwise(F.sum(value * weight) / F.sum(weight))


def interpolate(place_days: DataFrame, nearest: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings of the nearest stations, interpolated to each distinct place and day.

    ``place_days``: distinct (Longitude, latitude, day); ``nearest``: one row per place with its
    ``stations`` array; ``readings``: one row per (station_triplet, day). A place without stations
    keeps its row, with nulls. (An inner explode would also let Spark infer a filter on the array
    and push it, with the whole search, below the step that made places distinct.)
    """
    asked = place_days.join(nearest.select(*PLACE, "stations"), PLACE).select(
        *PLACE, "day", F.posexplode_outer("stations").alias("rank", "station")
    ).select(
        *PLACE, "day", "rank",
        F.col("station.distance_km").alias("distance_km"),
        F.col("station.station_triplet").alias("station_triplet"),
    )
    return (
        # Dealt by place alone, so that what is joined by place afterwards finds its rows there.
        asked.join(readings, STATION_DAY, "left")
        .repartition(*PLACE)
        .groupBy(*PLACE, "day")
        .agg(
            *[
                inverse_distance_mean(F.col(m), F.col("distance_km"), F.col("rank")).alias(m)
                for m in MEASURES
            ]
        )
    )


def weather_at(
    place_days: DataFrame, nearest: DataFrame, daily: DataFrame, allow_future: bool = True
) -> DataFrame:
    """Weather columns per distinct place and day, with the stations used."""
    readings = station_days(needed_readings(daily, nearest, place_days), allow_future)
    return with_weather(place_days, nearest, readings)


def with_weather(place_days: DataFrame, nearest: DataFrame, readings: DataFrame) -> DataFrame:
    """The same from ``readings``, the outcome of ``station_days``."""
    values = interpolate(place_days, nearest, readings)
    return with_station_lists(values.join(nearest, PLACE)).withColumn(
        "wind_speed", F.lit(None).cast("double")
    )
