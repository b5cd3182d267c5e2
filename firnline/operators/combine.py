"""Reports, terrain and weather joined into positive examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.functions.text import event_id, event_key
from firnline.operators.cleaning import quoted
from firnline.operators.nearest import PLACE
from firnline.operators.ranking import first_per_key

PLACE_TIME = [*PLACE, "Date"]


def join_terrain(reports: DataFrame, terrain: DataFrame) -> DataFrame:
    """Left join on the exact coordinates."""
    return reports.join(terrain, PLACE, "left")


def join_weather(reports: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on coordinates and time.

    ``weather`` may repeat a key (it has one row per report); equal keys hold equal values, so one
    of each is joined and a report never multiplies.
    """
    return reports.join(weather.dropDuplicates(PLACE_TIME), PLACE_TIME, "left")


def join_weather_by_day(reports: DataFrame, weather: DataFrame) -> DataFrame:
    """The same with weather kept once per place and day, which is all it depends on."""
    return (
        reports.withColumn("day", F.to_date("Date")).join(weather, [*PLACE, "day"], "left")
    ).drop("day")


def with_event_id(reports: DataFrame, name: str = "unique_id") -> DataFrame:
    return reports.withColumn(
        name, event_id(F.col("Longitude"), F.col("latitude"), F.col("Date"))
    )


def one_per_event(reports: DataFrame, order: list[str]) -> DataFrame:
    """The first report of every place and minute, in input order, with its ``unique_id``.

    Rows meet on the numbers the id is made of; only survivors get the text.
    """
    key = event_key(F.col("Longitude"), F.col("latitude"), F.col("Date"))
    first = first_per_key(reports.withColumns(key), list(key), order)
    return with_event_id(first.drop(*key))


def replace_id(reports: DataFrame) -> DataFrame:
    return reports.withColumn("Observation ID", F.col("unique_id")).drop("unique_id")


def keep_columns(df: DataFrame, wanted: list[str] = fv.POSITIVE_COLUMNS) -> DataFrame:
    """The wanted columns in their order, those that exist."""
    have = set(df.columns)
    return df.select(*[quoted(c) for c in wanted if c in have])


def positives(
    reports: DataFrame, terrain: DataFrame, weather: DataFrame, order: list[str]
) -> DataFrame:
    """One labelled row per event.

    Terrain and weather depend on the report's own place and day, so duplicates go first: the
    joins then see each event once, however often it was reported.
    """
    events = one_per_event(reports, order)
    joined = join_weather_by_day(join_terrain(events, terrain), weather)
    return keep_columns(replace_id(joined))
