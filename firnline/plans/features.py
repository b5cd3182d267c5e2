"""Reports, stations, readings and elevation cells to the training table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.operators import combine, negatives
from firnline.operators.cleaning import observed
from firnline.operators.nearest import PLACE, nearest_stations
from firnline.operators.terrain import Grid, terrain_at
from firnline.operators.weather import interpolate, needed_readings, station_days, with_weather
from firnline.session import stage


@dataclass(frozen=True)
class FeatureBuild:
    """One build over clean reports; each part is a DataFrame and nothing runs until used.

    ``order`` names the columns that give the input order of reports. Nearest stations are staged,
    since positives and negatives both use them and they are one row per place.
    """

    reports: DataFrame
    stations: DataFrame
    daily: DataFrame
    cells: DataFrame
    grid: Grid
    order: list[str]
    allow_future: bool = True

    @cached_property
    def places(self) -> DataFrame:
        return self.reports.select(*PLACE).distinct()

    @cached_property
    def _terrain(self) -> tuple[DataFrame, Observation]:
        """Stored, since positives and negatives both join it; its gaps are counted on the way."""
        found, seen = observed(
            terrain_at(self.places, self.cells, self.grid),
            no_elevation=F.count_if(F.col("elevation").isNull()), no_slope=F.count_if(F.col("slope").isNull()),
            places=F.count("*"),
        )
        return stage(found, "terrain"), seen

    @property
    def terrain(self) -> DataFrame:
        return self._terrain[0]

    @property
    def terrain_counts(self) -> Observation:
        return self._terrain[1]

    @cached_property
    def nearest(self) -> DataFrame:
        return stage(nearest_stations(self.places, self.stations), "nearest-stations")

    @cached_property
    def readings(self) -> DataFrame:
        """What the stations in use say about the days of the reports; stored, since negatives fall on the same days."""
        days = self.reports.select(F.to_date("Date").alias("day"))
        return stage(
            station_days(needed_readings(self.daily, self.nearest, days), self.allow_future), "readings"
        )

    @cached_property
    def answering(self) -> DataFrame:
        """Places with a snow depth on any day, that is with a station that has a reading of it; stored, one row per place."""
        heard = self.readings.filter(F.col("snow_depth").isNotNull()).select("station_triplet").distinct()
        asked = self.nearest.select(*PLACE, F.explode("stations.station_triplet").alias("station_triplet"))
        return stage(asked.join(heard, "station_triplet", "left_semi").select(*PLACE).distinct(), "answering")

    def weather(self, place_days: DataFrame) -> DataFrame:
        """Weather at places of the reports, on days from the first to the last of them."""
        return with_weather(place_days, self.nearest, self.readings)

    @cached_property
    def report_weather(self) -> DataFrame:
        """Weather per distinct place and day with a report."""
        return self.weather(
            self.reports.select(*PLACE, F.to_date("Date").alias("day")).distinct()
        )

    @cached_property
    def positives(self) -> DataFrame:
        return combine.positives(self.reports, self.terrain, self.report_weather, self.order)

    def negatives(self, positives: DataFrame, ratio: float = fv.NEGATIVE_RATIO) -> DataFrame:
        """``positives`` should be the stored table: it is read several times."""
        def values(place_days: DataFrame) -> DataFrame:
            return interpolate(place_days, self.nearest, self.readings)

        return negatives.negatives(
            positives, self.terrain, values, ratio, answering=self.answering, nearest=self.nearest)

    def training(self, ratio: float = fv.NEGATIVE_RATIO) -> DataFrame:
        """Positives and negatives, each written once to the shared folder."""
        stored = stage(self.positives, "positives")
        return negatives.training_table(stored, self.negatives(stored, ratio))
