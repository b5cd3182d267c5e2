"""The engine's input tables, derived from a directory of general-purpose Parquet tables.

Each has a twin in ``twins.py`` that says the same in SQL, so results can be compared.
"""

from __future__ import annotations

import uuid
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.functions.measure import nans_to_null
from firnline.functions.time import plus_days
from firnline.operators import cleaning, terrain
from firnline.operators.nearest import PLACE
from firnline.plans.features import FeatureBuild
from firnline.session import shared_folder, stage
from firnline.sources import writers

GRID = terrain.Grid(x0=-109.0, dx=0.14, y0=41.0, dy=0.1, tile=16)
GRID_COLS = 50


def _west(k: Column) -> Column:
    """Degrees west in thousandths."""
    return 102050 + k % 6900


def _north(k: Column) -> Column:
    return 37050 + k % 3900


def _lon(k: Column) -> Column:
    return -_west(k).cast("double") / 1000.0


def _lat(k: Column) -> Column:
    return _north(k).cast("double") / 1000.0


def _thousandths(n: Column) -> Column:
    """An integer number of thousandths as decimal text."""
    return F.concat(
        F.floor(n / 1000).cast("string"), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0")
    )


def _choice(index: Column, words: list[str]) -> Column:
    """The word at an index, null past the end."""
    return F.try_element_at(F.array(*[F.lit(w) for w in words]), index.cast("int") + 1)


def _code(key: Column) -> Column:
    """A station's code: a number, with a letter in front for some."""
    return F.concat(F.when(key % 13 == 5, "A").otherwise(""), key.cast("string"))


FIRST_DAY, DAYS = "2022-01-01", 731  # of the reports and readings


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def stations(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.read("supplier").select(
            _code(key).alias("station_id"),
            F.concat(_code(key), F.lit(":CO:STN")).alias("station_triplet"),
            F.col("s_name").alias("name"),
            _lat(key * 104729).alias("latitude"),
            _lon(key * 7919).alias("longitude"),
            F.rint(F.col("s_acctbal")).alias("elevation_ft"),
        )

    @staticmethod
    def _place() -> tuple[Column, Column]:
        """What the coordinates of an order are made from: five customers share a place, some places lie exactly on a
        station."""
        place = F.floor(F.col("o_custkey") / 5)
        on_station = place % 25 == 0
        return (
            F.when(on_station, place % 10 * 7919).otherwise(place * 6007),
            F.when(on_station, place % 10 * 104729).otherwise(place * 3571),
        )

    @cached_property
    def raw_reports(self) -> DataFrame:
        """Reports as text, with a position that gives their order; stored, as a file would be.

        Orders are dealt to all cores by the four columns read, before they become texts.
        """
        k = F.col("o_orderkey")
        lon, lat = self._place()
        day = plus_days(
            F.lit(f"{FIRST_DAY} 08:15:00").cast("timestamp_ntz"), (k * 37 % DAYS).cast("int")
        )
        # Some reports write their date month first.
        written = F.when(k % 4 == 1, F.date_format(day, "M/d/yyyy H:mm")).otherwise(
            F.date_format(day, "yyyy-MM-dd HH:mm:ss")
        )
        status = F.col("o_orderstatus")
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        text = orders.repartition(self.spark.sparkContext.defaultParallelism).select(
            k.alias("source_pos"),
            (k % 5000).cast("string").alias("Observation ID"),
            F.when(k % 101 != 0, written).alias("Date"),
            F.when(k % 97 == 0, " - ").when(k % 89 == 0, "abc")
            .otherwise(F.concat(F.lit(" -"), _thousandths(_west(lon)), F.lit("\t")))
            .alias("Longitude"),
            F.when(k % 83 != 0, _thousandths(_north(lat))).alias("latitude"),
            F.when((k % 9 == 8) & (k % 2 == 0), "-").otherwise(_choice(k % 9, fv.COMPASS))
            .alias("Aspect"),
            F.when(k % 103 != 0, F.col("o_orderpriority")).alias("Area"),
            F.when(k % 11 == 1, "R3").when(k % 11 == 2, " D1.5 ").when(k % 11 == 3, "D2-D3")
            .when(k % 11 > 3, F.format_string("D%.1f", 1.0 + (k % 9) / 2.0))
            .alias("Destructive Size"),
            _choice(k % 7, ["SS", "HS", "WL", "L", "WS", "C", "-"]).alias("Type"),
            F.when(status == "F", "N").when(status == "O", "U").when(k % 2 == 1, "AS")
            .alias("Trigger"),
        )
        return stage(text, "raw-reports")

    @cached_property
    def reports(self) -> DataFrame:
        """Clean reports, stored: every later step reads them. ``report_counts`` is known once they are."""
        cleaned, self.report_counts = cleaning.counted_reports(self.raw_reports)
        return stage(cleaned, "reports")

    @cached_property
    def history(self) -> DataFrame:
        """Typed reports over several years, for exploration."""
        k = F.col("o_orderkey")
        lon, lat = self._place()
        return self.read("orders").select(
            k.alias("source_pos"),
            (k % 5000).cast("string").alias("Observation ID"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=(k % 24).cast("int"))).alias("Date"),
            F.when(k % 97 == 0, _lon(lon) - 8.0).otherwise(_lon(lon)).alias("Longitude"),
            _lat(lat).alias("latitude"),
            _choice(k % 9, fv.COMPASS).alias("Aspect"),
            F.when(k % 103 != 0, F.col("o_orderpriority")).alias("Area"),
            (1.0 + (k % 9) / 2.0).alias("avalanche_size"),
            _choice(k % 7, ["SS", "HS", "WL", "L", "WS", "C"]).alias("Type"),
            F.when(F.col("o_orderstatus") == "F", "N").when(F.col("o_orderstatus") == "O", "U")
            .alias("Trigger"),
        )

    @cached_property
    def landed_daily(self) -> DataFrame:
        """Daily readings as they land: NaN stands for some that are missing."""
        value, nan = F.col("value"), F.lit(float("nan"))
        mark = F.col("user_id") + F.col("n")
        return (
            self.read("events")
            .groupBy("user_id", (F.col("event_id") * 7919 % DAYS).cast("int").alias("n"))
            .agg(
                F.max(F.when(F.col("event_type") != "error", value)).alias("depth_in"),
                F.min(value).alias("swe_in"),
                (F.max(value) - 20.0).alias("temp_f"),
            )
            .select(
                F.concat(_code(F.col("user_id")), F.lit(":CO:STN")).alias("station_triplet"),
                F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("n")).alias("day"),
                F.when(mark % 17 == 0, nan).otherwise(F.col("depth_in")).alias("depth_in"),
                "swe_in",
                F.when(mark % 19 == 0, nan).otherwise(F.col("temp_f")).alias("temp_f"),
            )
        )

    @cached_property
    def stored_daily(self) -> DataFrame:
        """The landed readings as a table partitioned by month."""
        path = f"{shared_folder(self.spark)}/daily-{uuid.uuid4().hex}"
        writers.station_daily(self.landed_daily, path)
        return self.spark.read.parquet(path)

    @cached_property
    def bucketed_daily(self) -> DataFrame:
        """The landed readings as a table bucketed by station."""
        name = f"daily_{uuid.uuid4().hex}"
        return writers.station_daily_bucketed(self.landed_daily, name, f"{shared_folder(self.spark)}/{name}")

    @cached_property
    def daily(self) -> DataFrame:
        return nans_to_null(self.landed_daily)

    @cached_property
    def cells(self) -> DataFrame:
        return nans_to_null(self.landed_cells)

    @cached_property
    def landed_cells(self) -> DataFrame:
        key = F.col("p_partkey")
        row, col = F.floor(key / GRID_COLS), key % GRID_COLS
        flat = row.between(10, 16) & col.between(10, 16)
        height = F.when(key % 53 == 0, fv.GRID_NODATA).when(key % 59 == 0, float("nan")).when(
            flat, 2000.0
        ).otherwise(
            1500.0 + key * 37 % 2800
        )
        return terrain.tiled(
            self.read("part").select(row.alias("row"), col.alias("col"), height.alias("elevation")),
            GRID,
        )

    @cached_property
    def places(self) -> DataFrame:
        return self.reports.select(*PLACE).distinct()

    @cached_property
    def place_days(self) -> DataFrame:
        return self.reports.select(*PLACE, F.to_date("Date").alias("day")).distinct()

    @cached_property
    def scores(self) -> DataFrame:
        event = F.col("l_returnflag") == "R"
        raw = F.col("l_quantity") / 50.0 * 0.6 + F.when(event, 0.3).otherwise(0.1)
        return self.read("lineitem").select(
            event.cast("int").alias("label"), (F.rint(raw * 100.0) / 100.0).alias("score")
        )

    @cached_property
    def labelled(self) -> DataFrame:
        return self.read("labels").select(
            F.col("doc_id").alias("id"), F.col("quality").alias("label"), "toxic"
        )

    @cached_property
    def contributions(self) -> DataFrame:
        """Seven contributions per vector, and a value for each feature."""
        def entry(i: int) -> Column:
            return F.col("embedding")[i].cast("double")

        cells = F.array(*[
            F.struct(
                F.lit(name).alias("feature"),
                (entry(8 + i) * 200.0).alias("value"),
                F.when(entry(16 + i) > -0.25, entry(i)).otherwise(0.0).alias("shap_value"),
            )
            for i, name in enumerate(fv.FEATURES)
        ])
        return self.read("embeddings").select(F.col("vec_id").alias("id"), F.inline(cells))

    @cached_property
    def predictions(self) -> DataFrame:
        key = F.col("vec_id")
        return self.read("embeddings").select(
            key.alias("id"), (key * 37 % 101 / 100.0).alias("prediction")
        )

    @cached_property
    def build(self) -> FeatureBuild:
        return FeatureBuild(
            self.reports, self.stations, self.stored_daily, self.landed_cells, GRID, ["source_pos"]
        )

    @cached_property
    def positives(self) -> DataFrame:
        """The stored positive examples."""
        return stage(self.build.positives, "positives")

    @cached_property
    def training(self) -> DataFrame:
        """The stored training table."""
        from firnline.operators.negatives import training_table

        return stage(
            training_table(self.positives, self.build.negatives(self.positives)), "training"
        )


@lru_cache(maxsize=8)
def _opened(application: str, folder: str) -> Tables:
    return Tables(SparkSession.active(), folder)


def open_tables(spark: SparkSession, folder: str) -> Tables:
    """Tables of a folder; stored intermediate tables are shared within a session."""
    return _opened(spark.sparkContext.applicationId, folder.rstrip("/"))
