"""From report text to typed, filtered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.functions import measure, text
from firnline.functions.time import to_time


def observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with measures that are taken while it is written or otherwise run, without a job of their own."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen


def observed_row(spark: SparkSession, seen: Observation) -> DataFrame:
    """The whole numbers that were observed, as one row; their frame has to have run."""
    found = seen.get
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{n} long" for n in found))


def _text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.strip(quoted(c)) for c in _text_columns(df)})


def null_placeholders(df: DataFrame, tokens: list[str] = fv.PLACEHOLDERS) -> DataFrame:
    return df.withColumns({c: text.null_if_in(quoted(c), tokens) for c in _text_columns(df)})


def coerce_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.to_number(quoted(c)) for c in columns})


def natural_trigger(trigger: Column) -> Column:
    return trigger.isin(fv.NATURAL_TRIGGERS) | trigger.isNull()


def in_box(lon: Column, lat: Column, box=fv.STATE_BOX) -> Column:
    south, north, west, east = box
    return lat.between(south, north) & lon.between(west, east)


def clean_reports(raw: DataFrame, natural_only: bool = True) -> DataFrame:
    """Trim, drop unusable rows, type, label and optionally keep natural triggers.

    Columns of ``raw`` beyond the report schema (a source position) pass through.
    """
    report_columns = {
        "Observation ID", "Date", "Longitude", "latitude", "Aspect", "Area",
        "Destructive Size", "Type", "Trigger",
    }
    extra = [c for c in raw.columns if c not in report_columns]
    # Coordinates become numbers first: most unusable rows go before any other text is touched.
    located = coerce_numbers(raw, ["Longitude", "latitude"]).dropna(
        subset=["Longitude", "latitude"]
    )
    cleaned = located.select(
        *[quoted(c) for c in extra],
        text.cell(quoted("Observation ID")).alias("Observation ID"),
        to_time(text.cell(F.col("Date"))).alias("Date"),
        "Longitude",
        "latitude",
        text.cell(F.col("Aspect")).alias("Aspect"),
        text.cell(F.col("Area")).alias("Area"),
        text.destructive_size(quoted("Destructive Size")).alias("avalanche_size"),
        text.cell(F.col("Type")).alias("Type"),
        text.cell(F.col("Trigger")).alias("Trigger"),
        F.lit(1).alias("avalanche_occurred"),
    ).dropna(subset=["Date", "avalanche_size", "Area"])
    return cleaned.filter(natural_trigger(F.col("Trigger"))) if natural_only else cleaned


def counted_reports(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """Clean natural reports, and how many there were ``before`` and ``after`` the choice of triggers.

    The counts are taken while the reports are written: they cost no job.
    """
    natural = natural_trigger(F.col("Trigger"))
    typed, seen = observed(clean_reports(raw, natural_only=False), before=F.count("*"), after=F.count_if(natural))
    return typed.filter(natural), seen


def stations_from_records(records: DataFrame) -> DataFrame:
    """Usable station records inside the state box, ordered by name."""
    number = text.station_number(F.col("stationTriplet"))
    return (
        measure.nans_to_null(records).withColumn("station_id", number)
        .filter(F.col("station_id").isNotNull())
        .dropna(subset=["latitude", "longitude"])
        .filter(in_box(F.col("longitude"), F.col("latitude")))
        .select(
            "station_id",
            F.col("stationTriplet").alias("station_triplet"),
            F.coalesce("name", F.lit("")).alias("name"),
            "latitude",
            "longitude",
            F.col("elevation").alias("elevation_ft"),
            measure.feet_to_metres(F.col("elevation")).alias("elevation_m"),
            F.coalesce("countyName", F.lit("")).alias("county"),
            F.coalesce("huc", F.lit("")).alias("huc"),
            F.lit(True).alias("active"),
        )
        .orderBy("name", "station_id")
    )


def round_columns(df: DataFrame, rules: dict[str, int] = fv.ROUNDING) -> DataFrame:
    """Round the floating columns named in ``rules``; integers and text are left alone."""
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.withColumns(
        {c: measure.round_half_even(quoted(c), d) for c, d in rules.items() if c in floats}
    )
