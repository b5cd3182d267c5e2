"""Explicit table schemas; nothing in this package infers one."""

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampNTZType(), T.BooleanType()

RAW_REPORTS = _table(
    *[(name, STRING) for name in (
        "Observation ID", "Date", "Longitude", "latitude", "Aspect", "Area",
        "Destructive Size", "Type", "Trigger",
    )]
)

STATIONS = _table(
    ("station_id", STRING), ("station_triplet", STRING), ("name", STRING),
    ("latitude", DOUBLE), ("longitude", DOUBLE), ("elevation_ft", DOUBLE),
    ("elevation_m", DOUBLE), ("county", STRING), ("huc", STRING), ("active", BOOLEAN),
)

# One record of the landed station payload.
STATION_RECORD = _table(
    ("stationTriplet", STRING), ("name", STRING), ("latitude", DOUBLE), ("longitude", DOUBLE),
    ("elevation", DOUBLE), ("countyName", STRING), ("huc", STRING), ("_corrupt_record", STRING),
)

STATION_DAILY = _table(
    ("station_triplet", STRING), ("day", DATE),
    ("depth_in", DOUBLE), ("swe_in", DOUBLE), ("temp_f", DOUBLE),
)

ELEVATION_GRID = _table(
    ("tile_row", INT), ("tile_col", INT), ("row", INT), ("col", INT), ("elevation", DOUBLE),
)

TRAINING = _table(
    ("Observation ID", STRING), ("Date", TIMESTAMP), ("Longitude", DOUBLE), ("latitude", DOUBLE),
    ("Area", STRING), ("Aspect", STRING), ("Type", STRING), ("Trigger", STRING),
    ("avalanche_size", DOUBLE), ("avalanche_occurred", INT),
    ("elevation", DOUBLE), ("slope", DOUBLE), ("aspect_degrees", DOUBLE),
    ("aspect_cardinal", STRING),
    ("snow_depth", DOUBLE), ("new_snow_24h", DOUBLE), ("swe", DOUBLE), ("temp", DOUBLE),
    ("wind_speed", DOUBLE), ("nearest_stations", STRING), ("nearest_distances", STRING),
)

SCENARIOS = _table(
    ("name", STRING), ("elevation", DOUBLE), ("slope", DOUBLE), ("aspect_degrees", DOUBLE),
    ("snow_depth", DOUBLE), ("new_snow_24h", DOUBLE), ("swe", DOUBLE), ("temp", DOUBLE),
)

MODEL_META = _table(
    ("optimal_threshold", DOUBLE), ("feature_cols", T.ArrayType(STRING)),
    ("training_date", TIMESTAMP), ("model_type", STRING), ("tuned", BOOLEAN),
)
