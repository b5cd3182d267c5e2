"""Fixed values.

Everything here must equal what existing users of these results expect: word lists, lookup tables,
constants, patterns and text formats. Nothing here is derived, and no logic lives here.
"""

# Tokens a CSV cell may hold for "missing" (the default list of pandas.read_csv).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Cells of a report that mean "missing" once trimmed.
PLACEHOLDERS = ["-", ""]

# Destructive size, for example "D2.5".
SIZE_PATTERN = r"D(\d+\.?\d*)"

# Triggers kept as natural; a missing trigger is kept as well.
NATURAL_TRIGGERS = ["N", "U"]

EARTH_RADIUS_KM = 6371
METRES_PER_DEGREE = 111320
CM_PER_INCH = 2.54
METRES_PER_FOOT = 0.3048

# Elevation cells that carry no reading.
GRID_NODATA = -32768.0
GRID_FLOOR = -999.0

# Compass sectors of 45 degrees, the first centred on north.
COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Inclusive box: south, north, west, east.
STATE_BOX = (36.9, 41.1, -109.1, -102.0)

# Look-back of a daily reading, in days before and after the wanted day, and of the 24 h change.
READING_DAYS_BEFORE = 3
READING_DAYS_AFTER = 1
CHANGE_DAYS_BEFORE = 4

NEAREST_STATIONS = 3
IDW_POWER = 2

# Negative sampling.
NEGATIVE_RATIO = 2.0
REPORTING_LAG_DAYS = 10
ATTEMPTS_PER_NEGATIVE = 10

FEATURES = ["elevation", "slope", "aspect_degrees", "snow_depth", "new_snow_24h", "swe", "temp"]

POSITIVE_COLUMNS = [
    "Observation ID", "Date", "Longitude", "latitude",
    "Area", "Aspect", "Type", "Trigger",
    "avalanche_size", "avalanche_occurred",
    "elevation", "slope", "aspect_degrees", "aspect_cardinal",
    "snow_depth", "new_snow_24h", "swe", "temp", "wind_speed",
    "nearest_stations", "nearest_distances",
]

# Decimals kept per column when a training table is rounded.
ROUNDING = {
    "Longitude": 4, "latitude": 4,
    "elevation": 1, "slope": 1, "aspect_degrees": 1,
    "snow_depth": 1, "new_snow_24h": 1, "swe": 1, "temp": 1, "wind_speed": 1,
    "avalanche_size": 1,
}

TEST_SHARE = 0.2
SEED = 42
FOLDS = 5
MIN_SIZE_EXAMPLES = 100
EXPLAIN_SAMPLE = 100

# Decision thresholds tried, and the miss rate below which one counts as safe.
SWEEP_THRESHOLDS = [0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7]
CURVE_THRESHOLDS = (0.1, 0.9, 50)
SAFE_MISS_RATE = 0.25

# Upper miss rate (exclusive) and the rating it earns; the last one has no upper bound.
SWEEP_RATINGS = [
    (0.15, "✓ Excellent (very safe)"),
    (0.25, "✓ Good (safe)"),
    (0.35, "⚠ Acceptable"),
    (None, "✗ Too risky"),
]
FINAL_RATINGS = [
    (0.15, "✓ EXCELLENT: Very safe model (missing <15% of avalanches)"),
    (0.25, "✓ GOOD: Safe model (missing <25% of avalanches)"),
    (0.35, "⚠ ACCEPTABLE: Could be safer (missing <35% of avalanches)"),
    (None, "✗ NEEDS IMPROVEMENT: Too many missed avalanches (>35%)"),
]

# How far below the threshold the middle risk level starts.
MODERATE_BAND = 0.1
RISK_HIGH, RISK_MODERATE, RISK_LOW = "HIGH DANGER", "MODERATE", "LOW/SAFE"
RISK_ICONS = {RISK_HIGH: "🔴", RISK_MODERATE: "🟡", RISK_LOW: "🟢"}

IMPACT_UP, IMPACT_DOWN = "↑ INCREASES RISK", "↓ DECREASES RISK"

# Notes on a factor that raises risk: feature, bound the value must exceed, text.
RAISING_NOTES = [
    ("new_snow_24h", 20, " (heavy recent snowfall - CRITICAL)"),
    ("slope", 35, " (steep slope - HIGH IMPACT)"),
    ("temp", 0, " (warming temps - unstable snow)"),
    ("snow_depth", 150, " (very deep snowpack)"),
]
# Notes on a factor that lowers risk: feature, bound the value must stay under, text.
LOWERING_NOTES = [
    ("new_snow_24h", 5, " (minimal new snow)"),
    ("temp", -10, " (cold temps - stable snow)"),
    ("slope", 30, " (gentler slope)"),
]

ADVICE_HIGH = "  ⚠️ DANGEROUS CONDITIONS. Avoid all avalanche terrain."
ADVICE_MODERATE = "  ⚠️ CONSIDERABLE DANGER. Careful snowpack evaluation required."
ADVICE_LOW = "  ✓ LOW DANGER. Normal caution advised."
THRESHOLD_ADVICE = "Use threshold=%.2f for predictions"

# What-if rows: name, then the seven features in the order of FEATURES.
SCENARIOS = [
    ("Heavy new snow on steep slope", 3400.0, 38.0, 315.0, 125.0, 35.0, 32.0, -5.0),
    ("Deep snowpack but no new snow", 3400.0, 38.0, 315.0, 200.0, 0.0, 60.0, -12.0),
    ("Warming temps on loaded slope", 3200.0, 40.0, 180.0, 130.0, 15.0, 35.0, 2.0),
    ("Low angle, minimal snow", 2800.0, 25.0, 90.0, 50.0, 2.0, 12.0, -8.0),
]

# Forest and boosting settings, and the tuning grid.
FOREST = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 10}
BOOSTING = {"maxIter": 200, "maxDepth": 5, "stepSize": 0.1}
GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [10, 15, 20, None],
    "minInstancesPerNode": [5, 10, 20],
    "balanced": [True, False],
}
