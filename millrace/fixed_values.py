"""Names, texts and limits that results must carry exactly.

Everything here is a plain value: column names, labels, thresholds, texts.
No logic lives in this module.
"""

# --- fixed values: trip contract (name, type), in contract order -------------
TRIP_COLUMNS = [
    ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "bigint"),
    ("trip_distance", "decimal(18,2)"),
    ("pickup_longitude", "double"),
    ("pickup_latitude", "double"),
    ("rate_code", "string"),
    ("store_and_fwd_flag", "string"),
    ("dropoff_longitude", "double"),
    ("dropoff_latitude", "double"),
    ("payment_type", "string"),
    ("fare_amount", "decimal(18,2)"),
    ("extra", "decimal(18,2)"),
    ("mta_tax", "decimal(18,2)"),
    ("tip_amount", "decimal(18,2)"),
    ("tolls_amount", "decimal(18,2)"),
    ("improvement_surcharge", "decimal(18,2)"),
    ("total_amount", "decimal(18,2)"),
]

# --- fixed values: limits ----------------------------------------------------
FARE_LOW, FARE_HIGH = 0, 500
LATITUDE_BOUNDS = (-90, 90)
LONGITUDE_BOUNDS = (-180, 180)
NULL_VALUE_LIMIT_PCT = 30
NULL_KEY_LIMIT_PCT = 5
STALE_AFTER_DAYS = 30
STALE_LIMIT_PCT = 50
MIN_FRESH_READINGS = 1
WHO_LIMIT = 15
HAZARDOUS_LIMIT = 250
WHO_AUDIT_LIMIT_PCT = 50
WHO_METRIC_LIMIT_PCT = 80
ALERT_ISSUES = 100
ALERT_MINUTES = 60
TREND_DAYS = 7
EXPORT_FILE_BYTES = 5_242_880

# --- fixed values: bands as (upper or lower edge, label) ---------------------
AIR_BANDS = [  # strictly above the edge, first match wins
    (250, "HAZARDOUS"),
    (150, "VERY_UNHEALTHY"),
    (55, "UNHEALTHY"),
    (35, "UNHEALTHY_SENSITIVE"),
    (15, "MODERATE"),
]
AIR_LOWEST = "GOOD"
AIR_MISSING = "NO_DATA"

FARE_BANDS = [  # strictly below the edge, first match wins
    (5, "< $5"),
    (10, "$5–$10"),
    (20, "$10–$20"),
    (50, "$20–$50"),
    (100, "$50–$100"),
]
FARE_HIGHEST = "> $100"
FARE_MISSING = "no fare"

FRESHNESS_BANDS = [  # at most this many days old
    (1, "✅ Fresh"),
    (7, "🟡 Week old"),
    (30, "🟠 Month old"),
]
FRESHNESS_OLDEST = "🔴 Stale (> 30 days)"

SCORE_BANDS = [(50, "red"), (80, "orange")]  # below the edge
SCORE_TOP = "green"

HEALTH_PASS = "🟢 PASS"
HEALTH_CRITICAL = "🔴 CRITICAL"
HEALTH_WARNING = "🟡 WARNING"

# --- fixed values: names and texts written by the checks ---------------------
TRIPS_TABLE = "silver"
READINGS_TABLE = "OPENAQ_FLATTENED"
NULLS_SUMMARY = "NULL check on critical fields: {n} null records found"
RANGE_SUMMARY = "Numeric range check on fare_amount: {n} out-of-range records"
SCHEMA_SUMMARY = "Schema validation: {n} unexpected columns found"
GEO_SUMMARY = "Geographic bounds check: {n} invalid coordinates"
NULLS_MESSAGE = "Rule 2 check complete: {n} NULL records found"
RANGE_MESSAGE = "Rule 3 check complete: {n} out-of-range records found"
SCHEMA_MESSAGE = "Rule 4 check complete: {n} unexpected columns found"
GEO_MESSAGE = "Rule 5 check complete. {n} invalid geographic coordinates found"
NULL_VALUE_ISSUE = "pm25_value is null"
STALE_ISSUE = "reading older than 30 days"
WHO_ISSUE = "PM2.5 exceeds WHO threshold of 15"
RUN_ALL_MESSAGE = "All DQ checks complete — NYC Taxi (4) + OpenAQ (3)."
SCORE_LABEL = "DQ Score"
CARD, CASH = "CARD", "CASH"
HEALTH_TABLE_PATTERNS = ["%SILVER%", "%BRONZE%", "%taxi%"]
TRIPS_DATASET, READINGS_DATASET = "NYC_TAXI", "OPENAQ"
