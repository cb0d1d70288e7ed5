"""Shape and fixed values of the metered-trip table."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: column names and types of one monthly file -------------------------
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)
TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
DATETIME_COLUMNS = [PICKUP, DROPOFF]

# --- Fixed values: documented codes and their labels ----------------------------------
CODE_DOMAINS = {
    "VendorID": [1, 2, 6, 7],
    "RatecodeID": [1, 2, 3, 4, 5, 6, 99],
    "payment_type": [0, 1, 2, 3, 4, 5, 6],
    "store_and_fwd_flag": ["Y", "N"],
}
PAYMENT_LABELS = {
    0: "Flex Fare",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_SLUGS = {
    0: "flex_fare",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}
VENDOR_SLUGS = {1: "creative_mobile", 2: "curb_mobility", 6: "myle", 7: "helix"}

FLEX_PAYMENT = 0
UNKNOWN_RATECODE = 99
SENTINEL_ZONES = [264, 265]
MAX_ZONE = 265

# --- Fixed values: groups of columns --------------------------------------------------
# Columns that go missing together on flex-fare rows.
BLOCK_COLUMNS = [
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
]
# Parts of total_amount, in the order in which they are added up.
AMOUNT_PARTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
]
METRIC_COLUMNS = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
]
IDENTITY_COLUMNS = [
    "VendorID",
    PICKUP,
    DROPOFF,
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "total_amount",
]

# --- Fixed values: output columns -----------------------------------------------------
REJECTION_REASON = "untrustworthy_pickup_timestamp"
QUALITY_FLAGS = [
    "is_flex_fare_record",
    "is_unknown_ratecode",
    "is_negative_transaction",
    "has_amount_sign_mismatch",
    "is_outside_reporting_month",
    "has_nonpositive_duration",
    "has_suspicious_long_duration",
    "has_near_24h_duration",
    "has_extreme_duration",
    "has_negative_distance",
    "has_zero_distance",
    "has_extreme_distance",
    "has_implausible_speed",
    "has_zero_passengers",
]
DURATION = "trip_duration_minutes"
SPEED = "average_speed_mph"

# --- Fixed values: thresholds ---------------------------------------------------------
LONG_MINUTES = 360.0
NEAR_DAY_MINUTES = 1380.0
DAY_MINUTES = 1440.0
EXTREME_MILES = 100.0
IMPLAUSIBLE_MPH = 80.0
CENT = 0.01
BOUNDARY_DAYS = 7

# --- Fixed values: bins, closed on the right ------------------------------------------
DURATION_EDGES = [0.0, 1.0, 360.0, 1200.0, 1380.0, 1440.0]
DURATION_BINS = ["<= 0 min", "0-1 min", "1 min-6 h", "6-20 h", "20-23 h", "23-24 h", "> 24 h"]
DISTANCE_EDGES = [0.0, 50.0, 100.0, 500.0]
DISTANCE_BINS = ["<= 0", "0-50", "50-100", "100-500", "> 500"]

# --- Fixed values: file naming --------------------------------------------------------
FILE_PREFIX = "yellow_tripdata_"
FILE_NAME_REGEX = r"^yellow_tripdata_(\d{4})-(\d{2})\.parquet$"
