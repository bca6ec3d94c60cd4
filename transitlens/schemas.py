"""Table schemas (Spark types for the reference's DDL)."""

from pyspark.sql import types as T

RAW_COLUMNS = [
    "vehicle_id", "line_id", "line_name", "station_naptan_id", "station_name",
    "platform_name", "direction", "destination_name", "destination_naptan_id",
    "current_location", "towards", "time_to_station", "expected_arrival",
    "timestamp_utc", "ingestion_id",
]

# The stand-in keeps the source row id as the last sort key of W1 (T4).
TIE_COLUMN = "event_id"

RAW_ARRIVALS = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS[:11]]
    + [
        T.StructField("time_to_station", T.IntegerType()),
        T.StructField("expected_arrival", T.TimestampNTZType()),
        T.StructField("timestamp_utc", T.TimestampNTZType()),
        T.StructField("ingestion_id", T.StringType()),
    ]
)

RAW_WITH_TIE = T.StructType(RAW_ARRIVALS.fields + [T.StructField(TIE_COLUMN, T.LongType())])

REF_STATIONS = T.StructType([
    T.StructField("naptan_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

REF_LINES = T.StructType([
    T.StructField("line_id", T.StringType()),
    T.StructField("line_name", T.StringType()),
    T.StructField("colour_hex", T.StringType()),
    T.StructField("colour_r", T.IntegerType()),
    T.StructField("colour_g", T.IntegerType()),
    T.StructField("colour_b", T.IntegerType()),
])

REF_LINE_ROUTES = T.StructType([
    T.StructField("line_id", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("coordinates", T.StringType()),
])

# Columns read from the latest row per vehicle into the parsed set (P5).
PARSED_BASE = [
    "vehicle_id", "line_id", "line_name", "direction", "destination_name",
    "current_location", "time_to_station", "station_name", "station_naptan_id",
    "towards", "timestamp_utc",
]
PARSED_NAMES = [
    "from_station_name", "to_station_name", "at_station_name", "approaching_station_name",
]

TRAIN_POSITIONS = [
    "vehicle_id", "line_id", "line_name", "direction", "destination_name",
    "current_location", "location_type", "time_to_station", "station_name", "towards",
    "timestamp_utc", "latitude", "longitude", "colour_hex", "colour_r", "colour_g", "colour_b",
]
