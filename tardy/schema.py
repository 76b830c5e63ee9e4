"""Declared schemas and the fixed column sets of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# The 31-column flights fact layout (name, type), in file order.
FLIGHT_FIELDS = [
    ("YEAR", T.IntegerType()),
    ("MONTH", T.IntegerType()),
    ("DAY", T.IntegerType()),
    ("DAY_OF_WEEK", T.IntegerType()),
    ("AIRLINE", T.StringType()),
    ("FLIGHT_NUMBER", T.StringType()),
    ("TAIL_NUMBER", T.StringType()),
    ("ORIGIN_AIRPORT", T.StringType()),
    ("DESTINATION_AIRPORT", T.StringType()),
    ("SCHEDULED_DEPARTURE", T.IntegerType()),
    ("DEPARTURE_TIME", T.IntegerType()),
    ("DEPARTURE_DELAY", T.DoubleType()),
    ("TAXI_OUT", T.DoubleType()),
    ("WHEELS_OFF", T.IntegerType()),
    ("SCHEDULED_TIME", T.DoubleType()),
    ("ELAPSED_TIME", T.DoubleType()),
    ("AIR_TIME", T.DoubleType()),
    ("DISTANCE", T.DoubleType()),
    ("WHEELS_ON", T.IntegerType()),
    ("TAXI_IN", T.DoubleType()),
    ("SCHEDULED_ARRIVAL", T.IntegerType()),
    ("ARRIVAL_TIME", T.IntegerType()),
    ("ARRIVAL_DELAY", T.DoubleType()),
    ("DIVERTED", T.IntegerType()),
    ("CANCELLED", T.IntegerType()),
    ("CANCELLATION_REASON", T.StringType()),
    ("AIR_SYSTEM_DELAY", T.DoubleType()),
    ("SECURITY_DELAY", T.DoubleType()),
    ("AIRLINE_DELAY", T.DoubleType()),
    ("LATE_AIRCRAFT_DELAY", T.DoubleType()),
    ("WEATHER_DELAY", T.DoubleType()),
]

FLIGHT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in FLIGHT_FIELDS])

# Codes that are upper-cased and trimmed before filtering and joining.
CODE_COLUMNS = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")

# The batch de-duplication key.
DEDUP_KEYS = [
    "YEAR", "MONTH", "DAY",
    "FLIGHT_NUMBER", "TAIL_NUMBER",
    "ORIGIN_AIRPORT", "SCHEDULED_DEPARTURE",
]

# The grain of the gold statistics (airline x origin x day).
GOLD_KEYS = [
    "FL_DATE",
    "AIRLINE", "AIRLINE_NAME",
    "ORIGIN_AIRPORT", "ORIGIN_AIRPORT_NAME", "ORIGIN_CITY", "ORIGIN_STATE",
]

# Dimension CSV headers and the names they get in the pipeline.
AIRLINE_RENAMES = {"IATA_CODE": "AIRLINE_CODE", "AIRLINE": "AIRLINE_NAME"}
AIRPORT_RENAMES = {
    "IATA_CODE": "AIRPORT_CODE",
    "AIRPORT": "AIRPORT_NAME",
    "CITY": "CITY_NAME",
    "STATE": "STATE_CODE",
}

# Labels of the two producers of gold rows.
BATCH_LABEL = "daily_batch"
STREAM_LABEL = "streaming_15min"
