"""Schemas and column names shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of a reading (fixed by the message format).
TIMESTAMP = "timestamp"
LOCATION_ID = "location_id"
ELEVATION = "elevation_m"
RAINFALL = "rainfall_mm_per_hr"
TEMPERATURE = "temperature_c"
RIVER_LEVEL = "river_level_m"

KAFKA_TIMESTAMP = "kafka_timestamp"
PROCESSING_TIME = "processing_time"
RAW_VALUE = "raw_value"
FLOOD_RISK_LEVEL = "flood_risk_level"
ALERT_TYPE = "alert_type"
CORRUPT_RECORD = "_corrupt_record"

READING = T.StructType(
    [
        T.StructField(TIMESTAMP, T.StringType(), True),
        T.StructField(LOCATION_ID, T.StringType(), True),
        T.StructField(ELEVATION, T.DoubleType(), True),
        T.StructField(RAINFALL, T.DoubleType(), True),
        T.StructField(TEMPERATURE, T.DoubleType(), True),
        T.StructField(RIVER_LEVEL, T.DoubleType(), True),
    ]
)
READING_COLUMNS = [f.name for f in READING.fields]

# Columns of Spark's Kafka source, in its order.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

ALERT = T.StructType(
    [
        T.StructField(TIMESTAMP, T.StringType(), True),
        T.StructField(LOCATION_ID, T.StringType(), True),
        T.StructField(RAINFALL, T.DoubleType(), True),
        T.StructField(RIVER_LEVEL, T.DoubleType(), True),
        T.StructField(ALERT_TYPE, T.StringType(), True),
    ]
)
ALERT_WITH_TIME = T.StructType(
    ALERT.fields + [T.StructField(PROCESSING_TIME, T.TimestampType(), True)]
)

LOCATION_STATS = T.StructType(
    [
        T.StructField(LOCATION_ID, T.StringType(), True),
        T.StructField("total_records", T.LongType(), False),
        T.StructField("avg_rainfall", T.DoubleType(), True),
        T.StructField("max_rainfall", T.DoubleType(), True),
        T.StructField("min_rainfall", T.DoubleType(), True),
        T.StructField("avg_temperature", T.DoubleType(), True),
        T.StructField("avg_river_level", T.DoubleType(), True),
        T.StructField("max_river_level", T.DoubleType(), True),
    ]
)
