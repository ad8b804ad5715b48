"""Explicit schemas of every source (no inference unless asked for)."""

from pyspark.sql import types as T

# Labels file: two stacked sections; the wider one decides the schema.
LABELS = T.StructType([
    T.StructField("filename", T.StringType(), True),
    T.StructField("yield", T.DoubleType(), True),
    T.StructField("rainfall", T.DoubleType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("soil_ph", T.DoubleType(), True),
    T.StructField("fertilizer", T.DoubleType(), True),
    T.StructField("region", T.StringType(), True),
])

FIELDS = T.StructType([
    T.StructField("field_id", T.StringType(), True),
    T.StructField("mean_ndvi", T.DoubleType(), True),
    T.StructField("temperature", T.DoubleType(), True),
])

YIELDS = T.StructType([
    T.StructField("field_id", T.StringType(), True),
    T.StructField("yield", T.DoubleType(), True),
    T.StructField("fertilizer_cost", T.DoubleType(), True),
])

# Test table read by the streaming operators (explicit: a file stream needs one).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

# The scored history that the observation stream appends to.
HISTORY_WITHOUT_YIELD = T.StructType([
    T.StructField("field_id", T.LongType(), True),
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("ndvi", T.DoubleType(), True),
    T.StructField("health_index", T.DoubleType(), True),
    T.StructField("water_stress", T.DoubleType(), True),
    T.StructField("risk_score", T.DoubleType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
    T.StructField("health_class", T.StringType(), True),
    T.StructField("risk_class", T.StringType(), True),
])
HISTORY = T.StructType([*HISTORY_WITHOUT_YIELD.fields,
                        T.StructField("predicted_yield", T.DoubleType(), True)])
