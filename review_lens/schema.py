"""Record layouts and the fixed vocabulary of the label grammar."""

from pyspark.sql import types as T

# The aspect names in the order of every label vector, and the
# sentiment codes (0 means the aspect is absent; OTHERS is only 0 or 1).
ASPECTS = (
    "BATTERY",
    "CAMERA",
    "DESIGN",
    "FEATURES",
    "GENERAL",
    "PERFORMANCE",
    "PRICE",
    "SCREEN",
    "SER&ACC",
    "STORAGE",
    "OTHERS",
)
OTHERS = "OTHERS"
SENTIMENT_CODES = {"Negative": 1, "Neutral": 2, "Positive": 3}

RATED_ASPECTS = tuple(a for a in ASPECTS if a != OTHERS)
SENTIMENT_NAMES = {code: name for name, code in SENTIMENT_CODES.items()}
CODES = (0, *SENTIMENT_NAMES)

# Default slice of a feed and default cap of a trigger, in records.
SLICE_ROWS = 1024

# One JSON record of a review topic. Never inferred; every field nullable.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("n_star", T.IntegerType()),
        T.StructField("date_time", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

# Partitions of what micro-batches land: where it came from, the day it came in, the
# stream (by its checkpoint) and the number of its micro-batch.
LANDING_PARTITIONS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# A stored review.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("n_star", T.IntegerType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("label", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
    ]
)
REVIEW_COLUMNS = tuple(REVIEW_SCHEMA.fieldNames())
LANDED_SCHEMA = T.StructType(REVIEW_SCHEMA.fields + LANDING_PARTITIONS.fields)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        *LANDING_PARTITIONS.fields,
    ]
)

# Reviews that came in before any model was published, until one scores them.
WAITING_SCHEMA = LANDED_SCHEMA

# A delimited review file: header row, fields in this order.
CSV_SCHEMA = T.StructType(
    [
        T.StructField("comment", T.StringType()),
        T.StructField("n_star", T.IntegerType()),
        T.StructField("date_time", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

# The fields of a prediction message, in its order.
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("n_star", T.IntegerType()),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("label", T.StringType()),
        T.StructField("predicted_label", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampType()),
    ]
)

PREDICTION_COLUMNS = tuple(PREDICTION_SCHEMA.fieldNames())

# The fields of a metrics message, in its (alphabetical) order.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("accuracy_per_label", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("exact_match_accuracy", T.DoubleType()),
        T.StructField("f1_macro", T.DoubleType()),
        T.StructField("f1_micro", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_records", T.LongType()),
    ]
)

# One message of a topic kept as files.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# One published generation of models.
PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("training_rows", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)
