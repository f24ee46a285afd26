"""Explicit schemas for the tables the engine reads and writes."""

from pyspark.sql import types as T

FEEDBACK_EVENTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
    T.StructField("text_hash", T.StringType(), True),
    T.StructField("model_score", T.DoubleType(), True),
    T.StructField("user_feedback", T.StringType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("target_score", T.DoubleType(), True),
])

FEEDBACK_REQUEST = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
    T.StructField("model_score", T.DoubleType(), True),
    T.StructField("user_feedback", T.StringType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
])

TRAINING_SET = T.StructType([
    T.StructField("text", T.StringType(), True),
    T.StructField("label", T.DoubleType(), True),
])

PREDICTIONS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("y_true", T.DoubleType(), True),
    T.StructField("y_pred", T.DoubleType(), True),
])

BAND_METRICS = T.StructType([
    T.StructField("range", T.StringType(), True),
    T.StructField("precision", T.DoubleType(), True),
    T.StructField("recall", T.DoubleType(), True),
    T.StructField("false_positives", T.LongType(), True),
    T.StructField("false_negatives", T.LongType(), True),
])

MODEL_METRICS = T.StructType([
    T.StructField("test_mae", T.DoubleType(), True),
    T.StructField("test_rmse", T.DoubleType(), True),
    T.StructField("test_samples", T.LongType(), True),
    T.StructField("experiment_name", T.StringType(), True),
    T.StructField("experiment_id", T.StringType(), True),
])

LOSS_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("phase", T.StringType(), False),
    T.StructField("epoch", T.LongType(), False),
    T.StructField("step", T.LongType(), False),
    T.StructField("loss", T.DoubleType(), True),
])

DATASET_MANIFEST = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("fingerprint", T.StringType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("registered_at", T.TimestampNTZType(), True),
])

DRIFT_STATE = T.StructType([
    T.StructField("run_ts", T.TimestampNTZType(), False),
    T.StructField("mean_score", T.DoubleType(), True),
])
