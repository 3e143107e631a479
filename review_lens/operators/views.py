"""What a dashboard shows: the newest predictions and the history of metrics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.operators.keyed import latest_per_key

RECENT_PREDICTIONS = 50
METRICS_HISTORY = 10

# The columns of both lists, in their order.
PREDICTION_VIEW = ("processing_timestamp", "comment", "n_star", "label", "predicted_label")
METRICS_VIEW = (
    "timestamp",
    "batch_id",
    "total_records",
    "accuracy_per_label",
    "exact_match_accuracy",
    "f1_micro",
    "f1_macro",
)


def recent_predictions(predictions: DataFrame, limit=RECENT_PREDICTIONS) -> DataFrame:
    """The newest predictions, one for each review; each task sorts out its own newest rows first."""
    once = latest_per_key(predictions, "id", "processing_timestamp", "predicted_label")
    newest = once.orderBy(F.col("processing_timestamp").desc(), F.col("id")).limit(limit)
    return newest.select(*PREDICTION_VIEW)


def without_repeats(metrics: DataFrame, run="key") -> DataFrame:
    """The newest metrics of each micro-batch.

    A batch that is measured again is stamped anew, so repeats are known by the stream
    (`run`: the column that names it, the key of a metrics message) and the batch's
    number. Messages of an unnamed stream count as those of one stream.
    """
    known = metrics if run in metrics.columns else metrics.withColumn(run, F.lit(None).cast("string"))
    batch = F.struct(F.coalesce(run, F.lit("")), "batch_id")
    newest = latest_per_key(known.withColumn("_batch", batch), "_batch", "timestamp")
    return newest.drop("_batch", run)


def metrics_history(metrics: DataFrame, limit=METRICS_HISTORY, run="key") -> DataFrame:
    """The newest metrics rows, newest first."""
    newest = without_repeats(metrics, run).orderBy(
        F.col("timestamp").desc(), F.col("batch_id").desc()
    )
    return newest.limit(limit).select(*METRICS_VIEW)
