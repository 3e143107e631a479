"""Queries over predictions and metrics."""

import time

from pyspark.sql import functions as F

from review_lens.functions import labels as L
from review_lens.functions.records import as_messages, from_messages
from review_lens.operators import quality as Q
from review_lens.operators import views as V
from review_lens.operators.matrix import aspect_matrix
from review_lens.plans import fixtures as P
from review_lens.schema import ASPECTS, METRICS_SCHEMA, PREDICTION_COLUMNS, PREDICTION_SCHEMA
from review_lens.session import scratch_dir
from review_lens.sinks.topics import file_outlet, publish
from review_lens.sources.topics import read_messages, record_topic
from review_lens.streaming import tails

_MEASURES = ("accuracy_per_label", "exact_match_accuracy", "f1_micro", "f1_macro")


def _rounded(rows):
    return rows.withColumns({c: F.round(c, 9) for c in _MEASURES})


def _vectors(spark, sf_dir):
    true = L.aspect_array("_true").alias("true_array")
    guess = L.aspect_array("_pred").alias("prediction_array")
    return P.predicted(spark, sf_dir).select("doc_id", "batch_id", true, guess)


def flattened_label_pairs(spark, sf_dir):
    """True and predicted vectors flattened to one pair per aspect, counted."""
    pairs = Q.flattened_pairs(_vectors(spark, sf_dir), "batch_id")
    counted = pairs.groupBy("batch_id", "true_code", "predicted_code")
    return counted.agg(F.count(F.lit(1)).alias("pairs"))


def confusion_by_batch(spark, sf_dir):
    """Tallies per batch and class."""
    return Q.confusion_tallies(Q.flattened_pairs(_vectors(spark, sf_dir), "batch_id"))


def _metrics(spark, sf_dir):
    return Q.batch_metrics(P.predicted(spark, sf_dir))


def batch_quality_metrics(spark, sf_dir):
    """Accuracy, exact match and both F1 scores per batch."""
    return _rounded(_metrics(spark, sf_dir))


def training_overlap_by_batch(spark, sf_dir):
    """How many reviews of each batch carry a comment of the training matrix."""
    batches = P.predicted(spark, sf_dir).select("batch_id", F.col("text").alias("comment"))
    return Q.training_overlap(batches, aspect_matrix(P.reviews(spark, sf_dir)))


def _predictions(spark, sf_dir):
    rows = P.predicted(spark, sf_dir).withColumn("predicted_label", L.encode("_pred"))
    return rows.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("comment"),
        (1 + F.col("doc_id") % 5).cast("int").alias("n_star"),
        F.lit(None).cast("timestamp").alias("date_time"),
        L.encode("_true").alias("label"),
        "predicted_label",
        P.arrival().cast("timestamp").alias("processing_timestamp"),
    ).select(*PREDICTION_COLUMNS)


def prediction_messages(spark, sf_dir):
    """Predictions published as JSON and decoded again."""
    path = scratch_dir(spark, "predictions")
    publish(as_messages(_predictions(spark, sf_dir), key="id"), file_outlet(path), "run", 0)
    decoded = from_messages(read_messages(spark, path), PREDICTION_SCHEMA)
    time = F.col("processing_timestamp").cast("timestamp_ntz").alias("processing_timestamp")
    return decoded.select("id", "comment", "n_star", "label", "predicted_label", time)


def recent_predictions_50(spark, sf_dir):
    """The fifty newest predictions, as a dashboard lists them."""
    sent = _predictions(spark, sf_dir)
    # Every third review was scored before, with another result.
    before = sent.where("id % 3 = 0").withColumns(
        {
            "processing_timestamp": F.col("processing_timestamp") - F.expr("INTERVAL 1 HOUR"),
            "predicted_label": F.lit("{OTHERS};"),
        }
    )
    newest = V.recent_predictions(sent.union(before).union(sent))
    return newest.withColumn(
        "processing_timestamp", F.col("processing_timestamp").cast("timestamp_ntz")
    )


def live_predictions(spark, sf_dir):
    """The list that follows a topic of predictions, after each of three micro-batches: half of the
    reviews with older results of others, the other half, then repeats and late results."""
    base = scratch_dir(spark, "live")
    sent = _predictions(spark, sf_dir)
    before = sent.where("id % 3 = 0").withColumns(
        {
            "processing_timestamp": F.col("processing_timestamp") - F.expr("INTERVAL 1 HOUR"),
            "predicted_label": F.lit("{OTHERS};"),
        }
    )
    steps = [sent.where("id % 2 = 0").union(before), sent.where("id % 2 = 1"), sent.where("id % 5 = 0").union(before)]
    topic = record_topic(f"{base}/sent", f"{base}/journal", max_per_trigger=None)
    query = tails.start_recent(spark, topic, f"{base}/shown", f"{base}/state")
    for step, rows in enumerate(steps):
        publish(as_messages(rows, key="id"), file_outlet(f"{base}/sent"), "run", step)
        query.processAllAvailable()
        tails.recent(spark, f"{base}/shown").write.parquet(f"{base}/lists/step={step}")
    query.stop()
    stamp = F.col("processing_timestamp").cast("timestamp_ntz").alias("processing_timestamp")
    return spark.read.parquet(f"{base}/lists").select("step", stamp, "comment", "n_star", "label", "predicted_label")


def live_metrics(spark, sf_dir):
    """The history that follows a topic of metrics: every batch is measured again half a minute
    later, and once more with a stamp that is a year too late. `late` counts the last."""
    base = scratch_dir(spark, "live-metrics")
    rows = _stamped(_metrics(spark, sf_dir)).select(*METRICS_SCHEMA.fieldNames())
    again = rows.withColumns(
        {"timestamp": F.concat(F.substring("timestamp", 1, 17), F.lit("30")), "total_records": F.lit(0).cast("bigint")}
    )
    late = rows.withColumn("timestamp", F.concat(F.lit("2023"), F.substring("timestamp", 5, 30)))
    topic = record_topic(f"{base}/sent", f"{base}/journal", max_per_trigger=None)
    query = tails.start_history(spark, topic, f"{base}/shown", f"{base}/late", f"{base}/state", patience="30 days")
    for step, sent in enumerate((rows, again, late)):
        messages = as_messages(sent).withColumn("key", F.lit("stream"))
        publish(messages, file_outlet(f"{base}/sent"), "run", step)
        query.processAllAvailable()
    query.stop()
    # What Spark reports of a micro-batch arrives a moment after it.
    deadline = time.time() + 60
    while time.time() < deadline and tails.late_rows(spark, f"{base}/late").isEmpty():
        time.sleep(0.2)
    counted = tails.late_rows(spark, f"{base}/late").agg(F.sum("rows")).first()[0]
    return _rounded(tails.history(spark, f"{base}/shown")).withColumn("late", F.lit(counted).cast("bigint"))


def _stamped(metrics):
    """Metrics with the moment their batch would have been measured."""
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.col("batch_id").cast("int")
    )
    return metrics.withColumn("timestamp", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))


def _twice_published(spark, sf_dir):
    """Metrics messages of which every one was delivered twice, with an older stamp once."""
    path = scratch_dir(spark, "metrics")
    rows = _stamped(_metrics(spark, sf_dir)).select(*METRICS_SCHEMA.fieldNames())
    older = rows.withColumn("timestamp", F.concat(F.lit("2023"), F.substring("timestamp", 5, 30)))
    for batch, sent in enumerate((rows, older)):
        messages = as_messages(sent).withColumn("key", F.lit("stream"))
        publish(messages, file_outlet(path), "run", batch)
    return from_messages(read_messages(spark, path), METRICS_SCHEMA, "key")


def metrics_without_repeats(spark, sf_dir):
    """Metrics messages after repeated deliveries are dropped."""
    return _rounded(V.without_repeats(_twice_published(spark, sf_dir)))


def metrics_history_10(spark, sf_dir):
    """The ten newest metrics rows, as a dashboard lists them."""
    return _rounded(V.metrics_history(_twice_published(spark, sf_dir)))


def latest_metrics(spark, sf_dir):
    """The newest metrics row."""
    return _rounded(V.metrics_history(_twice_published(spark, sf_dir), limit=1))


def _label_sql(suffix):
    def piece(aspect):
        column = f'"{aspect}{suffix}"'
        if aspect == "OTHERS":
            return f"CASE WHEN {column} <> 0 THEN '{{OTHERS}};' ELSE '' END"
        return (
            f"CASE {column} WHEN 1 THEN '{{{aspect}#Negative}};' "
            f"WHEN 2 THEN '{{{aspect}#Neutral}};' WHEN 3 THEN '{{{aspect}#Positive}};' ELSE '' END"
        )

    return " || ".join(piece(a) for a in ASPECTS)


_PREDICTIONS_SQL = (
    P.PREDICTED_SQL
    + ", predictions AS (SELECT CAST(doc_id AS VARCHAR) AS id, text AS comment, "
    + "CAST(1 + doc_id % 5 AS INTEGER) AS n_star, "
    + f"{_label_sql('_true')} AS label, {_label_sql('_pred')} AS predicted_label, "
    + f"TIMESTAMP '2024-02-01 00:00:00' + to_minutes(doc_id // {P.ARRIVAL_ROWS}) "
    + "AS processing_timestamp FROM predicted)"
)

_ROUNDED_SQL = ", ".join(f"round({c}, 9) AS {c}" for c in _MEASURES)
_STAMP_SQL = (
    "strftime(TIMESTAMP '2024-02-01 00:00:00' + to_minutes(batch_id), '%Y-%m-%dT%H:%M:%S') "
    "AS timestamp"
)

QUERIES = {
    "flattened_label_pairs": (
        flattened_label_pairs,
        f"WITH {P.PREDICTED_SQL} SELECT batch_id, true_code, predicted_code, count(*) AS pairs "
        "FROM pairs GROUP BY batch_id, true_code, predicted_code",
    ),
    "confusion_by_batch": (
        confusion_by_batch,
        f"WITH {P.METRICS_SQL} SELECT batch_id, class, tp, fp, fn FROM tallies",
    ),
    "batch_quality_metrics": (
        batch_quality_metrics,
        f"WITH {P.METRICS_SQL} SELECT batch_id, {_ROUNDED_SQL}, total_records FROM metrics",
    ),
    "training_overlap_by_batch": (
        training_overlap_by_batch,
        f"WITH {P.ENTRIES_SQL}, known AS (SELECT DISTINCT comment FROM entries) "
        f"SELECT doc_id // {P.ARRIVAL_ROWS} AS batch_id, count(*) AS total_records, "
        "count(k.comment) AS trained_records "
        "FROM reviews r LEFT JOIN known k ON k.comment = r.comment GROUP BY 1",
    ),
    "prediction_messages": (
        prediction_messages,
        f"WITH {_PREDICTIONS_SQL} SELECT id, comment, n_star, label, predicted_label, "
        "processing_timestamp FROM predictions",
    ),
    "recent_predictions_50": (
        recent_predictions_50,
        f"WITH {_PREDICTIONS_SQL} SELECT processing_timestamp, comment, n_star, label, "
        "predicted_label FROM predictions ORDER BY processing_timestamp DESC, id LIMIT 50",
    ),
    "live_predictions": (
        live_predictions,
        f"WITH {_PREDICTIONS_SQL}, newest AS (SELECT * FROM predictions ORDER BY processing_timestamp DESC, id LIMIT 50), "
        "early AS (SELECT * FROM predictions WHERE CAST(id AS BIGINT) % 2 = 0 UNION ALL "
        "SELECT * REPLACE (processing_timestamp - INTERVAL 1 HOUR AS processing_timestamp, '{OTHERS};' AS predicted_label) "
        "FROM predictions WHERE CAST(id AS BIGINT) % 6 = 3), "
        "first AS (SELECT * FROM early ORDER BY processing_timestamp DESC, id LIMIT 50) "
        "SELECT 0 AS step, processing_timestamp, comment, n_star, label, predicted_label FROM first "
        "UNION ALL SELECT 1, processing_timestamp, comment, n_star, label, predicted_label FROM newest "
        "UNION ALL SELECT 2, processing_timestamp, comment, n_star, label, predicted_label FROM newest",
    ),
    "live_metrics": (
        live_metrics,
        f"WITH {P.METRICS_SQL} SELECT {_STAMP_SQL}, batch_id, total_records, {_ROUNDED_SQL}, "
        "(SELECT count(*) FROM metrics) AS late FROM metrics ORDER BY batch_id DESC LIMIT 10",
    ),
    "metrics_without_repeats": (
        metrics_without_repeats,
        f"WITH {P.METRICS_SQL} SELECT {_STAMP_SQL}, batch_id, total_records, {_ROUNDED_SQL} "
        "FROM metrics",
    ),
    "metrics_history_10": (
        metrics_history_10,
        f"WITH {P.METRICS_SQL} SELECT {_STAMP_SQL}, batch_id, total_records, {_ROUNDED_SQL} "
        "FROM metrics ORDER BY batch_id DESC LIMIT 10",
    ),
    "latest_metrics": (
        latest_metrics,
        f"WITH {P.METRICS_SQL} SELECT {_STAMP_SQL}, batch_id, total_records, {_ROUNDED_SQL} "
        "FROM metrics ORDER BY batch_id DESC LIMIT 1",
    ),
}
