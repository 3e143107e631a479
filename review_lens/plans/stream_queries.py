"""Queries that run a continuous job over all reviews until its feed is used up."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.functions import labels as L
from review_lens.functions.records import from_messages
from review_lens.operators import examples
from review_lens.operators import models as M
from review_lens.operators.features import COUNTS
from review_lens.operators.quality import batch_metrics
from review_lens.plans import fixtures as P
from review_lens.plans.model_queries import trained_root
from review_lens.plans.record_queries import damaged_messages
from review_lens.schema import (
    ASPECTS,
    LANDED_SCHEMA,
    METRICS_SCHEMA,
    PREDICTION_SCHEMA,
    WIRE_SCHEMA,
)
from review_lens.session import scratch_dir
from review_lens.sinks.tables import fold, land_reviews
from review_lens.sinks.topics import file_outlet, write_record_files
from review_lens.sources.reviews import (
    landed_files,
    read_files,
    read_landed,
    read_quarantine,
    read_reviews,
)
from review_lens.sources.topics import (
    file_topic,
    read_messages,
    record_topic,
    stream_topic,
)
from review_lens.streaming.jobs import (
    publish_rows,
    start_ingest,
    start_retraining,
    start_scoring,
)

_ALL = {"availableNow": True}
_FILES = 24


def _feed(spark, messages, base):
    """Text files to stream, and a topic that takes in a third of them with each batch."""
    write_record_files(messages.repartition(_FILES), f"{base}/feed")
    return file_topic(f"{base}/feed", max_files_per_trigger=_FILES // 3)


def stream_feed(spark, sf_dir):
    """A table published once, in three slices."""
    base = scratch_dir(spark, "feeding")
    rows = P.reviews(spark, sf_dir).select("doc_id", "comment", "n_star", "label")
    publish_rows(rows, file_outlet(f"{base}/sent"), "doc_id", size=-(-rows.count() // 3))
    sent = read_messages(spark, f"{base}/sent")
    records = sent.select("batch_id", F.from_json("value", WIRE_SCHEMA).alias("data"))
    return records.groupBy(F.col("batch_id").alias("tick")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("data.n_star").alias("stars"),
        F.sum(F.length("data.label")).alias("label_letters"),
        F.count("data.id").alias("ids"),
    )


def _ingest(spark, messages):
    base = scratch_dir(spark, "ingest")
    topic = _feed(spark, messages, base)
    query = start_ingest(
        spark, topic, f"{base}/reviews", f"{base}/quarantine", f"{base}/state", trigger=_ALL
    )
    query.awaitTermination()
    return base


def stream_ingest_to_table(spark, sf_dir):
    """Reviews through the ingestion job into the keyed table."""
    base = _ingest(spark, P.wire_records(spark, sf_dir))
    time = F.col("date_time").cast("timestamp_ntz").alias("date_time")
    return read_reviews(spark, f"{base}/reviews").select("id", "comment", "n_star", time, "label")


def two_topics_one_table(spark, sf_dir):
    """Two topics with streams of their own land in one table; one of them is run again."""
    base = scratch_dir(spark, "two-topics")
    records = P.wire_records(spark, sf_dir)
    for part in (0, 1):
        topic = _feed(spark, records.where(F.col("doc_id") % 2 == part), f"{base}/{part}")
        for _ in range(1 + part):
            query = start_ingest(
                spark, topic, f"{base}/reviews", f"{base}/aside", f"{base}/state-{part}", trigger=_ALL
            )
            query.awaitTermination()
    # What a batch landed before it failed is replaced when it is run again.
    landed = read_landed(spark, f"{base}/reviews")
    again = landed.where("batch_id = 0").groupBy("run").count().orderBy("run").first().run
    copy = f"{base}/again"
    landed.where((F.col("run") == again) & (F.col("batch_id") == 0)).write.parquet(copy)
    rows = spark.read.schema(LANDED_SCHEMA).parquet(copy)
    land_reviews(rows, f"{base}/reviews", "train", again, 0)
    time = F.col("date_time").cast("timestamp_ntz").alias("date_time")
    return read_landed(spark, f"{base}/reviews").select("id", "comment", "n_star", time, "label")


def stream_quarantine(spark, sf_dir):
    """Damaged messages through the ingestion job: stored, or set aside with a reason."""
    base = _ingest(spark, damaged_messages(spark, sf_dir))
    stored = read_landed(spark, f"{base}/reviews").select(F.lit("stored").alias("outcome"))
    aside = read_quarantine(spark, f"{base}/quarantine").select(F.col("reason").alias("outcome"))
    return stored.union(aside).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


def _score(spark, sf_dir, records=None, base=None, models=None):
    base = base or scratch_dir(spark, "scoring")
    records = P.wire_records(spark, sf_dir) if records is None else records
    query = start_scoring(
        spark,
        _feed(spark, records, base),
        models or trained_root(spark, sf_dir),
        f"{base}/reviews",
        f"{base}/quarantine",
        file_outlet(f"{base}/predictions"),
        file_outlet(f"{base}/metrics"),
        f"{base}/state",
        trigger=_ALL,
    )
    query.awaitTermination()
    return base


def score_after_late_models(spark, sf_dir):
    """Half of the reviews come in before any model is published, half after."""
    base = scratch_dir(spark, "late-models")
    records = P.wire_records(spark, sf_dir)
    models = f"{base}/models"
    _score(spark, sf_dir, records.where("doc_id % 2 = 0"), base, models)
    trained = M.load(spark, trained_root(spark, sf_dir))
    M.publish(spark, trained, models)
    _score(spark, sf_dir, records.where("doc_id % 2 = 1"), base, models)
    sent = from_messages(read_messages(spark, f"{base}/predictions"), PREDICTION_SCHEMA)
    landed = read_landed(spark, f"{base}/reviews")
    predicted = sent.groupBy("id").agg(F.count(F.lit(1)).alias("predictions"))
    fed_back = landed.groupBy("id").agg(F.count(F.lit(1)).alias("fed_back"))
    return predicted.join(fed_back, "id", "full")


def stream_score_and_measure(spark, sf_dir):
    """Reviews through the scoring job; what came out of it on each side."""
    base = _score(spark, sf_dir)
    metrics = from_messages(read_messages(spark, f"{base}/metrics"), METRICS_SCHEMA)
    off = F.abs(F.col("f1_micro") - F.col("accuracy_per_label")) > 1e-12
    landed = read_landed(spark, f"{base}/reviews")

    def fact(rows, name, value):
        amount = rows.agg(value.cast("bigint").alias("amount"))
        return amount.select(F.lit(name).alias("fact"), "amount")

    return (
        fact(metrics, "measured", F.sum("total_records"))
        .union(fact(metrics, "micro f1 unlike accuracy", F.sum(off.cast("int"))))
        .union(fact(read_messages(spark, f"{base}/predictions"), "published", F.count(F.lit(1))))
        .union(fact(landed.where("source = 'test'"), "fed back", F.countDistinct("id")))
    )


def stream_batch_metrics(spark, sf_dir):
    """The published metrics against those worked out anew from the published predictions."""
    base = _score(spark, sf_dir)
    metrics = from_messages(read_messages(spark, f"{base}/metrics"), METRICS_SCHEMA).drop("timestamp")
    sent = from_messages(read_messages(spark, f"{base}/predictions"), PREDICTION_SCHEMA, "batch_id")
    coded = L.decoded(sent.select("batch_id", "label", "predicted_label"), suffix="_true")
    coded = L.decoded(coded, "predicted_label", "_pred")
    names = [c for c in metrics.columns if c != "batch_id"]
    anew = batch_metrics(coded).select("batch_id", *(F.col(c).alias(f"{c}_anew") for c in names))
    same = F.lit(True)
    for c in names:
        same = same & F.coalesce(F.abs(F.col(c) - F.col(f"{c}_anew")) < 1e-9, F.lit(False))
    both = metrics.join(anew, "batch_id", "full")
    return both.agg(F.sum("total_records").alias("records"), F.bool_and(same).alias("same"))


def scheduled_retrain(spark, sf_dir):
    """One tick of the retraining job: the generation that it published."""
    base = scratch_dir(spark, "retraining")
    rows = P.reviews(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("date_time", "ingestion_timestamp")}
    )
    land_reviews(rows, f"{base}/reviews", "train", "once", 0)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    query = start_retraining(
        spark, f"{base}/reviews", f"{base}/models", f"{base}/state", ticks, trigger=_ALL
    )
    query.awaitTermination()
    models = M.load(spark, f"{base}/models")
    published = spark.read.parquet(f"{base}/models/published")
    count = F.lit(len(models.classifiers)).alias("models")
    return published.select("version", "training_rows", count)


def _corrected(spark, sf_dir):
    """All reviews, and a later version of every thirtieth with another comment."""
    rows = P.reviews(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("date_time", "ingestion_timestamp")}
    )
    later = rows.where("doc_id % 30 = 0").withColumns(
        {
            "comment": F.concat("comment", F.lit(" corrected")),
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return rows, later


def _thirds(spark, sf_dir, path, repeat):
    """Land all reviews in three steps and stop after each; corrections come with the second, and
    with the third the second batch is run again if `repeat`."""
    rows, later = _corrected(spark, sf_dir)
    for step in range(3):
        mine = rows.where(F.col("doc_id") % 3 == step)
        land_reviews(mine.union(later) if step == 1 else mine, path, "train", "steps", step)
        if step == 2 and repeat:
            again = read_files(spark, path, [f for f in landed_files(spark, path) if "/batch_id=1/" in f])
            copy = scratch_dir(spark, "again")
            again.write.parquet(copy)
            land_reviews(spark.read.schema(LANDED_SCHEMA).parquet(copy), path, "train", "steps", 1)
        yield step


def incremental_matrix(spark, sf_dir):
    """Training examples kept up to date over three landings: codes and tokens of each text."""
    path = scratch_dir(spark, "incremental")
    for _ in _thirds(spark, sf_dir, path, repeat=True):
        examples.update(spark, path, buckets=8)
    rows = examples.examples(spark, path)
    tokens = F.aggregate(f"{COUNTS}.values", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        F.lower(F.hex("digest")).alias("digest"), *ASPECTS, tokens.cast("bigint").alias("tokens")
    )


def compacted_under_reader(spark, sf_dir):
    """Reviews seen by readers that were planned before the table was folded under them."""
    path = scratch_dir(spark, "folded")
    readers = []
    for _ in _thirds(spark, sf_dir, path, repeat=False):
        readers.append(read_reviews(spark, path))
        fold(spark, path, buckets=8, keep=4)
    readers.append(read_reviews(spark, path))
    time = F.col("date_time").cast("timestamp_ntz").alias("date_time")
    seen = [
        rows.select(F.lit(k).alias("reader"), "id", F.sha2("comment", 256).alias("comment"), "n_star", time, "label")
        for k, rows in enumerate(readers)
    ]
    return reduce(DataFrame.union, seen)


def capped_stream(spark, sf_dir):
    """A folder topic by record: no micro-batch takes more than an eighth of the reviews. The stream
    is stopped when it has caught up with two slices, and started again for the third."""
    base = scratch_dir(spark, "capped")
    rows = P.reviews(spark, sf_dir).select("doc_id", "comment", "n_star", "label")
    count = rows.count()
    size, cap = -(-count // 3), -(-count // 8)
    topic = record_topic(f"{base}/sent", f"{base}/journal", max_per_trigger=cap)

    def note(batch, number):
        batch.withColumn("tick", F.lit(number)).write.mode("overwrite").parquet(f"{base}/seen/{number}")

    for part in (F.col("doc_id") < 2 * size, F.col("doc_id") >= 2 * size):
        publish_rows(rows.where(part), file_outlet(f"{base}/sent"), "doc_id", size=size)
        writer = stream_topic(spark, topic).writeStream.foreachBatch(note)
        query = writer.option("checkpointLocation", f"{base}/state").start()
        query.processAllAvailable()
        query.stop()
    seen = spark.read.schema("value STRING, tick BIGINT").option("recursiveFileLookup", True).parquet(f"{base}/seen")
    records = seen.select("tick", F.from_json("value", WIRE_SCHEMA).alias("data"))
    each = records.groupBy("tick").agg(
        F.count(F.lit(1)).alias("records"), F.lit(0).cast("bigint").alias("ids"), F.lit(0).cast("bigint").alias("stars")
    )
    whole = records.agg(
        F.lit(-1).cast("bigint").alias("tick"),
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("data.id").alias("ids"),
        F.sum("data.n_star").alias("stars"),
    )
    return each.union(whole)


#: The reviews with later versions in the place of those they correct.
_CORRECT = [
    ("text AS comment", "CASE WHEN doc_id % 30 = 0 THEN text || ' corrected' ELSE text END AS comment"),
    (
        "AS ingestion_timestamp FROM coded",
        "+ CASE WHEN doc_id % 30 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS ingestion_timestamp FROM coded",
    ),
]


def _correct(sql):
    for old, new in _CORRECT:
        if old not in sql:
            raise ValueError(old)
        sql = sql.replace(old, new)
    return sql


_SEEN = "id, sha256(comment) AS comment, n_star, date_time, label FROM"

QUERIES = {
    "incremental_matrix": (
        incremental_matrix,
        f"WITH {_correct(P.MATRIX_SQL)}, bodies AS (SELECT comment, lower(comment) AS low, "
        r"regexp_replace(lower(comment), '[ \t\n\x0B\f\r]+$', '') AS body FROM matrix) "
        f"SELECT sha256(m.comment) AS digest, {', '.join('m.' + P._q(a) for a in ASPECTS)}, "
        r"CASE WHEN body = '' AND low <> '' THEN 0 ELSE len(string_split_regex(body, '[ \t\n\x0B\f\r]')) END "
        "AS tokens FROM matrix m JOIN bodies b ON b.comment = m.comment",
    ),
    "capped_stream": (
        capped_stream,
        f"WITH {P.REVIEWS_SQL}, n AS (SELECT count(*) AS n, (count(*) + 2) // 3 AS size, (count(*) + 7) // 8 AS cap FROM reviews), "
        "parts AS (SELECT 0 AS part, 2 * size AS amount, cap FROM n UNION ALL SELECT 1, n - 2 * size, cap FROM n), "
        "batches AS (SELECT part, k, least(cap, amount - k * cap) AS records "
        "FROM (SELECT part, amount, cap, unnest(range((amount + cap - 1) // cap)) AS k FROM parts)) "
        "SELECT row_number() OVER (ORDER BY part, k) - 1 AS tick, CAST(records AS BIGINT) AS records, "
        "CAST(0 AS BIGINT) AS ids, CAST(0 AS BIGINT) AS stars FROM batches "
        "UNION ALL SELECT -1, count(*), count(DISTINCT id), CAST(sum(n_star) AS BIGINT) FROM reviews",
    ),
    "compacted_under_reader": (
        compacted_under_reader,
        f"WITH {P.REVIEWS_SQL}, corrected AS (WITH {_correct(P.REVIEWS_SQL)} SELECT * FROM reviews) "
        f"SELECT 0 AS reader, {_SEEN} reviews WHERE doc_id % 3 = 0 "
        f"UNION ALL SELECT 1, {_SEEN} corrected WHERE doc_id % 3 < 2 "
        f"UNION ALL SELECT 2, {_SEEN} corrected UNION ALL SELECT 3, {_SEEN} corrected",
    ),
    "stream_feed": (
        stream_feed,
        f"WITH {P.REVIEWS_SQL}, sizes AS (SELECT (count(*) + 2) // 3 AS size FROM reviews), "
        "slices AS (SELECT doc_id // (SELECT size FROM sizes) AS slice, n_star, label "
        "FROM reviews), "
        "sent AS (SELECT slice AS tick, * FROM slices) "
        "SELECT tick, count(*) AS records, CAST(sum(n_star) AS BIGINT) AS stars, "
        "CAST(sum(length(label)) AS BIGINT) AS label_letters, count(*) AS ids "
        "FROM sent GROUP BY tick",
    ),
    "stream_ingest_to_table": (
        stream_ingest_to_table,
        f"WITH {P.REVIEWS_SQL} SELECT id, comment, n_star, date_time, label FROM reviews",
    ),
    "stream_quarantine": (
        stream_quarantine,
        f"WITH {P.REVIEWS_SQL} SELECT CASE doc_id % 9 WHEN 1 THEN 'unparsable' "
        "WHEN 2 THEN 'missing id' WHEN 5 THEN 'missing comment' ELSE 'stored' END AS outcome, "
        "count(*) AS messages FROM reviews GROUP BY 1",
    ),
    "stream_score_and_measure": (
        stream_score_and_measure,
        f"WITH {P.REVIEWS_SQL}, n AS (SELECT count(*) AS n FROM reviews) "
        "SELECT 'measured' AS fact, n AS amount FROM n "
        "UNION ALL SELECT 'micro f1 unlike accuracy', CAST(0 AS BIGINT) FROM n "
        "UNION ALL SELECT 'published', n FROM n UNION ALL SELECT 'fed back', n FROM n",
    ),
    "two_topics_one_table": (
        two_topics_one_table,
        f"WITH {P.REVIEWS_SQL} SELECT id, comment, n_star, date_time, label FROM reviews",
    ),
    "score_after_late_models": (
        score_after_late_models,
        f"WITH {P.REVIEWS_SQL} SELECT id, CAST(1 AS BIGINT) AS predictions, CAST(1 AS BIGINT) AS fed_back FROM reviews",
    ),
    "stream_batch_metrics": (
        stream_batch_metrics,
        f"WITH {P.REVIEWS_SQL} SELECT count(*) AS records, true AS same FROM reviews",
    ),
    "scheduled_retrain": (
        scheduled_retrain,
        f"WITH {P.MATRIX_SQL} SELECT CAST(0 AS BIGINT) AS version, count(*) AS training_rows, "
        f"{len(ASPECTS)} AS models FROM matrix",
    ),
}
