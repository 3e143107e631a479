"""The continuous jobs, wired on micro-batches."""

import logging
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.functions import labels as L
from review_lens.functions.labels import quoted
from review_lens.functions.records import accepted, as_messages, parse_records, rejected
from review_lens.operators import examples
from review_lens.operators import models as M
from review_lens.operators.matrix import landed_matrix
from review_lens.operators.quality import metrics_messages, one_batch_metrics
from review_lens.operators.slices import (
    derived_records,
    feed_namespace,
    feed_records,
    number_rows,
    slice_rows,
)
from review_lens.schema import (
    ASPECTS,
    PREDICTION_COLUMNS,
    REVIEW_COLUMNS,
    SLICE_ROWS,
    WAITING_SCHEMA,
    WIRE_SCHEMA,
)
from review_lens.session import remove, scratch_dir
from review_lens.sinks.buckets import BUCKETS
from review_lens.sinks.tables import fold, land, land_reviews, remove_empty
from review_lens.sinks.topics import Outlet, committed, publish
from review_lens.sources.files import read_or_empty
from review_lens.sources.reviews import read_landed
from review_lens.sources.topics import Topic, clock, stream_topic

logger = logging.getLogger(__name__)


def _start(stream: DataFrame, write, checkpoint: str, trigger: dict):
    """Start a stream; `write` takes a micro-batch, the stream's lasting id and the batch's number."""

    def numbered(batch: DataFrame, batch_id: int):
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run:
            raise RuntimeError("a micro-batch without the id of its stream")
        write(batch, run, batch_id)

    writer = stream.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def publish_rows(rows: DataFrame, outlet: Outlet, *order: str, size=SLICE_ROWS) -> None:
    """Publish a table once, as records in slices of `size` rows of the given order.

    A folder topic gets one partition for each slice, so that a stream can take one
    at a time; the order of what Kafka gets is up to its partitions.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "feed")
    try:
        sent = slice_rows(number_rows(rows, *order, path=f"{path}/numbered"), size=size)
        # Written once, as the records' ids are random.
        feed_records(sent).write.parquet(f"{path}/records")
        publish_slices(spark.read.parquet(f"{path}/records"), outlet)
    finally:
        remove(spark, path)


def publish_feed(rows: DataFrame, outlet: Outlet, feed: str, *order: str, size=SLICE_ROWS, most=None) -> int:
    """Publish a table to a folder topic under a name, so that it can be resumed.

    `feed` names the publication. Its committed slices are the ledger: a call goes on after the
    last of them, with at most `most` slices, and gives the number of slices published so
    far. Ids follow from the name, a row's position and its content, so a slice that was
    written but not committed is replaced by equal records. The table must not change meanwhile.
    """
    spark = rows.sparkSession
    run = f"feed-{feed_namespace(feed)}"
    done = len(committed(spark, outlet, run))
    path = scratch_dir(spark, "feed")
    try:
        sent = slice_rows(number_rows(rows, *order, path=f"{path}/numbered"), size=size)
        rest = sent.where(F.col("slice") >= done)
        rest = rest if most is None else rest.where(F.col("slice") < done + most)
        publish_slices(derived_records(rest, feed), outlet, run)
    finally:
        remove(spark, path)
    return len(committed(spark, outlet, run))


def publish_slices(records: DataFrame, outlet: Outlet, run=None) -> None:
    """Publish records that have the number of their slice, all in one job."""
    fields = [F.col(name) for name in WIRE_SCHEMA.fieldNames()]
    value = F.to_json(F.struct(*fields)).alias("value")
    key = F.lit(None).cast("string").alias("key")
    publish(records.select(key, value, "slice"), outlet, run or uuid.uuid4().hex, "slice")


def start_ingest(
    spark: SparkSession,
    topic: Topic,
    table: str,
    quarantine: str,
    checkpoint: str,
    source="train",
    trigger=None,
    name=None,
    fold_every=None,
    buckets=BUCKETS,
):
    """Land a review topic; every batch has partitions of its own in the table.

    `name` is the table's name in the catalog, if it is defined there. With `fold_every`
    each so many batches what has landed is folded into `buckets` buckets of ids, by this
    job alone, so that neither partitions nor old versions pile up.
    """

    def write(batch: DataFrame, run: str, batch_id: int):
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            land_reviews(accepted(batch), table, source, run, batch_id, name)
            land(rejected(batch), quarantine, source, run, batch_id)
            if fold_every and batch_id % fold_every == fold_every - 1:
                fold(spark, table, buckets, name=name)
        finally:
            batch.unpersist()

    parsed = parse_records(stream_topic(spark, topic))
    return _start(parsed, write, checkpoint, trigger or {"processingTime": "20 seconds"})


def retrain(
    spark: SparkSession, table: str, model_root: str, keep=M.KEPT, incremental=False, **fit_options
):
    """One retraining from the landed table; publishes unless it is empty.

    `incremental` reads only what landed since the last such call and keeps the training
    examples up to date beside the table; the examples are those of a full retraining.
    """
    if incremental:
        examples.update(spark, table)
        models = M.train_counted(examples.examples(spark, table), **fit_options)
    else:
        models = M.train(landed_matrix(read_landed(spark, table)), **fit_options)
    if models is None:
        logger.warning("no training rows in %s; nothing is published", table)
        return None
    newest = M.published_version(spark, model_root)
    models.version = 0 if newest is None else newest + 1
    M.publish(spark, models, model_root)
    M.retire(spark, model_root, keep)
    return models


def start_retraining(
    spark: SparkSession,
    table: str,
    model_root: str,
    checkpoint: str,
    ticks: DataFrame | None = None,
    trigger=None,
    **fit_options,
):
    """Retrain on every trigger of a clock; whatever `ticks` carries is not read."""

    def tick(_, run: str, batch_id: int):
        retrain(spark, table, model_root, **fit_options)

    ticks = clock(spark) if ticks is None else ticks
    return _start(ticks, tick, checkpoint, trigger or {"processingTime": "300 seconds"})


def predictions(scored: DataFrame) -> DataFrame:
    """Scored reviews in the layout of their message."""
    return M.with_predicted_label(scored).select(*PREDICTION_COLUMNS)


def feedback(scored: DataFrame) -> DataFrame:
    """Scored reviews in the layout of the training table."""
    return scored.withColumnRenamed("processing_timestamp", "ingestion_timestamp")


def aside(batch: DataFrame) -> DataFrame:
    """The useless records of a scoring batch in the layout of the side table."""
    return feedback(rejected(batch, "processing_timestamp"))


def quality(scored: DataFrame, batch_id: int) -> DataFrame:
    """The metrics row of a scored batch; no row for a batch without reviews."""
    coded = scored.select("label", *[quoted(f"{a}_pred") for a in ASPECTS])
    return one_batch_metrics(L.decoded(coded, suffix="_true"), batch_id)


@dataclass(frozen=True)
class Scoring:
    """Where a scoring job publishes, and where reviews wait for the first models."""

    predictions: Outlet
    metrics: Outlet
    waiting: str

    def publish(self, models, reviews: DataFrame, run: str, batch_id: int) -> None:
        """Score the reviews of one micro-batch, publish predictions and metrics."""
        scored = M.score(models, reviews).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            publish(as_messages(predictions(scored), key="id"), self.predictions, run, batch_id)
            metrics = as_messages(metrics_messages(quality(scored, batch_id)))
            publish(metrics.withColumn("key", F.lit(run)), self.metrics, run, batch_id)
        finally:
            scored.unpersist()

    def catch_up(self, spark: SparkSession, models) -> None:
        """Score the micro-batches that have waited, each under its own number."""
        waiting = read_or_empty(spark, self.waiting, WAITING_SCHEMA)
        for run, batch_id in waiting.select("run", "batch_id").distinct().collect():
            own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
            held = waiting.where(own).select(*REVIEW_COLUMNS)
            files = held.inputFiles()
            mine = [f for f in files if f"/run={run}/batch_id={batch_id}/" in f]
            self.publish(models, held.withColumnRenamed("ingestion_timestamp", "processing_timestamp"), run, batch_id)
            for file in mine:
                remove(spark, file)
            remove_empty(spark, self.waiting, {file.rsplit("/", 1)[0] for file in mine})


def start_scoring(
    spark: SparkSession,
    topic: Topic,
    model_root: str,
    table: str,
    quarantine: str,
    prediction_outlet: Outlet,
    metrics_outlet: Outlet,
    checkpoint: str,
    trigger=None,
    waiting=None,
    name=None,
):
    """Score a review topic, publish, feed back and measure, batch by batch.

    Every batch asks for the published models and loads them only when they are
    newer than those at hand. Reviews are fed back and bad records set aside in
    any case. Without any published model the reviews wait in a folder (`waiting`,
    beside the checkpoint by default); the first batch, or start of the job, that
    finds models scores them under their own batch numbers. All outputs are written
    per stream and batch, so a batch that fails half way is simply run again.
    """
    held = {"models": None}
    scoring = Scoring(prediction_outlet, metrics_outlet, waiting or f"{checkpoint.rstrip('/')}-waiting")

    def write(batch: DataFrame, run: str, batch_id: int):
        before = held["models"]
        held["models"] = M.load(spark, model_root, before)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        reviews = accepted(batch)
        try:
            land_reviews(feedback(reviews), table, "test", run, batch_id, name)
            land(aside(batch), quarantine, "test", run, batch_id)
            if held["models"] is None:
                logger.warning("batch %d: no published model yet, its reviews wait", batch_id)
                land_reviews(feedback(reviews), scoring.waiting, "test", run, batch_id)
                return
            if before is None:
                scoring.catch_up(spark, held["models"])
            scoring.publish(held["models"], reviews, run, batch_id)
        finally:
            batch.unpersist()

    models = M.load(spark, model_root)
    if models is not None:
        scoring.catch_up(spark, models)
    parsed = parse_records(stream_topic(spark, topic), stamp="processing_timestamp")
    return _start(parsed, write, checkpoint, trigger or {"processingTime": "60 seconds"})
