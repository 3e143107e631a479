"""The jobs as commands, e.g. under `spark-submit review_lens/cli.py ingest ...`.

Topics are `kafka:SERVERS/NAME`, or the path of a folder of messages.
"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from review_lens.functions.records import from_messages  # noqa: E402
from review_lens.operators import views as V  # noqa: E402
from review_lens.operators.models import KEPT  # noqa: E402
from review_lens.schema import (  # noqa: E402
    CSV_SCHEMA,
    METRICS_SCHEMA,
    PREDICTION_SCHEMA,
    SLICE_ROWS,
)
from review_lens.session import build_session  # noqa: E402
from review_lens.sinks.buckets import BUCKETS, KEEP  # noqa: E402
from review_lens.sinks.tables import compact, create_review_table, fold  # noqa: E402
from review_lens.sinks.topics import file_outlet, kafka_outlet  # noqa: E402
from review_lens.sources.delimited import read_split_csv  # noqa: E402
from review_lens.sources.reviews import (  # noqa: E402
    CSV_FORMAT,
    in_file_order,
    read_review_csv,
)
from review_lens.sources.topics import (  # noqa: E402
    kafka_topic,
    message_topic,
    newest_messages,
    read_kafka,
    read_messages,
    record_topic,
)
from review_lens.streaming import jobs, tails  # noqa: E402


def _kafka(name):
    servers, _, topic = name.removeprefix("kafka:").rpartition("/")
    return servers, topic


def topic(name, starting=None, per_trigger=None, journal=None):
    """A topic to read. A folder is read from its beginning, some files at a time; where a start
    or a number of records is asked for, by the records of its committed batches, whose
    order is kept in `journal`."""
    if name.startswith("kafka:"):
        return kafka_topic(
            *_kafka(name), starting=starting or "earliest", max_per_trigger=per_trigger or SLICE_ROWS
        )
    if starting in (None, "earliest") and per_trigger is None:
        return message_topic(name)
    if journal is None:
        raise SystemExit(f"{name} is a folder: without a journal it takes neither --starting latest nor --per-trigger")
    return record_topic(name, journal, starting or "earliest", per_trigger or SLICE_ROWS)


def outlet(name):
    return kafka_outlet(*_kafka(name)) if name.startswith("kafka:") else file_outlet(name)


def parser():
    top = argparse.ArgumentParser(prog="review-lens", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(word, help, *options, **defaults):
        sub = commands.add_parser(word, help=help)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        for option, value in defaults.items():
            name = f"--{option.replace('_', '-')}"
            if value is False:
                sub.add_argument(name, action="store_true")
                continue
            kind = int if option in ("per_trigger", "size", "keep", "buckets", "layers", "fold_every") else str
            sub.add_argument(name, default=value, type=kind)
        return sub

    command("feed", "publish a review file once, in slices; under a name it can be resumed", "csv", "to",
            size=SLICE_ROWS, name=None, split=False)
    command("define", "define the landed table in the catalog", "table", "name")
    command("ingest", "land a topic", "topic", "table", "quarantine", "checkpoint",
            every="20 seconds", starting=None, per_trigger=None, name=None, fold_every=None, buckets=BUCKETS)
    command("retrain", "retrain all aspect models by the clock", "table", "models", "checkpoint",
            every="300 seconds", keep=KEPT, incremental=False)
    command("score", "score, publish, feed back and measure a topic", "topic", "models", "table",
            "quarantine", "predictions", "metrics", "checkpoint",
            every="60 seconds", starting=None, per_trigger=None, name=None)
    command("compact", "merge the versions of a landed table that nobody reads, in place", "table", name=None)
    command("fold", "merge what has landed into buckets of ids, under readers", "table",
            buckets=BUCKETS, layers=1, keep=KEEP, name=None)
    command("watch", "keep the newest predictions of a topic as a list", "predictions", "shown", "checkpoint",
            every="2 seconds")
    command("watch-metrics", "keep the metrics of a topic without repeats", "metrics", "shown", "late", "checkpoint",
            every="2 seconds", patience="1 hour")
    command("recent", "show the newest predictions of a topic", "predictions")
    command("history", "show the newest metrics of a topic", "metrics")
    return top


def published(spark, name):
    return read_kafka(spark, *_kafka(name)) if name.startswith("kafka:") else read_messages(spark, name)


def recent(spark, name):
    """The newest predictions; of a folder only the newest batches are read."""
    messages = published(spark, name)
    if not name.startswith("kafka:"):
        field = lambda path: F.get_json_object("value", path)
        wanted = V.RECENT_PREDICTIONS
        reviews = lambda m: m.select(field("$.id")).distinct().limit(wanted).count() >= wanted
        messages = newest_messages(messages, field("$.processing_timestamp").cast("timestamp"), reviews)
    return V.recent_predictions(from_messages(messages, PREDICTION_SCHEMA))


def history(spark, name):
    """The newest metrics; of a folder only the newest batches are read."""
    messages = published(spark, name)
    if not name.startswith("kafka:"):
        # A batch has one row of metrics.
        batches = lambda m: m.select("run", "batch_id").distinct().count() >= V.METRICS_HISTORY
        messages = newest_messages(messages, F.get_json_object("value", "$.timestamp"), batches)
    return V.metrics_history(from_messages(messages, METRICS_SCHEMA, "key"))


def journal(a):
    """Where a job keeps the order of a folder's batches: beside its checkpoint."""
    return f"{a.checkpoint.rstrip('/')}-journal"


def start(spark, a):
    """Run a command; a continuous job comes back as its running query."""
    trigger = {"processingTime": a.every} if "every" in a else None
    if a.command == "feed":
        if a.split:
            rows = read_split_csv(spark, a.csv, CSV_SCHEMA, CSV_FORMAT)
        else:
            rows = in_file_order(read_review_csv(spark, a.csv))
        if a.name:
            jobs.publish_feed(rows, outlet(a.to), a.name, "file", "place", size=a.size)
            return None
        return jobs.publish_rows(rows, outlet(a.to), "file", "place", size=a.size)
    if a.command == "define":
        return create_review_table(spark, a.name, a.table)
    if a.command == "ingest":
        source = topic(a.topic, a.starting, a.per_trigger, journal(a))
        return jobs.start_ingest(
            spark, source, a.table, a.quarantine, a.checkpoint, trigger=trigger, name=a.name,
            fold_every=a.fold_every, buckets=a.buckets,
        )
    if a.command == "retrain":
        return jobs.start_retraining(
            spark, a.table, a.models, a.checkpoint, trigger=trigger, keep=a.keep,
            incremental=a.incremental,
        )
    if a.command == "score":
        live = a.starting or ("latest" if a.topic.startswith("kafka:") else None)
        return jobs.start_scoring(
            spark, topic(a.topic, live, a.per_trigger, journal(a)), a.models, a.table, a.quarantine,
            outlet(a.predictions), outlet(a.metrics), a.checkpoint, trigger=trigger, name=a.name,
        )
    if a.command == "compact":
        return compact(spark, a.table, a.name)
    if a.command == "fold":
        fold(spark, a.table, a.buckets, a.keep, a.layers, a.name)
        return None
    if a.command == "watch":
        source = topic(a.predictions, "earliest", SLICE_ROWS, journal(a))
        return tails.start_recent(spark, source, a.shown, a.checkpoint, trigger=trigger)
    if a.command == "watch-metrics":
        source = topic(a.metrics, "earliest", SLICE_ROWS, journal(a))
        return tails.start_history(
            spark, source, a.shown, a.late, a.checkpoint, a.patience, trigger=trigger
        )
    if a.command == "recent":
        return recent(spark, a.predictions).show(V.RECENT_PREDICTIONS, truncate=False)
    return history(spark, a.metrics).show(V.METRICS_HISTORY, truncate=False)


def main(arguments=None):
    a = parser().parse_args(arguments)
    spark = build_session(app_name=f"review-lens {a.command}")
    query = start(spark, a)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
