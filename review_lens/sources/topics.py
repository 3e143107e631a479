"""Review topics: a message broker, or a folder of text files in its place."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from review_lens.schema import MESSAGE_SCHEMA, SLICE_ROWS
from review_lens.sources import record_topic as record_source
from review_lens.sources.files import read_or_empty


@dataclass(frozen=True)
class Topic:
    """A topic to read: `format`, `options` and perhaps `schema` of a Spark source."""

    format: str
    options: dict = field(default_factory=dict)
    schema: StructType | None = None


def kafka_topic(servers: str, name: str, starting="earliest", max_per_trigger=SLICE_ROWS) -> Topic:
    """A Kafka topic; needs Spark's Kafka package on the cluster.

    `starting` is `earliest` for a feed that must be whole (training) and
    `latest` for one that only matters from now on (scoring).
    """
    return Topic(
        "kafka",
        {
            "kafka.bootstrap.servers": servers,
            "subscribe": name,
            "startingOffsets": starting,
            "maxOffsetsPerTrigger": str(max_per_trigger),
        },
    )


def file_topic(path: str, max_files_per_trigger=1) -> Topic:
    """A folder that text files with one JSON record per line arrive in."""
    return Topic("text", {"path": path, "maxFilesPerTrigger": str(max_files_per_trigger)})


def message_topic(path: str, max_files_per_trigger=10) -> Topic:
    """A folder that `sinks.topics.publish` writes its messages to."""
    options = {"path": path, "maxFilesPerTrigger": str(max_files_per_trigger)}
    return Topic("parquet", options, MESSAGE_SCHEMA)


def record_topic(path: str, journal: str, starting="earliest", max_per_trigger=SLICE_ROWS) -> Topic:
    """The same folder, by record: from its beginning or its end, so many records at a time.

    `journal` is a folder of the stream's own, kept as long as its checkpoint.
    """
    options = {"path": path, "journal": journal, "starting": starting}
    if max_per_trigger:
        options["limit"] = str(max_per_trigger)
    return Topic(record_source.NAME, options)


def _stream(spark: SparkSession, topic: Topic) -> DataFrame:
    if topic.format == record_source.NAME:
        record_source.register(spark)
    reader = spark.readStream.format(topic.format).options(**topic.options)
    return (reader.schema(topic.schema) if topic.schema else reader).load()


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """The endless stream of a topic's messages as one string column `value`."""
    return _stream(spark, topic).select(F.col("value").cast("string").alias("value"))


def stream_messages(spark: SparkSession, topic: Topic) -> DataFrame:
    """The endless stream of a topic's messages with their keys, for topics that have keys."""
    stream = _stream(spark, topic)
    return stream.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages published so far to a topic that is kept as files."""
    return read_or_empty(spark, path, MESSAGE_SCHEMA)


def kafka_history(servers: str, name: str) -> dict:
    """Options to read all messages of a Kafka topic in one batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": name,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def read_kafka(spark: SparkSession, servers: str, name: str) -> DataFrame:
    """All messages of a Kafka topic (key, value); needs Spark's Kafka package."""
    read = spark.read.format("kafka").options(**kafka_history(servers, name)).load()
    return read.select(F.col("key").cast("string"), F.col("value").cast("string"))


def newest_messages(messages: DataFrame, stamp, enough) -> DataFrame:
    """The newest batches of a topic that is kept as files, as far back as `enough` asks for.

    Batches of one stream follow each other in time. So the last 1, 2, 4, ... batches
    of each stream are read, until the count that `enough` gets from those as new
    as every batch left out is reached. `stamp` is the time in a message, and
    `enough` takes the messages and tells whether they suffice.
    """
    batches: dict[str, set[int]] = {}
    for file in messages.inputFiles():
        parts = dict(p.split("=", 1) for p in file.split("/") if "=" in p)
        batches.setdefault(parts["run"], set()).add(int(parts["batch_id"]))
    last = 1
    while any(len(numbers) > last for numbers in batches.values()):
        wanted, edges = F.lit(False), F.lit(False)
        for run, numbers in batches.items():
            newest = sorted(numbers)[-last:]
            own = F.col("run") == run
            wanted = wanted | (own & (F.col("batch_id") >= newest[0]))
            if len(numbers) > last:
                edges = edges | (own & (F.col("batch_id") == newest[0]))
        read = messages.where(wanted)
        oldest = read.where(edges).agg(F.max(stamp)).first()[0]
        if oldest is not None and enough(read.where(F.coalesce(stamp > F.lit(oldest), F.lit(False)))):
            return read
        last *= 2
    return messages


def clock(spark: SparkSession) -> DataFrame:
    """A stream that only serves to fire a trigger; its rows mean nothing."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()
