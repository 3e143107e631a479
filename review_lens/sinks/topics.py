"""Publishing messages."""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.schema import MESSAGE_SCHEMA
from review_lens.session import children, exists, write_text
from review_lens.sources.record_topic import COMMITS


@dataclass(frozen=True)
class Outlet:
    """A topic to write: Kafka options, or the folder of a topic kept as files."""

    format: str
    options: dict = field(default_factory=dict)


def kafka_outlet(servers: str, name: str) -> Outlet:
    """A Kafka topic; every send waits for all replicas."""
    return Outlet(
        "kafka", {"kafka.bootstrap.servers": servers, "topic": name, "kafka.acks": "all"}
    )


def file_outlet(path: str) -> Outlet:
    return Outlet("parquet", {"path": path})


def publish(messages: DataFrame, outlet: Outlet, run: str, batch_id: int | str) -> None:
    """Write (key, value) messages of one micro-batch of a stream.

    `batch_id` is the batch's number, or the column that has it.

    In a folder a batch counts once its writing is committed, with the names of its files: a
    stream by `sources.topics.record_topic` sees committed batches alone, and each once. A
    committed batch that is run again is not written again; what a failed one left is
    replaced. Kafka keeps both copies, so a reader of Kafka may see a message twice: the
    views in `operators.views` keep the newest of each.
    """
    if outlet.format == "kafka":
        messages.select("key", "value").write.format("kafka").options(**outlet.options).save()
        return
    spark, path = messages.sparkSession, outlet.options["path"].rstrip("/")
    if not isinstance(batch_id, str) and exists(spark, commit_file(path, run, batch_id)):
        return
    number = F.col(batch_id) if isinstance(batch_id, str) else F.lit(batch_id)
    (
        messages.select("key", "value", F.lit(run).alias("run"), number.cast("bigint").alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch_id")
        .parquet(path)
    )
    commit(spark, path, run, None if isinstance(batch_id, str) else batch_id)


def commit_file(path: str, run: str, batch_id: int) -> str:
    return f"{path}/{COMMITS}/{run}-{batch_id:012d}"


def committed(spark: SparkSession, outlet: Outlet, run: str) -> list[int]:
    """Numbers of the committed batches of a run in a folder topic."""
    names = children(spark, f"{outlet.options['path'].rstrip('/')}/{COMMITS}")
    return sorted(int(n.removeprefix(f"{run}-")) for n in names if n.startswith(f"{run}-"))


def commit(spark: SparkSession, path: str, run: str, batch_id: int | None) -> None:
    """Commit a written batch of a run, or all its batches, with files and their record counts."""
    folder = f"{path}/run={run}"
    if not exists(spark, folder):
        return
    if batch_id is None:
        numbers = sorted(int(n.removeprefix("batch_id=")) for n in children(spark, folder) if n.startswith("batch_id="))
    else:
        numbers = [batch_id] if exists(spark, f"{folder}/batch_id={batch_id}") else []
    done = set(committed(spark, file_outlet(path), run))
    numbers = [n for n in numbers if n not in done]
    if not numbers:
        return
    read = spark.read.schema(MESSAGE_SCHEMA).option("basePath", path)
    rows = read.parquet(*(f"{folder}/batch_id={n}" for n in numbers))
    # One row a file that was just written.
    counts = rows.groupBy("batch_id", F.col("_metadata.file_name").alias("file")).count().collect()
    for number in numbers:
        files = sorted((r.file, r["count"]) for r in counts if r.batch_id == number)
        said = [{"path": f"run={run}/batch_id={number}/{f}", "records": n} for f, n in files]
        write_text(spark, commit_file(path, run, number), json.dumps({"run": run, "batch_id": number, "files": said}))


def write_record_files(messages: DataFrame, path: str) -> None:
    """Write the values as text files, one JSON record per line, for `file_topic`."""
    messages.select("value").write.mode("append").text(path)
