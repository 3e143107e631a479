"""The landed review table, its side table, and its definition."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.schema import LANDED_SCHEMA, LANDING_PARTITIONS, REVIEW_COLUMNS
from review_lens.session import remove
from review_lens.sinks import buckets as B
from review_lens.sources.files import read_or_empty
from review_lens.sources.reviews import (
    folded_store,
    landed_files,
    read_files,
    without_old_versions,
)

PARTITIONS = LANDING_PARTITIONS.fieldNames()


def land(rows: DataFrame, path: str, source: str, run: str, batch_id: int, name=None) -> None:
    """Write one micro-batch of a stream as partitions of its own, by day of arrival.

    `run` names the stream for as long as its checkpoint lives. A batch that is run
    again has the same time of arrival, as that is part of the checkpoint, and so
    replaces the partitions it wrote before: nothing is lost and nothing doubled,
    whatever other streams land in the table. `name` is the catalog's name of it.
    """
    tagged = rows.withColumns(
        {
            "source": F.lit(source),
            "day": F.to_date("ingestion_timestamp"),
            "run": F.lit(run),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    if name:
        # One day per micro-batch, but for reviews that bring their own time.
        for (day,) in tagged.select("day").distinct().collect():
            value = "NULL" if day is None else f"DATE'{day}'"
            spec = f"source = '{source}', day = {value}, run = '{run}', batch_id = {batch_id}"
            rows.sparkSession.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")


def land_reviews(reviews: DataFrame, path: str, source: str, run: str, batch_id: int, name=None):
    land(reviews.select(*REVIEW_COLUMNS), path, source, run, batch_id, name)


def compact(spark: SparkSession, path: str, name=None) -> None:
    """Merge what has landed so far into few large files, one row per id, in the same partitions.

    For a table that nobody is reading: readers under way lose their files. `fold` is the way
    for a table in use. The merged rows are written as a run of source `compacted`; then exactly the files
    that were read are deleted. Batches that land meanwhile are neither read nor
    deleted. Between the two steps readers see a review twice, and the keyed view
    keeps one of them; so does it after a failure there.
    """
    landed = read_or_empty(spark, path, LANDED_SCHEMA)
    read = landed.inputFiles()
    if not read:
        return
    fixed = spark.read.schema(LANDED_SCHEMA).option("basePath", path).parquet(*read)
    run = uuid.uuid4().hex
    # Few files for each day, several where a day is large.
    newest = without_old_versions(fixed).hint("rebalance", "day")
    land_reviews(newest, path, "compacted", run, 0, name)
    for file in read:
        remove(spark, file)
    remove_empty(spark, path, {file.rsplit("/", 1)[0] for file in read})
    if name:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def fold(
    spark: SparkSession, path: str, buckets=B.BUCKETS, keep=B.KEEP, layers=1, name=None
) -> B.Snapshot | None:
    """Take what has landed since the last call into the table's buckets of ids.

    The newest version of each id becomes a row of its bucket. Only buckets with new ids get
    written: as one more layer, or whole once they have more than `layers`. `buckets` holds
    for the first call. Readers go on with what they began with, through `keep` - 1 further
    calls: layers and landed files are deleted when none of the newest `keep` snapshots needs them, and
    landed files not before `operators.examples` has taken them, where that is in use.
    `name` is the catalog's name of the landing partitions; those deleted go from it.
    """
    store = folded_store(path)
    held = B.newest(spark, store)
    files = landed_files(spark, path)
    fresh = set(files) - (held.taken if held else set())
    if fresh:
        held = held or B.Snapshot(-1, buckets)
        rows = B.dealt(without_old_versions(read_files(spark, path, fresh)), "id", held.buckets)
        folded = B.added(
            rows, store, held.tables.get("reviews", {}), "id", held.buckets, layers, without_old_versions
        )
        taken = fresh | (held.taken & set(files))
        held = B.Snapshot(held.version + 1, held.buckets, {"reviews": folded}, frozenset(taken))
        B.publish(spark, store, held)
    if held:
        release(spark, path, B.prune(spark, store, keep), keep, name)
    return held


def release(spark: SparkSession, path: str, kept: list[B.Snapshot], keep: int, name=None) -> None:
    """Delete landed files that all kept snapshots have taken, and those of the examples as well."""
    if len(kept) < keep:
        return
    examples = B.newest(spark, examples_store(path))
    done = set(kept[0].taken) & (set(examples.taken) if examples else set(kept[0].taken))
    gone = [file for file in landed_files(spark, path) if file in done]
    for file in gone:
        remove(spark, f"{path.rstrip('/')}/{file}")
    remove_empty(spark, path, {f"{path.rstrip('/')}/{file.rsplit('/', 1)[0]}" for file in gone})
    if name and gone:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def examples_store(path: str) -> str:
    """Where the training examples of a landed table are kept up to date."""
    return f"{path.rstrip('/')}/_examples"


def remove_empty(spark: SparkSession, root: str, folders: set[str]) -> None:
    """Delete partition folders that hold no rows any more, and those above them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    top = hadoop(root).getName()
    for folder in map(hadoop, folders):
        while folder.getName() != top and fs.exists(folder):
            if any(not status.getPath().getName().startswith(".") for status in fs.listStatus(folder)):
                break
            fs.delete(folder, True)
            folder = folder.getParent()


def create_review_table(spark: SparkSession, name: str, location: str) -> None:
    """Define the landed table in the catalog, with all that has landed there so far.

    Jobs that are given its name add the partitions that they land.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LANDED_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{location}'"
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(location)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
