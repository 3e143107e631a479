"""Reviews at rest: delimited files and the landed table."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_lens.operators.keyed import comment_tie, latest_per_key
from review_lens.schema import CSV_SCHEMA, LANDED_SCHEMA, QUARANTINE_SCHEMA
from review_lens.sinks import buckets as B
from review_lens.sources.files import read_or_empty

# Quotes are doubled inside quoted fields.
CSV_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_review_csv(
    spark: SparkSession, path: str, schema=CSV_SCHEMA, multi_line=True
) -> DataFrame:
    """Delimited review files with a header; the types are given, never inferred.

    With `multi_line` comments may hold line breaks, and a file is read by one task.
    Without it, large files are split among tasks.
    """
    return spark.read.schema(schema).options(**CSV_FORMAT, multiLine=multi_line).csv(path)


def in_file_order(rows: DataFrame) -> DataFrame:
    """Add `file` and `place`, which together follow the order of the rows on disk.

    A delimited file with line breaks in its fields is read by one task, so ids
    that grow along a task also grow along the file.
    """
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )


def folded_store(path: str) -> str:
    """Where the folded part of a landed table is; Spark's readers pass over the name."""
    return f"{path.rstrip('/')}/_keyed"


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """Files of the landing partitions, as paths below the table. One listing, as by any reader."""
    files = read_or_empty(spark, path, LANDED_SCHEMA).inputFiles()
    return [unquote(file[file.index("/source=") + 1 :]) for file in files]


def read_files(spark: SparkSession, path: str, files) -> DataFrame:
    """The rows of some of the landed files."""
    if not files:
        return spark.createDataFrame([], LANDED_SCHEMA)
    whole = [f"{path.rstrip('/')}/{file}" for file in sorted(files)]
    return spark.read.schema(LANDED_SCHEMA).option("basePath", path).parquet(*whole)


def read_folded(spark: SparkSession, path: str, held: B.Snapshot) -> DataFrame:
    """All layers of the folded rows, bucketed by id."""
    return B.held_table(spark, folded_store(path), held, "reviews", LANDED_SCHEMA, "id")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Every landed version of every review, but for those that folding replaced; what is
    not folded prunes by its partitions."""
    held = B.newest(spark, folded_store(path))
    if held is None:
        return read_or_empty(spark, path, LANDED_SCHEMA)
    fresh = set(landed_files(spark, path)) - held.taken
    folded = read_folded(spark, path, held).select(*LANDED_SCHEMA.fieldNames())
    return folded.unionByName(read_files(spark, path, fresh)) if fresh else folded


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The keyed view of the landed table: the newest version of each id.

    Folded rows are bucketed by id and stay where they are; only what landed since is
    shuffled to them.
    """
    held = B.newest(spark, folded_store(path))
    if held is None:
        return without_old_versions(read_or_empty(spark, path, LANDED_SCHEMA))
    names = LANDED_SCHEMA.fieldNames()
    folded = without_old_versions(read_folded(spark, path, held)).select(*names)
    fresh = set(landed_files(spark, path)) - held.taken
    if not fresh:
        return folded
    new = B.dealt(without_old_versions(read_files(spark, path, fresh)), "id", held.buckets)
    order = ["ingestion_timestamp", "date_time", "label", "tie", "n_star"]
    order += [name for name in names if name not in order]
    folded, new = (rows.withColumn("tie", comment_tie()) for rows in (folded, new))
    row = lambda t: F.when(F.col(f"{t}.id").isNotNull(), F.struct(*(f"{t}.{c}" for c in order)))
    joined = folded.alias("a").join(new.alias("b"), F.col("a.id") == F.col("b.id"), "full")
    return joined.select(F.greatest(row("a"), row("b")).alias("row")).select(*(f"row.{c}" for c in names))


def without_old_versions(landed: DataFrame) -> DataFrame:
    """The newest version of each id.

    Versions that arrived at the same instant rank by content, so that every
    reader sees the same one, before and after a compaction.
    """
    return latest_per_key(
        landed,
        "id",
        "ingestion_timestamp",
        F.col("date_time").desc_nulls_last(),
        F.col("label").desc_nulls_last(),
        comment_tie().desc(),
        F.col("n_star").desc_nulls_last(),
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Records that could not be stored, with the reason and the raw text."""
    return read_or_empty(spark, path, QUARANTINE_SCHEMA)
