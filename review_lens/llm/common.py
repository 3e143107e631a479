"""Helpers that the operators share: tables, folds, samples, settled tables, components."""

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from review_lens.llm.blocks import pieces
from review_lens.session import scratch_dir

#: The library's top package, as a folder.
PACKAGE = Path(__file__).resolve().parent.parent
#: Bytes of text that a Python worker holds in one Arrow batch, a text longer than this aside.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def ready(spark: SparkSession) -> None:
    """Set a session up for Python tasks: Arrow batches small in bytes, whatever the length
    of the texts, and this package sent to the executors, once for each context."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if PACKAGE.parent in getattr(context, "packages_sent", ()):
        return
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for module in PACKAGE.rglob("*.py"):
            archive.write(module, module.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    context.packages_sent = (PACKAGE.parent,)


def settled(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read again: it cuts the lineage
    and gives every later reader the same rows, also after an executor was lost."""
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fold(id_column: str, folds: int):
    """crc32 of the id as text, modulo `folds`. A null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(folds))


def bounded_sample(rows: DataFrame, group, keys: list, bound: int) -> DataFrame:
    """About `bound` rows of each group at most, picked by a hash of `keys`, which should
    tell rows with equal texts apart.

    The share to take follows from one count of each group, so a group that fits is
    taken whole. Only for fitting models; `group` must have few values (labels).
    """
    counts = rows.groupBy(group.alias("sample_group")).count().collect()
    share = F.lit(0.0)
    for row in counts:
        taken = F.lit(min(1.0, bound / row["count"]))
        share = F.when(group.eqNullSafe(F.lit(row["sample_group"])), taken).otherwise(share)
    drawn = F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(drawn < share)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, root) for every node of the edges (u, v): the smallest node it can reach.

    Large-star and small-star steps in turn until the edges no longer change. Each
    step groups with partial sums and joins on a node, a join that adaptive execution
    splits at a hub. Nothing but two totals per round comes to the driver.
    """

    def oriented(pairs):
        high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        return pairs.where("u <> v").select(high, low).distinct()

    def mark(pairs):
        parts = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(pairs.agg(F.count("*"), F.coalesce(F.sum(parts), F.lit(0))).first())

    now = settled(oriented(edges), purpose)
    seen = mark(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = oriented(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = oriented(pulled.union(least.select("u", F.col("m").alias("v"))))
        now = settled(small, purpose)
        before, seen = seen, mark(now)
        if seen == before:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def extended(docs: DataFrame, text_column: str, fields: str, make, keep=None) -> DataFrame:
    """The rows with new columns made from their texts, a block of texts at a time.

    `make` takes an Arrow array of texts and returns the arrays of `fields` (a schema as
    text). `keep` names the input columns to return, all by default; an input column
    with the name of a new one is replaced. Null texts reach `make` as null.
    """
    ready(docs.sparkSession)
    added = StructType.fromDDL(fields)
    names = docs.columns if keep is None else list(keep)
    names = [name for name in names if name.lower() not in {f.name.lower() for f in added}]
    own = "text_of_row_"
    while own in {name.lower() for name in names}:
        own += "_"
    text = F.col(f"`{text_column}`").cast("string").alias(own)
    picked = docs.select(*(F.col(f"`{name}`") for name in names), text)
    schema = StructType([picked.schema[name] for name in names] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, own):
            made = make(piece.column(len(names)))
            arrays = [piece.column(k) for k in range(len(names))] + list(made)
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return picked.mapInArrow(run, schema)


def kept_where(docs: DataFrame, text_column: str, judge, condition) -> DataFrame:
    """The rows for which `condition` holds on what `judge(rows, text column)` adds. The
    rows come back as they were, also columns with names that the judge uses itself."""
    names = docs.columns
    plain = docs.toDF(*(f"c{k}_" for k in range(len(names))))
    judged = judge(plain, f"c{names.index(text_column)}_")
    return judged.where(condition).select(*(F.col(f"c{k}_").alias(name) for k, name in enumerate(names)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, id_column: str, text_column: str, bound: int
) -> tuple[DataFrame, dict[int, int]]:
    """(id, label, text) of about `bound` documents of each class 0 and 1 at most, and how
    many labelled documents each class has. Of several labels for an id the highest counts.

    Labels are sampled before they are joined: about 2 * `bound` ids at most are
    broadcast, and no text is shuffled.
    """
    known = docs.select(F.col(id_column).alias("id")).distinct()
    marks = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    marks = settled(marks.join(known, "id", "left_semi"), f"{label}-labels")
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    marks = bounded_sample(marks, F.col("label"), [F.col("id")], bound)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return texts.join(F.broadcast(marks), "id"), counts
