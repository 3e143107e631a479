"""Training examples that follow the landed table, worked out from what landed since.

Two tables, in buckets and under snapshots (`sinks.buckets`), hold what later calls need: the
newest version of each review without its text, by id; and for each comment's digest the
newest code of every aspect, packed with its time of arrival, and the hashed term counts,
by digest. Newest codes are maxima, so a new version is merged into what is there. Where a
review's older version gave way, its digest may have lost a code: such digests, the
corrected ones alone, are worked out anew from the versions.

The result is that of `operators.matrix.landed_matrix`, whatever the order or number of calls, also
with batches that are run again. Texts of earlier calls are not read; versions and
examples are read by column, and only in buckets that new rows fall into, but that corrections scan
the digests of all versions.
"""

import uuid

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_lens.functions import labels as L
from review_lens.operators import features as X
from review_lens.operators.keyed import comment_tie, latest_per_key
from review_lens.operators.matrix import arrival_rank, comment_digest, packed_codes, unpacked
from review_lens.schema import OTHERS, RATED_ASPECTS, REVIEW_SCHEMA
from review_lens.session import remove, scratch_dir
from review_lens.sinks import buckets as B
from review_lens.sinks.tables import examples_store
from review_lens.sources.reviews import landed_files, read_files, read_landed

#: Layers that a bucket may have before it's rewritten.
LAYERS = 8

# What decides between the versions of an id, in this order.
_ORDER = ("ingestion_timestamp", "date_time", "label", "tie", "n_star")
VERSION_SCHEMA = T.StructType(
    [
        REVIEW_SCHEMA["id"],
        T.StructField("digest", T.BinaryType()),
        T.StructField("told", T.BooleanType()),
        *(T.StructField(c, T.LongType()) if c == "tie" else REVIEW_SCHEMA[c] for c in _ORDER),
    ]
)
EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        *(T.StructField(a, T.LongType()) for a in RATED_ASPECTS),
        T.StructField(OTHERS, T.LongType()),
        T.StructField("any", T.LongType()),
        T.StructField(X.COUNTS, VectorUDT.sqlType()),
    ]
)
_CODES = [f"`{name}`" for name in EXAMPLE_SCHEMA.fieldNames()[1:-1]]


def newest_versions(versions: DataFrame) -> DataFrame:
    """One row per id, by the order in which `landed_matrix` prefers versions."""
    return latest_per_key(versions, "id", *(F.col(c).desc_nulls_last() for c in _ORDER))


def newest_examples(examples: DataFrame) -> DataFrame:
    """The last written row of each digest; those that lost all labels are out."""
    return latest_per_key(examples, "digest", "layer").where("any <> 0")


def _usable(versions: DataFrame) -> DataFrame:
    """Digest, rank and label bits of the versions that may train models."""
    told = versions.where(F.col("told") & L.maybe_labelled("label"))
    return told.select("digest", arrival_rank(told, "ingestion_timestamp"), L.label_bits().alias("bits"))


def _changes(rows: DataFrame, versions: DataFrame, buckets: int) -> DataFrame:
    """New versions that beat the stored one of their id, with its digest if it had labels."""
    new = B.dealt(newest_versions(rows.select(*VERSION_SCHEMA.fieldNames())), "id", buckets)
    old = newest_versions(versions).select("id", "digest", "told", *_ORDER)
    row = lambda t: F.struct(*(f"{t}.{c}" for c in _ORDER))
    joined = new.alias("n").join(old.alias("o"), F.col("n.id") == F.col("o.id"), "left")
    counted = F.col("o.told") & L.maybe_labelled("o.label")
    return joined.where(F.col("o.id").isNull() | (row("n") > row("o"))).select(
        "n.*", F.when(counted, F.col("o.digest")).alias("lost")
    )


def _touched(table: DataFrame, keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of the buckets that some keys fall into; at most one number a bucket is gathered."""
    found = keys.select(B.bucket_of(key, buckets).alias("b")).distinct().collect()
    return table.where(F.col("bucket").isin([r.b for r in found]))


def update(
    spark: SparkSession, path: str, buckets=B.BUCKETS, keep=B.KEEP, layers=LAYERS
) -> B.Snapshot:
    """Take what has landed since the last call into the examples; the first call takes everything.

    `buckets` holds for the first call. A reader keeps the snapshot that it began with
    through `keep` - 1 further calls that find new rows.
    """
    store = examples_store(path)
    held = B.newest(spark, store)
    files = set(landed_files(spark, path))
    fresh = files - (held.taken if held else set())
    if held and not fresh:
        return held
    rows = read_files(spark, path, fresh) if held else read_landed(spark, path)
    held = held or B.Snapshot(-1, buckets, {"versions": {}, "examples": {}})
    rows = rows.withColumns(
        {"digest": comment_digest(), "told": F.col("comment").isNotNull(), "tie": comment_tie()}
    )
    work = scratch_dir(spark, "examples")
    current = f"current_{uuid.uuid4().hex}"
    try:
        versions = B.held_table(spark, store, held, "versions", VERSION_SCHEMA, "id")
        known = _touched(versions, rows.where("id IS NOT NULL"), "id", held.buckets)
        _changes(rows, known, held.buckets).write.parquet(f"{work}/changes")
        changes = spark.read.parquet(f"{work}/changes")
        stored = B.added(
            B.dealt(changes.select(*VERSION_SCHEMA.fieldNames()), "id", held.buckets),
            store, held.tables["versions"], "id", held.buckets, layers, newest_versions,
        )
        _delta(spark, store, held, changes, stored, current).write.parquet(f"{work}/delta")
        delta = spark.read.parquet(f"{work}/delta")
        examples = B.held_table(spark, store, held, "examples", EXAMPLE_SCHEMA, "digest")
        before = newest_examples(_touched(examples, delta, "digest", held.buckets))
        merged = _merged(B.dealt(delta, "digest", held.buckets), before, _counts(rows, changes, held.buckets))
        merged.write.parquet(f"{work}/merged")
        coded = B.added(
            B.dealt(spark.read.parquet(f"{work}/merged"), "digest", held.buckets),
            store, held.tables["examples"], "digest", held.buckets, layers, newest_examples,
        )
    finally:
        remove(spark, work)
        spark.sql(f"DROP TABLE IF EXISTS {current}")
    tables = {"versions": stored, "examples": coded}
    new = B.Snapshot(held.version + 1, held.buckets, tables, frozenset(fresh | (held.taken & files)))
    B.publish(spark, store, new)
    B.prune(spark, store, keep)
    return new


def _delta(
    spark: SparkSession, store: str, held: B.Snapshot, changes: DataFrame, stored: dict, current: str
) -> DataFrame:
    """(digest, codes, renewed) of all digests that a change concerns. Codes of `renewed` ones replace
    what is stored; the others' are merged with it. `current` names the table of new versions."""
    gained = _usable(changes)
    lost = changes.where("lost IS NOT NULL").select(F.col("lost").alias("digest")).distinct()
    if lost.isEmpty():
        return packed_codes(gained, "digest").withColumn("renewed", F.lit(False))
    now = newest_versions(B.define(spark, store, stored, VERSION_SCHEMA, "id", held.buckets, current))
    again = packed_codes(_usable(now.join(lost, "digest", "left_semi")), "digest")
    again = lost.join(again, "digest", "left").withColumn("renewed", F.lit(True))
    merged = packed_codes(gained.join(lost, "digest", "left_anti"), "digest")
    return again.unionByName(merged.withColumn("renewed", F.lit(False))).na.fill(0, ["any"])


def _counts(rows: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
    """Hashed term counts of the new texts that count, each worked out once."""
    wanted = _usable(changes).select("digest").distinct()
    texts = rows.where("told").select("digest", "comment").dropDuplicates(["digest"])
    counted = X.term_counts(texts.join(wanted, "digest", "left_semi"))
    return B.dealt(counted.select("digest", F.unwrap_udt(X.COUNTS).alias(X.COUNTS)), "digest", buckets)


def _merged(delta: DataFrame, before: DataFrame, counts: DataFrame) -> DataFrame:
    """The new rows of the examples; all sides are partitioned by digest alike."""
    joined = delta.alias("d").join(before.alias("b"), F.col("d.digest") == F.col("b.digest"), "left")
    joined = joined.join(counts.alias("c"), F.col("d.digest") == F.col("c.digest"), "left")
    codes = [
        F.when(F.col("d.renewed"), F.col(f"d.{c}")).otherwise(F.greatest(f"d.{c}", f"b.{c}")).alias(c.strip("`"))
        for c in _CODES
    ]
    kept = F.coalesce(f"c.{X.COUNTS}", f"b.{X.COUNTS}").alias(X.COUNTS)
    return joined.select("d.digest", *codes, kept)


def examples(spark: SparkSession, path: str) -> DataFrame:
    """(digest, codes of all aspects, term counts) of every labelled comment, as of the last update."""
    store = examples_store(path)
    held = B.newest(spark, store) or B.Snapshot(-1, B.BUCKETS)
    rows = newest_examples(B.held_table(spark, store, held, "examples", EXAMPLE_SCHEMA, "digest"))
    codes = [unpacked(a) for a in RATED_ASPECTS]
    return rows.selectExpr("digest", *codes, f"cast({OTHERS} AS INT) AS {OTHERS}", X.COUNTS)
