"""Keyed tables in buckets of their key, under snapshots that readers hold.

A store is a folder of its own. Each table in it has a fixed number of buckets, and each
bucket one or more layers: folders of Spark's own bucketed files, which are never changed. A
snapshot lists the layers of every bucket, and the landed files that went into them.
Readers see the newest snapshot, as a bucketed table of the session's catalog, so what
they group or join by the key needs no exchange. New rows are written as one more layer
of the buckets that they fall into; buckets with more layers than allowed are rewritten
alone. One writer at a time: of two, the second fails to publish.
"""

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from review_lens.session import children, remove

#: Newest snapshots whose files stay; a reader may hold any of them.
KEEP = 3
#: Buckets of a new table. A task reads a bucket, so choose it for the size to come.
BUCKETS = 64
RECORD = "kind STRING, name STRING, number INT, place STRING"


@dataclass(frozen=True)
class Snapshot:
    """`tables`: the folders of every bucket of every table, oldest layer first. `taken`: landed
    files that are in them and have not been deleted since."""

    version: int
    buckets: int
    tables: dict[str, dict[int, list[str]]] = field(default_factory=dict)
    taken: frozenset[str] = frozenset()

    def folders(self) -> set[str]:
        return {f for table in self.tables.values() for layers in table.values() for f in layers}


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark's bucketed writer puts a key into."""
    return F.expr(f"pmod(hash(`{key}`), {buckets})").cast("int")


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the complete snapshots, oldest first."""
    folder = f"{store}/snapshots"
    return sorted(int(n) for n in children(spark, folder) if "_SUCCESS" in children(spark, f"{folder}/{n}"))


def snapshot(spark: SparkSession, store: str, version: int) -> Snapshot:
    """A snapshot by its number. Its records are as many as the buckets' layers and recent files."""
    rows = spark.read.schema(RECORD).parquet(f"{store}/snapshots/{version:010d}").collect()
    tables: dict[str, dict[int, list[str]]] = {}
    for row in sorted(r for r in rows if r.kind == "layer"):
        place, folder = row.place.split(" ", 1)
        tables.setdefault(row.name, {}).setdefault(row.number, []).append((int(place), folder))
    tables = {t: {b: [f for _, f in sorted(layers)] for b, layers in held.items()} for t, held in tables.items()}
    for row in rows:
        if row.kind == "table":
            tables.setdefault(row.name, {})
    buckets = next(r.number for r in rows if r.kind == "buckets")
    return Snapshot(version, buckets, tables, frozenset(r.place for r in rows if r.kind == "taken"))


def newest(spark: SparkSession, store: str) -> Snapshot | None:
    found = versions(spark, store)
    return snapshot(spark, store, found[-1]) if found else None


def publish(spark: SparkSession, store: str, new: Snapshot) -> None:
    """Make a snapshot the newest. Fails if there is one of its number already."""
    rows = [("buckets", None, new.buckets, None)]
    for name, held in new.tables.items():
        rows.append(("table", name, None, None))
        rows += [("layer", name, b, f"{k} {f}") for b, layers in held.items() for k, f in enumerate(layers)]
    rows += [("taken", None, None, file) for file in new.taken]
    records = spark.createDataFrame(rows, RECORD).coalesce(1)
    records.write.mode("error").parquet(f"{store}/snapshots/{new.version:010d}")


def write_layer(rows: DataFrame, store: str, key: str, buckets: int) -> dict[int, str]:
    """Write rows as bucketed files, one a bucket; gives each bucket's folder below the store."""
    spark = rows.sparkSession
    name, folder = f"layer_{uuid.uuid4().hex}", f"rows/{uuid.uuid4().hex}"
    tagged = rows.withColumn("bucket", bucket_of(key, buckets))
    writer = tagged.write.partitionBy("bucket").bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{store}/{folder}").mode("error").saveAsTable(name)
    # Only the definition goes; the files are the store's.
    spark.sql(f"DROP TABLE {name}")
    found = [n for n in children(spark, f"{store}/{folder}") if n.startswith("bucket=")]
    return {int(n.removeprefix("bucket=")): f"{folder}/{n}" for n in found}


def dealt(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with a key, partitioned as the buckets are."""
    return rows.where(F.col(key).isNotNull()).repartition(buckets, key)


def define(
    spark: SparkSession, store: str, layers: dict[int, list[str]], schema: StructType, key: str, buckets: int, name: str
) -> DataFrame:
    """The rows of given layers, with `layer`, as a bucketed table of the session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, layer INT, bucket INT) USING parquet "
        f"PARTITIONED BY (layer, bucket) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{store}/rows'"
    )
    places = [(k, b, f) for b, held in layers.items() for k, f in enumerate(held)]
    if places:
        parts = " ".join(f"PARTITION (layer = {k}, bucket = {b}) LOCATION '{store}/{f}'" for k, b, f in places)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    return spark.table(name)


def held_table(spark: SparkSession, store: str, held: Snapshot, table: str, schema: StructType, key: str) -> DataFrame:
    """All layers of a snapshot's table, under a name of its own in the session's catalog."""
    name = held_name(store, table, held.version)
    return define(spark, store, held.tables.get(table, {}), schema, key, held.buckets, name)


def held_name(store: str, table: str, version: int) -> str:
    """The name that a snapshot's table has in the session's catalog."""
    return f"held_{hashlib.md5(store.encode()).hexdigest()[:16]}_{table}_{version + 1}"


def added(
    rows: DataFrame, store: str, held: dict[int, list[str]], key: str, buckets: int, limit: int, merge
) -> dict[int, list[str]]:
    """The layers of a table with one more, of `rows`, which have a key once each and are
    partitioned like the buckets. `merge` takes the rows of all layers, with `layer`, and keeps those that
    count; buckets of over `limit` layers are rewritten by it."""
    spark = rows.sparkSession
    fresh = write_layer(rows, store, key, buckets)
    layers = {b: [*held.get(b, []), *([fresh[b]] if b in fresh else [])] for b in held.keys() | fresh.keys()}
    full = {b: folders for b, folders in layers.items() if len(folders) > limit}
    if full:
        name = f"full_{uuid.uuid4().hex}"
        whole = define(spark, store, full, rows.schema, key, buckets, name)
        rewritten = write_layer(merge(whole).select(*rows.columns), store, key, buckets)
        spark.sql(f"DROP TABLE {name}")
        layers |= {b: [rewritten[b]] if b in rewritten else [] for b in full}
    return {b: folders for b, folders in layers.items() if folders}


def prune(spark: SparkSession, store: str, keep: int) -> list[Snapshot]:
    """Forget all but the newest `keep` snapshots and delete the layers that only those had.
    Gives the ones that stay, oldest first."""
    numbers = versions(spark, store)
    kept = [snapshot(spark, store, v) for v in numbers[-keep:]]
    needed = set().union(*(s.folders() for s in kept))
    for version in numbers[:-keep]:
        old = snapshot(spark, store, version)
        for folder in old.folders() - needed:
            remove(spark, f"{store}/{folder}")
        for table in old.tables:
            spark.sql(f"DROP TABLE IF EXISTS {held_name(store, table, version)}")
        remove(spark, f"{store}/snapshots/{version:010d}")
    return kept
