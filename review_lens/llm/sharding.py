"""Shards of near equal bytes, by sampled splitters.

Rows get a key that orders equal texts next to each other. A sample of the keys, each
drawn with a chance in proportion to its row's size, gives the quantiles at which the
keys are cut into ranges, many for each shard. The ranges' true sizes are then summed;
those that came out overfull are sampled anew and subdivided until none is left that
can be. Within a range rows are put in order, and with the sums of the ranges before
it every row knows how many bytes stand before it in all: that decides its shard. So
shards differ by no more than about one row, and no task sorts more than a range.

Defined results: a null text has no bytes and the CRC of no bytes. Rows of equal text
share a shard unless a shard's end falls among them. Repeated rows are rows like any
others. An empty table gives no rows. Other columns of the input are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_lens.llm.common import ready, settled

#: Ranges for each shard at least, and bytes of a range at most.
RANGES_PER_SHARD = 64
RANGE_BYTES = 4 << 30
#: Keys that are drawn for each range, on average.
DRAWS = 8
#: Times its due size that makes a range overfull.
OVERFULL = 2.0


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(key, id, size, text_crc32). 40 bits of the key are the text's, 24 tell its rows apart."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    own = F.xxhash64(F.col(f"`{id_column}`"), F.monotonically_increasing_id())
    high = F.xxhash64(text).bitwiseAND(F.lit(-(1 << 24)))
    return docs.select(
        high.bitwiseOR(F.shiftrightunsigned(own, 40)).alias("key"),
        F.col(f"`{id_column}`").alias("id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def drawn(rows: DataFrame, bytes_each: float, salt: int) -> list[tuple[int, float]]:
    """Keys with weights: one for each `bytes_each` bytes on average, larger rows all."""
    chance = F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = rows.where(chance < F.col("size") / F.lit(bytes_each))
    return [tuple(r) for r in sample.select("key", F.greatest("size", F.lit(bytes_each))).collect()]


def quantiles(sample: list[tuple[int, float]], due: float) -> list[int]:
    """Keys at which the weights reach another multiple of `due`."""
    sample = sorted(sample)
    total = np.cumsum([weight for _, weight in sample])
    steps = np.floor(total / due)
    return [sample[k][0] for k in np.flatnonzero(np.diff(steps, prepend=0.0))]


def in_ranges(rows: DataFrame, splitters: list[int]) -> DataFrame:
    cuts = np.array(splitters, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "right").astype(np.int32))

    return rows.withColumn("range", place("key"))


def sized_ranges(rows: DataFrame, total: int, due: float) -> tuple[list[int], list]:
    """Splitters, and (range, bytes, rows) of each range they make."""
    splitters = sorted(set(quantiles(drawn(rows, due / DRAWS, 0), due)))
    salt = 1
    while True:
        placed = in_ranges(rows, splitters)
        sizes = placed.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("a"), F.max("key").alias("b")
        )
        sizes = sorted(sizes.collect())
        full = [r["range"] for r in sizes if r["bytes"] > OVERFULL * due and r["a"] < r["b"]]
        if not full:
            return splitters, sizes
        again = placed.where(F.col("range").isin(full))
        more = set(quantiles(drawn(again, due / DRAWS, salt), due / OVERFULL)) - set(splitters)
        salt += 1
        if not more:
            return splitters, sizes
        splitters = sorted({*splitters, *more})


def sharded(docs: DataFrame, shards: int, id_column="doc_id", text_column="text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; slots count from 0 in each shard."""
    spark = docs.sparkSession
    ready(spark)
    rows = settled(keyed(docs, id_column, text_column), "shard-keys")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    due = max(1.0, min(total / (shards * RANGES_PER_SHARD), RANGE_BYTES))
    splitters, sizes = sized_ranges(rows, total, due)
    before, held = [], (0, 0)
    for r in sizes:
        before.append((r["range"], *held))
        held = (held[0] + r["bytes"], held[1] + r["rows"])
    before = spark.createDataFrame(before, "range int, bytes_before bigint, rows_before bigint")
    line = Window.partitionBy("range").orderBy("key", "size", "text_crc32", "id")
    here = in_ranges(rows, splitters).join(F.broadcast(before), "range")
    bytes_to = F.col("bytes_before") + F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    middle = bytes_to.cast("double") - F.col("size") / 2
    shard = F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")
    number = F.col("rows_before") + F.row_number().over(line) - 1
    placed = settled(here.select("id", "size", "text_crc32", shard.alias("shard"), number.alias("number")), "shards")
    first = placed.groupBy("shard").agg(F.min("number").alias("first"))
    placed = placed.join(F.broadcast(first), "shard")
    return placed.select("id", "size", "text_crc32", "shard", (F.col("number") - F.col("first")).alias("slot"))
