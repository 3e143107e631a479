"""Importance resampling towards a target: documents whose word runs look like the target's.

Features are all runs of one and two words, hashed by CRC-32 into buckets. The hashes of a
block of texts are worked out together: its distinct features are grouped by their length in
bytes, each group is a matrix of bytes with one row for a feature, and one step a
column moves the checksums of all its rows on; the results are scattered back to where the
features occur. Bucket counts of all documents and of the target give each bucket a gain,
the mean gain of a document is its weight, and with a hashed Gumbel noise added the
highest scores are a weighted draw without replacement.

Defined results: a null text has no words, hence weight 0. A null id is hashed as an empty one and
ranks after the others of its score. Rows with equal score and id rank in any order; repeated
rows are ranked one by one. An empty target gains by its smoothing alone; an empty table gives
no rows. Other columns are not read.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import extended, ready, settled
from review_lens.operators.slices import number_rows

BUCKETS = 10_000
#: Words in the longest feature.
RUN = 2
#: Features with more bytes than this go through zlib one by one, as few share a length.
LONG = 96
#: Rows of a matrix of features.
ROWS = 1 << 16


def crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1)
    return values


CRC = crc_table()


def crc_rows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges of `data`, all ranges of one length at a time."""
    out, whole = np.zeros(len(starts), np.uint32), memoryview(data)
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, here in zip(sizes.tolist(), np.split(order, first[1:]), strict=True):
        if size > LONG:
            out[here] = [zlib.crc32(whole[s : s + size]) for s in starts[here].tolist()]
            continue
        for some in np.split(here, range(ROWS, len(here), ROWS)):
            matrix = data[starts[some][:, None] + np.arange(size)]
            state = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in np.ascontiguousarray(matrix.T):
                state = (state >> np.uint32(8)) ^ CRC[(state ^ column) & np.uint32(0xFF)]
            out[some] = state ^ np.uint32(0xFFFFFFFF)
    return out


def spaced(words: blocks.Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes with a space after each, and where each word begins there."""
    sizes = words.ends - words.starts
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(sizes) else np.zeros(0, np.int64)
    data = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(begins, sizes) + within] = words.data[np.repeat(words.starts, sizes) + within]
    return data, begins


def same_bytes(data, starts, lengths, firsts) -> bool:
    """Whether each range holds the same bytes as the one it is taken to be equal to."""
    if not np.array_equal(lengths, lengths[firsts]):
        return False
    places = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.array_equal(data[np.repeat(starts, lengths) + places], data[np.repeat(starts[firsts], lengths) + places])


def word_numbers(data, begins, sizes, hashes) -> np.ndarray:
    """A number for each word, equal for equal words only: by hash, then checked by bytes."""
    _, firsts, numbers = np.unique(hashes, return_index=True, return_inverse=True)
    if same_bytes(data, begins, sizes, firsts[numbers]):
        return numbers
    held = {}
    whole = data.tobytes()
    return np.array([held.setdefault(whole[b : b + s], len(held)) for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)])


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS, run: int = RUN):
    """Buckets of all features of a block of texts, the text that each is in, and the number of
    words of each text."""
    data, offsets = blocks.text_bytes(texts)
    words = blocks.find_words(blocks.LOWER[data], offsets, blocks.ALNUM)
    counts = np.diff(words.rows)
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    sizes = words.ends - words.starts
    joined, begins = spaced(words)
    numbers = word_numbers(joined, begins, sizes, blocks.word_hashes(words))
    row_of = words.row_of()
    found, owners = [], []
    keys = numbers.astype(np.int64)
    for n in range(1, run + 1):
        if n > 1:
            # A run is one number of the run without its last word and one of that word.
            keys = keys[:-1] * (int(numbers.max()) + 1) + numbers[n - 1 :]
            _, keys = np.unique(keys, return_inverse=True)
        places = blocks.whole_grams(words.rows, n)
        distinct, first, where = np.unique(keys[places], return_index=True, return_inverse=True)
        if not len(distinct):
            break
        starts = begins[places[first]]
        last = places[first] + n - 1
        crcs = crc_rows(joined, starts, begins[last] + sizes[last] - starts)
        found.append((crcs % np.uint32(buckets)).astype(np.int64)[where])
        owners.append(row_of[places])
    return np.concatenate(found), np.concatenate(owners), counts


def bucket_counts(rows: DataFrame, text_column="text", buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """How often the features of all rows fall into each bucket: `buckets` numbers, summed in each
    task and then by Spark."""
    ready(rows.sparkSession)
    texts = rows.select(F.col(f"`{text_column}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in blocks.pieces(batches, "text"):
            total += np.bincount(feature_buckets(piece.column(0), buckets, run)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    summed = texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in summed.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares in target and source, floored."""
    count = len(source)
    s, t = source.astype(np.float64) + 1.0, target.astype(np.float64) + 1.0
    ratio = (t * float(source.sum() + count)) / (s * float(target.sum() + count))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text_column="text", run: int = RUN, keep=None) -> DataFrame:
    """The rows with n_features, n_words and weight, the floored mean of their features' gains."""

    def make(texts: pa.Array) -> list[pa.Array]:
        found, owners, words = feature_buckets(texts, len(gain), run)
        features = np.bincount(owners, minlength=len(texts))
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, owners, gain[found])
        return [pa.array(x.astype(np.int64)) for x in (features, words, total // np.maximum(features, 1))]

    return extended(docs, text_column, "n_features bigint, n_words bigint, weight bigint", make, keep)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    run: int = RUN,
    id_column="doc_id",
    text_column="text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank counts the drawn ones from 1.

    `percent` of the rows with at least `least_words` words are drawn. Rows are ranged by
    score and id, so ranking sorts no more than a range in a task.
    """
    gain = gains(bucket_counts(docs, text_column, buckets, run), bucket_counts(target, text_column, buckets, run))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(told.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = weighted(rows, gain, "text", run, keep=["id"]).select(
        (F.col("n_words") < least_words).alias("short"),
        (-(F.col("weight") + noise)).alias("low"),
        F.col("id").isNull().alias("no_id"),
        "id",
        "n_features",
        "weight",
    )
    # Written before it is ranged: finding the ranges would read all texts once more.
    scored = settled(scored, "importance-scores")
    numbered = settled(number_rows(scored, "short", "low", "no_id", "id"), "importance")
    count = numbered.agg(F.expr(f"count_if(NOT short) * {percent} div 100").alias("due")).first()["due"]
    rank = F.when(~F.col("short") & (F.col("row_index") < count), F.col("row_index") + 1)
    return numbered.select("id", "n_features", "weight", (-F.col("low")).alias("score"), rank.alias("rank"))
