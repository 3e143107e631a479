"""Benchmark decontamination with suffix arrays over the training texts.

The training texts are dealt into shards, blocks of texts within a task. Each shard has
an array of its suffixes, sorted by their first `window` words; suffixes that begin
with no first words of any test suffix are left out of it. Every test suffix, cut to
`window` words, is looked up in every shard by binary search, which gives the range of
all places where it occurs. Matches that go on word by word are joined to the longest
verbatim ones. Words are compared by 64-bit hashes first, then as they are.

The test set is worked off in blocks of about BLOCK_BYTES, one pass each, so what the
tasks are sent has a bound whatever the size of the test set.

Defined results: a null or empty text has no words and no match. An item of fewer words
than the window is one window; one without words can't match. Items with the same id
count as one, a null id as the empty text. All rows and columns of the documents stay.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import extended, kept_where

WINDOW = 10
#: Words of a test suffix that a training suffix must share to stand in a shard's array.
LEAD = 4
#: Bytes of test text for one pass over the training texts.
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22

MATCH = "array<struct<item: string, item_start: int, start: int, words: int>>"
MATCH_TYPE = pa.list_(
    pa.struct([("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("words", pa.int32())])
)


def split(texts: pa.Array) -> blocks.Words:
    data, offsets = blocks.text_bytes(texts)
    return blocks.find_words(blocks.LOWER[data], offsets, blocks.ALNUM)


def columns_at(hashes: np.ndarray, places: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The next `depth` hashes from each place on; zero, which sorts first, from its end on."""
    at = places[:, None] + np.arange(depth)
    inside = at < ends[:, None]
    return np.where(inside, hashes[np.minimum(at, max(len(hashes) - 1, 0))], np.uint64(0))


class TestSuffixes:
    """Distinct windows of a block of test items, and where each occurs."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        self.ids, self.window = ids, window
        words = split(texts)
        self.words = words
        hashes = blocks.word_hashes(words)
        first, last = words.rows[:-1], words.rows[1:]
        counts = last - first
        cut = np.minimum(counts, window)
        places = np.concatenate(
            [np.arange(a, b - n + 1) for a, b, n in zip(first, last, cut, strict=True) if b > a] or [np.zeros(0, int)]
        ).astype(np.int64)
        item = np.searchsorted(words.rows, places, "right") - 1
        table = columns_at(hashes, places, places + cut[item], window)
        table, of = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
        order = np.argsort(of.reshape(-1), kind="stable")
        self.table = table
        self.lengths = np.zeros(len(table), np.int64)
        self.lengths[of.reshape(-1)] = cut[item]
        self.of = np.concatenate(([0], np.cumsum(np.bincount(of.reshape(-1), minlength=len(table)))))
        self.places, self.items = places[order], item[order]
        self.firsts = first
        self.leads = {}
        for k in np.unique(np.minimum(self.lengths, LEAD)).tolist():
            grams = np.unique(blocks.gram_hashes(hashes, k)[self.places[self.of[:-1][np.minimum(self.lengths, LEAD) == k]]])
            sieve = np.zeros(1 << FILTER_BITS, bool)
            sieve[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.leads[k] = (grams, sieve)

    def shard(self, words: blocks.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shard's suffix array: places in order, and their first words."""
        found = []
        for k, (grams, sieve) in self.leads.items():
            places = blocks.whole_grams(words.rows, k)
            lead = blocks.gram_hashes(hashes, k)[places]
            may = sieve[(lead >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            places, lead = places[may], lead[may]
            at = np.minimum(np.searchsorted(grams, lead), len(grams) - 1)
            found.append(places[grams[at] == lead])
        places = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        ends = words.rows[np.searchsorted(words.rows, places, "right")] if len(places) else places
        table = columns_at(hashes, places, ends, self.window)
        order = np.lexsort(table.T[::-1])
        return places[order], table[order]

    def search(self, table: np.ndarray, after: bool) -> np.ndarray:
        """For each test suffix the first place of the array not before it, or after all that begin with it."""
        low, high = np.zeros(len(self.table), np.int64), np.full(len(self.table), len(table))
        used = np.arange(self.window) < self.lengths[:, None]
        while (low < high).any():
            open_ = low < high
            mid = np.minimum((low + high) // 2, len(table) - 1)
            rows = table[mid]
            differ = (rows != self.table) & used
            at = differ.argmax(axis=1)
            line = np.arange(len(at))
            less = differ[line, at] & (rows[line, at] < self.table[line, at])
            go = open_ & (less | (~differ[line, at] if after else False))
            low, high = np.where(go, mid + 1, low), np.where(open_ & ~go, mid, high)
        return low

    def matches(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        words = split(texts)
        found = [[] for _ in range(len(texts))]
        counts = np.diff(words.rows)
        if not len(self.table) or not len(words.starts):
            return counts, found
        places, table = self.shard(words, blocks.word_hashes(words))
        if not len(places):
            return counts, found
        low, high = self.search(table, False), self.search(table, True)
        hits, suffix = spread(low, high)
        if not len(hits):
            return counts, found
        at = places[hits]
        one, many = spread(self.of[:-1][suffix], self.of[1:][suffix])
        at, suffix, test, item = at[many], suffix[many], self.places[one], self.items[one]
        order = np.lexsort((at, at - test, item))
        at, suffix, test, item = at[order], suffix[order], test[order], item[order]
        row = np.searchsorted(words.rows, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (np.diff(at) != 1) | (np.diff(test) != 1)
        starts = np.flatnonzero(new)
        ends = np.concatenate((starts[1:], [len(at)])) - 1
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            size = int(at[e] - at[s] + self.lengths[suffix[e]])
            if same(words, int(at[s]), self.words, int(test[s]), size):
                found[row[s]].append(
                    {
                        "item": self.ids[item[s]],
                        "item_start": int(test[s] - self.firsts[item[s]]),
                        "start": int(at[s] - words.rows[row[s]]),
                        "words": size,
                    }
                )
        return counts, found


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges low..high, and the range that each is of."""
    sizes = high - low
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(ends[-1] if len(ends) else 0) + (low - (ends - sizes))[of], of


def same(a: blocks.Words, i: int, b: blocks.Words, j: int, size: int) -> bool:
    """Whether the words themselves, not just their hashes, are equal."""
    return all(
        a.data[a.starts[i + k] : a.ends[i + k]].tobytes() == b.data[b.starts[j + k] : b.ends[j + k]].tobytes()
        for k in range(size)
    )


def leaks(
    docs: DataFrame, items: DataFrame, text_column="text", item_column="item_id", item_text="text", window=WINDOW, keep=None
) -> DataFrame:
    """The documents with n_words and leaks: their longest verbatim matches with test items,
    in words counted from 0. `keep` names the columns to return besides, all by default."""
    spark = docs.sparkSession
    tests = items.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text")
    )
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // BLOCK_BYTES))
    names = docs.columns if keep is None else list(keep)
    # Names of our own, whatever the input's are.
    own = {name.lower() for name in docs.columns}
    whole, before = "text_of_leaks_", "leaks_before_"
    while own & {whole, before}:
        whole, before = whole + "_", before + "_"
    out = docs.select(*(F.col(f"`{name}`") for name in names), F.col(f"`{text_column}`").alias(whole))
    out = out.withColumn("n_words", F.lit(0)).withColumn("leaks", F.lit(None).cast(MATCH))
    for part in range(parts):
        block = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).toArrow().combine_chunks()
        texts = block.column("text").combine_chunks() if block.num_rows else pa.array([], pa.string())
        sent = spark.sparkContext.broadcast(TestSuffixes(block.column("id").to_pylist(), texts, window))

        def make(texts, sent=sent):
            counts, found = sent.value.matches(texts)
            return [pa.array(counts, pa.int64()), pa.array(found, MATCH_TYPE)]

        out = out.select(*(F.col(f"`{name}`") for name in names), whole, F.col("leaks").alias(before))
        held = [*names, before] + ([whole] if part + 1 < parts else [])
        out = extended(out, whole, f"n_words bigint, leaks {MATCH}", make, keep=held)
        none = F.array().cast(MATCH)
        out = out.withColumn("leaks", F.concat(F.coalesce(before, none), "leaks")).drop(before)
    return out


def leaked_words(matches):
    """Words of a text inside any match, each counted once."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["words"]).alias("b"))))
    step = lambda acc, s: F.struct(
        F.greatest(acc["upto"], s["b"]).alias("upto"),
        (acc["hit"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["upto"], s["a"])).cast("bigint")).alias("hit"),
    )
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("hit"))
    return F.aggregate(spans, start, step, lambda acc: acc["hit"])


def leaked_items(matches):
    """Ids of the items with a match, sorted as texts, each once."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def decontaminated(docs: DataFrame, items: DataFrame, text_column="text", **options) -> DataFrame:
    """The documents without any match; their columns as they were."""
    judge = lambda rows, text: leaks(rows, items, text, **options)
    return kept_where(docs, text_column, judge, F.size("leaks") == 0)
