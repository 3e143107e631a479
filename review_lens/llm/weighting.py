"""Language-model scores by context-tree weighting.

A text's bytes, lower-cased, are predicted one by one, each as eight binary decisions.
For every decision there is a tree of contexts, the exact bytes before it, up to
contexts.DEPTH of them; each node has a Krichevsky-Trofimov estimate from what followed it
in the corpus. A node's weighted probability is half its own estimate's and half the product
of its children's, so estimates of all depths are mixed by how well each has coded the
corpus. Once all counts are in, the mixture gives each byte its probability in each context.

Beside it stands a unigram base over white-space tokens.

Both grow with the corpus: grams (a byte and its context) and tokens are counted and kept by
Spark. Those that make up a share of FREQUENT_GRAM or FREQUENT or more are broadcast, at most
1 / FREQUENT_GRAM grams and 1 / FREQUENT tokens; all others are joined, so no key that the
corpus often has is hot. Grams that the corpus does not have are worked out in its trees,
once for each distinct one.

Defined results: a null text is an empty one, and has one token, the end. Without
training rows all counts are 0. Rows stay as they are, repeated ones too; other columns
than id and text are not read.

The functions down to `mixed_ones` work out a whole table of trees at a time, over 32 classes
of context bytes. Scores do not use them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks, contexts
from review_lens.llm.common import extended, ready, settled
from review_lens.llm.contexts import estimate

DEPTH = 3
CLASSES = 32
CONTEXTS = CLASSES**DEPTH
EDGE = 0xFF
FREQUENT = 1 / (1 << 20)
FREQUENT_GRAM = 1 / (1 << 24)
#: Decisions whose trees are worked out together.
AT_ONCE = 8

_classes = np.full(256, 28)
_classes[97:123] = np.arange(26)
_classes[[0x20, *range(0x09, 0x0E)]] = 26
_classes[48:58] = 27
_classes[0x80:0xC0] = 30
_classes[0xC0:0xFF] = 29
_classes[EDGE] = 31
CLASS_OF = _classes.astype(np.int64)

TOKEN, END = 0, 1


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and each text's end the place in the table: context, then byte. And
    where each text's places begin."""
    texts = len(offsets) - 1
    stream = np.full(len(data) + DEPTH * (texts + 1), EDGE, np.uint8)
    row = np.repeat(np.arange(texts), np.diff(offsets))
    stream[np.arange(len(data)) + DEPTH * (row + 1)] = data
    kinds = CLASS_OF[stream]
    context = np.zeros(len(stream), np.int64)
    for back in range(DEPTH, 0, -1):
        context[DEPTH:] = context[DEPTH:] * CLASSES + kinds[DEPTH - back : len(stream) - back]
    ends = offsets[1:] + DEPTH * np.arange(1, texts + 1)
    used = np.ones(len(stream), bool)
    used[:DEPTH] = False
    for k in range(1, DEPTH):
        used[ends + k] = False
    return (context * 256 + stream)[used], offsets[:-1] + np.arange(texts)


def byte_logs(counts: np.ndarray) -> np.ndarray:
    """Log10 of each byte's probability in each context, from the counts of both.

    `counts` has a row for each context, numbered with the nearest byte's class last, and
    256 columns. Decisions have trees of their own; a few are worked out at a time, for
    all contexts.
    """
    logs = np.zeros((len(counts), 256))
    for level in range(8):
        width = 256 >> level
        several = max(1, min(AT_ONCE, 1 << level)) * width
        for first in range(0, 256, several):
            own = counts[:, first : first + several].reshape(len(counts), -1, 2, width // 2).sum(axis=3)
            one = mixed_ones(own)
            for bit, share in enumerate((1 - one, one)):
                part = np.repeat(np.log10(share), width // 2, axis=1)
                target = logs[:, first : first + several].reshape(len(counts), -1, 2, width // 2)
                target[:, :, bit] += part.reshape(len(counts), -1, width // 2)
    return logs


def mixed_ones(counts: np.ndarray) -> np.ndarray:
    """The probability of a one, mixed over all depths, for each context and decision.

    `counts`: of zeros and ones, by context and decision.
    """
    depth = round(np.log(len(counts)) / np.log(CLASSES))
    # By depth: counts of each node, folding the farthest class away.
    nodes = [counts]
    for _ in range(depth):
        nodes.insert(0, nodes[0].reshape(CLASSES, -1, *counts.shape[1:]).sum(axis=0))
    weighted, own_share = None, [None] * (depth + 1)
    for d in range(depth, -1, -1):
        own = estimate(nodes[d][..., 0], nodes[d][..., 1])
        if weighted is None:
            weighted, own_share[d] = own, np.ones_like(own)
            continue
        below = weighted.reshape(CLASSES, -1, counts.shape[1]).sum(axis=0)
        weighted = np.logaddexp(own, below) + np.log(0.5)
        own_share[d] = np.exp(own + np.log(0.5) - weighted)
    mixed = None
    for d in range(depth, -1, -1):
        one = (nodes[d][..., 1] + 0.5) / (nodes[d].sum(axis=2) + 1.0)
        if mixed is None:
            mixed = one
            continue
        # A node's share is mixed into all contexts below it.
        repeat = len(mixed) // len(one)
        share, one = np.tile(own_share[d], (repeat, 1)), np.tile(one, (repeat, 1))
        mixed = share * one + (1 - share) * mixed
    return mixed


def corpus_counts(docs: DataFrame, text_column="text") -> DataFrame:
    """(kind, key, count): tokens by hash, and ends of texts."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind, keys, counts):
            columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["kind", "key", "count"])

        ends = 0
        for piece in blocks.pieces(batches, "text"):
            data, offsets = blocks.text_bytes(piece.column("text"))
            data = blocks.LOWER[data]
            ends += len(offsets) - 1
            words = blocks.find_words(data, offsets, blocks.NOT_SPACE)
            keys, counts = np.unique(blocks.word_hashes(words), return_counts=True)
            yield rows(TOKEN, keys.view(np.int64), counts.astype(np.int64))
        if ends:
            yield rows(END, np.zeros(1, np.int64), np.array([ends], np.int64))

    counted = texts.mapInArrow(run, "kind int, key bigint, count bigint")
    return settled(counted.groupBy("kind", "key").agg(F.sum("count").alias("count")), "corpus-counts")


def found_in(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is among the known ones, which are in order, and whether it is there."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def lists(keys: np.ndarray, rows: np.ndarray, count: int) -> list[pa.Array]:
    """Each row's distinct keys, and how often it has them."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.flatnonzero((np.diff(keys, prepend=0) != 0) | (np.diff(rows, prepend=-1) != 0))
    times = np.diff(np.append(new, len(keys)))
    cuts = pa.array(np.searchsorted(rows[new], np.arange(count + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(cuts, pa.array(values)) for values in (keys[new], times.astype(np.int32))]


class Frequent:
    """Counts of frequent tokens, and log10 of the probabilities of frequent grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, grams: np.ndarray, logs: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        order = np.argsort(grams)
        self.grams, self.logs = grams[order], logs[order]

    def measure(self, texts: pa.Array) -> list[pa.Array]:
        data, offsets = blocks.text_bytes(texts)
        data = blocks.LOWER[data]
        count = len(offsets) - 1
        grams, begin = contexts.grams(data, offsets)
        order = np.argsort(grams)
        grams = grams[order]
        at, often = found_in(self.grams, grams)
        value = np.zeros(len(grams))
        value[order[often]] = self.logs[at[often]]
        total = np.add.reduceat(value, begin) if count else np.zeros(0)
        gram_rows = np.searchsorted(begin, order[~often], "right") - 1
        words = blocks.find_words(data, offsets, blocks.NOT_SPACE)
        hashes, rows = blocks.word_hashes(words).view(np.int64), words.row_of()
        at, known = found_in(self.keys, hashes)
        sums = np.bincount(rows[known], np.log10(self.counts[at[known]] + 0.5), count).astype(np.float64)
        return [
            pa.array(np.diff(offsets)),
            pa.array(np.diff(words.rows).astype(np.int64)),
            pa.array(np.bincount(rows[known], minlength=count).astype(np.int64)),
            pa.array(sums),
            pa.array(total),
            *lists(hashes[~known], rows[~known], count),
            *lists(grams[~often], gram_rows, count),
        ]


MEASURES = (
    "n_bytes bigint, n_words bigint, known bigint, often double, score double, rare array<bigint>, times array<int>, "
    "rare_grams array<bigint>, gram_times array<int>"
)


def exploded(parts: DataFrame, keys: str, times: str) -> DataFrame:
    found = parts.select("row", F.explode(F.arrays_zip(keys, times)).alias("held"))
    return found.select("row", F.col(f"held.{keys}").alias("key"), F.col(f"held.{times}").alias("times"))


def rare_gram_logs(parts: DataFrame, rows: DataFrame, seen: DataFrame, top) -> DataFrame:
    """(row, gram_logs): the sum over each row's rare grams, those that the corpus has by a
    join, all others by a walk down its trees."""
    held = exploded(parts, "rare_grams", "gram_times").join(seen, "key", "left")
    missing = F.when(F.col("logs").isNull(), F.col("key")).alias("missing")
    sums = held.groupBy("row", missing).agg(
        F.sum(F.col("times") * F.col("logs")).alias("gram_logs"), F.sum("times").alias("times")
    )
    sums = settled(sums, "lm-sums")
    absent = sums.where("missing is not null").select("row", F.col("missing").alias("key"), "times")
    answers = contexts.answered(rows, absent, top)
    absent = absent.join(answers, "key").select("row", (F.col("times") * F.col("logs")).alias("gram_logs"))
    sums = sums.where("missing is null").select("row", "gram_logs").union(absent)
    return sums.groupBy("row").agg(F.sum("gram_logs").alias("gram_logs"))


def scored(docs: DataFrame, training: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row."""
    context = docs.sparkSession.sparkContext
    counts = corpus_counts(training, text_column)
    tokens = counts.where(F.col("kind") == TOKEN)
    total, distinct = tokens.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    ends = sum(r["count"] for r in counts.where(F.col("kind") == END).collect())
    total, distinct = total + ends, distinct + (ends > 0)
    often = F.col("count") >= total * FREQUENT
    held = tokens.where(often).select("key", "count").toArrow()
    trees = contexts.counted(training.select(F.col(text_column).cast("string").alias("text")))
    top = contexts.topped(trees)
    places, top = top.places, context.broadcast(top)
    grams = contexts.measured(trees, top)
    often_gram = F.col("count") >= places * FREQUENT_GRAM
    logs = grams.where(often_gram).select("key", "logs").toArrow()
    columns = [table.column(name).to_numpy() for table, name in ((held, "key"), (held, "count"), (logs, "key"), (logs, "logs"))]
    sent = context.broadcast(Frequent(*columns))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = settled(extended(rows, "text", MEASURES, lambda texts: sent.value.measure(texts), keep=["id", "row"]), "lm-parts")
    seen = tokens.where(~often).select("key", "count")
    rare = exploded(parts, "rare", "times").join(seen, "key", "left").groupBy("row")
    count = F.coalesce("count", F.lit(0))
    rare = rare.agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(count + 0.5)).alias("rare_logs"),
    )
    gram_logs = rare_gram_logs(parts, trees, grams.where(~often_gram).select("key", "logs"), top)
    found = parts.drop("rare", "times", "rare_grams", "gram_times").join(rare, "row", "left").join(gram_logs, "row", "left")
    n_tokens = F.col("n_words") + 1
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    logs = F.col("often") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 0.5)))
    floor = float(np.log10(total + 0.5 * (distinct + 1)))
    score = F.col("score") + F.coalesce("gram_logs", F.lit(0.0))
    return found.select(
        "id",
        n_tokens.alias("n_tokens"),
        known.cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - n_tokens * F.lit(floor)).alias("base_score"),
        score.alias("score"),
        (-score * F.lit(float(np.log2(10))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
