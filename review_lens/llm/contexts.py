"""Context trees over exact bytes: counts of a corpus, and what they make each byte cost.

A gram is a byte after the DEPTH bytes before it, in one number: the nearest of them
highest, the byte itself lowest. A node is a context of up to DEPTH bytes and a decision, that
is, the leading bits of the byte that are known already: context << 8 | 1 << bits | those bits.
No two contexts share a node, and what is counted grows with the corpus.

Grams are kept in rows, one for all that share their nearest NEAR bytes, so that each row holds
whole subtrees. Tasks count and merge rows, work out their subtrees and send up what the nodes
above need, at most one number for each two bytes and decision; only these shortest contexts
meet in one place. Then tasks walk their subtrees down again and give each gram its probability.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import ready, settled

DEPTH = 6
NEAR = 3
#: Stands before a text and is its end; no byte of UTF-8.
EDGE = 0xFF
#: Grams that a task counts together, and how many distinct ones it holds before it hands rows on.
PLACES = 2 << 20
HELD = 3 << 20
#: Bytes of grams in a batch that a task hands on, a longer row aside.
BATCH = 1 << 21
HALF = np.log(0.5)

ROW = "near int, low binary, count binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of numbers above 0, by Stirling's series from x + 8 on."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each byte and of each text's end, and where each text's grams begin."""
    texts = len(offsets) - 1
    stream = np.full(len(data) + DEPTH * (texts + 1), EDGE, np.uint8)
    row = np.repeat(np.arange(texts), np.diff(offsets))
    stream[np.arange(len(data)) + DEPTH * (row + 1)] = data
    found = stream[DEPTH:].astype(np.int64)
    for back in range(1, DEPTH + 1):
        found |= stream[DEPTH - back : len(stream) - back].astype(np.int64) << 8 * (DEPTH + 1 - back)
    ends = offsets[1:] + DEPTH * np.arange(texts)
    used = np.ones(len(found), bool)
    for k in range(1, DEPTH):
        used[ends + k] = False
    return found[used], offsets[:-1] + np.arange(texts)


def together(keys: np.ndarray, *numbers: np.ndarray) -> list[np.ndarray]:
    """The distinct keys in order, and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return [keys[first], *(np.add.reduceat(n[order], first) if len(first) else n[:0] for n in numbers)]


def shorter(keys: np.ndarray) -> np.ndarray:
    """Grams or nodes without the farthest byte of their contexts."""
    return keys >> 16 << 8 | keys & 255


def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of distinct grams, which are in order."""
    near = keys >> 32
    first = np.flatnonzero(np.diff(near, prepend=-1))

    def binary(values):
        offsets = (np.append(first, len(keys)) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(values)])

    columns = [pa.array(near[first].astype(np.int32)), binary(keys.astype(np.uint32)), binary(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["near", "low", "count"])


def batched(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    return blocks.pieces([packed(keys, counts)], "low", BATCH)


def numbers(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row has."""
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, kind), np.zeros(len(column), np.int64)
    offsets = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind)
    return values, np.diff(offsets) // values.itemsize


def unpacked(near: np.ndarray, low: pa.Array, count: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lows, sizes = numbers(low, np.uint32)
    return np.repeat(near.astype(np.int64), sizes) << 32 | lows.astype(np.int64), numbers(count, np.int64)[0]


def counted(texts: DataFrame) -> DataFrame:
    """Rows of all grams of the column `text`, lower-cased, one for each value of `near`."""
    ready(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, size, runs = [], 0, []
        for piece in blocks.pieces(batches, "text"):
            data, offsets = blocks.text_bytes(piece.column("text"))
            raw.append(grams(blocks.LOWER[data], offsets)[0])
            size += len(raw[-1])
            if size < PLACES:
                continue
            runs.append(np.unique(np.concatenate(raw), return_counts=True))
            raw, size = [], 0
            if sum(len(keys) for keys, _ in runs) > HELD:
                runs = [together(*map(np.concatenate, zip(*runs, strict=True)))]
                if len(runs[0][0]) > HELD // 2:
                    yield from batched(*runs.pop())
        if raw:
            runs.append(np.unique(np.concatenate(raw), return_counts=True))
        if runs:
            yield from batched(*together(*map(np.concatenate, zip(*runs, strict=True))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = unpacked(batch.column("near").to_numpy(), batch.column("low"), batch.column("count"))
            keys, counts = together(np.append(keys, new[0]), np.append(counts, new[1]))
            # More may follow of the last value of `near` only.
            whole = np.searchsorted(keys, keys[-1] >> 32 << 32) if len(keys) else 0
            yield from batched(keys[:whole], counts[:whole])
            keys, counts = keys[whole:], counts[whole:]
        yield from batched(keys, counts)

    rows = texts.mapInArrow(count, ROW).repartition("near").sortWithinPartitions("near")
    return settled(rows.mapInArrow(merge, ROW), "lm-contexts")


class Nodes:
    """The nodes of one decision's trees, from contexts of DEPTH to those of NEAR bytes."""

    def __init__(self, by_depth: list, level: int):
        keys = by_depth[0][0]
        self.bit = keys >> (7 - level) & 1
        self.ids, self.share, self.one, self.up = [], [], [], []
        weighted = None
        for keys, counts in by_depth:
            byte = keys & 255
            ids = keys >> 8 << 8 | 1 << level | byte >> (8 - level)
            begins = np.diff(ids, prepend=-1) != 0
            first = np.flatnonzero(begins)
            total = np.add.reduceat(counts, first)
            ones = np.add.reduceat(counts * (byte >> (7 - level) & 1), first)
            ids = ids[first]
            own = estimate(total - ones, ones)
            if weighted is None:
                self.place = np.cumsum(begins) - 1
                weighted, share = own, np.ones_like(own)
            else:
                up = np.searchsorted(ids, shorter(self.ids[-1]))
                self.up.append(up)
                weighted = np.logaddexp(own, np.bincount(up, weighted, len(ids))) + HALF
                share = np.exp(own + HALF - weighted)
            self.ids.append(ids)
            self.share.append(share)
            self.one.append((ones + 0.5) / (total + 1.0))
        self.total, self.ones, self.weighted = total, ones, weighted


def all_depths(keys: np.ndarray, counts: np.ndarray) -> list:
    found = [(keys, counts)]
    for _ in range(DEPTH - NEAR):
        found.append(together(shorter(found[-1][0]), found[-1][1]))
    return found


def sent_up(keys: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """For contexts of NEAR - 1 bytes: nodes, zeros, ones, and the weights of what is below them."""
    by_depth, parts = all_depths(keys, counts), []
    for level in range(8):
        nodes = Nodes(by_depth, level)
        parts.append((shorter(nodes.ids[-1]), nodes.total - nodes.ones, nodes.ones, nodes.weighted))
    return together(*map(np.concatenate, zip(*parts, strict=True)))


class Top:
    """The shortest contexts: what they, mixed, add to the probability of a one, and the share
    that is left to the contexts below."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(ids)
        by_depth = [[n[order] for n in (ids, zeros, ones, below)]]
        while len(by_depth) < NEAR:
            ids, zeros, ones, below = by_depth[-1]
            weighted = np.logaddexp(estimate(zeros, ones), below) + HALF
            by_depth.append(together(shorter(ids), zeros, ones, weighted))
        zeros, ones = by_depth[-1][1:3]
        #: Predicted bytes and ends of the corpus: what its first decision was met with.
        self.places = int((zeros + ones)[by_depth[-1][0] == 1].sum())
        self.ids, self.mixed, self.left = [], [], []
        for ids, zeros, ones, below in reversed(by_depth):
            own = estimate(zeros, ones)
            share = np.exp(own - np.logaddexp(own, below))
            mixed, left = self.of(shorter(ids))
            self.ids.append(ids)
            self.mixed.append(mixed + left * share * (ones + 0.5) / (zeros + ones + 1.0))
            self.left.append(left * (1 - share))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of nodes of the last depth. One that was never seen has what those above it have:
        all below it say one half, as it does."""
        mixed, left = np.zeros(len(ids)), np.ones(len(ids))
        open_, wanted = np.ones(len(ids), bool), ids
        for known, m, rest in zip(self.ids[::-1], self.mixed[::-1], self.left[::-1], strict=True):
            if len(known):
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = open_ & (known[at] == wanted)
                mixed[hit], left[hit] = m[at[hit]], rest[at[hit]]
                open_ &= ~hit
            wanted = shorter(wanted)
        return mixed, left


def logs(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """Log10 of the probability of each gram's byte in its context. Grams that the corpus
    does not have are given with a count of 0."""
    found = np.zeros(len(keys))
    if not len(keys):
        return found
    by_depth = all_depths(keys, counts)
    for level in range(8):
        nodes = Nodes(by_depth, level)
        mixed, left = top.of(shorter(nodes.ids[-1]))
        for d in range(DEPTH - NEAR, -1, -1):
            if d < DEPTH - NEAR:
                mixed, left = mixed[nodes.up[d]], left[nodes.up[d]]
            mixed = mixed + left * nodes.share[d] * nodes.one[d]
            left = left * (1 - nodes.share[d])
        one = mixed[nodes.place]
        found += np.log10(np.where(nodes.bit == 1, one, 1 - one))
    return found


def topped(rows: DataFrame) -> Top:
    """The trees of the whole corpus down to contexts of NEAR - 1 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = unpacked(batch.column("near").to_numpy(), batch.column("low"), batch.column("count"))
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n) for n in sent_up(keys, counts)], ["node", "zeros", "ones", "below"]
                )

    sums = rows.mapInArrow(run, "node bigint, zeros bigint, ones bigint, below double").groupBy("node")
    sums = sums.agg(*(F.sum(name).alias(name) for name in ("zeros", "ones", "below"))).toArrow()
    return Top(*(sums.column(name).to_numpy() for name in ("node", "zeros", "ones", "below")))


def measured(rows: DataFrame, top) -> DataFrame:
    """(key, logs, count) of every gram of the corpus; `top` is broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = unpacked(batch.column("near").to_numpy(), batch.column("low"), batch.column("count"))
            found = logs(keys, counts, top.value).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(n) for n in (keys, found, counts)], ["key", "logs", "count"])

    return settled(rows.mapInArrow(run, "key bigint, logs float, count bigint"), "lm-logs")


def answered(rows: DataFrame, asked: DataFrame, top) -> DataFrame:
    """(key, logs) of every distinct `key` of `asked`, grams that the corpus does not have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = unpacked(batch.column("near").to_numpy(), batch.column("low"), batch.column("count"))
            new = np.unique(batch.column("asked").flatten().to_numpy())
            keys, counts = together(np.append(keys, new), np.append(counts, np.zeros(len(new), np.int64)))
            found = logs(keys, counts, top.value)[np.searchsorted(keys, new)].astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(new), pa.array(found)], ["key", "logs"])

    asked = asked.select("key").distinct().groupBy(F.shiftright("key", 32).cast("int").alias("near"))
    asked = asked.agg(F.collect_list("key").alias("asked"))
    return rows.join(asked, "near", "right").mapInArrow(run, "key bigint, logs float")
