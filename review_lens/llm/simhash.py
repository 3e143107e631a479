"""SimHash near-dedup by a binary trie that is joined with itself.

`fingerprints` gives each text its 64 majority bits. `trie_links` finds all pairs of
distinct fingerprints within a budget of differing bits: with budget e, two such
fingerprints agree on at least one of e + 1 blocks of bits. Rotated so that the block
leads, they share the first levels of a trie, and each block value is the root of a
trie of its own. Within it, pairs of nodes are walked down together; a pair collects
an error where the two take different branches and is cut off beyond the budget.

Defined results: a null or empty text, or one without words, has fingerprint zero and
is linked like any other. Null ids are kept; the smallest id ignores them. Repeated
rows stay, one row out for each row in. Only the named columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import components, extended, ready, settled

BUDGET = 4
BITS = 64
#: A trie with more fingerprints than this is split by a second block, then dealt out as pairs of parts.
PART = 2_000
#: Node pairs that are walked down at once in a task.
FRONTIER = 400_000
#: Rows of whole tries that a task gathers before it walks them.
GATHERED = 100_000


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text the bits set in over half of its hashes; counts: hashes of each text."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    places = np.concatenate(([0], np.cumsum(counts)))
    some = counts > 0
    found = np.zeros((len(counts), BITS), bool)
    if some.any():
        sums = np.add.reduceat(bits, places[:-1][some], axis=0, dtype=np.int32)
        found[some] = 2 * sums > counts[some][:, None]
    return np.packbits(found, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprint_batch(texts: pa.Array, ngram: int, seed: int) -> np.ndarray:
    data, offsets = blocks.text_bytes(texts)
    words = blocks.find_words(blocks.LOWER[data], offsets, blocks.NOT_SPACE)
    hash_of, hashes, counts = xxhash.xxh64_intdigest, [], []
    low = words.data.tobytes()
    starts, ends = words.starts.tolist(), words.ends.tolist()
    rows = words.rows.tolist()
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if a == b:
            counts.append(0)
            continue
        line = b" ".join([low[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)])
        ends_here = np.cumsum(words.ends[a:b] - words.starts[a:b] + 1) - 1
        begins = np.concatenate(([0], ends_here[:-1] + 1)).tolist()
        stops = ends_here[ngram - 1 :].tolist() or [len(line)]
        hashes.extend([hash_of(line[i:j], seed) for i, j in zip(begins, stops, strict=False)])
        counts.append(len(stops))
    return majority_bits(np.array(hashes, np.uint64), np.array(counts, np.int64))


def fingerprints(docs: DataFrame, id_column="doc_id", text_column="text", ngram=4, seed=42) -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint's 64 bits as a signed long."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    make = lambda texts: [pa.array(fingerprint_batch(texts, ngram, seed).view(np.int64))]
    return extended(rows, "text", "fingerprint bigint", make, keep=["id"])


class Forest:
    """Union-find on places of an array; roots are the smallest places."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def flat(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            flat = self.flat()
            x, y = flat[a], flat[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def walk(values: np.ndarray, nodes: list[np.ndarray], budget: int, forest: Forest) -> None:
    """Walk node pairs down. values: sorted within each node. nodes: lo and hi of the one
    side, lo and hi of the other, errors so far, levels so far (equal nodes: a trie with itself)."""
    zeros = {}
    stack = [(nodes, 0)]

    def below(level):
        if level not in zeros:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            zeros[level] = np.concatenate(([0], np.cumsum(bit == 0)))
        return zeros[level]

    while stack:
        (a, b, c, d, err), level = stack.pop()
        own = (a == c) & (b == d)
        live = (a < b) & (c < d) & (err <= budget) & ~(own & (b - a < 2))
        a, b, c, d, err = (x[live] for x in (a, b, c, d, err))
        if not len(a):
            continue
        if len(a) > FRONTIER:
            for k in range(0, len(a), FRONTIER):
                stack.append(([x[k : k + FRONTIER] for x in (a, b, c, d, err)], level))
            continue
        # All that can still differ fits the budget: the whole pair is linked, by a star.
        near = BITS - level <= budget - err
        for lo, hi, hub in ((a, b, c), (c, d, a)):
            sizes = (hi - lo)[near]
            if len(sizes):
                ends = np.cumsum(sizes)
                member = np.arange(ends[-1]) + np.repeat(lo[near] - (ends - sizes), sizes)
                forest.link(member, np.repeat(hub[near], sizes))
        single = ~near & (b - a == 1) & (d - c == 1)
        differ = np.bitwise_count(values[a[single]] ^ values[c[single]])
        forest.link(a[single][differ <= budget], c[single][differ <= budget])
        rest = ~near & ~single
        a, b, c, d, err = (x[rest] for x in (a, b, c, d, err))
        if not len(a):
            continue
        zero = below(level)
        m, n = a + zero[b] - zero[a], c + zero[d] - zero[c]
        cross = ~((a == c) & (b == d))
        stack.append(
            (
                [
                    np.concatenate(x)
                    for x in (
                        (a, m, a, m[cross]),
                        (m, b, m, b[cross]),
                        (c, n, n, c[cross]),
                        (n, d, d, n[cross]),
                        (err, err, err + 1, err[cross] + 1),
                    )
                ],
                level + 1,
            )
        )


def linked(tries: np.ndarray, sides: np.ndarray, values: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold each trie's classes together. Rows come sorted by trie, side and value.
    A trie with one side is joined with itself, one with two sides only across them."""
    change = np.flatnonzero((tries[1:] != tries[:-1]) | (sides[1:] != sides[:-1])) + 1
    lo = np.concatenate(([0], change))
    hi = np.concatenate((change, [len(tries)]))
    other = np.flatnonzero(tries[lo[1:]] == tries[lo[:-1]])
    alone = np.ones(len(lo), bool)
    alone[other], alone[other + 1] = False, False
    alone &= sides[lo] == 0
    a = np.concatenate((lo[alone], lo[other]))
    b = np.concatenate((hi[alone], hi[other]))
    c = np.concatenate((lo[alone], lo[other + 1]))
    d = np.concatenate((hi[alone], hi[other + 1]))
    forest = Forest(len(values))
    walk(values, [a, b, c, d, np.zeros(len(a), np.int64)], budget, forest)
    root = forest.flat()
    member = np.flatnonzero(root != np.arange(len(root)))
    return member, root[member]


def _unsigned(side: str, column, bits):
    return F.call_function(side, column, bits)


def _piece(cuts: list[int], number):
    """(first bit, width) of the block that `number` names, for blocks between `cuts`."""
    first, width = F.lit(0), F.lit(0)
    for k in range(len(cuts) - 1):
        first = F.when(number == k, cuts[k]).otherwise(first)
        width = F.when(number == k, cuts[k + 1] - cuts[k]).otherwise(width)
    return first, width


def _turned(column, lead):
    """The 64 bits rotated so that bit `lead`, counted from the top, comes first."""
    back = _unsigned("shiftrightunsigned", column, F.lit(BITS) - lead)
    return F.when(lead == 0, column).otherwise(_unsigned("shiftleft", column, lead).bitwiseOR(back))


def _even(bits: int, parts: int) -> list[int]:
    return [bits * k // parts for k in range(parts + 1)]


def dealt_tries(prints: DataFrame, budget: int) -> DataFrame:
    """(trie, side, value, fingerprint): each fingerprint under the block values that lead its tries.

    A crowded trie is split the same way one level down: its fingerprints agree on a block, so
    two of them within the budget also agree on one of as many blocks of the other bits. What
    is still crowded then is dealt out as pairs of parts. So a fingerprint has (budget + 1)
    copies, or their square where tries are crowded, whatever the number of fingerprints.
    """
    count = budget + 1
    numbers = lambda name: F.explode(F.array(*(F.lit(k) for k in range(count)))).alias(name)
    rows = prints.select("fingerprint", numbers("band"))
    lead, width = _piece(_even(BITS, count), F.col("band"))
    rows = rows.withColumn("width", width).withColumn("turned", _turned(F.col("fingerprint"), lead))
    block = _unsigned("shiftrightunsigned", F.col("turned"), F.lit(BITS) - F.col("width"))
    rows = rows.withColumn("block", block)
    crowded = rows.groupBy("band", "block").count().where(f"count > {PART}").select("band", "block", F.lit(True).alias("crowded"))
    rows = rows.join(crowded, ["band", "block"], "left")
    plain = rows.where("crowded IS NULL").select(
        F.xxhash64("band", "block").alias("trie"), F.lit(0).alias("side"), F.col("turned").alias("value"), "fingerprint"
    )
    again = rows.where("crowded").select("fingerprint", "band", "block", "turned", "width", numbers("sub"))
    # Block widths differ by one bit at most; the other bits are cut by their own number.
    widths = sorted({b - a for a, b in zip(_even(BITS, count)[:-1], _even(BITS, count)[1:], strict=True)})
    first, wide = F.lit(0), F.lit(0)
    for w in widths:
        f, n = _piece(_even(BITS - w, count), F.col("sub"))
        first = F.when(F.col("width") == w, f).otherwise(first)
        wide = F.when(F.col("width") == w, n).otherwise(wide)
    again = again.withColumn("first", first).withColumn("wide", wide)
    # The block stays on top, the other bits are rotated below it.
    rest = F.lit(BITS) - F.col("width")
    mask = _unsigned("shiftrightunsigned", F.lit(-1).cast("bigint"), F.col("width"))
    low = F.col("turned").bitwiseAND(mask)
    moved = _unsigned("shiftleft", low, F.col("first")).bitwiseOR(_unsigned("shiftrightunsigned", low, rest - F.col("first")))
    moved = F.when(F.col("first") == 0, low).otherwise(moved.bitwiseAND(mask))
    again = again.withColumn("moved", moved)
    again = again.withColumn("subblock", _unsigned("shiftrightunsigned", F.col("moved"), rest - F.col("wide")))
    key = ["band", "block", "sub", "subblock"]
    full = again.groupBy(*key).count().where(f"count > {PART}")
    full = full.select(*key, F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    again = again.join(full, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    again = again.withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    again = again.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.least("part", "with"), F.greatest("part", "with")
    value = _unsigned("shiftleft", F.col("block"), rest).bitwiseOR(F.col("moved"))
    split = again.select(
        F.xxhash64(*key, *pair).alias("trie"),
        (F.col("part") > F.col("with")).cast("int").alias("side"),
        value.alias("value"),
        "fingerprint",
    )
    return plain.union(split)


def trie_links(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fingerprint) whose classes are
    those of all pairs with at most `budget` differing bits."""
    ready(prints.sparkSession)
    # The sort is of signed longs; flipped, their order is that of unsigned values.
    flipped = F.col("value").bitwiseXOR(F.lit(-(1 << 63))).alias("flipped")
    tries = dealt_tries(prints, budget).select("trie", "side", flipped, "fingerprint")
    dealt = tries.repartition("trie").sortWithinPartitions("trie", "side", "flipped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def emit(rows):
            trie, side, value, whole = (np.concatenate(x) for x in zip(*rows, strict=True))
            left, right = linked(trie, side, value.view(np.uint64) ^ np.uint64(1 << 63), budget)
            return pa.RecordBatch.from_arrays([pa.array(whole[left]), pa.array(whole[right])], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(k).to_numpy() for k in range(4)])
            count += batch.num_rows
            if count >= GATHERED:
                tries_ = np.concatenate([x[0] for x in held])
                cut = int(np.flatnonzero(tries_ != tries_[-1])[-1]) + 1 if (tries_ != tries_[-1]).any() else 0
                if cut:
                    whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                    yield emit([[x[:cut] for x in whole]])
                    held = [[x[cut:] for x in whole]]
                    count = len(held[0][0])
        if held and count:
            yield emit(held)

    return dealt.mapInArrow(run, "u bigint, v bigint")


def classes_of(prints: DataFrame, budget: int) -> DataFrame:
    """(fingerprint, first, root) of distinct fingerprints; equal roots make a class."""
    stars = components(trie_links(prints.select("fingerprint"), budget), "simhash-links")
    joined = prints.join(stars, prints.fingerprint == stars.node, "left")
    return joined.select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, id_column="doc_id", text_column="text", budget: int = BUDGET) -> DataFrame:
    """(id, fingerprint, component) of every row; component: the smallest id of its class."""
    rows = settled(fingerprints(docs, id_column, text_column), "simhash")
    prints = settled(rows.groupBy("fingerprint").agg(F.min("id").alias("first")), "simhash-distinct")
    rooted = classes_of(prints, budget)
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    classes = rooted.join(least, "root").select("fingerprint", "component")
    return rows.join(classes, "fingerprint").select("id", "fingerprint", "component")


def hex_digits(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def representatives(
    docs: DataFrame, id_column="doc_id", text_column="text", ngram=4, seed=42, budget: int = BUDGET, stored=False
) -> DataFrame:
    """One row of each class, all columns kept: that with the smallest id, ids before nulls.

    Rows are told apart by their place, a file and a row number in it, so a class keeps one row
    whether ids are missing, repeated or neither. `stored` says that the rows are those of files
    as they are; others get written first. Places are joined with their rows, once: no text
    is compared.
    """
    rows = with_places(docs, stored)
    file, place = rows.columns[-2:]
    id_name, text_name = (rows.columns[docs.columns.index(c)] for c in (id_column, text_column))
    make = lambda texts: [pa.array(fingerprint_batch(texts, ngram, seed).view(np.int64))]
    slim = rows.select(
        F.col(id_name).alias("id"), F.col(text_name).alias("text"), F.col(file).alias("file"), F.col(place).alias("place")
    )
    slim = settled(extended(slim, "text", "fingerprint bigint", make, keep=["id", "file", "place"]), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "place")).alias("first")
    prints = settled(slim.groupBy("fingerprint").agg(first), "simhash-distinct")
    kept = classes_of(prints, budget).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.file").alias(file), F.col("first.place").alias(place))
    stay = rows.join(kept, [file, place], "left_semi")
    return stay.select(*(F.col(c).alias(name) for c, name in zip(rows.columns, docs.columns, strict=False)))


def with_places(docs: DataFrame, stored: bool) -> DataFrame:
    """The rows with columns renamed c0_, c1_, ... and, last, file_ and place_, which name each row
    in every later read: a hash of the file's path, and the row's number in the file."""
    plain = docs.toDF(*(f"c{k}_" for k in range(len(docs.columns))))
    plain = plain if stored else settled(plain, "rows")
    return plain.selectExpr("*", "xxhash64(_metadata.file_path) AS file_", "_metadata.row_index AS place_")
