"""Language ID by unigram pieces, summed over all segmentations.

Each language has its own probabilities for the pieces of a fixed public vocabulary.
The forward algorithm sums, over all ways to cut a word into pieces, the product of
their probabilities. No piece reaches over a space, so a text's likelihood is the
product over its words. Single bytes are pieces too: every text has a segmentation.

Probabilities are fitted by expectation and maximisation: forward and backward sums
give each piece's expected count in a language's words, counts give probabilities.
Words are runs of letters and of everything that is not ASCII, lower-cased.

Defined results: a text that is null or has no letter is `und` with score 0; without
any labelled row all texts are. Ties go to the language first in order. Rows without a
label are not learned from. All rows stay; other columns are not read.
"""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import extended, kept_where, ready, settled

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
ROUNDS = 3
#: Expected count that every piece has to begin with, so that none has probability 0.
SMOOTHING = 0.05
#: Share of the likelihood that a document's language must exceed to be accepted.
LEAST_SHARE = 0.5
#: A floor is measured on one part of so many of the labelled texts; the others teach it.
PARTS = 5
#: Decimals of what floors are medians of, so that counting its values takes bounded room.
DECIMALS = 3
LETTERS = blocks.byte_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)
ASCII_LETTER = re.compile("[A-Za-z]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a public vocabulary that can stand in a word, and all single bytes. A
    leading space marks the beginning of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256) if LETTERS[b]} | {b" "}
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
            continue
        piece = model.id_to_piece(k).replace("▁", " ").lower().encode()
        body = piece[1:] if piece[:1] == b" " else piece
        if body and LETTERS[np.frombuffer(body, np.uint8)].all():
            found.add(piece)
    return sorted(found)


class Pieces:
    """The vocabulary as a hash table: a piece's place from the hash of its bytes."""

    SLOTS = 1 << 19

    def __init__(self, pieces: list[bytes]):
        self.count = len(pieces)
        self.lengths = sorted({len(p) for p in pieces})
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        words = blocks.Words(data, ends - sizes, ends, np.array([0, len(pieces)]))
        hashes = blocks.word_hashes(words)
        order = np.argsort(hashes)
        self.hashes, self.places = hashes[order], order
        self.maybe = np.zeros(self.SLOTS, bool)
        self.maybe[(hashes & np.uint64(self.SLOTS - 1)).astype(np.int64)] = True

    def at(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's piece, -1 for none."""
        out = np.full(len(hashes), -1)
        may = np.flatnonzero(self.maybe[(hashes & np.uint64(self.SLOTS - 1)).astype(np.int64)])
        asked = hashes[may]
        near = np.minimum(np.searchsorted(self.hashes, asked), self.count - 1)
        hit = self.hashes[near] == asked
        out[may[hit]] = self.places[near[hit]]
        return out


class Lattice:
    """All arcs of the segmentations of some words, by the place at which they end.

    Words stand one after the other with a leading space each. Arcs that end at the
    same distance from their word's start are worked on together.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces):
        self.starts, self.ends = starts, ends
        length = ends - starts
        froms, tos, which = [], [], []
        for size in pieces.lengths:
            counts = np.maximum(length - size + 1, 0)
            if not counts.any():
                break
            total = np.cumsum(counts)
            begin = np.arange(total[-1]) + np.repeat(starts - (total - counts), counts)
            found = pieces.at(blocks.word_hashes(blocks.Words(data, begin, begin + size, np.zeros(1, int))))
            hit = found >= 0
            froms.append(begin[hit])
            tos.append(begin[hit] + size)
            which.append(found[hit])
        self.froms, self.tos, self.which = (np.concatenate(x) for x in (froms, tos, which))
        word = np.searchsorted(starts, self.froms, "right") - 1
        # Node k of a word is its byte k; nodes of all words, one more than bytes in each.
        self.node_from = self.froms + word
        self.node_to = self.tos + word
        self.first = starts + np.arange(len(starts))
        self.last = ends + np.arange(len(starts))
        self.nodes = int(self.last[-1]) + 1
        depth = self.node_to - self.first[word]
        order = np.lexsort((self.node_to, depth))
        for name in ("node_from", "node_to", "which"):
            setattr(self, name, getattr(self, name)[order])
        self.steps = np.flatnonzero(np.diff(depth[order], prepend=-1, append=-1))

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations up to each node, for each language."""
        sums = np.full((self.nodes, logs.shape[1]), -np.inf)
        sums[self.first] = 0.0
        for a, b in zip(self.steps[:-1], self.steps[1:], strict=True):
            self._add(sums, self.node_to[a:b], sums[self.node_from[a:b]] + logs[self.which[a:b]])
        return sums

    @staticmethod
    def _add(sums, to, terms):
        at = np.flatnonzero(np.diff(to, prepend=-1))
        most = np.maximum.reduceat(terms, at, axis=0)
        safe = np.where(np.isfinite(most), most, 0.0)
        sizes = np.diff(np.append(at, len(to)))
        total = np.add.reduceat(np.exp(terms - np.repeat(safe, sizes, axis=0)), at, axis=0)
        with np.errstate(divide="ignore"):
            sums[to[at]] = safe + np.log(total)

    def backward(self, logs: np.ndarray) -> np.ndarray:
        sums = np.full((self.nodes, logs.shape[1]), -np.inf)
        sums[self.last] = 0.0
        begin = self.first[np.searchsorted(self.first, self.node_from, "right") - 1]
        depth = self.node_from - begin
        order = np.lexsort((self.node_from, -depth))
        at, to, which = self.node_from[order], self.node_to[order], self.which[order]
        cuts = np.flatnonzero(np.diff(depth[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            self._add(sums, at[a:b], sums[to[a:b]] + logs[which[a:b]])
        return sums

    def expected(self, logs: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
        """Expected count of each piece; weight: of each word."""
        before, after = self.forward(logs), self.backward(logs)
        word = np.searchsorted(self.first, self.node_from, "right") - 1
        share = np.exp(before[self.node_from] + logs[self.which] + after[self.node_to] - before[self.last[word]])
        return np.bincount(self.which, (share * weight[word][:, None])[:, 0], count)


def lattice(words: list[bytes], pieces: Pieces) -> Lattice:
    data = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words])
    return Lattice(data, np.concatenate(([0], ends[:-1])), ends, pieces)


class Scorer:
    """Log probabilities of words in all languages; those of recent words are kept."""

    KEPT = 200_000

    def __init__(self, languages: list[str], pieces: list[bytes], logs: np.ndarray):
        self.languages, self.pieces, self.logs = languages, Pieces(pieces), logs
        self.hashes = np.zeros(0, np.uint64)
        self.known = np.zeros((0, len(languages)))

    def word_logs(self, words: blocks.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words' log probabilities, and each word's place among them."""
        distinct, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        out = np.zeros((len(distinct), len(self.languages)))
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        have = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        out[have] = self.known[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            taken = first[new]
            for a in range(0, len(new), 20_000):
                part = taken[a : a + 20_000]
                spans = zip(words.starts[part], words.ends[part], strict=True)
                table = lattice([words.data[s:e].tobytes() for s, e in spans], self.pieces)
                out[new[a : a + 20_000]] = table.forward(self.logs)[table.last]
            if len(self.hashes) + len(new) > self.KEPT:
                self.hashes, self.known = distinct, out
            else:
                merged = np.concatenate((self.hashes, distinct[new]))
                order = np.argsort(merged)
                self.hashes, self.known = merged[order], np.concatenate((self.known, out[new]))[order]
        return out, of.reshape(-1)

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Best language, its share of the likelihoods, and log likelihood per byte."""
        return self.measured(texts)[:3]

    def measured(self, texts: pa.Array) -> tuple[list[str], *tuple[np.ndarray, ...]]:
        """Best language, its share, its log likelihood per byte and per letter, letters (each
        word's leading space counts as one), and the least log likelihood of a word."""
        lowered = [x.lower() if x is not None else "" for x in texts.to_pylist()]
        data, offsets = blocks.text_bytes(pa.array(lowered, pa.large_string()))
        words = blocks.find_words(data, offsets, LETTERS)
        logs, of = self.word_logs(words, blocks.word_hashes(words))
        rows = words.row_of()
        total = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages) if len(of) else 0):
            total[:, k] = np.bincount(rows, logs[of, k], len(texts))
        size = np.bincount(rows, words.ends - words.starts + 1, len(texts))
        begun = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        letters = np.maximum(np.bincount(rows, begun[words.ends] - begun[words.starts] + 1, len(texts)), 1)
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share = share.max(axis=1) / share.sum(axis=1)
        found = [has_letter(x) for x in lowered]
        names = [self.languages[k] if f else UNDETERMINED for k, f in zip(best, found, strict=True)]
        own = total[np.arange(len(texts)), best]
        rate = own / np.maximum(size, 1)
        worst = np.zeros(len(texts))
        if len(of):
            np.minimum.at(worst, rows, logs[of, best[rows]])
        return names, np.where(found, share, 0.0), np.where(found, rate, 0.0), own / letters, letters, worst


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text))


def fit(
    docs: DataFrame, label="lang", id_column="doc_id", text_column="text", path: str | None = None
) -> Scorer | None:
    """A scorer learned from the words of all labelled rows; None without any."""
    spark = docs.sparkSession
    ready(spark)
    pieces = read_pieces(path or vocabulary_path())
    rows = docs.select(F.col(label).cast("string").alias("label"), F.col(text_column).cast("string").alias("text"))
    rows = rows.where("label is not null and text is not null")
    letters = F.regexp_extract_all(F.lower("text"), F.lit("([a-z\u0080-\U0010ffff]+)"), F.lit(1))
    words = rows.select("label", F.explode(letters).alias("word")).groupBy("label", "word").count()
    words = settled(words, "language-words")
    languages = sorted(r[0] for r in words.select("label").distinct().collect())
    if not languages:
        return None
    place = {name: k for k, name in enumerate(languages)}
    logs = np.full((len(pieces), len(languages)), -np.log(len(pieces)))
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((pieces, logs))

        def expect(batches, sent=sent):
            pieces, logs = sent.value
            table = Pieces(pieces)
            sums = np.zeros(logs.shape)
            for batch in batches:
                label = np.array([place[x] for x in batch.column("label").to_pylist()], int)
                count = batch.column("count").to_numpy()
                words = [w.encode() for w in batch.column("word").to_pylist()]
                for k in np.unique(label):
                    own = np.flatnonzero(label == k)
                    net = lattice([words[i] for i in own], table)
                    sums[:, k] += net.expected(logs[:, k : k + 1], count[own], len(pieces))
            piece, language = np.nonzero(sums)
            columns = [pa.array(piece), pa.array(language), pa.array(sums[piece, language])]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "language", "expected"])

        parts = words.repartition("label", "word").mapInArrow(expect, "piece bigint, language bigint, expected double")
        found = parts.groupBy("piece", "language").agg(F.sum("expected").alias("expected")).toArrow()
        sums = np.full(logs.shape, SMOOTHING)
        sums[found.column("piece").to_numpy(), found.column("language").to_numpy()] += found.column("expected").to_numpy()
        logs = np.log(sums / sums.sum(axis=0))
    return Scorer(languages, pieces, logs)


def identified(docs: DataFrame, scorer: Scorer | None, text_column="text", keep=None) -> DataFrame:
    """The rows with lang_pred and lang_score."""
    if scorer is None:
        names = docs.columns if keep is None else keep
        return docs.select(*names).withColumns({"lang_pred": F.lit(UNDETERMINED), "lang_score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def make(texts):
        names, share, _ = sent.value.score(texts)
        return [pa.array(names, pa.string()), pa.array(share, pa.float64())]

    return extended(docs, text_column, "lang_pred string, lang_score double", make, keep)


def shuffled(text: str) -> str:
    """The text with all its letters in another order; words keep their lengths."""
    words = re.findall("[a-z\u0080-\U0010ffff]+", text.lower())
    letters = list("".join(words))
    random.Random(len(letters)).shuffle(letters)
    ends = np.cumsum([len(w) for w in words]).tolist()
    return " ".join("".join(letters[a:b]) for a, b in zip([0, *ends], ends, strict=False))


def floors(
    docs: DataFrame, label="lang", id_column="doc_id", text_column="text", path: str | None = None
) -> dict[str, tuple[float, float]]:
    """For each language the least log likelihood per letter to be taken for it, and what a
    text may lack in all: as much as the worst word of a usual text costs, so that one odd
    word is not held against a short text. Per letter, as bytes of other scripts are cheap:
    most of them follow from the ones before.

    The least is halfway between the median of its texts and that of the same texts with
    their letters shuffled. Both are measured on all labelled texts that were left out of a
    fit of their own; a language without such texts has no floor.
    """
    part = F.pmod(F.xxhash64(id_column, F.col(text_column).cast("string")), F.lit(PARTS))
    scorer = fit(docs.where(part != 0), label, id_column, text_column, path)
    if scorer is None:
        return {}
    rows = docs.where(part == 0).select(
        F.col(label).cast("string").alias("label"), F.col(text_column).cast("string").alias("text")
    )
    rows = rows.where("label is not null")
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def make(texts):
        names, _, _, rate, _, worst = sent.value.measured(texts)
        mixed = sent.value.measured(pa.array([shuffled(x or "") for x in texts.to_pylist()], pa.large_string()))[3]
        return [pa.array(names, pa.string()), pa.array(rate), pa.array(mixed), pa.array(worst)]

    found = extended(rows, "text", "lang_pred string, rate double, mixed double, worst double", make, keep=["label"])
    middle = [F.percentile(F.round(c, DECIMALS), F.lit(0.5)).alias(c) for c in ("rate", "mixed", "worst")]
    found = found.where("label = lang_pred").groupBy("label").agg(*middle)
    return {r["label"]: ((r["rate"] + r["mixed"]) / 2, -r["worst"]) for r in found.collect()}


def accepted(
    docs: DataFrame,
    scorer: Scorer | None,
    text_column="text",
    least: float = LEAST_SHARE,
    limits: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """The documents in some learned language; rejected are those without letters, those for
    which no language has more than `least` of the likelihood, and those that even the
    best language fits worse, letter for letter, than `limits` (from `floors`) allow."""
    limits = limits or {}
    if scorer is None:
        judge = lambda rows, text: identified(rows, None, text).withColumn("lang_fits", F.lit(False))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(scorer)

        def make(texts):
            names, share, _, rate, letters, _ = sent.value.measured(texts)
            floor = np.array([limits.get(name, (-np.inf, 0.0)) for name in names]).reshape(-1, 2)
            fits = rate >= floor[:, 0] - floor[:, 1] / letters
            return [pa.array(names, pa.string()), pa.array(share, pa.float64()), pa.array(fits)]

        fields = "lang_pred string, lang_score double, lang_fits boolean"
        judge = lambda rows, text: extended(rows, text, fields, make)
    fitting = (F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") > least) & F.col("lang_fits")
    return kept_where(docs, text_column, judge, fitting)
