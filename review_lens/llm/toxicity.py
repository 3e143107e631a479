"""Toxicity by compression distance: a zstandard dictionary of each class.

Two dictionaries are trained from labelled texts, one on toxic and one on ordinary
text. Each holds strings that are typical of its own class, and the same common words
before them, so that whatever is typical of neither is compressed alike by both. A text
is cut into windows of words, each window is compressed with both, and the difference
of the two lengths tells whose strings it holds. Mean, extremes and the shares of
windows above thresholds are calibrated to a probability, on labelled texts and dictionaries that
haven't seen them.

Strings are typical by how many texts have them, and a text only counts with the pairs
of words that it is the first to have, so many copies don't make their words typical.

Defined results: null and empty texts, and those without words, score like a text
without any difference. Without labelled rows of both classes every score is 0. Rows
without a label, and labels of unknown ids, are not learned from. Rows stay as they
are; of several labels for an id the highest counts.
"""

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm.common import extended, labelled_sample, ready, settled

WINDOW = 12
#: Labelled texts of each class that a fit uses, about and at most, picked by a hash.
SAMPLE = 6_000
#: Words and grams that the dictionaries are chosen from, those in the most texts.
VOCABULARY = 60_000
#: Bytes of words common to both dictionaries, and of a class's own strings.
COMMON_BYTES = 4_000
OWN_BYTES = 8_000
#: Length of the strings that are tested, how sure and how large a difference must be.
GRAM = 5
SURE = 6.0
LIFT = 8.0
#: Bytes of common words that lead every window, so that none is stored uncompressed.
LEAD_BYTES = 47
THRESHOLDS = (1, 2, 3)
WORD = re.compile("[a-z\u0080-\U0010ffff]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Coder:
    """A compressor with each class's dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes, lead: bytes):
        self.dictionaries, self.lead = (toxic, ordinary), lead
        self.made = None

    def __getstate__(self):
        return self.__dict__ | {"made": None}

    def compressors(self):
        if self.made is None:
            settings = zstandard.ZstdCompressionParameters(
                window_log=17,
                hash_log=16,
                chain_log=16,
                search_log=4,
                min_match=GRAM,
                strategy=zstandard.STRATEGY_LAZY,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            raw = zstandard.DICT_TYPE_RAWCONTENT
            self.made = [
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(d, dict_type=raw), compression_params=settings
                ).compress
                for d in self.dictionaries
            ]
        return self.made

    def differences(self, text: str | None) -> list[int]:
        """For each window how many bytes shorter it is with the toxic dictionary."""
        toxic, ordinary = self.compressors()
        words, lead, out = words_of(text), self.lead, []
        for k in range(0, len(words), WINDOW):
            window = lead + f" {' '.join(words[k : k + WINDOW])} ".encode()
            out.append(len(ordinary(window)) - len(toxic(window)))
        return out

    def features(self, text: str | None) -> list[float]:
        found = np.array(self.differences(text) or [0], float)
        shares = [float((found >= t).mean()) for t in THRESHOLDS]
        above = float(np.log1p((found >= THRESHOLDS[0]).sum()))
        return [float(found.mean()), float(found.max()), float(found.min()), *shares, above, float(np.log1p(len(found)))]


def signed_surprise(a: int, b: int, in_a: int, in_b: int) -> float:
    """Root of the likelihood ratio that a and b have different rates, below 0 if b's is higher."""
    n, share = a + b, in_a / (in_a + in_b)
    ratio = sum(x * np.log(x / (n * p)) for x, p in ((a, share), (b, 1 - share)) if x)
    return float(np.sign(a / (n * share) - 1) * np.sqrt(max(2 * ratio, 0.0)))


def grams_of(word: str) -> set[str]:
    return {f" {word} "[k : k + GRAM] for k in range(len(word) + 3 - GRAM)}


Counts = dict[str, tuple[int, int]]


def typical(words: Counts, grams: Counts, totals: tuple[int, int], side: int) -> list[str]:
    """Parts of words that far more texts of the class have than of the other, up to OWN_BYTES."""
    sure = set()
    for gram, pair in grams.items():
        mine, other = pair[side], pair[1 - side]
        rates = [(mine + 0.5) / (totals[side] + 1), (other + 0.5) / (totals[1 - side] + 1)]
        if rates[0] >= LIFT * rates[1] and signed_surprise(mine, other, totals[side], totals[1 - side]) >= SURE:
            sure.add(gram)
    out, size = [], 0
    for word in sorted((w for w in words if grams_of(w) & sure), key=lambda w: (-words[w][side], w)):
        padded, k = f" {word} ", 0
        while k < len(padded):
            end = k
            while padded[end : end + GRAM] in sure:
                end += 1
            if end > k:
                part = padded[k : end + GRAM - 1]
                if not any(part in x for x in out):
                    out = [x for x in out if x not in part] + [part]
            k = end + 1
        size = sum(len(x.encode()) + 1 for x in out)
        if size > OWN_BYTES:
            break
    return out


def trained(words: Counts, grams: Counts, totals: tuple[int, int]) -> Coder:
    """Dictionaries from words and grams, with the toxic and the ordinary texts that have them."""
    common, size = [], 0
    for word in sorted(words, key=lambda w: (-sum(words[w]), w)):
        if abs(signed_surprise(*words[word], *totals)) < SURE / 2:
            size += len(word.encode()) + 1
            if size > COMMON_BYTES:
                break
            common.append(word)
    end = f" {' '.join(reversed(common))} ".encode()
    own = ["\n".join(typical(words, grams, totals, side)).encode() for side in (0, 1)]
    # Filled up to one length, so that the common words lie equally far from a window's start.
    length = max(map(len, own)) + 1
    return Coder(*(end + part.rjust(length, b"\n") for part in own), end[-LEAD_BYTES - 1 : -1])


def logistic(rows: np.ndarray, labels: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, spreads and weights (the constant first) by Newton's steps, with a small ridge."""
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    design = np.c_[np.ones(len(rows)), (rows - mean) / spread]
    weights = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(len(weights))
        weights += np.linalg.solve(bend, design.T @ (labels - p) - 0.01 * weights)
    return mean, spread, weights


class Model:
    def __init__(self, coder: Coder, fitted):
        self.coder, self.fitted = coder, fitted

    def scores(self, texts: list[str | None]) -> np.ndarray:
        mean, spread, weights = self.fitted
        rows = np.array([self.coder.features(t) for t in texts]).reshape(-1, len(mean))
        return 1 / (1 + np.exp(-np.clip(weights[0] + (rows - mean) / spread @ weights[1:], -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, label="toxic", id_column="doc_id", text_column="text", sample: int = SAMPLE
) -> Model | None:
    """A model learned from the documents that have a label; None without both classes.

    Dictionaries of either half of the texts measure
    the other half for the calibration; scores use those of all.
    """
    spark = docs.sparkSession
    ready(spark)
    rows, shares = labelled_sample(docs, labels, label, id_column, text_column, sample)
    if len(shares) < 2:
        return None
    rows = rows.withColumnRenamed("label", "toxic")
    half = F.pmod(F.crc32(F.concat(F.lit("half-"), F.col("id").cast("string"))), F.lit(2))

    def follow(texts):
        found = []
        for text in texts.to_pylist():
            words = words_of(text)
            found.append(sorted({f"{a} {b}" for a, b in zip(["", *words], words, strict=False)}))
        return [pa.array(found, pa.list_(pa.string()))]

    # Each pair of words belongs to the first text that has it, so copies own next to nothing.
    pairs = extended(rows.withColumn("half", half), "text", "pairs array<string>", follow, keep=["id", "toxic", "half"])
    pairs = pairs.select("toxic", "half", "id", F.explode("pairs").alias("pair"))
    owned = pairs.groupBy("pair", "toxic").agg(F.min(F.struct("id", "half")).alias("owner"))
    owned = owned.groupBy("owner", "toxic").agg(F.collect_set(F.substring_index("pair", " ", -1)).alias("words"))

    def parts_of(batches):
        for batch in batches:
            words = batch.column("words").to_pylist()
            strings = [w + sorted(set().union(*map(grams_of, w))) for w in words]
            kinds = [[False] * len(w) + [True] * (len(s) - len(w)) for w, s in zip(words, strings, strict=True)]
            sizes = [len(s) for s in strings]
            columns = [batch.column(k).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))) for k in (0, 1)]
            flat = [pa.array([x for s in strings for x in s], pa.string()), pa.array([x for k in kinds for x in k], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns + flat, ["toxic", "half", "string", "gram"])

    strings = owned.select("toxic", F.col("owner.half").alias("half"), "words")
    strings = strings.mapInArrow(parts_of, "toxic int, half bigint, string string, gram boolean")
    # Parts of the labelled texts that have dictionaries: all, and both halves.
    parts = {"": F.lit(True), "0": F.col("half") == 0, "1": F.col("half") == 1}
    of = {f"{side}{part}": (F.col("toxic") == mark) & use for side, mark in (("a", 1), ("b", 0)) for part, use in parts.items()}
    counts = strings.groupBy("gram", "string").agg(*(F.sum(seen.cast("int")).alias(name) for name, seen in of.items()))
    counts = settled(counts, "toxicity-strings")
    texts = owned.select("toxic", F.col("owner.half").alias("half"))
    totals = texts.agg(*(F.coalesce(F.sum(seen.cast("int")), F.lit(0)).alias(name) for name, seen in of.items())).first()
    if not all(totals):
        return None
    often = F.col("a") / F.lit(float(totals["a"])) + F.col("b") / F.lit(float(totals["b"]))
    top = [
        counts.where(F.col("gram") == gram).orderBy(often.desc(), "string").limit(VOCABULARY).toArrow().to_pydict()
        for gram in (False, True)
    ]
    coders = []
    for part in parts:
        words, grams = (
            {s: (a, b) for s, a, b in zip(t["string"], t[f"a{part}"], t[f"b{part}"], strict=True) if a + b} for t in top
        )
        coders.append(trained(words, grams, (totals[f"a{part}"], totals[f"b{part}"])))
    sent = spark.sparkContext.broadcast(coders[1:])

    def measure(texts):
        return [
            pa.array([coder.features(t) for t in texts.to_pylist()], pa.list_(pa.float64())) for coder in sent.value
        ]

    fields = "by_one array<double>, by_other array<double>"
    measured = extended(rows.withColumn("half", half), "text", fields, measure, keep=["id", "toxic", "half"])
    unseen = F.when(F.col("half") == 0, F.col("by_other")).otherwise(F.col("by_one"))
    measured = measured.select("id", "toxic", unseen.alias("features")).toArrow().sort_by("id")
    marked = measured.column("toxic").to_numpy()
    mean, spread, weights = logistic(np.array(measured.column("features").to_pylist()), marked)
    # The sample may hold another share of toxic texts than all labelled rows.
    weights[0] += np.log(shares[1] / shares[0]) - np.log(marked.sum() / (1 - marked).sum())
    return Model(coders[0], (mean, spread, weights))


def scored(docs: DataFrame, model: Model | None, text_column="text", keep=None) -> DataFrame:
    """The rows with toxicity, a probability."""
    if model is None:
        return docs.select(*(docs.columns if keep is None else keep)).withColumn("toxicity", F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    make = lambda texts: [pa.array(sent.value.scores(texts.to_pylist()))]
    return extended(docs, text_column, "toxicity double", make, keep)
