"""Quality rules: lines are marked content or boilerplate, their share decides.

A linear-chain conditional random field gives each line of a text a label from its
features (length, shares of capitals, digits, symbols and long words, how it begins and
ends, whether it came before) and from its neighbours' labels; Viterbi decoding finds
the best labels of all lines together. A text is kept if enough of its words stand in
content lines. Before that, fixed rules reject texts that are too short or repeat
themselves.

The field is fitted by likelihood on lines of labelled texts. All lines of good texts
are content. Lines of bad texts begin as boilerplate and are relabelled by the field
itself in rounds, as such texts also hold good lines.

Defined results: a null text has no words and fails. Without labelled texts of both
classes every line is content. A text without words has a content share of 0. Rows stay
as they are, repeated ones too.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm import blocks
from review_lens.llm.common import extended, labelled_sample, ready

BOILERPLATE, CONTENT = 0, 1
#: Labelled texts of each class that a fit uses, about and at most, picked by a hash.
SAMPLE = 1_500
#: Lines in a stretch: a fit learns from all lines of a text, cut into stretches of so many, so that
#: a step's loop is as long as a stretch. Decoding always takes texts as they are.
STRETCH = 80
#: Texts with the most lines in a block, which are decoded one by one.
ALONE = 32
ROUNDS, STEPS = 3, 60
#: Share of a text's words that must stand in content lines.
LEAST_CONTENT = 0.5
#: Fixed values of the base rules.
GRAM, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
SYMBOLS = b"#*$%&|<>"

_class = lambda chars: blocks.byte_table(lambda b: b in chars)
CLASSES = {
    "capital": _class(range(65, 91)),
    "small": _class(range(97, 123)),
    "digit": _class(range(48, 58)),
    "symbol": _class(SYMBOLS),
    "loud": _class(b"!?=~^_+@/\\{}[]"),
    "stop": _class(b".,;:"),
    "high": _class(range(0xC2, 0xF5)),
    "space": _class(b" \t\x0b\x0c\r"),
}
FOLLOWS = _class(range(0x80, 0xC0))
#: Upper ends of the steps into which shares, and numbers of words, are cut.
SHARES = np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.5])
SIZES = np.array([0, 1, 2, 4, 8, 16, 40, 120])
ENDS = [_class(chars) for chars in (b".", b"!?", b",;:", SYMBOLS)] + [blocks.ALNUM]


class Lines:
    """Lines of a block of texts, with all the counts that rules and features need."""

    def __init__(self, texts: pa.Array):
        data, offsets = blocks.text_bytes(texts)
        self.texts = len(offsets) - 1
        self.words = blocks.find_words(data, offsets, blocks.NOT_SPACE)
        breaks = np.flatnonzero(data == 10)
        # A line begins with each text and after each line end.
        order = np.sort(np.concatenate((offsets[:-1] * 2, breaks * 2 + 3)))
        self.starts = order // 2
        row = np.searchsorted(breaks, offsets)
        self.rows = row + np.arange(self.texts + 1)
        self.ends = np.concatenate((self.starts[1:], [len(data)])) if len(self.starts) else self.starts
        last = np.zeros(len(self.starts), bool)
        last[self.rows[1:] - 1] = True
        self.ends = self.ends - np.where(last, 0, 1)
        self.row_of = np.repeat(np.arange(self.texts), np.diff(self.rows))
        self.line_of = np.searchsorted(self.starts, self.words.starts, "right") - 1
        self.n_words = np.bincount(self.line_of, minlength=len(self.starts)).astype(np.int64)
        self.data, self.offsets = data, offsets
        hashes = blocks.word_hashes(blocks.Words(data, self.starts, self.ends, self.rows))
        keys = hashes ^ blocks.mixed(self.row_of.astype(np.uint64) + np.uint64(1))
        self.repeated = self.later(keys) & (self.n_words > 0)

    @staticmethod
    def later(keys: np.ndarray) -> np.ndarray:
        """Whether each key came before."""
        out = np.ones(len(keys), bool)
        out[np.unique(keys, return_index=True)[1]] = False
        return out

    def count(self, mask: np.ndarray, starts, ends) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[ends] - total[starts]

    def base(self) -> dict[str, np.ndarray]:
        """The counts of the base rules for each text."""
        words, begin, end = self.words, self.offsets[:-1], self.offsets[1:]
        inside = blocks.NOT_SPACE[self.data]
        hashes = blocks.word_hashes(words)
        at = blocks.whole_grams(words.rows, GRAM)
        rows = np.searchsorted(words.rows, at, "right") - 1
        keys = blocks.gram_hashes(hashes, GRAM)[at] ^ blocks.mixed(rows.astype(np.uint64) + np.uint64(1))
        _, of, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[times[of.reshape(-1)] > 1]
        change = np.bincount(twice, minlength=len(hashes) + GRAM) - np.bincount(twice + GRAM, minlength=len(hashes) + GRAM)
        covered = np.cumsum(change)[: len(hashes)] > 0
        covered = np.concatenate(([0], np.cumsum(covered)))
        return {
            "n_words": np.diff(words.rows),
            "word_chars": self.count(inside & ~FOLLOWS[self.data], begin, end),
            "n_symbols": self.count(CLASSES["symbol"][self.data], begin, end),
            "n_dup_lines": np.bincount(self.row_of, self.repeated, self.texts).astype(np.int64),
            "n_repeat_words": covered[words.rows[1:]] - covered[words.rows[:-1]],
        }

    def features(self) -> np.ndarray:
        """For each line the numbers of the features that hold, one of each group."""
        size = np.maximum(self.count(~FOLLOWS[self.data], self.starts, self.ends), 1)
        found, base = [], 0

        def group(values, many):
            nonlocal base
            found.append(values + base)
            base += many

        group(np.searchsorted(SIZES, self.n_words), len(SIZES) + 1)
        for name in CLASSES:
            share = self.count(CLASSES[name][self.data], self.starts, self.ends) / size
            group(np.searchsorted(SHARES, share), len(SHARES) + 1)
        group(np.minimum(size // np.maximum(self.n_words, 1), 24) // 3, 9)
        group(self.repeated.astype(int), 2)
        full = self.n_words > 0
        first, last = np.zeros(len(full), int), np.zeros(len(full), int)
        if full.any():
            begin = np.searchsorted(self.line_of, np.flatnonzero(full))
            finish = np.searchsorted(self.line_of, np.flatnonzero(full), "right") - 1
            first[full] = self.data[self.words.starts[begin]]
            last[full] = self.data[self.words.ends[finish] - 1]
        group(np.select([CLASSES[c][first] for c in ("capital", "small", "digit", "high")], [1, 2, 3, 4], 0), 5)
        group(np.select([end[last] for end in ENDS], [1, 2, 3, 4, 5], 0), 6)
        return np.stack(found, axis=1)


GROUPS = [len(SIZES) + 1, *[len(SHARES) + 1] * len(CLASSES), 9, 2, 5, 6]
WIDTH = sum(GROUPS)


def stretches(rows: np.ndarray, most: int = STRETCH) -> np.ndarray:
    """The first lines of all texts, and of each further `most` lines within one."""
    cuts = [np.arange(a, b, most) for a, b in zip(rows[:-1], rows[1:], strict=True) if b > a]
    return np.concatenate([*cuts, rows[-1:]])


def padded(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of lines by text and position, and which of them there are."""
    counts = np.diff(rows)
    at = np.arange(counts.max(initial=0))
    there = at < counts[:, None]
    return np.where(there, rows[:-1, None] + at, 0), there


class Chain:
    """A linear-chain field with two labels."""

    def __init__(self):
        self.weights = np.zeros((WIDTH, 2))
        self.follows = np.zeros((2, 2))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=1)

    def step(self, features, places, there, labels, rate, memory) -> None:
        """One step up the likelihood of the labels, texts side by side."""
        scores = self.emissions(features)[places]
        n, t, _ = scores.shape
        fore, aft = np.zeros((t, n, 2)), np.zeros((t, n, 2))
        for k in range(t):
            into = scores[:, k]
            if k:
                into = into + np.logaddexp.reduce(fore[k - 1][:, :, None] + self.follows, axis=1)
            fore[k] = np.where(there[:, k, None], into, fore[k - 1] if k else into)
        for k in range(t - 2, -1, -1):
            back = np.logaddexp.reduce(self.follows + (scores[:, k + 1] + aft[k + 1])[:, None, :], axis=2)
            aft[k] = np.where(there[:, k + 1, None], back, aft[k + 1])
        total = np.logaddexp.reduce(fore[-1], axis=1)
        share = np.exp(fore + aft - total[:, None]).transpose(1, 0, 2)
        own = np.eye(2)[labels[places]]
        push = ((own - share) * there[..., None])[there]
        flat = features[places[there]].ravel()
        move = np.stack([np.bincount(flat, np.repeat(p, len(GROUPS)), WIDTH) for p in push.T], axis=1)
        pairs = np.zeros((2, 2))
        for k in range(1, t):
            both = there[:, k]
            joint = fore[k - 1][:, :, None] + self.follows + (scores[:, k] + aft[k])[:, None, :] - total[:, None, None]
            pairs -= np.exp(joint[both]).sum(axis=0)
            np.add.at(pairs, (labels[places[both, k - 1]], labels[places[both, k]]), 1)
        count = max(there.sum(), 1)
        for value, change, past in zip((self.weights, self.follows), (move, pairs), memory, strict=True):
            change = change / count - 1e-4 * value
            past *= 0.9
            past += 0.1 * change**2
            value += rate * change / (np.sqrt(past) + 1e-6)

    def decode(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The best label of every line. The texts with the most lines are worked off one by one,
        those with lines left of the others side by side."""
        scores = self.emissions(features)
        labels = np.zeros(len(features), np.int8)
        order = np.argsort(-np.diff(rows), kind="stable")
        for text in order[:ALONE].tolist():
            a, b = int(rows[text]), int(rows[text + 1])
            if b > a:
                labels[a:b] = self.best(scores[a:b].tolist())
        order = order[ALONE:]
        starts, counts = rows[:-1][order], np.diff(rows)[order]
        back = np.zeros((len(features), 2), np.int8)
        now = np.zeros((len(order), 2))
        for k in range(counts.max(initial=0)):
            open_ = int(np.searchsorted(-counts, -k))
            at = starts[:open_] + k
            if k:
                ways = now[:open_, :, None] + self.follows
                back[at] = ways.argmax(axis=1)
                now[:open_] = ways.max(axis=1)
            now[:open_] += scores[at]
        if not len(order):
            return labels
        last = now.argmax(axis=1)
        for k in range(counts.max(initial=0) - 1, -1, -1):
            open_ = int(np.searchsorted(-counts, -k))
            at = starts[:open_] + k
            labels[at] = last[:open_]
            last[:open_] = back[at, last[:open_]]
        return labels

    def best(self, scores: list) -> list[int]:
        """The same for one text, by plain numbers: what an array costs more a line than two of them."""
        (stay, leave), (enter, remain) = self.follows.tolist()
        a, b = scores[0]
        from_a, from_b = bytearray(1), bytearray(1)
        for x, y in scores[1:]:
            one, two = a + stay, b + enter
            three, four = a + leave, b + remain
            from_a.append(two > one)
            from_b.append(four > three)
            a = (two if two > one else one) + x
            b = (four if four > three else three) + y
        label, out = int(b > a), []
        for k in range(len(scores) - 1, -1, -1):
            out.append(label)
            label = (from_b if label else from_a)[k]
        return out[::-1]

    def fit(self, features: np.ndarray, rows: np.ndarray, good: np.ndarray) -> "Chain":
        """Fit on the features of all lines of some texts; `rows` has each text's first line."""
        places, there = padded(stretches(rows))
        of_good = np.repeat(good, np.diff(rows)).astype(bool)
        labels = of_good.astype(int)
        for _ in range(ROUNDS):
            memory = [np.zeros_like(self.weights), np.zeros_like(self.follows)]
            for k in range(STEPS):
                self.step(features, places, there, labels, 0.1 if k < STEPS // 2 else 0.03, memory)
            labels = np.where(of_good, CONTENT, self.decode(features, rows))
        return self


def line_features(texts: pa.Array) -> list[pa.Array]:
    """The features of all lines of each text, one byte each, a text after the other."""
    lines = Lines(texts)
    data = lines.features().astype(np.uint8).tobytes()
    offsets = (lines.rows * len(GROUPS)).astype(np.int64)
    sizes = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    return [pa.array([data[a:b] for a, b in sizes], pa.binary())]


def fit(
    docs: DataFrame, labels: DataFrame, label="quality", id_column="doc_id", text_column="text", sample: int = SAMPLE
) -> Chain | None:
    """A field fitted on labelled texts; None without both classes."""
    ready(docs.sparkSession)
    rows, counts = labelled_sample(docs, labels, label, id_column, text_column, sample)
    if len(counts) < 2:
        return None
    # Features come to the driver, not texts: some bytes for each line of the sampled ones.
    table = extended(rows, "text", "features binary", line_features, keep=["id", "label"]).toArrow().sort_by("id")
    good = table.column("label").to_numpy()
    if len(set(good.tolist())) < 2:
        return None
    held = table.column("features").to_pylist()
    features = np.frombuffer(b"".join(held), np.uint8).reshape(-1, len(GROUPS)).astype(np.int64)
    return Chain().fit(features, np.cumsum([0, *(len(f) // len(GROUPS) for f in held)]), good)


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, content_share double"
)


def measured(texts: pa.Array, chain: Chain | None) -> list[pa.Array]:
    lines = Lines(texts)
    base = lines.base()
    n_words = base["n_words"]
    failed = (n_words < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * n_words)
    labels = np.full(len(lines.starts), CONTENT) if chain is None else chain.decode(lines.features(), lines.rows)
    content = np.bincount(lines.row_of, lines.n_words * (labels == CONTENT), lines.texts)
    share = content / np.maximum(n_words, 1)
    return [pa.array(v.astype(np.int64)) for v in base.values()] + [
        pa.array(failed),
        pa.array(~failed & (share >= LEAST_CONTENT)),
        pa.array(share),
    ]


def judged(docs: DataFrame, chain: Chain | None, text_column="text", keep=None) -> DataFrame:
    """The rows with their counts, base_failed, content_share and kept."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    return extended(docs, text_column, FIELDS, lambda texts: measured(texts, sent.value), keep)
