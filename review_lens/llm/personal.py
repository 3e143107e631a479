"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns give the base spans of emails, IP addresses, cards and phones. The field
works on the tokens around digits and @ signs. Its candidates are whole spans of up to
LONGEST tokens; features of a whole span (its digits, their checksum, separators, parts
of addresses, what stands beside it) score it for each kind, and weights between labels
score what follows what. A dynamic programme over span ends picks boundaries and kinds
together. It is fitted by likelihood on base spans and on stated variations of them
(a phone without its country code, a card with dots, an address with spaces round @,
blanks round the marks of a number), so it also finds forms that the patterns don't know. Spans of the field that overlap no
base span are added; base spans always stay.

Defined results: a null or empty text has no spans. Offsets are code points, ends
exclusive. Repeated rows give repeated results. All rows and columns stay. Without
rows to fit on, the field adds nothing.
"""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm.common import bounded_sample, extended, ready

# The kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is tried from its start only: from within it, no other match can follow.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 20
#: Characters of unbroken text beside a digit or @ that belong to its surroundings.
REACH = 64
#: Texts that the field is fitted on, about and at most, picked by a hash.
SAMPLE = 4_000
#: Different token shapes of surroundings that the fit goes over.
SHAPES = 1_200
ROUNDS = 12

TOKEN = re.compile(r"[^\W_]+|\s|[\W_]")
#: Blanks between an @ and what it joins, at most.
GAP = 3
WORDLIKE = re.compile(r"[^\W_]")
TRIGGER = re.compile(r"[0-9@]+")
SPACES = re.compile(r"\s")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Matches of local@domain, leftmost first. Each @ is met once, so time is linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        rest = DOMAIN.match(text, at + 1) if start < at else None
        if rest:
            yield start, rest.end()
            done = rest.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        found = digits_of(m[0])
        if 16 <= len(found) <= 19 and luhn(found):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def unbroken(text: str, a: int, b: int) -> tuple[int, int]:
    """The range with the text up to the next white space on both sides, REACH at most."""
    low, high = max(0, a - REACH), min(len(text), b + REACH)
    left = max((s.end() for s in SPACES.finditer(text, low, a)), default=low)
    right = SPACES.search(text, b, high)
    return left, right.start() if right else high


def surroundings(text: str) -> list[tuple[int, int]]:
    """Where digits or @ signs stand, with the unbroken text beside them. An @ with a blank
    beside it has the unbroken text beyond the blank, too. Neighbours are joined if nothing
    but blanks and separators, fewer than a span has tokens, stands between them."""
    out = []
    for m in TRIGGER.finditer(text):
        a, b = m.span()
        if out and b <= out[-1][1] and "@" not in m[0]:
            continue
        left, end = unbroken(text, a, b)
        if m[0][0] == "@" and a and text[a - 1] in " \t":
            beyond = len(text[max(0, a - GAP) : a].rstrip(" \t")) + max(0, a - GAP)
            left = min(left, unbroken(text, beyond, beyond)[0])
        if m[0][-1] == "@" and text[b : b + 1] in (" ", "\t"):
            beyond = min(len(text), b + GAP) - len(text[b : b + GAP].lstrip(" \t"))
            end = max(end, unbroken(text, beyond, beyond)[1])
        if out and left <= out[-1][1]:
            low, high = out.pop()
            out.append((min(low, left), max(end, high)))
        elif out and left - out[-1][1] < LONGEST and not WORDLIKE.search(text, out[-1][1], left):
            out[-1] = (out[-1][0], end)
        else:
            out.append((left, end))
    return out


def features(span: str, before: str, after: str) -> list[float]:
    """What holds of a whole span; nothing here knows its kind."""
    n = digits_of(span)
    marks = {c for c in span if not c.isalnum()}
    letters = any(c.isalpha() for c in span)
    parts = span.split(".")
    tail = span.rpartition("@")[2].strip()
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p[:6]) <= 255 for p in parts)
    plain = not letters and "@" not in marks
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    return [
        1.0,
        float(plain),
        float(plain and octets),
        float(plain and 16 <= len(n) <= 19 and luhn(n)),
        float(plain and 16 <= len(n) <= 19 and not luhn(n)),
        float(plain and 8 <= len(n) <= 15),
        float(plain and len(n) < 8),
        float(plain and len(n) > 19),
        float(span[0] == "+"),
        float(span[0] == "(" and ")" in marks),
        float(plain and not octets and bool(marks) and len(n) in (10, 11) and groups[-1] == 4),
        float(marks <= {" ", "-", "."}),
        float(bool(marks - set(" ().+-"))),
        float(not marks),
        float(span.count("@") == 1),
        float(span.count("@") > 1),
        float("@" in marks and "." in tail and all(c in LOCAL_CHARS for c in tail)),
        float("@" in marks and any(c.isspace() for c in span.replace(" @ ", "@"))),
        float(letters and "@" not in marks),
        float(before.isalnum() or after.isalnum()),
        float(before in tuple("+@.-_%") or after in tuple("@-_")),
        float(bool(re.search(r"[^\w\s][^\w\s]{2,}", span))),
    ]


WIDTH = len(features("0", "", ""))


class Region:
    """Tokens of a piece of text and all its candidate spans, as places between tokens."""

    def __init__(self, text: str):
        self.tokens = [m.span() for m in TOKEN.finditer(text)]
        self.text = text
        good = [text[a].isalnum() for a, _ in self.tokens]
        starts, ends, rows = [], [], []
        for i, (a, _) in enumerate(self.tokens):
            if not good[i] and text[a] not in "+(":
                continue
            for j in range(i, min(i + LONGEST, len(self.tokens))):
                b = self.tokens[j][1]
                if text[self.tokens[j][0]] in "\n\r":
                    break
                if not good[j] or not TRIGGER.search(text, a, b):
                    continue
                starts.append(i)
                ends.append(j + 1)
                rows.append(features(text[a:b], text[a - 1 : a] if a else "", text[b : b + 1]))
        self.starts, self.ends = np.array(starts, int), np.array(ends, int)
        self.features = np.array(rows).reshape(-1, WIDTH)
        self.ending = [[] for _ in range(len(self.tokens) + 1)]
        for k, e in enumerate(ends):
            self.ending[e].append(k)

    def best(self, weights: np.ndarray, follows: np.ndarray) -> list[tuple[str, int, int]]:
        """The best labelling: spans (kind, start, end) in characters."""
        if not len(self.starts):
            return []
        scores = self.features @ weights.T
        n, labels = len(self.tokens), len(KINDS) + 1
        top = np.full((n + 1, labels), -np.inf)
        top[0, 0] = 0.0
        back = {}
        for e in range(1, n + 1):
            way = top[e - 1] + follows[:, 0]
            top[e, 0], back[e, 0] = way.max(), (e - 1, int(way.argmax()))
            for k in self.ending[e]:
                way = top[self.starts[k]][:, None] + follows[:, 1:] + scores[k]
                for kind in np.flatnonzero(way.max(axis=0) > top[e, 1:]):
                    top[e, kind + 1] = way[:, kind].max()
                    back[e, kind + 1] = (int(self.starts[k]), int(way[:, kind].argmax()))
        e, label, out = n, int(top[n].argmax()), []
        while e:
            a, before = back[e, label]
            if label:
                out.append((KINDS[label - 1], self.tokens[a][0], self.tokens[e - 1][1]))
            e, label = a, before
        return out[::-1]

    def gradient(self, weights, follows, gold: dict[tuple[int, int], int]):
        """Gold counts less expected ones, of span features and of label pairs."""
        scores = self.features @ weights.T
        n, labels = len(self.tokens), len(KINDS) + 1
        fore, aft = np.full((n + 1, labels), -np.inf), np.full((n + 1, labels), -np.inf)
        fore[0, 0], aft[n] = 0.0, 0.0
        total = np.logaddexp.reduce
        for e in range(1, n + 1):
            fore[e, 0] = total(fore[e - 1] + follows[:, 0])
            for k in self.ending[e]:
                fore[e, 1:] = np.logaddexp(fore[e, 1:], total(fore[self.starts[k]][:, None] + follows[:, 1:], axis=0) + scores[k])
        began = [[] for _ in range(n + 1)]
        for k, s in enumerate(self.starts):
            began[s].append(k)
        for e in range(n - 1, -1, -1):
            aft[e] = follows[:, 0] + aft[e + 1, 0]
            for k in began[e]:
                aft[e] = np.logaddexp(aft[e], total(follows[:, 1:] + scores[k] + aft[self.ends[k], 1:], axis=1))
        z = total(fore[n])
        pairs = np.zeros_like(follows)
        share = np.zeros(scores.shape)
        for e in range(1, n + 1):
            pairs[:, 0] -= np.exp(fore[e - 1] + follows[:, 0] + aft[e, 0] - z)
            for k in self.ending[e]:
                part = np.exp(fore[self.starts[k]][:, None] + follows[:, 1:] + scores[k] + aft[e, 1:] - z)
                pairs[:, 1:] -= part
                share[k] = part.sum(axis=0)
        own = np.zeros(scores.shape)
        place = {(s, e): k for k, (s, e) in enumerate(zip(self.starts.tolist(), self.ends.tolist(), strict=True))}
        e, before = 0, 0
        by_start = {s: (t, kind) for (s, t), kind in gold.items()}
        while e < n:
            t, label = e + 1, 0
            if e in by_start and (e, by_start[e][0]) in place:
                t, kind = by_start[e]
                own[place[e, t], kind], label = 1.0, kind + 1
            pairs[before, label] += 1
            e, before = t, label
        return (own - share).T @ self.features, pairs


def variation(kind: str, text: str, draw: random.Random) -> str:
    """Another way to write a span of the kind; the same span still."""
    pick = draw.random()
    if pick < 0.4:
        return text
    if kind == "email" and pick < 0.7:
        return text.replace("@", " @ ")
    if kind == "card":
        n = digits_of(text)
        return draw.choice((".", " ", "-", " - ")).join(n[k : k + 4] for k in range(0, len(n), 4))
    if kind == "phone":
        n = digits_of(text)[-10:]
        return draw.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} - {} - {}"]).format(n[:-7], n[-7:-4], n[-4:])
    return text


def example(text: str, draw: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A text with its base spans, some of them rewritten."""
    out, spans, done = "", [], 0
    for kind, a, b in sorted(base_spans(text), key=lambda s: (s[1], -s[2])):
        if a < done:
            continue
        out += text[done:a]
        new = variation(kind, text[a:b], draw)
        spans.append((kind, len(out), len(out) + len(new)))
        out += new
        done = b
    return out + text[done:], spans


def ordinary(draw: random.Random) -> str:
    """Numbers that are nobody's data: dates, times, sums, decimals, versions, lists, codes."""
    n = lambda size: "".join(draw.choice("0123456789") for _ in range(size))
    form = draw.choice(
        (
            lambda: f"20{n(2)}-{n(2)}-{n(2)} {n(2)}:{n(2)}:{n(2)}",
            lambda: f"{n(2)}.{n(2)}.{n(4)}",
            lambda: f"{n(2)}/{n(2)}/{n(4)} at {n(2)}:{n(2)}",
            lambda: f"${n(1)},{n(3)},{n(3)}.{n(2)}",
            lambda: " ".join(f"{n(draw.randint(1, 2))}.{n(draw.randint(1, 5))}" for _ in range(draw.randint(1, 5))),
            lambda: " ".join(n(draw.randint(1, 5)) for _ in range(draw.randint(1, 12))),
            lambda: f"{n(4)}-{n(4)}",
            lambda: f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}",
            lambda: f"{n(3)}.{n(1)}.{n(1)}.{n(1)} {n(1)}.{n(1)}.",
            lambda: f"{draw.randint(256, 999)}.{n(3)}.{n(3)}.{n(3)}",
            lambda: f"({n(1)}) {n(1)}-{n(1)} of ({n(2)})",
            lambda: n(draw.randint(5, 30)),
            lambda: f"{n(3)} ({n(4)}) {n(2)}",
            lambda: "a" * 60 + "@" + "b" * 60,
            lambda: f"@name{n(2)} and x@ y",
        )
    )
    return form()


class Field:
    """Fitted weights, and the spans they add."""

    def __init__(self):
        self.weights = np.zeros((len(KINDS), WIDTH))
        self.weights[:, 0] = -4.0
        self.follows = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def fit(self, texts: list[str]) -> "Field":
        draw = random.Random(7)
        examples = []
        # Without any text there is nothing to set ordinary numbers against.
        for text in texts + [ordinary(draw) for _ in range(len(texts))]:
            changed, spans = example(text, draw)
            # Regions are cut as for decoding, after the spans were rewritten.
            for low, high in surroundings(changed):
                region = Region(changed[low:high])
                if not len(region.starts):
                    continue
                first = {low + a: k for k, (a, _) in enumerate(region.tokens)}
                last = {low + b: k + 1 for k, (_, b) in enumerate(region.tokens)}
                gold = {(first[a], last[b]): KINDS.index(kind) for kind, a, b in spans if a in first and b in last}
                examples.append((region, gold))
        seen = [np.full_like(self.weights, 1e-3), np.full_like(self.follows, 1e-3)]
        for _ in range(ROUNDS):
            draw.shuffle(examples)
            for region, gold in examples:
                for value, move, past in zip(
                    (self.weights, self.follows), region.gradient(self.weights, self.follows, gold), seen, strict=True
                ):
                    past += move**2
                    value += 0.3 * move / np.sqrt(past)
        return self

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans of a text, base ones first found, by kind as listed, then start."""
        regions = surroundings(text)
        if not regions:
            return []
        found = base_spans(text)
        taken = sorted((a, b) for _, a, b in found)
        for low, high in regions:
            for kind, a, b in Region(text[low:high]).best(self.weights, self.follows):
                a, b = a + low, b + low
                if all(b <= s or e <= a for s, e in taken):
                    found.append((kind, a, b))
        return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPAN = "array<struct<kind: string, start: int, end: int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def fit(docs: DataFrame, id_column="doc_id", text_column="text", sample: int = SAMPLE) -> Field:
    """A field fitted on surroundings of digits and @ in a bounded sample of the texts."""
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = bounded_sample(rows.where(F.col("text").rlike("[0-9@]")), F.lit("all"), [F.col("id"), F.col("text")], sample)

    def make(texts):
        found = [[t[a:b] for a, b in surroundings(t) if b - a <= 2 * REACH] for t in texts.to_pylist()]
        return [pa.array(found, pa.list_(pa.string()))]

    # One surrounding for each shape (digits and letters alike), and only SHAPES of them.
    regions = extended(rows, "text", "regions array<string>", make, keep=[]).select(F.explode("regions").alias("region"))
    shape = F.regexp_replace(F.regexp_replace("region", r"\p{L}+", "a"), "[0-9]", "9")
    one = F.min_by("region", F.xxhash64("region")).alias("region")
    several = regions.groupBy(shape.alias("shape"), F.pmod(F.xxhash64("region"), F.lit(24))).agg(one)
    texts = several.orderBy(F.xxhash64("region"), "region").limit(SHAPES).toArrow().column("region").to_pylist()
    return Field().fit(texts)


def with_spans(docs: DataFrame, field: Field, text_column="text", keep=None) -> DataFrame:
    """The rows with base_spans and all_spans."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def make(texts):
        base, every = [], []
        for text in texts.to_pylist():
            text = text or ""
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base_spans(text)])
            every.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in sent.value.spans(text)])
        return [pa.array(base, SPAN_TYPE), pa.array(every, SPAN_TYPE)]

    return extended(docs, text_column, f"base_spans {SPAN}, all_spans {SPAN}", make, keep)


def listed(spans):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping ones as the first of them."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, field: Field, text_column="text") -> DataFrame:
    """The rows with all personal data in their texts replaced by its kind; a null text stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def make(texts):
        return [pa.array([None if t is None else masked(t, sent.value.spans(t)) for t in texts.to_pylist()], pa.string())]

    return extended(docs, text_column, f"`{text_column}` string", make).select(*(f"`{c}`" for c in docs.columns))
