"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A public model is compiled into one machine: the normaliser's arcs (a space before the
text, spaces to the vocabulary's space mark), an arc for each piece, arcs from
characters outside the vocabulary to their byte pieces, and a weight for each pair of
pieces in a row. An input is composed with it lazily, so only arcs that read the input
are made; its encoding is the shortest path, with weights added along a path and the
least taken over paths.

In a unigram model pieces weigh minus their scores and pairs nothing. In a byte-pair
model pieces weigh nothing, and a pair weighs nothing if merging leaves it apart, else
infinity: a cut of a text is the byte-pair encoding just when every pair in it is left
apart, and for each start of the text there is one such cut. So at each place one state
with a finite weight is left, and the path is what merging by rank gives.

No piece reads over the beginning of a run of spaces, so texts are worked off run by
run; encodings of frequent runs are kept.

Defined results: a null text has null ids and decodes to null, an empty one has none.
The space mark in a text is read as a space. Decoding leaves out the space that
encoding put first, ids outside the vocabulary and control pieces; bytes that are no
UTF-8 become U+FFFD. All rows and columns stay.
"""

import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from review_lens.llm.common import extended
from review_lens.llm.language import vocabulary_path

INFINITE = float("inf")
MARK = "▁"
#: Encodings and pair weights that a Python worker keeps.
KEPT_RUNS = 500_000
KEPT_PAIRS = 600_000
LONGEST_KEPT = 48
LETTER = r"[^\W\d_]"
MARKS = r"[!-@\[-`{-~]"
BESIDE = re.compile(f"{LETTER}(?={MARKS})|{MARKS}(?={LETTER})")


class Machine:
    """A compiled model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        if spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models whose normaliser keeps characters and spaces can be compiled")
        self.prefix = " " if spec.normalizer_spec.add_dummy_prefix else ""
        kinds = proto.ModelProto.SentencePiece
        self.merging = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        self.ids, self.byte_ids, self.scores, self.outputs = {}, {}, {}, []
        self.unknown = 0
        for k, piece in enumerate(spec.pieces):
            text = piece.piece.replace(MARK, " ")
            out = b""
            if piece.type == kinds.BYTE:
                out = bytes([int(piece.piece[3:5], 16)])
                self.byte_ids[out[0]] = k
            elif piece.type == kinds.UNKNOWN:
                self.unknown = k
            elif piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.ids[text], self.scores[text] = k, piece.score
                out = text.encode()
            self.outputs.append(out)
        self.texts = {k: text for text, k in self.ids.items()}
        if any(" " in text.lstrip(" ") for text in self.ids):
            raise ValueError("a piece reads over a space inside it")
        least = min(self.scores.values(), default=0.0)
        self.weights = {k: 0.0 if self.merging else -self.scores[text] for text, k in self.ids.items()}
        self.byte_weight = 0.0 if self.merging else 10.0 - least
        self.parts = {}
        if self.merging:
            for text in list(self.ids):
                *_, before, last = [None, *self.merges(text)]
                if len(last) > 1:
                    # Merging never makes this piece, so no path may use it.
                    self.ids.pop(text)
                elif before:
                    self.parts[text] = before
        self.longest = {}
        for text in self.ids:
            self.longest[text[-1]] = max(len(text), self.longest.get(text[-1], 0))
        # A line end outside the vocabulary stands alone on every path, and between an
        # ASCII mark and a letter that no piece holds side by side, every path has an end.
        breaks = "" if any("\n" in t for t in self.ids) else r"\n"
        runs = [breaks] * bool(breaks)
        mixed = {c for t in self.ids if BESIDE.search(t) for c in t if re.match(LETTER, c)}
        if not any(c.isascii() for c in mixed):
            end, letter = rf"[ {breaks}]|\Z", LETTER[:-1] + "".join(sorted(mixed)) + "]"
            runs += [f" *+{letter}++(?={MARKS}|{end})", f" *+{MARKS}++(?={letter}|{end})"]
        self.runs = re.compile("|".join([*runs, f" +[^ {breaks}]*", f"[^ {breaks}]+"]))
        self.clear()

    def clear(self):
        self.kept, self.kept_before, self.pairs = {}, {}, {}
        self.spine = cache(self._spine)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("kept", "kept_before", "pairs", "spine")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.clear()

    def merges(self, text: str) -> list[list[str]]:
        """The symbols of a text before each merge and at last: best score first, then leftmost."""
        symbols, out = list(text), []
        while True:
            out.append(symbols)
            options = [
                (-self.scores[a + b], k)
                for k, (a, b) in enumerate(zip(symbols[:-1], symbols[1:], strict=True))
                if a + b in self.scores
            ]
            if not options:
                return out
            k = min(options)[1]
            symbols = symbols[:k] + [symbols[k] + symbols[k + 1]] + symbols[k + 2 :]

    def _spine(self, text: str, last: bool) -> list[tuple[str, float]]:
        """What stands at a piece's edge as merging builds it up, and when each is taken up."""
        out, until = [], INFINITE
        while True:
            out.append((text, until))
            if text not in self.parts:
                return out[::-1]
            until = -self.scores[text]
            text = self.parts[text][-1 if last else 0]

    def pair_weight(self, left: int, right: int) -> float:
        """0 if merging leaves the two pieces apart, else infinity."""
        if not self.merging:
            return 0.0
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = 0.0 if self.apart(self.texts[left], self.texts[right]) else INFINITE
        return known

    def apart(self, left: str, right: str) -> bool:
        if left.isspace() and right[0] == " ":
            # Runs of spaces share one score, so their order of merging is played through.
            return self.merges(left + right)[-1] == [left, right]
        one, two = self.spine(left, True), self.spine(right, False)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = one[i], two[j]
            joined = self.scores.get(a + b)
            when = INFINITE if joined is None else -joined
            if when < a_until and when <= b_until and when < INFINITE:
                return False
            if a_until == b_until == INFINITE:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def path(self, run: str) -> list[int]:
        """Output of the shortest path that reads the run."""
        ids, weights, longest = self.ids, self.weights, self.longest
        n = len(run)
        cost = [0.0] + [INFINITE] * n
        last = [-1] * (n + 1)
        back = [0] * (n + 1)
        for end in range(1, n + 1):
            best = INFINITE
            for start in range(end - 1, max(-1, end - longest.get(run[end - 1], 0) - 1), -1):
                piece = ids.get(run[start:end])
                if piece is None or cost[start] == INFINITE:
                    continue
                weight = cost[start] + weights[piece]
                if weight < best:
                    if last[start] >= 0:
                        weight += self.pair_weight(last[start], piece)
                    if weight < best:
                        best, last[end], back[end] = weight, piece, start
                        if self.merging:
                            break
            if run[end - 1] not in self.scores and cost[end - 1] + self.byte_weight < best:
                best, last[end], back[end] = cost[end - 1] + self.byte_weight, -2, end - 1
            cost[end] = best
        out, end = [], n
        while end:
            if last[end] >= 0:
                out.append(last[end])
            else:
                tail = run[end - 1].encode("utf-8", "surrogatepass")
                out += [self.byte_ids.get(b, self.unknown) for b in reversed(tail)]
            end = back[end]
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a text, as 32-bit numbers."""
        if not text:
            return b""
        kept, out = self.kept, []
        for run in self.runs.findall((self.prefix + text).replace(MARK, " ")):
            ids = kept.get(run)
            if ids is None:
                ids = self.remembered(run)
                kept = self.kept
            out.append(ids)
        return b"".join(out)

    def remembered(self, run: str) -> bytes:
        """A run's ids, kept while it is among those last asked for."""
        ids = self.kept_before.get(run)
        if ids is None:
            ids = array("i", self.path(run)).tobytes()
        if len(self.kept) >= KEPT_RUNS:
            self.kept, self.kept_before = {}, self.kept
        if len(run) <= LONGEST_KEPT:
            self.kept[run] = ids
        return ids

    def decode(self, ids) -> str:
        outputs, size = self.outputs, len(self.outputs)
        data = b"".join([outputs[k] for k in ids if 0 <= k < size])
        if self.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


def compiled(path: str | None = None) -> Machine:
    with open(path or vocabulary_path(), "rb") as model:
        return Machine(model.read())


def ids_array(encoded: list[bytes | None]) -> pa.Array:
    sizes = np.array([0 if e is None else len(e) // 4 for e in encoded], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(e or b"" for e in encoded), np.int32))
    none = pa.array([e is None for e in encoded], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=none)


def encoded(docs: DataFrame, path: str | None = None, text_column="text", keep=None) -> DataFrame:
    """The rows with ids, and with round_trip: whether the ids decode to the normalised text."""
    sent = docs.sparkSession.sparkContext.broadcast(compiled(path))

    def make(texts):
        machine, found, trips = sent.value, [], []
        for text in texts.to_pylist():
            ids = None if text is None else machine.encode(text)
            found.append(ids)
            trips.append(ids is None or machine.decode(np.frombuffer(ids, np.int32).tolist()) == text.replace(MARK, " "))
        return [ids_array(found), pa.array(trips, pa.bool_())]

    return extended(docs, text_column, "ids array<int>, round_trip boolean", make, keep)
