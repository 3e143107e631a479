"""Token counts of whole texts under a public tokenizer: lengths only leave a task.

Texts are cut only where the tokenizer cuts itself: for a byte-level vocabulary without
normaliser, between a visible character and white space, and in long runs without any also between a
letter and a digit, and between an old CJK letter and CJK punctuation. So the sum of a text's
parts is always its count, parts that occur again are encoded once, and no batch grows with
the longest text. The library gets the distinct parts in batches of about equal bytes. What has
no such place stays whole, as do all texts under other vocabularies.

Defined results: a null text is an empty one, with 0 bytes and 0 tokens. Strings of special tokens
inside texts count as the library's default has it. Repeated rows are counted one by one; an empty table gives no
rows. Columns named like a result are replaced, others are kept.
"""

import functools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from review_lens.llm import blocks
from review_lens.llm.common import extended

#: The default vocabulary, by its name among the public ones.
VOCABULARY = "byte_bpe_50k.json"
#: Characters of a part of a run without white space, about, and bytes of a batch for the library.
PART = 1 << 15
BATCH = 1 << 17
#: Parts of up to so many bytes are remembered by a worker, so many of them at most; then it starts anew.
SHORT, REMEMBERED = 64, 1 << 18

#: Places where a byte-level pattern always ends a piece, whatever stands around them. Fixed
#: classes, of letters assigned for long, so that no version of Unicode reads them otherwise.
SAFE = regex.compile(
    r"(?<=[!-~一-龥ぁ-ゖァ-ヺ])(?=[ \t\r\n])"
    r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[一-龥ぁ-ゖァ-ヺ])(?=[、。，！？；：])"
)


def parts_of(text: str, size: int = PART) -> list[str]:
    """The text cut at the first safe place after every `size` characters."""
    parts, start = [], 0
    while len(text) - start > size:
        place = SAFE.search(text, start + size)
        if place is None:
            break
        parts.append(text[start : place.start()])
        start = place.start()
    parts.append(text[start:])
    return parts


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin: at each text, and at white space after a visible character, which is
    an ASCII one or has a lead byte of C3-DF or E4-E9 (none of those is white space)."""
    space = (data == 0x20) | (data == 0x09) | (data == 0x0A) | (data == 0x0D)
    seen = np.zeros(len(data) + 1, bool)
    seen[1:] = (data > 0x20) & (data < 0x7F)
    tail = data >= 0x80
    seen[2:] |= tail[1:] & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    seen[3:] |= tail[2:] & (data[:-2] >= 0xE4) & (data[:-2] <= 0xE9)
    begins = space & seen[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def balanced(sizes: list[int], limit: int = BATCH) -> list[tuple[int, int]]:
    """Ranges of neighbours of about equal bytes, none over `limit` by more than one of them."""
    place = np.concatenate(([0], np.cumsum(sizes)))
    count = max(1, -(-int(place[-1]) // limit))
    cuts = np.searchsorted(place, place[-1] * np.arange(1, count) / count)
    edges = sorted({0, len(sizes), *(int(c) for c in cuts)})
    return list(zip(edges[:-1], edges[1:], strict=True))


class Counter:
    """A vocabulary with the lengths of its encodings; made in each Python worker once."""

    def __init__(self, path: str):
        # A task has one core: the library's own threads would only take those of others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.known: dict[bytes, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cut = False
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        before = said.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        bound = any(t["lstrip"] or t["rstrip"] or t["single_word"] or SAFE.search(t["content"]) for t in said["added_tokens"])
        self.cut = bool(plain and not bound and not said.get("normalizer"))
        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.lengths = lambda texts: [len(e) for e in model.encode_batch(texts, add_special_tokens=False)]

    def encoded(self, parts: list[bytes]) -> dict[bytes, int]:
        """The lengths of distinct parts, by batches of about equal bytes."""
        pieces, owners = [], []
        for part in parts:
            text = part.decode()
            cut = parts_of(text) if self.cut else [text]
            pieces += cut
            owners += [part] * len(cut)
        found = dict.fromkeys(parts, 0)
        for a, b in balanced([len(piece.encode()) for piece in pieces]):
            for owner, length in zip(owners[a:b], self.lengths(pieces[a:b]), strict=True):
                found[owner] += length
        return found

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        data, offsets = blocks.text_bytes(texts)
        begins = cuts(data, offsets) if self.cut else offsets[:-1][offsets[:-1] < offsets[1:]]
        raw = data.tobytes()
        ends = [*begins[1:].tolist(), len(raw)]
        parts = [raw[a:b] for a, b in zip(begins.tolist(), ends, strict=False)]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = self.encoded([part for part in dict.fromkeys(parts) if part not in self.known])
        lengths = np.array([self.known[p] if p in self.known else new[p] for p in parts], np.int64)
        self.known.update((part, length) for part, length in new.items() if len(part) <= SHORT)
        total = np.concatenate(([0], np.cumsum(lengths)))
        return total[np.searchsorted(begins, offsets[1:])] - total[np.searchsorted(begins, offsets[:-1])]


@functools.cache
def counter(path: str | None) -> Counter:
    import public_tokenizers

    return Counter(path or public_tokenizers.path(VOCABULARY))


def token_counts(docs: DataFrame, limit: int = 512, path: str | None = None, text_column="text", keep=None) -> DataFrame:
    """The rows with n_bytes, n_tokens, and over_limit: whether they have more than `limit` tokens.

    `path` names the vocabulary file, one for each executor to open: .json or .model; by
    default a public one.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        texts = pc.fill_null(texts, "")
        tokens = counter(path).counts(texts)
        sizes = pc.binary_length(texts).cast(pa.int64())
        return [sizes, pa.array(tokens), pa.array(tokens > limit)]

    return extended(docs, text_column, "n_bytes bigint, n_tokens bigint, over_limit boolean", make, keep)
