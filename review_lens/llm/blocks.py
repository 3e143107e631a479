"""Words of many texts at once, on the bytes of an Arrow batch.

A byte table tells word bytes from separators, so only classes that are whole in
UTF-8 bytes fit: every byte from 0x80 on belongs to one side.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 19

_RANDOM = np.random.default_rng(20240229)
BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRAM_CODES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_table(keep):
    return np.array([bool(keep(b)) for b in range(256)])


#: Separators are the six ASCII white-space characters.
NOT_SPACE = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Digits, letters a-z (texts are lower-cased first) and all that is not ASCII.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, one offset more than texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, text: str, limit: int = PIECE_BYTES):
    """Slices of Arrow batches with about `limit` bytes of the column `text`; a longer text comes alone."""
    for batch in batches:
        column = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        place = np.concatenate(([0], np.cumsum(column, dtype=np.int64)))
        start = 0
        while start < len(column):
            end = max(start + 1, int(np.searchsorted(place, place[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


@dataclass
class Words:
    """Words of a block of texts: byte ranges in `data`, and the range of words of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    opens[first], closes[last] = inside[first], inside[last]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


_POWERS = {}


def powers(base: int, count: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < count:
        steps = np.full(max(count, PIECE_BYTES + 64), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if count <= PIECE_BYTES + 64:
            _POWERS[base] = have
    return have[:count]


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every block and process."""
    terms = BYTE_CODES[words.data] * powers(STEP, len(words.data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    totals = sums[words.ends] - sums[words.starts]
    back = powers(BACK, len(words.data) + 1)
    lengths = (words.ends - words.starts).astype(np.uint64)
    return mixed(totals * back[words.starts] + lengths)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n hashes; runs may cross texts, the caller leaves those out."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += hashes[k : k + count] * GRAM_CODES[k] if k < 64 else mixed(hashes[k : k + count] + np.uint64(k))
    return mixed(total)


def whole_grams(rows: np.ndarray, n: int) -> np.ndarray:
    """Places of the first words of runs of n words that lie within one text."""
    lengths = np.maximum(np.diff(rows) - n + 1, 0)
    if not lengths.sum():
        return np.zeros(0, np.int64)
    shift = np.repeat(rows[:-1] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(lengths.sum()) + shift
