"""Words of whole Arrow text columns as 64-bit codes, without a Python loop over words.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D), so
non-ASCII letters stay inside words.  Codes are polynomial hashes over random byte
weights, finished with a mixer; equal words have equal codes, different words differ
but for a chance of about 2**-64.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Kinds of bytes: white space 0, the rest 1; with SPLIT, ASCII punctuation is a kind of its own.
WHOLE = np.ones(256, dtype=np.uint8)
WHOLE[[0x20, *range(0x09, 0x0E)]] = 0
SPLIT = WHOLE.copy()
SPLIT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 2
_PLAIN = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _PLAIN.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _PLAIN[ord("a") : ord("z") + 1]
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes taken at a time; the temporaries are about 40 times as large.
SLICE_BYTES = 1_500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer, so that every bit of a code is usable."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts: codes, byte bounds, and where each text's words begin."""

    data: np.ndarray
    text_at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, fold: bool = True, kinds: np.ndarray = WHOLE) -> Words:
    """Words of every text; ``fold`` lower-cases A-Z.

    ``kinds=SPLIT`` also cuts words into runs of punctuation and runs of anything else.
    """
    data, text_at = utf8(column)
    kind = kinds[data]
    inside = kind > 0
    begin, finish = inside.copy(), inside.copy()
    change = kind[1:] != kind[:-1]
    begin[1:] &= change
    finish[:-1] &= change
    at = text_at[(text_at < len(data)) & (text_at >= 0)]
    begin[at] = inside[at]
    at = text_at[text_at > 0] - 1
    finish[at] = inside[at]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    if len(starts):
        size = ends - starts
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
        power = np.full(int(size.max()), _BASE, dtype=np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        value = (_FOLDED if fold else _PLAIN)[data[inside]] * power[place]
        codes = mix(np.add.reduceat(value, first) + size.astype(np.uint64))
    else:
        codes = np.zeros(0, dtype=np.uint64)
    return Words(data, text_at, starts, ends, codes, np.searchsorted(starts, text_at))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` text bytes each; no text is cut."""
    if not batch.num_rows:
        return
    _, at = utf8(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of each ``size``-word window and the number of its first word."""
    n = len(words.codes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    # windows of 1, 2, 4 and more words; those of the bits of the size are put together
    code, done, part, length, power = np.zeros(n, dtype=np.uint64), 0, words.codes, 1, _BASE
    while True:
        if size & length:
            code = code * power + part[done : done + n]
            done += length
        if done == size:
            break
        part = part[:-length] * power + part[length:]
        length, power = 2 * length, np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
    owner = words.owner()
    kept = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(code[kept]), kept


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle codes of each text, and where each text's begin.

    A text with fewer words than ``size`` has its whole sequence as the one shingle; a
    text without words has none.
    """
    code, at = windows(words, size)
    counts = np.diff(words.first)
    per_text = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    per_text[short] = 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    out = np.empty(first[-1], dtype=np.uint64)
    long = np.ones(len(out), dtype=bool)
    long[first[short]] = False
    out[long] = code
    for i in short:
        value = np.uint64(counts[i])
        for c in words.codes[words.first[i] : words.first[i + 1]]:
            value = np.uint64((int(value) * int(_BASE) + int(c)) & 0xFFFFFFFFFFFFFFFF)
        out[first[i]] = mix(np.array([value ^ np.uint64(0x5851F42D4C957F2D)], dtype=np.uint64))[0]
    for low, high in zip(first[:-1], first[1:]):
        out[low:high].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[first[:-1][per_text > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[first]


def prefix_codes(words: Words, size: int) -> np.ndarray:
    """Codes of the first ``size`` bytes of each word, A-Z lower-cased."""
    code = np.zeros(len(words.starts), dtype=np.uint64)
    for j in range(size):
        at = words.starts + j
        byte = _FOLDED[words.data[np.minimum(at, words.ends - 1)]]
        code = code * _BASE + np.where(at < words.ends, byte, np.uint64(0))
    return mix(code)


def code_of(word: str) -> int:
    """Code of one word as :func:`words_of` gives it."""
    return int(words_of(pa.array([word])).codes[0])
