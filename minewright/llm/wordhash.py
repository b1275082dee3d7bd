"""Words and word n-grams of a column of texts as 64-bit hashes, computed by numpy over the column's bytes.

A word is a maximal run of bytes other than the six ASCII white-space characters, which is what ``[^\\x20\\x09-\\x0D]+``
finds in the text. The hash of a word is a polynomial over random byte values, finished by a bit mixer; equal words have
equal hashes in every task and run. Texts are taken in pieces of ``PIECE_BYTES`` cut at white space, so memory does not
grow with a text beyond eight bytes a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _VALUES.copy()
_LOWER[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_powers: list[np.ndarray] = []


@dataclass
class Words:
    """Words of all texts in order; text ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective bit mixer on unsigned 64-bit integers."""
    x = values.copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        length = max(size, PIECE_BYTES + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(length, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def column_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return raw, (offsets - offsets[0] if len(texts) else np.zeros(1, np.int64))


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words of a string column; ``lower`` hashes A-Z like a-z."""
    data, offsets = column_bytes(texts)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = ~space
    first[1:] &= space[:-1] | edge[1:-1]
    last = ~space
    last[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    values = _LOWER if lower else _VALUES
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE_BYTES, "right")))
        low, high = starts[at], ends[to - 1]
        up, down = _power_tables(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], dtype=np.uint64, out=sums[1:])
        hashes[at:to] = (sums[ends[at:to] - low] - sums[starts[at:to] - low]) * down[starts[at:to] - low]
        at = to
    return Words(mix(hashes), starts, ends, bounds, data)


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; positions run over text ends, see ``inside``."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for step in range(1, size):
        out *= _U(_BASE)
        out += hashes[step : step + count]
    return mix(out)


def inside(bounds: np.ndarray, size: int, count: int) -> np.ndarray:
    """Which of the first ``count`` positions begin ``size`` words of one text."""
    ok = np.zeros(count + 1, np.int64)
    low, high = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - size + 1)
    keep = high > low
    np.add.at(ok, low[keep], 1)
    np.add.at(ok, high[keep], -1)
    return np.cumsum(ok[:-1]) > 0


def text_of_position(bounds: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the text that a word position belongs to."""
    return np.searchsorted(bounds, positions, "right") - 1


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each text, ascending, and the bounds of the texts.

    A text of fewer words has its whole sequence as the only shingle; one without words has none.
    """
    counts = np.diff(words.bounds)
    grams = ngrams(words.hashes, size)
    spots = np.flatnonzero(inside(words.bounds, size, len(grams)))
    texts, values = text_of_position(words.bounds, spots), grams[spots]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [ngrams(words.hashes[words.bounds[i] : words.bounds[i + 1]], int(counts[i]))[0] ^ _U(counts[i]) for i in short]
        texts, values = np.concatenate([texts, short]), np.concatenate([values, np.array(whole, np.uint64)])
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return values[fresh], np.searchsorted(texts[fresh], np.arange(len(counts) + 1))
