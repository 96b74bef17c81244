"""Words, shingles and their hashes for many texts at once, as numpy arrays.

Words are maximal runs of bytes other than white space (0x20, 0x09 to 0x0D), with A to Z
lower-cased. UTF-8 keeps those bytes out of longer characters, so texts are read as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
# Bytes of text worked on together; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20

_U = np.uint64
# The bytes of words, and of words of letters alone (all of a longer character counts as one).
WORD_BYTES = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LETTER_BYTES = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
CAPITAL_BYTES = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
# The numbers bytes are hashed by: as they are, and with A to Z in lower case.
EXACT_BYTES = _LETTER.copy()
_LETTER[65:91] = _LETTER[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = [_U(pow(0xD1342543DE82EF95, k, 1 << 64)) for k in range(1, 10)]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of a number modulo 2**64, computed as far as any text needed them."""

    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            steps = np.full(max(n, CHUNK_BYTES + 1), _U(self.base))
            steps[0] = 1
            self.known = np.multiply.accumulate(steps)
        return self.known[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_INVERSE)


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into the bytes) of runs of rows; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(first + 1, min(last, len(texts)))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(
    data: np.ndarray, offsets: np.ndarray, members: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, number of words before each row and in all); ``members``: bytes of words."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = members[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[:-1] & (cut[:-1] | ~np.concatenate(([False], inside[:-2]))))
    ends = np.flatnonzero(inside[:-1] & (cut[1:] | ~inside[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray = _LETTER
) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial, read off running sums, then mixed."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * _POWERS.upto(len(data)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _INVERSES.upto(len(data) + 1)[starts]
    return mix(words + (ends - starts).astype(np.uint64) * _STEPS[8])


def shingle_hashes(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of five words within a row, number of shingles before each row).

    A row of one to four words has one shingle, all of them.
    """
    counts = np.diff(before)
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(many)))
    out = np.empty(bounds[-1], np.uint64)
    if len(words) >= SHINGLE:
        n = len(words) - SHINGLE + 1
        runs = words[:n] * _STEPS[0]
        for k in range(1, SHINGLE):
            runs += words[k : k + n] * _STEPS[k]
        runs = mix(runs)
        for row in np.flatnonzero(counts >= SHINGLE):
            out[bounds[row] : bounds[row + 1]] = runs[before[row] : before[row] + many[row]]
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        short = words[before[row] : before[row + 1]]
        with np.errstate(over="ignore"):
            total = _U(counts[row]) * _STEPS[7]
            for k, word in enumerate(short):
                total = total + word * _STEPS[k]
        out[bounds[row]] = mix(np.array([total]))[0]
    return out, bounds


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) of runs of rows."""
    for first, data, offsets in text_chunks(texts):
        starts, ends, before = word_spans(data, offsets)
        hashes, bounds = shingle_hashes(word_hashes(data, starts, ends), before)
        yield first, [distinct(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The sorted set of hashes."""
    hashes = np.sort(hashes)
    new = np.empty(len(hashes), bool)
    new[:1] = True
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]
