"""Fast similarity sketching: min-hash sketches without empty bins.

Round ``i`` hashes every element of a set to one of ``bins`` bins and keeps the least hash
of each bin; values of an earlier round are smaller than those of a later one. After
``bins`` rounds, ``bins`` more give bin ``i`` to all elements, so that every bin fills
whatever the set's size. A set of many elements is done after two or three rounds, and
the share of equal bins estimates resemblance with the concentration of independent hashes.
"""

from __future__ import annotations

import numpy as np

from tablelift.llm.words import mix

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
_ROUND_BITS = 16


def _salt(i: int) -> np.uint64:
    return _U((0x2545F4914F6CDD1D * (i + 1)) & 0xFFFFFFFFFFFFFFFF)


def sketch_all(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` values for each set of 64-bit hashes; rows of empty sets stay empty."""
    if 2 * bins >= 1 << _ROUND_BITS:
        raise ValueError("too many bins")
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), bins), _EMPTY)
    rows = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(2 * bins):
        if not len(elements):
            break
        x = mix(elements ^ _salt(i))
        values = (_U(i) << _U(64 - _ROUND_BITS)) | (mix(x + _U(1)) >> _U(_ROUND_BITS))
        if i < bins:
            places = ((x >> _U(32)) * _U(bins)) >> _U(32)
            np.minimum.at(out.reshape(-1), rows * bins + places.astype(np.int64), values)
        else:
            np.minimum.at(out[:, i - bins], rows, values)
        left = (out == _EMPTY).any(axis=1)[rows]
        rows, elements = rows[left], elements[left]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each run of ``rows`` bins and its place, ``bands`` for each sketch."""
    values = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), values.shape[:2])
    for r in range(rows):
        keys = mix(keys ^ values[:, :, r])
    return keys
