"""Segmentation lattices of words under a unigram vocabulary.

The probability of a word is the sum over all ways to cut it into pieces, each way's the
product of its pieces'. Words of one length are worked on together: for each piece length
all places are looked up at once, then the recursion takes one step per character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tablelift.llm.words import mix

SPACE = "▁"
# Characters of words worked on together.
BATCH_CHARS = 150_000
_U = np.uint64
_BASE, _MASK = 0xD6E8FEB86659FD93, (1 << 64) - 1
_SLOT_BITS = 20


class Vocabulary:
    """Pieces by their text, and the pieces of single bytes for characters that have none."""

    def __init__(self, pieces: list[str], bytes_: list[int], end: int):
        """``pieces`` in the order of their ids, '' where an id is no text; ``bytes_``: 256 ids."""
        self.size, self.bytes, self.end = len(pieces), bytes_, end
        keys, ids = [], []
        for i, piece in enumerate(pieces):
            if piece:
                keys.append(self._key(piece))
                ids.append(i)
        self.keys = np.full(self.size + 1, _U(0))
        self.keys[ids] = np.array(keys, np.uint64)
        self.longest = max((len(p) for p in pieces), default=1)
        self.first = np.full(1 << _SLOT_BITS, self.size, np.int32)
        self.second = np.full(1 << _SLOT_BITS, self.size, np.int32)
        left = []
        for i in ids:
            key = int(self.keys[i])
            for table, slot in ((self.first, key >> (64 - _SLOT_BITS)), (self.second, key & ((1 << _SLOT_BITS) - 1))):
                if table[slot] == self.size:
                    table[slot] = i
                    break
            else:
                left.append(i)
        # Pieces whose two places are taken are searched for by their keys, in order.
        left.sort(key=lambda i: int(self.keys[i]))
        self.left = np.array(left, np.int32)
        self.units = np.array([ord(p) for p in pieces if len(p) == 1], np.int64)

    @staticmethod
    def _key(piece: str) -> int:
        total = 0
        for k, c in enumerate(piece):
            total += (ord(c) + 1) * pow(_BASE, k, 1 << 64)
        with np.errstate(over="ignore"):
            return int(mix(np.array([total & _MASK], np.uint64) + _U(len(piece)))[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The id of each key, ``size`` if there is no such piece."""
        found = self.first[(keys >> _U(64 - _SLOT_BITS)).astype(np.int64)]
        missed = self.keys[found] != keys
        if missed.any():
            other = self.second[(keys[missed] & _U((1 << _SLOT_BITS) - 1)).astype(np.int64)]
            found[missed] = np.where(self.keys[other] == keys[missed], other, self.size)
        if len(self.left):
            missed = np.flatnonzero(found == self.size)
            other = self.left[np.minimum(np.searchsorted(self.keys[self.left], keys[missed]), len(self.left) - 1)]
            found[missed] = np.where(self.keys[other] == keys[missed], other, self.size)
        return found


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, _U(base))
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def groups(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, characters) of words of one length, a leading space mark included."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    a = 0
    while a < len(order):
        n = int(lengths[order[a]])
        b = int(np.searchsorted(lengths[order], n, "right"))
        b = min(b, a + max(1, BATCH_CHARS // n))
        some = order[a:b]
        text = "".join(SPACE + words[i] for i in some)
        yield some, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), n)
        a = b


class Lattices:
    """The lattices of words of one length: the pieces that may stand at each place."""

    def __init__(self, vocabulary: Vocabulary, chars: np.ndarray):
        self.vocabulary, self.n = vocabulary, chars.shape[1]
        sums = np.zeros((len(chars), self.n + 1), np.uint64)
        np.cumsum((chars.astype(np.uint64) + _U(1)) * _powers(_BASE, self.n), axis=1, out=sums[:, 1:])
        inverse = _powers(pow(_BASE, -1, 1 << 64), self.n)
        self.ids: list[np.ndarray] = []
        for k in range(1, min(vocabulary.longest, self.n) + 1):
            keys = mix((sums[:, k:] - sums[:, :-k]) * inverse[: self.n - k + 1] + _U(k))
            self.ids.append(vocabulary.find(keys))
        # Characters without a piece are spelled in bytes.
        rows, places = np.nonzero(self.ids[0] == vocabulary.size)
        self.spelled = rows, places, chars[rows, places]

    def _spelling(self, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points, which = np.unique(self.spelled[2], return_inverse=True)
        spelled = [[self.vocabulary.bytes[b] for b in chr(p).encode("utf-8", "surrogatepass")] for p in points]
        return np.array([logs[s].sum() for s in spelled]), which, spelled

    def edges(self, logs: np.ndarray) -> list[np.ndarray]:
        """For each piece length, the log probability of the piece at each place."""
        padded = np.append(logs, -np.inf)
        out = [padded[ids] for ids in self.ids]
        rows, places, _ = self.spelled
        if len(rows):
            cost, which, _ = self._spelling(logs)
            out[0][rows, places] = cost[which]
        return out

    def forward(self, edges: list[np.ndarray]) -> np.ndarray:
        """Log of the summed probability of all segmentations up to each place."""
        alpha = np.full((self.n + 1, len(edges[0])), -np.inf)
        alpha[0] = 0
        for j in range(1, self.n + 1):
            for k in range(1, min(len(edges), j) + 1):
                np.logaddexp(alpha[j], alpha[j - k] + edges[k - 1][:, j - k], out=alpha[j])
        return alpha

    def expected(self, logs: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Adds how often each piece is expected in the words, times their counts."""
        edges = self.edges(logs)
        alpha = self.forward(edges)
        beta = np.full_like(alpha, -np.inf)
        beta[self.n] = 0
        for i in range(self.n - 1, -1, -1):
            for k in range(1, min(len(edges), self.n - i) + 1):
                np.logaddexp(beta[i], edges[k - 1][:, i] + beta[i + k], out=beta[i])
        total = alpha[self.n][:, None]
        rows, places, _ = self.spelled
        for k, (ids, edge) in enumerate(zip(self.ids, edges), 1):
            chance = np.exp(alpha.T[:, : self.n - k + 1] + edge + beta.T[:, k:] - total) * counts[:, None]
            into += np.bincount(ids.reshape(-1), chance.reshape(-1), len(into) + 1)[: len(into)]
            if k == 1 and len(rows):
                _, which, spelled = self._spelling(logs)
                weights = np.bincount(which, chance[rows, places], len(spelled))
                for weight, ids_of in zip(weights, spelled):
                    np.add.at(into, ids_of, weight)


def word_logs(vocabulary: Vocabulary, logs: np.ndarray, words: list[str]) -> np.ndarray:
    """The natural log of each word's probability over all its segmentations."""
    out = np.zeros(len(words))
    for places, chars in groups(words):
        lattices = Lattices(vocabulary, chars)
        out[places] = lattices.forward(lattices.edges(logs))[lattices.n]
    return out


def expected_pieces(vocabulary: Vocabulary, logs: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that occur ``counts`` times."""
    out = np.zeros(vocabulary.size)
    for places, chars in groups(words):
        Lattices(vocabulary, chars).expected(logs, counts[places], out)
    return out
