"""Linear-chain conditional random fields: forward-backward over many texts at once.

Texts are cut into segments of up to SEGMENT words, and all segments take their steps
together, so that a long text costs no more steps than a short one. A segment's product of
transfer matrices carries the messages from segment to segment, which keeps it exact.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1024


class Segments:
    """Where the segments of texts lie in the array of all words."""

    def __init__(self, before: np.ndarray, length: int = SEGMENT):
        counts = np.diff(before)
        per_text = -(-counts // length)
        self.text = np.repeat(np.arange(len(counts)), per_text)
        self.place = np.arange(len(self.text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.first = before[:-1][self.text] + self.place * length
        self.size = np.minimum(length, before[1:][self.text] - self.first)
        self.many = per_text[self.text] > 1
        self.opens = self.place == 0
        self.closes = self.place == per_text[self.text] - 1

    def steps(self, chosen: np.ndarray):
        """(t, segments that have a word t), longest first, so that each set is a prefix."""
        order = chosen[np.argsort(-self.size[chosen], kind="stable")]
        sizes = self.size[order]
        for t in range(int(sizes[0]) if len(sizes) else 0):
            yield t, order[: int(np.searchsorted(-sizes, -t, "left"))]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def forward_backward(
    scores: np.ndarray, before: np.ndarray, start: np.ndarray, move: np.ndarray, length: int = SEGMENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, local) messages of each word, each scaled.

    ``scores`` has a row of log scores for each word, ``start`` and ``move`` are log scores
    of first labels and of label pairs. forward * backward, scaled, are the marginals.
    """
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    s, a = np.exp(start - start.max()), np.exp(move - move.max())
    seg = Segments(before, length)
    n, labels = len(seg.text), len(start)
    into = np.tile(s, (n, 1))
    after = np.ones((n, labels))
    if seg.many.any():
        product = np.tile(np.eye(labels), (n, 1, 1))
        for t, now in seg.steps(np.flatnonzero(seg.many)):
            kept = seg.opens[now] if t == 0 else np.zeros(len(now), bool)
            stepped = np.where(kept[:, None, None], product[now], product[now] @ a)
            stepped = stepped * e[seg.first[now] + t][:, None, :]
            product[now] = stepped / np.maximum(stepped.sum(axis=(1, 2), keepdims=True), 1e-300)
        for place in range(1, int(seg.place.max()) + 1):
            now = np.flatnonzero(seg.place == place)
            into[now] = _scaled(np.einsum("ni,nij->nj", into[now - 1], product[now - 1]))
        for place in range(int(seg.place.max()) - 1, -1, -1):
            now = np.flatnonzero((seg.place == place) & ~seg.closes)
            after[now] = _scaled(np.einsum("nij,nj->ni", product[now + 1], after[now + 1]))
    forward = np.empty_like(e)
    state = into.copy()
    everything = np.arange(n)
    for t, now in seg.steps(everything):
        moved = state[now] @ a
        if t == 0:
            moved = np.where(seg.opens[now][:, None], into[now], moved)
        state[now] = forward[seg.first[now] + t] = _scaled(moved * e[seg.first[now] + t])
    backward = np.empty_like(e)
    state = after.copy()
    for t, now in reversed(list(seg.steps(everything))):
        place = seg.first[now] + t
        backward[place] = state[now]
        state[now] = _scaled((e[place] * state[now]) @ a.T)
    return forward, backward, e


def marginals(scores: np.ndarray, before: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The probability of each label at each word, given its whole text."""
    forward, backward, _ = forward_backward(scores, before, start, move)
    return _scaled(forward * backward)


def expectations(
    scores: np.ndarray, before: np.ndarray, start: np.ndarray, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals of words, expected first labels, expected label pairs)."""
    forward, backward, e = forward_backward(scores, before, start, move)
    single = _scaled(forward * backward)
    firsts = before[:-1][np.diff(before) > 0]
    later = np.setdiff1d(np.arange(len(scores)), firsts, assume_unique=True)
    pairs = forward[later - 1][:, :, None] * np.exp(move - move.max()) * (e[later] * backward[later])[:, None, :]
    pairs /= np.maximum(pairs.sum(axis=(1, 2), keepdims=True), 1e-300)
    return single, single[firsts].sum(axis=0), pairs.sum(axis=0)
