"""Metric trees of the anchors hierarchy over integer points, and owners of their balls.

A tree is built middle-out. Anchors are placed one by one, each on the point that is
farthest from its own anchor, and take the points that are nearer to them; a point at most
half as far from its anchor as the new one is from that anchor cannot change hands and is
not looked at. About the square root of n anchors are the middle of the tree: each is built
on in the same way downwards, and upwards the two balls whose union is smallest are joined
until one is left. Every ball caches the number and the sum of its points.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

# A ball of so many points or fewer is not split.
LEAF = 48
# Distances are computed in floating point, and widened by this share before they decide.
ROUNDING = 1e-9


@dataclass
class Forest:
    """Trees over the parts of one set of vectors; ``points`` are in the order of the balls.

    Ball i holds the ``counts[i]`` points from ``starts[i]`` on, which add up to ``sums[i]``
    and lie within ``radii[i]`` of their mean. A leaf has -1 for its ``children``.
    """

    points: np.ndarray  # (parts * n, d)
    order: np.ndarray  # (parts * n), the row of each point
    counts: np.ndarray
    sums: np.ndarray  # (balls, d)
    radii: np.ndarray
    children: np.ndarray  # (balls, 2)
    starts: np.ndarray
    roots: np.ndarray  # (parts)

    KINDS = dict(points="<i4", order="<i4", counts="<i8", sums="<i8", radii="<f8", children="<i4", starts="<i8", roots="<i4")

    def packed(self) -> dict[str, bytes]:
        return {f.name: np.ascontiguousarray(getattr(self, f.name), self.KINDS[f.name]).tobytes() for f in fields(self)}

    @classmethod
    def unpacked(cls, columns: dict[str, bytes], width: int) -> Forest:
        """From packed columns; those that are missing are left empty."""
        found = {f.name: np.frombuffer(columns.get(f.name, b""), cls.KINDS[f.name]) for f in fields(cls)}
        for name, shape in (("points", (-1, width)), ("sums", (-1, width)), ("children", (-1, 2))):
            found[name] = found[name].reshape(shape)
        found["points"] = found["points"].astype(np.int64)
        return cls(**found)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor of each point, of ``wanted`` anchors or as many as there are distinct points."""
    owner = np.zeros(len(points), np.int64)
    away = _lengths(points - points[0])
    pivots = [0]
    while len(pivots) < wanted:
        new = int(np.argmax(away))
        if away[new] == 0:
            break
        apart = _lengths(points[pivots] - points[new])
        open_ = np.flatnonzero(away > apart[owner] * (0.5 - ROUNDING))
        there = _lengths(points[open_] - points[new])
        nearer = there < away[open_]
        owner[open_[nearer]] = len(pivots)
        away[open_[nearer]] = there[nearer]
        pivots.append(new)
    return owner


class _Builder:
    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points, leaf
        self.exact = points.astype(np.int64)
        self.counts: list[int] = []
        self.sums: list[np.ndarray] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int]] = []
        self.rows: list[np.ndarray | None] = []

    def _ball(self, count, total, centre, radius, children, rows) -> int:
        for kept, value in zip(
            (self.counts, self.sums, self.centres, self.radii, self.children, self.rows),
            (count, total, centre, radius, children, rows),
        ):
            kept.append(value)
        return len(self.counts) - 1

    def _leaf(self, rows: np.ndarray) -> int:
        total = self.exact[rows].sum(axis=0)
        centre = total / len(rows)
        radius = float(_lengths(self.points[rows] - centre).max())
        return self._ball(len(rows), total, centre, radius, (-1, -1), rows)

    def _joined(self, a: int, b: int) -> int:
        count, total = self.counts[a] + self.counts[b], self.sums[a] + self.sums[b]
        centre = total / count
        radius = max(float(np.sqrt(((centre - self.centres[x]) ** 2).sum())) + self.radii[x] for x in (a, b))
        return self._ball(count, total, centre, radius, (a, b), None)

    def build(self, rows: np.ndarray) -> int:
        if len(rows) <= self.leaf:
            return self._leaf(rows)
        owner = anchors(self.points[rows], int(np.ceil(np.sqrt(len(rows)))))
        order = np.argsort(owner, kind="stable")
        groups = np.split(rows[order], np.flatnonzero(np.diff(owner[order])) + 1)
        if len(groups) == 1:
            return self._leaf(rows)
        return self._united([self.build(group) for group in groups])

    def _united(self, balls: list[int]) -> int:
        centres = np.array([self.centres[b] for b in balls])
        radii = np.array([self.radii[b] for b in balls])
        balls = np.array(balls)
        # The radius of the smallest ball around two: upper triangle and lower alike.
        apart = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(axis=2), 0))
        size = np.maximum((apart + radii[:, None] + radii[None]) / 2, np.maximum(radii[:, None], radii[None]))
        np.fill_diagonal(size, np.inf)
        for _ in range(len(balls) - 1):
            a, b = divmod(int(np.argmin(size)), len(balls))
            balls[a] = self._joined(int(balls[a]), int(balls[b]))
            centres[a], radii[a] = self.centres[balls[a]], self.radii[balls[a]]
            gone = np.isinf(size[a])
            apart = _lengths(centres - centres[a])
            row = np.maximum((apart + radii + radii[a]) / 2, np.maximum(radii, radii[a]))
            row[gone] = np.inf
            size[a], size[:, a] = row, row
            size[b], size[:, b] = np.inf, np.inf
        return int(balls[a])


def build_forest(parts: np.ndarray, leaf: int = LEAF) -> Forest:
    """One tree for each of ``parts``, an array of (parts, points, components) of integers."""
    held: dict[str, list] = {f.name: [] for f in fields(Forest)}
    balls = 0
    for k, part in enumerate(parts):
        builder = _Builder(part.astype(np.float64), leaf)
        root = builder.build(np.arange(len(part)))
        starts = np.zeros(len(builder.counts), np.int64)
        order, stack = [], [(root, k * len(part))]
        while stack:
            ball, start = stack.pop()
            starts[ball] = start
            left, right = builder.children[ball]
            if left < 0:
                order.append(builder.rows[ball])
            else:
                stack += [(right, start + builder.counts[left]), (left, start)]
        order = np.concatenate(order)
        children = np.array(builder.children)
        held["points"].append(part[order])
        held["order"].append(order)
        held["counts"].append(np.array(builder.counts))
        held["sums"].append(np.array(builder.sums))
        held["radii"].append(np.array(builder.radii))
        held["children"].append(np.where(children < 0, -1, children + balls))
        held["starts"].append(starts)
        held["roots"].append(np.array([root + balls]))
        balls += len(starts)
    return Forest(**{name: np.concatenate(values) for name, values in held.items()})


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one span after the other."""
    bounds = np.cumsum(sizes)
    return np.arange(bounds[-1] if len(bounds) else 0) + np.repeat(starts - bounds + sizes, sizes)


class Owners:
    """Which entry of its part's codebook is nearest to each point, ties to the lower index.

    ``entries`` is (parts, entries, components). Candidates go from a ball to its children.
    One is struck off where another is nearer to every point of the ball: where the ball
    lies on the other's side of the plane between the two. A ball with one candidate left is
    owned, with all of its points; in a leaf that is not, points are compared with the
    candidates left, in integers.
    """

    def __init__(self, forest: Forest, entries: np.ndarray):
        self.forest, self.entries = forest, entries
        parts, k, _ = entries.shape
        centres = forest.sums / forest.counts[:, None]
        between = np.sqrt(((entries[:, :, None] - entries[:, None]).astype(float) ** 2).sum(axis=3))
        # Of equal entries only the first can own a point.
        allowed = np.array([[not (entry == book[:j]).all(axis=1).any() for j, entry in enumerate(book)] for book in entries])
        balls, part, left = forest.roots.astype(np.int64), np.arange(parts), allowed.reshape(parts, k)
        owned, leaves = [], []
        while len(balls):
            apart = ((centres[balls, None] - entries[part]) ** 2).sum(axis=2)
            apart[~left] = np.inf
            best = apart.argmin(axis=1)
            nearest = apart.min(axis=1, keepdims=True)
            radius = forest.radii[balls, None]
            slack = ROUNDING * (apart + nearest + radius**2 + 1)
            left = left & ~(apart - nearest > 2 * radius * between[part, best] * (1 + ROUNDING) + slack)
            alone = left.sum(axis=1) == 1
            owned.append((balls[alone], part[alone], best[alone]))
            balls, part, left = balls[~alone], part[~alone], left[~alone]
            end = forest.children[balls, 0] < 0
            leaves.append((balls[end], part[end], left[end]))
            balls, part, left = (np.repeat(x[~end], 2, axis=0) for x in (balls, part, left))
            balls = forest.children[balls[::2]].reshape(-1).astype(np.int64)
        self.balls, self.ball_part, self.ball_entry = (np.concatenate(x) for x in zip(*owned)) if owned else (np.zeros(0, int),) * 3
        ends, end_part, end_left = (np.concatenate(x) for x in zip(*leaves)) if leaves else (np.zeros(0, int),) * 3
        sizes = forest.counts[ends]
        self.single = spans(forest.starts[ends], sizes)
        self.single_part = np.repeat(end_part, sizes)
        candidates = np.repeat(end_left, sizes, axis=0).reshape(-1, k)
        best = np.full(len(self.single), np.iinfo(np.int64).max)
        self.single_entry = np.zeros(len(self.single), np.int64)
        for j in range(k):
            here = np.flatnonzero(candidates[:, j])
            off = forest.points[self.single[here]] - entries[self.single_part[here], j]
            found = np.einsum("ij,ij->i", off, off)
            nearer = found < best[here]
            best[here[nearer]] = found[nearer]
            self.single_entry[here[nearer]] = j

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """(number, sum) of the points of each entry, as (parts, entries) and (parts, entries, components)."""
        parts, k, d = self.entries.shape
        counts, sums = np.zeros(parts * k, np.int64), np.zeros((parts * k, d), np.int64)
        slot = self.ball_part * k + self.ball_entry
        np.add.at(counts, slot, self.forest.counts[self.balls])
        np.add.at(sums, slot, self.forest.sums[self.balls])
        slot = self.single_part * k + self.single_entry
        counts += np.bincount(slot, minlength=parts * k)
        order = np.argsort(slot, kind="stable")
        firsts = np.flatnonzero(np.diff(slot[order], prepend=-1))
        if len(firsts):
            sums[slot[order[firsts]]] += np.add.reduceat(self.forest.points[self.single[order]], firsts, axis=0)
        return counts.reshape(parts, k), sums.reshape(parts, k, d)

    def assigned(self) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance to it) of each row in each part, both (rows, parts)."""
        forest, parts = self.forest, len(self.entries)
        entry = np.zeros(len(forest.points), np.int64)
        sizes = forest.counts[self.balls]
        entry[spans(forest.starts[self.balls], sizes)] = np.repeat(self.ball_entry, sizes)
        entry[self.single] = self.single_entry
        rows = len(forest.points) // parts
        part = np.repeat(np.arange(parts), rows)
        off = forest.points - self.entries[part, entry]
        error = np.einsum("ij,ij->i", off, off)
        out = np.zeros((2, rows, parts), np.int64)
        out[0][forest.order, part], out[1][forest.order, part] = entry, error
        return out[0], out[1]
