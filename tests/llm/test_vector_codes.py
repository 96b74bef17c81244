import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tablelift.llm.ball_trees import Forest, Owners, anchors, build_forest
from tablelift.llm.vector_codes import codebooks_sha256, vector_codes, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, parts=8, entries=16, rounds=6):
    """The contract, one vector at a time; the sums by label are left to the caller."""
    kept = [
        (i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
        if v and not any(x is None or not math.isfinite(x) for x in v) and len(v) % parts == 0
    ]
    lengths = Counter(len(v) for _, v, _ in kept)
    dims = max(lengths, key=lambda n: (lengths[n], n), default=0)
    kept = [(i, np.array(v).reshape(parts, -1), label) for i, v, label in kept if len(v) == dims]
    order = sorted(kept, key=lambda row: (row[0] is None, row[0] or 0, row[1].reshape(-1).tolist()))
    books = [[row[1][p] for row in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        found = [int(((x - c) ** 2).sum()) for c in books[p]]
        return min(range(len(found)), key=lambda j: (found[j], j))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            of = [[] for _ in books[p]]
            for _, v, _ in kept:
                of[nearest(p, v[p])].append(v[p])
            moved.append([np.floor_divide(sum(xs), len(xs)) if xs else c for xs, c in zip(of, books[p])])
        books = moved
    out = []
    for i, v, label in kept:
        index = [nearest(p, v[p]) for p in range(parts)]
        error = sum(int(((v[p] - books[p][j]) ** 2).sum()) for p, j in enumerate(index))
        out.append((i, label, "".join(f"{j:02x}" for j in index), error))
    text = ",".join(str(x) for book in books for c in book for x in c.tolist())
    return out, hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, **options):
    coded, books = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    wanted, digest = brute_force(rows, **options)
    found = coded.collect()
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in found), key=repr) == sorted(wanted, key=repr)
    assert codebooks_sha256(books) == digest
    by_label = Counter()
    for _, label, _, error in wanted:
        by_label[label] += error
    assert all(r.label_error == by_label[r.label] for r in found)
    return found


def drawn(rng, n, dims=16, spread=0.2):
    return [[float(np.float32(rng.gauss(0, spread))) for _ in range(dims)] for _ in range(n)]


def test_codes_match_brute_force(spark):
    rng = random.Random(1)
    check(spark, [(i * 3 % 401, v, rng.choice([None, 1, 2])) for i, v in enumerate(drawn(rng, 400))])


def test_ties_copies_and_few_values(spark):
    rng = random.Random(2)
    vectors = [[rng.choice([-0.5, 0.0, 0.25]) for _ in range(8)] for _ in range(300)]
    rows = [(i // 2, v, i % 3) for i, v in enumerate(vectors)] + [(500 + i, vectors[0], None) for i in range(200)]
    check(spark, rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    good = drawn(rng, 9)
    rows = [(i, v, None) for i, v in enumerate(good)]
    rows += [(None, good[0], 1), (None, None, 1), (20, None, 2), (21, [], 2), (22, [0.1] * 7, 2), (23, [0.1] * 8, 2)]
    rows += [(24, [math.nan] + good[0][1:], 3), (25, [math.inf] + good[0][1:], 3), (26, [None] + good[0][1:], 3)]
    rows += [(3, good[3], None), (3, good[4], 7)]
    assert len(check(spark, rows)) == 12


def test_no_rows(spark):
    for rows in ([], [(1, None, 2)]):
        coded, books = vector_codes(spark.createDataFrame(rows, SCHEMA))
        assert coded.collect() == [] and books.size == 0
        assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_other_sizes_and_clashing_columns(spark):
    rng = random.Random(4)
    rows = [(i, v, i % 2) for i, v in enumerate(drawn(rng, 60, 12))]
    check(spark, rows, parts=4, entries=3, rounds=2)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS code", "'x' AS dims", "'x' AS __label", "'x' AS n")
    assert vector_codes(df, parts=4, entries=3, rounds=2)[0].count() == 60


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 64 bits"):
        vector_codes(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_common_and_rare_labels_alike(spark):
    coded = spark.createDataFrame([(i, "code", i, 0 if i % 2 else i) for i in range(40_000)], "vec_id long, code string, error long, label int")
    found = {r.label: r.label_error for r in with_label_error(coded.select("vec_id", "label", "code", "error"), 40_000).collect()}
    assert found[0] == sum(i for i in range(40_000) if i % 2 or i == 0) and found[8] == 8 and len(found) == 20_000


def test_balls_hold_what_they_say():
    rng = np.random.default_rng(5)
    parts = rng.integers(-40, 40, (2, 700, 3))
    forest = build_forest(parts, leaf=10)
    forest = Forest.unpacked(forest.packed(), 3)
    for ball in range(len(forest.counts)):
        own = forest.points[forest.starts[ball] : forest.starts[ball] + forest.counts[ball]]
        assert (own.sum(axis=0) == forest.sums[ball]).all()
        assert np.sqrt(((own - own.mean(axis=0)) ** 2).sum(axis=1)).max() <= forest.radii[ball] * (1 + 1e-9) + 1e-9
    for k in range(2):
        own = slice(k * 700, (k + 1) * 700)
        assert sorted(forest.order[own].tolist()) == list(range(700))
        assert (forest.points[own] == parts[k][forest.order[own]]).all()


def test_balls_far_from_other_entries_are_owned_whole():
    rng = np.random.default_rng(6)
    blobs = np.array([[0, 0], [10_000, 0], [0, 10_000]])
    points = (blobs[rng.integers(0, 3, 900)] + rng.integers(-50, 50, (900, 2)))[None]
    owners = Owners(build_forest(points), blobs[None])
    assert len(owners.single) == 0 and owners.forest.counts[owners.balls].sum() == 900
    assert len(owners.balls) < 100


def test_anchors_take_their_nearest_points():
    points = np.random.default_rng(7).normal(size=(500, 4))
    owner = anchors(points, 22)
    assert len(np.unique(owner)) == 22
    assert len(np.unique(anchors(np.ones((30, 2)), 6))) == 1
