import random
import re
from itertools import combinations

import numpy as np
import pytest

from tablelift.llm.components import components
from tablelift.llm.near_duplicates import near_duplicates
from tablelift.llm.sketches import sketch_all

from .conftest import frame


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_force(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("hub_rounds", [0, 1, 2])
def test_groups_of_edited_copies_match_brute_force(spark, hub_rounds):
    rng = random.Random(hub_rounds)
    texts = ["", None, "a b", "A  b", "a b c d e"]
    for _ in range(4):
        base = [f"w{rng.randrange(5000)}" for _ in range(150)]
        texts += [" ".join(edited(rng, base, rng.randrange(7))) for _ in range(30)]
    rng.shuffle(texts)
    found = near_duplicates(frame(spark, texts), hub_rounds=hub_rounds).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_rows(odd):
    found = near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == [(116, 1, True)] * 2
    assert sorted(by_id[2]) == [(2, 2, True), (116, 1, False)]
    assert by_id[3] == [(0, 3, True)] and by_id[4] == [(0, 4, True)] and by_id[5] == [(0, 5, True)]
    assert sorted(by_id[None]) == [(0, None, True), (116, None, True)]
    assert by_id[6] == [(1, 6, True)]


def test_no_rows(no_rows):
    assert near_duplicates(no_rows).collect() == []


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    whole = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    sets = [np.unique(whole[:2000]), np.unique(whole[500:2500]), whole[:1], whole[:0]]
    sketch = sketch_all(sets, 128)
    assert (sketch[:3] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (sketch[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 1500 / 2500) < 0.15


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(10, 60)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert set(found) == set(range(10, 61)) | {100, 101}
    assert all(c == (10 if n <= 60 else 100) for n, c in found.items())
