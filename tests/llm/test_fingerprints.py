import hashlib
import random

import numpy as np

from tablelift.llm import fingerprints as fp

from .conftest import frame
from .test_near_duplicates import shingles


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)) for _ in range(2))
    whole = np.union1d(a, b[::2])
    sa, sw = fp.bottom_k(a), fp.bottom_k(whole)
    assert (fp.merge(sa, fp.bottom_k(b[::2])) == sw).all()
    assert abs(fp.distinct_count(sw) - 6000) < 1500
    assert abs(fp.resemblance(sa, sw) - 4000 / 6000) < 0.15
    assert abs(fp.containment(sa, sw) - 1) < 0.3 and abs(fp.containment(sw, sa) - 2 / 3) < 0.3
    assert (fp.from_text(fp.to_text(sa)) == sa).all()
    none = a[:0]
    assert fp.resemblance(none, none) == 1 and fp.resemblance(none, a) == 0 and fp.distinct_count(a[:5]) == 5


def test_edits_follow_the_ring_of_ids(spark):
    rng = random.Random(3)
    texts = ["", None, "é" * 9, "a b"]
    texts += [" ".join(f"wÄ{rng.randrange(9)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    docs = frame(spark, texts)
    texts = [t or "" for t in texts]
    for run_rows in (7, 1000):
        found = {r.doc_id: r for r in fp.edited_fingerprints(docs, run_rows=run_rows).collect()}
        assert sorted(found) == list(range(len(texts)))
        for i, text in enumerate(texts):
            after, half = texts[i - 1], len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            r, sets = found[i], [shingles(t) for t in (text, edited, after)]
            assert r.n_chars == len(text)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            for value, other in ((r.near_edited, sets[1]), (r.near_next, sets[2])):
                # Below k shingles the sketch is the set itself.
                union = sets[0] | other
                assert value == (len(sets[0] & other) / len(union) if union else 1.0)


def test_odd_rows(odd, no_rows):
    rows = fp.edited_fingerprints(odd, run_rows=2).collect()
    assert len(rows) == odd.count()
    prints = {}
    for r in rows:
        prints.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert prints[0] == {""} and all(len(p) == 1 for n, p in prints.items() if n > 100)
    assert fp.edited_fingerprints(no_rows).collect() == []
    assert fp.fingerprints(odd).count() == len(rows) and fp.fingerprints(no_rows).collect() == []
    one = odd.where("doc_id = 6")
    assert [(r.n_chars, r.near_next) for r in fp.edited_fingerprints(one).collect()] == [(7, 1.0)]
