import math
import random

import pytest

from tablelift.llm.mixing import in_mix_order, mix, one_period, phases, shares

from .conftest import frame


def test_a_period_keeps_each_source_within_a_block():
    for weights in ({"a": 1}, {"a": 3, "b": 1}, {f"s{i}": i + 1 for i in range(17)}, {"hot": 50, "x": 1, "y": 1}):
        slots = shares(weights, 500)
        assert sum(slots.values()) == 500 and min(slots.values()) >= 1
        seen = dict.fromkeys(slots, 0)
        for t, s in enumerate(one_period(slots), 1):
            seen[s] += 1
            assert all(abs(seen[k] - t * slots[k] / 500) < 1 for k in slots)


def brute_force(blocks, weights, period):
    """Pfair slot by slot: among released blocks the earliest deadline."""
    left, clock, order = dict(blocks), 0, []
    while any(left.values()):
        live = {s for s in left if left[s]}
        slots, ran, t = shares({s: weights[s] for s in live}, period), dict.fromkeys(live, 0), 0
        while all(left[s] for s in live):
            ready = [(math.ceil((ran[s] + 1) * period / slots[s]), s) for s in live if ran[s] * period // slots[s] <= t]
            _, s = min(ready)
            order.append((clock + t, s, blocks[s] - left[s]))
            ran[s] += 1
            left[s] -= 1
            t += 1
        clock += t
    return order


def test_phases_match_a_slot_by_slot_schedule():
    rng = random.Random(2)
    for _ in range(20):
        names = [f"s{i}" for i in range(rng.randrange(1, 6))]
        blocks = {s: rng.randrange(1, 60) for s in names}
        weights = {s: rng.random() + 0.05 for s in names}
        found = []
        for s, first, stop, clock, slots, rank, place in phases(blocks, weights, 20):
            found += [(clock + (b - first) // slots * 20 + place, s, b) for b in range(first + rank, stop, slots)]
        assert sorted(found) == sorted(brute_force(blocks, weights, 20))


def test_every_row_is_mixed_once_by_size(spark):
    rng = random.Random(4)
    texts = ["x" * rng.randrange(1, 400) for _ in range(900)]
    sources = [rng.choice(["hot"] * 8 + ["b", "c", None]) for _ in texts]
    docs = frame(spark, texts, source=sources)
    out = mix(docs, block_chars=1000, bucket_rows=50, period=50).collect()
    assert sorted(r.doc_id for r in out) == list(range(900))
    ends = {}
    for r in sorted(out, key=lambda r: (r.source or "", r.position)):
        assert r.position == ends.get(r.source, 0) and r.source_block == r.position // 1000
        ends[r.source] = r.position + r.n_chars
    assert len({(r.slot, r.source) for r in out}) == len({r.slot for r in out})
    total = {s or "": -(-n // 1000) for s, n in ends.items()}
    weights = {s or "": n**0.5 for s, n in ends.items()}
    place = {(s, b): t for t, s, b in brute_force(total, weights, 50)}
    assert all(r.slot == place[(r.source or "", r.source_block)] for r in out)


def test_rows_come_in_the_order_of_the_mix(spark):
    docs = frame(spark, [f"{i}" * 50 for i in range(80)], source=["a", "b"] * 40)
    ranks = {r.doc_id: (r.slot, r.position) for r in mix(docs, block_chars=300).collect()}
    ids = [r.doc_id for r in in_mix_order(docs, block_chars=300).collect()]
    assert ids == sorted(ids, key=ranks.get)


def test_odd_rows(odd):
    out = mix(odd)
    assert sorted(out.columns) == sorted({*odd.columns, "source_block", "slot", "position"})
    assert out.count() == odd.count()
    again = in_mix_order(odd)
    assert again.columns == odd.columns and again.exceptAll(odd).isEmpty() and odd.exceptAll(again).isEmpty()
    with pytest.raises(ValueError, match="no weight"):
        mix(odd, weights={"a": 1.0})


def test_no_rows(no_rows):
    assert mix(no_rows).collect() == [] and in_mix_order(no_rows).collect() == []
