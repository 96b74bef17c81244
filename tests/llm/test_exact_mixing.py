import math
import random
from fractions import Fraction

import pytest

from tablelift.llm.mixing import default_weights, exact_slots, has_short_period, mix, repeating_phases, shares

from .conftest import frame


def slot_by_slot(blocks, weights):
    """Among released blocks the earliest deadline, then the heavier source, then by name."""
    left, clock, found = {s: n for s, n in blocks.items() if n}, 0, []
    while left:
        total = sum(Fraction(str(weights[s])) for s in left)
        w = {s: Fraction(str(weights[s])) / total for s in left}
        live, ran, t = set(left), dict.fromkeys(left, 0), 0
        while live == set(left):
            ready = [(math.ceil((ran[s] + 1) / w[s]), -w[s], s) for s in live if math.floor(ran[s] / w[s]) <= t]
            s = min(ready)[2]
            found.append((s, blocks[s] - left[s], clock + t))
            ran[s] += 1
            left[s] -= 1
            t += 1
            if not left[s]:
                del left[s]
        clock += t
    return found


def test_slots_match_a_slot_by_slot_schedule():
    rng = random.Random(12)
    for _ in range(60):
        names = [f"s{i}" for i in range(rng.randrange(1, 9))]
        blocks = {s: rng.randrange(0, 40) for s in names}
        weights = {s: rng.choice([1, 0.3, 2.5, rng.random() + 0.01]) for s in names}
        found = [(s, b, t) for s, own in exact_slots(blocks, weights).items() for b, t in enumerate(own)]
        assert sorted(found) == sorted(slot_by_slot(blocks, weights))


@pytest.mark.parametrize("weights", [
    {"a": 0.9, "b": 0.1}, {"a": 0.5, **{f"s{i}": 0.5 / 19 for i in range(19)}}, {"a": 2, "b": 1, "c": 1e-4},
    {"a": 0.5, **{f"s{i}": 0.5 / 999 for i in range(999)}},
])
def test_a_long_mix_stays_within_a_block_of_the_weights(weights):
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total = sum(exact.values())
    slots = exact_slots(dict.fromkeys(weights, 60_000 if len(weights) < 100 else 1500), weights)
    first_end = min(own[-1] for own in slots.values()) + 1
    for s in list(weights)[:25]:
        w = exact[s] / total
        for j, t in enumerate(slots[s]):
            if t >= first_end:
                break
            # j blocks before this slot, j + 1 after it.
            assert abs(j - t * w) < 1 and abs(j + 1 - (t + 1) * w) < 1


def test_shares_of_a_period_are_the_weights():
    assert shares({"a": 0.9, "b": 0.1}, 2000) == {"a": 1800, "b": 200}
    assert shares({"a": 0.5, **{f"s{i}": 0.5 / 19 for i in range(19)}}, 2000)["a"] == 1000
    assert shares({"a": 0.5, **{f"s{i}": 0.5 / 999 for i in range(999)}}, 2000)["a"] == 1000


def test_more_sources_than_a_period_has_slots(spark):
    docs = spark.range(2500).selectExpr("id AS doc_id", "concat('s', id) AS source", "id + 1 AS n_chars")
    rows = mix(docs).select("slot").collect()
    assert sorted(r.slot for r in rows) == list(range(2500))


def test_rows_lie_in_the_slots_of_their_blocks(spark):
    rng = random.Random(5)
    docs = frame(spark, ["x" * rng.randrange(1, 90) for _ in range(3000)], source=[rng.choice("aaab") for _ in range(3000)])
    rows = mix(docs, {"a": 0.9, "b": 0.1}, block_chars=100, bucket_rows=500).collect()
    ends = {s: max(r.position + r.n_chars for r in rows if r.source == s) for s in "ab"}
    place = {(s, b): t for s, b, t in slot_by_slot({s: -(-n // 100) for s, n in ends.items()}, {"a": 0.9, "b": 0.1})}
    assert len(rows) == 3000 and max(r.source_block for r in rows) > 1000
    assert all(r.slot == place[r.source, r.source_block] for r in rows)


def placed_by(rows, blocks):
    """The slot of every block, looked up as the operator does."""
    found = {}
    for s, first, stop, clock, slots, rank, place, period in rows:
        for block in range(first + rank, stop, slots):
            found[s, block] = clock + (block - first) // slots * period + place
    assert len(found) == sum(blocks.values())
    return found


def test_repeating_phases_are_the_exact_schedule():
    rng = random.Random(13)
    for _ in range(60):
        names = [f"s{i}" for i in range(rng.randrange(1, 9))]
        blocks = {s: rng.randrange(0, 400) for s in names}
        weights = {s: rng.choice([1, 2, 0.3, 2.5, rng.randrange(1, 60)]) for s in names}
        assert has_short_period(blocks, weights)
        wanted = {(s, b): t for s, own in exact_slots(blocks, weights).items() for b, t in enumerate(own)}
        assert placed_by(repeating_phases(blocks, weights), blocks) == wanted


def test_the_schedules_table_does_not_grow_with_the_blocks():
    sizes = {"a": 10**14, "b": 10**13, "c": 3 * 10**12, "d": 7}
    weights = default_weights(sizes, 0.5)
    assert sum(weights.values()) == 10_000 and min(weights.values()) >= 1
    tables = [repeating_phases({s: -(-n * k // 50_000) for s, n in sizes.items()}, weights) for k in (1, 1000)]
    assert max(len(t) for t in tables) <= 4 * 10_000 and abs(len(tables[0]) - len(tables[1])) < 10_000


def test_weights_without_a_short_period_are_scheduled_block_by_block(spark):
    rng = random.Random(14)
    docs = frame(spark, ["x" * rng.randrange(1, 90) for _ in range(500)], source=[rng.choice("ab") for _ in range(500)])
    weights = {"a": 0.123456789, "b": 0.876543211}
    rows = mix(docs, weights, block_chars=100).collect()
    ends = {s: max(r.position + r.n_chars for r in rows if r.source == s) for s in "ab"}
    blocks = {s: -(-n // 100) for s, n in ends.items()}
    assert not has_short_period(blocks, weights)
    place = {(s, b): t for s, b, t in slot_by_slot(blocks, weights)}
    assert all(r.slot == place[r.source, r.source_block] for r in rows)
