import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tablelift.llm import conversations as c, turn_edits as te

SCHEMA = "conv_id long, turn long, role string, text string"
BARE = re.compile(r"[^\x20\x09-\x0D]")
ORDERED = re.compile(r"(s?(ua)+)?")


def best_edits(rows):
    """(cost, audit, turns) by trying all edits; ``rows`` are (fault, role, text)."""
    best = [None]

    def go(i, cost, audit, turns):
        initials = "".join(role[:1] for role, _ in turns)
        if not re.fullmatch(r"(s|s?(ua)*u?)", initials) or (best[0] and cost > best[0][0]):
            return
        if i == len(rows) and ORDERED.fullmatch(initials) and (best[0] is None or (cost, audit) < best[0][:2]):
            best[0] = cost, audit, turns
        if i < len(rows):
            fault, role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", turns)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role:
                    go(i + 1, cost + extra, audit + "K", turns + [(role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + extra + 1, audit + "R", turns + [(new, text)])
        if cost + 5 <= 2 * len(rows):  # deleting all costs no more
            for new in ("user", "assistant"):
                go(i, cost + 5, audit + "I", turns + [(new, "")])

    go(0, 0, "", [])
    return best[0]


def expected(rows, damage=True):
    """The contract, one conversation at a time."""
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20 if damage else 19
        role, text = " " if role is None else role, " " if text is None else text
        kept = groups[conv_id]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv_id, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, told = set(), []
        for _, role, text in turns:
            bare = BARE.findall(text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((fault, role, text))
        cost, audit, repaired = best_edits(told)
        numbers = [t for t, _, _ in turns if t is not None]
        faults = [fault for fault, _, _ in told]
        pairs = zip([r[:1] for _, r, _ in told], [r[:1] for _, r, _ in told][1:])
        spelled = "\n".join(f"{role}:{text}" for role, text in repaired)
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256(spelled.encode()).hexdigest(),
        )
    return out


def found(df, **options):
    rows = c.repaired_digests(c.repair_conversations(df, **options)).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def drawn(rng, conversations, most):
    rows = []
    for i in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "  ", "Why? ", "Äö!", None, "a b.\n", f"{i} {turn}.", "x" * 90 + str(turn % 2)])
            rows.append((i, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


def test_damaged_conversations_match_brute_force(spark):
    rows = drawn(random.Random(1), 150, 7) + [(None, 3, "user", "Hm."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(c.damaged(df)) == expected(rows)


@pytest.mark.parametrize("block_rows", [1, 2, 3])
def test_conversations_over_many_blocks_match_brute_force(spark, block_rows):
    rows = drawn(random.Random(2), 40, 8)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(3), block_rows=block_rows)
    assert got == expected(rows, damage=False)


def test_a_long_conversation_is_the_same_in_blocks_as_in_one(spark):
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No.", "Cut", f"{t}.", f"{t}", " "])) for t in range(20_000)]
    rows += [(i, 0, "user", "Alone.") for i in range(100, 200)]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(6))
    block, faults = c.Block(), []
    for _, turn, role, text in rows[:20_000]:
        block.add(turn, role, text)
    repair = te.Repair(block.kinds, te.END)
    audit, roles, texts = c.repaired(block.roles, block.texts, repair.edits(te.START, True))
    spelled = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts))
    assert got[7] == (*c.report_of(block.facts, repair.start[0]).values(), audit, hashlib.sha256(spelled.encode()).hexdigest())
    assert ORDERED.fullmatch("".join(r[0] for r in roles)) and len(got) == 101


def test_rows_alike_in_any_number(spark):
    rows = [(1, None, "user", "Again.")] * 9_000 + [(1, 5, "assistant", "Yes.")]
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found(spark.createDataFrame(rows, SCHEMA).repartition(4))[1]
    assert (gaps, blank, duplicate, truncated, illegal) == (0, 0, 8_999, 0, 8_999)
    assert cost == 2 * 8_999 and audit == "K" + "D" * 8_999 + "K"


def test_repaired_turns_are_in_order(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Cut"), (1, 2, "tool", "Odd."), (2, 0, "assistant", " ")]
    pieces = c.repair_conversations(spark.createDataFrame(rows, SCHEMA))
    turns = [(r.conv_id, r.role, r.text) for r in c.repaired_turns(pieces).orderBy("conv_id", "block", "place").collect()]
    assert turns == [(1, "user", "Hi."), (1, "assistant", "Odd.")]


def test_rows_that_are_not_present(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", False), (2, 0, "user", "Hi.", None)], SCHEMA + ", present boolean")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(df) == {1: empty, 2: empty}


def test_no_rows_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(c.damaged(none)) == {} and found(none) == {}
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS block", "'x' AS salt", "'x' AS kinds", "'x' AS report")
    assert found(df)[1][:7] == (0, 0, 0, 0, 0, 0, "KK")


def test_edits_are_the_cheapest_and_the_least():
    rng = random.Random(4)
    faults = {te.FINE: "", te.BLANK: "blank", te.DUPLICATE: "duplicate", te.TRUNCATED: "truncated"}
    roles = {te.START: "tool", te.SYSTEM: "system", te.USER: "user", te.ASSISTANT: "assistant"}
    for _ in range(300):
        kinds = [rng.randrange(16) if rng.random() < 0.6 else rng.choice([2, 3]) for _ in range(rng.randrange(7))]
        rows = [(faults[k // 4], roles[k % 4], "t") for k in kinds]
        cost, audit, _ = best_edits(rows)
        repair = te.Repair(kinds, te.END)
        assert (repair.start[te.START], "".join(e for e, _, _ in repair.edits(te.START, True))) == (cost, audit)
        assert te.across(te.crossing(kinds), te.END) == repair.start


@pytest.mark.parametrize("n", [0, 2, 4, 50, 1000])
def test_vectors_are_kept_at_every_square_root_only(n):
    repair = te.Repair([te.kind(te.FINE, te.USER + i % 2) for i in range(n)], te.END)
    assert len(repair.saved) <= n**0.5 + 2
    assert [e for e, _, _ in repair.edits(te.START, True)]== ["K"] * n
