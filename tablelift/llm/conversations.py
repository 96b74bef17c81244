"""Repair of the structure of conversations: faults told, roles and turns put in order.

Turns are sorted over all tasks by conversation and turn, so no conversation, however long,
has to fit one task. A task cuts what it has of a conversation into blocks of a bounded
size. A conversation that is one block, with others before and after it in its task, is
repaired there and then. The blocks of others are stored, and joined up: each has the least
costs from state to state; going back over them gives the costs at every block's end, going
forward the state it is entered in, and with both every block is repaired on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablelift.llm import turn_edits as te
from tablelift.llm.tables import written

BLOCK_ROWS = 4096
BLOCK_CHARS = 4 << 20
# Code points of role and text that rows of one turn are sorted by, before a hash of all of them.
SORTED_BY = 64
SPACE = " \t\n\v\f\r"
SPELLED = {te.USER: "user", te.ASSISTANT: "assistant"}

REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = "struct<" + ", ".join(f"{name}: long" for name in REPORT) + ">"
# What is known of a block apart from its turns.
_FACTS = {
    "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "first_initial": "int",
    "last_initial": "int", "first_turn": "long", "last_turn": "long", "turns": "long",
}
_PIECE = f"conv_id long, block long, single boolean, report {_REPORT}, audit string, roles array<string>, texts array<string>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 256, chars: Callable[[tuple], int] = lambda row: 0) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += chars(row)
        if len(held) >= at_once or size >= BLOCK_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


class Block:
    """Turns of one conversation that follow one another, and what is known of them."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.kinds = bytearray()
        self.hashes: list[tuple[int, bytes]] = []
        self.seen: set[bytes] = set()
        self.chars = 0
        self.facts = dict.fromkeys(_FACTS, 0)
        self.facts.update(first_initial=None, last_initial=None, first_turn=None, last_turn=None)

    def add(self, turn: int | None, role: str, text: str) -> None:
        facts = self.facts
        bare = text.rstrip(SPACE)
        fault = te.BLANK
        if bare:
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            fault = te.DUPLICATE
            if key not in self.seen:
                self.seen.add(key)
                self.hashes.append((len(self.kinds), key))
                fault = te.FINE if bare[-1] in ".!?" else te.TRUNCATED
        initial = te.INITIALS.get(role[:1], te.START)
        for name, value in (("blank", te.BLANK), ("duplicate", te.DUPLICATE), ("truncated", te.TRUNCATED)):
            facts[name] += fault == value
        if facts["last_initial"] is None:
            facts["first_initial"] = initial
        else:
            facts["illegal"] += (facts["last_initial"], initial) not in te.SIDE_BY_SIDE
        facts["last_initial"] = initial
        if turn is not None:
            if facts["last_turn"] is None:
                facts["first_turn"] = turn
            facts["turns"] += turn != facts["last_turn"]
            facts["last_turn"] = turn
        self.kinds.append(te.kind(fault, initial))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)

    def full(self, rows: int) -> bool:
        return len(self.kinds) >= rows or self.chars >= BLOCK_CHARS


def joined_facts(left: dict, right: dict) -> dict:
    """The facts of two runs of turns, one after the other, as those of one run."""
    out = {name: left[name] + right[name] for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
    if left["last_initial"] is not None and right["first_initial"] is not None:
        out["illegal"] += (left["last_initial"], right["first_initial"]) not in te.SIDE_BY_SIDE
    if left["last_turn"] is not None and left["last_turn"] == right["first_turn"]:
        out["turns"] -= 1
    for name, first, second in (("first_initial", left, right), ("last_initial", right, left),
                                ("first_turn", left, right), ("last_turn", right, left)):
        out[name] = first[name] if first[name] is not None else second[name]
    return out


def report_of(facts: dict, cost: int) -> dict:
    # Turns are sorted, so the first is the least and the last the greatest.
    gaps = 0 if facts["first_turn"] is None else facts["last_turn"] - facts["first_turn"] + 1 - facts["turns"]
    return {"gaps": gaps, **{name: facts[name] for name in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost}


def repaired(roles: list[str], texts: list[str], edits: Iterator[tuple[str, int, int]]) -> tuple[str, list[str], list[str]]:
    """(initials of the edits, roles, texts) of the turns after their edits."""
    audit, new_roles, new_texts = [], [], []
    for edit, turn, state in edits:
        audit.append(edit)
        if edit != "D":
            new_roles.append(roles[turn] if edit == "K" else SPELLED[state])
            new_texts.append("" if edit == "I" else texts[turn])
    return "".join(audit), new_roles, new_texts


_SORTED = (
    _PIECE + ", kinds binary, places array<int>, hashes array<binary>, "
    + "facts struct<" + ", ".join(f"{name}: {kind}" for name, kind in _FACTS.items()) + ">"
)


def cut_into_blocks(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pieces of repaired conversations, and blocks that are still to be joined up (facts not null).

    Every row of ``turns`` (conv_id, turn, role, text, present) counts for its
    conversation, but rows that are not present are no turns.
    """
    ordered = ["conv_id", "turn", *(F.substring(c, 1, SORTED_BY) for c in ("role", "text")), F.xxhash64("role", "text"), "salt"]
    # Rows alike in all columns may be in any order, and go to several tasks.
    salted = turns.select("conv_id", "turn", "role", "text", "present", F.monotonically_increasing_id().alias("salt"))
    sorted_ = salted.repartitionByRange(*ordered).sortWithinPartitions(*ordered).drop("salt")
    schema = _arrow(_SORTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = iter(range(TaskContext.get().partitionId() << 32, 1 << 63))

        def still_open(conv_id: int | None, block: Block) -> tuple:
            places, hashes = zip(*block.hashes) if block.hashes else ((), ())
            return (conv_id, next(numbers), None, None, None, block.roles, block.texts, bytes(block.kinds),
                    list(places), list(hashes), block.facts)

        def whole(conv_id: int | None, block: Block) -> tuple:
            repair = te.Repair(block.kinds, te.END)
            piece = repaired(block.roles, block.texts, repair.edits(te.START, True))
            report = report_of(block.facts, repair.start[te.START])
            return (conv_id, next(numbers), True, report, *piece, None, None, None, None)

        def found() -> Iterator[tuple]:
            waiting = None
            for n, (conv_id, rows) in enumerate(groupby(_rows(batches), key=lambda row: row[0])):
                if waiting:
                    yield whole(*waiting)
                    waiting = None
                block, parted = Block(), n == 0
                for _, turn, role, text, present in rows:
                    if block.full(block_rows):
                        yield still_open(conv_id, block)
                        block, parted = Block(), True
                    if present:
                        block.add(turn, role, text)
                if parted:
                    yield still_open(conv_id, block)
                else:
                    waiting = conv_id, block
            if waiting:
                yield still_open(*waiting)

        yield from _batches(found(), schema, chars=lambda row: sum(map(len, row[6])))

    return sorted_.mapInArrow(run, _SORTED)


def _seen_before(blocks: DataFrame) -> DataFrame:
    """block, again: the places in each block of turns that an earlier block has."""
    turns = blocks.select("conv_id", "block", F.posexplode("hashes").alias("i", "hash"), "places")
    first = F.min("block").over(W.partitionBy("conv_id", "hash"))
    again = turns.select("block", F.col("places")[F.col("i")].alias("place"), first.alias("first")).where("block > first")
    return again.groupBy("block").agg(F.collect_list("place").alias("again"))


def _told(blocks: DataFrame) -> DataFrame:
    """conv_id, block, kinds, facts and costs of each block, with the turns seen before it as duplicates."""
    facts = blocks.schema["facts"].dataType.simpleString()
    out = f"conv_id long, block long, kinds binary, facts {facts}, costs array<long>"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, block, kinds, facts, again in _rows(batches):
                kinds = bytearray(kinds)
                for place in again or ():
                    fault, initial = divmod(kinds[place], te.STATES)
                    facts["truncated"] -= fault == te.TRUNCATED
                    facts["duplicate"] += 1
                    kinds[place] = te.kind(te.DUPLICATE, initial)
                yield conv_id, block, bytes(kinds), facts, te.crossing(kinds)

        yield from _batches(found(), schema)

    wanted = blocks.select("conv_id", "block", "kinds", "facts").join(_seen_before(blocks), "block", "left")
    return wanted.select("conv_id", "block", "kinds", "facts", "again").mapInArrow(run, out)


def _by_conversation(rows: DataFrame, order: Column) -> DataFrame:
    """Blocks of one conversation one after the other; there are few of them, and they are read as a stream."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", order)


def _ends(told: DataFrame) -> DataFrame:
    """block, end, last: the costs at each block's end, and whether its conversation ends there."""
    out = "block long, end array<long>, last boolean"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, rows in groupby(_rows(batches), key=lambda row: row[0]):
                end, last = te.END, True
                for _, block, costs in rows:
                    yield block, list(end), last
                    end, last = te.across(costs, end), False

        yield from _batches(found(), schema)

    return _by_conversation(told.select("conv_id", "block", "costs"), F.desc("block")).mapInArrow(run, out)


def _exits(told: DataFrame, ends: DataFrame) -> DataFrame:
    """conv_id, block, facts, kinds, end, last, exits: the state after each block by the one before it."""
    facts = told.schema["facts"].dataType.simpleString()
    out = f"conv_id long, block long, facts {facts}, kinds binary, end array<long>, last boolean, exits array<int>, cost long"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, block, facts, kinds, end, last in _rows(batches):
                repair = te.Repair(kinds, tuple(end))
                yield conv_id, block, facts, kinds, end, last, repair.exits(), repair.start[te.START]

        yield from _batches(found(), schema)

    joined = told.drop("costs").join(ends, "block")
    return joined.select("conv_id", "block", "facts", "kinds", "end", "last").mapInArrow(run, out)


def _entries(exits: DataFrame) -> DataFrame:
    """block, state, single, report: the state each block is entered in; the report with the last one."""
    out = f"block long, state int, single boolean, report {_REPORT}"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, rows in groupby(_rows(batches), key=lambda row: row[0]):
                state, facts, total = te.START, None, 0
                for _, block, own, last, leads, cost in rows:
                    if facts is None:
                        total = cost
                    single = facts is None and last
                    facts = own if facts is None else joined_facts(facts, own)
                    yield block, state, single, report_of(facts, total) if last else None
                    state = leads[state]

        yield from _batches(found(), schema)

    wanted = exits.select("conv_id", "block", "facts", "last", "exits", "cost")
    return _by_conversation(wanted, F.asc("block")).mapInArrow(run, out)


def _repaired_blocks(blocks: DataFrame, exits: DataFrame, entries: DataFrame) -> DataFrame:
    schema = _arrow(_PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, block, roles, texts, kinds, end, last, state, single, report in _rows(batches):
                edits = te.Repair(kinds, tuple(end)).edits(state, last)
                yield conv_id, block, single, report, *repaired(roles, texts, edits)

        yield from _batches(found(), schema, chars=lambda row: sum(map(len, row[6])))

    known = exits.select("block", "kinds", "end", "last").join(entries, "block")
    joined = blocks.select("conv_id", "block", "roles", "texts").join(known, "block")
    columns = ("conv_id", "block", "roles", "texts", "kinds", "end", "last", "state", "single", "report")
    return joined.select(*columns).mapInArrow(run, _PIECE)


def repair_conversations(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every conversation repaired, in pieces: conv_id, block, single, report, audit, roles, texts.

    The pieces of a conversation follow one another by ``block``; ``single`` says that it
    has one alone. ``audit`` has the initials of the edits of a piece in order, ``roles``
    and ``texts`` its turns after them, and ``report`` (null but on the last piece) gaps,
    blank, duplicate, truncated, illegal and cost of the whole conversation.

    ``turns`` has conv_id, turn, role and text; a null role or text is one space. Turns are
    in order of turn, nulls first; those of one turn in order of role and text, by their
    first 64 code points and then by a hash. A blank turn has no character but white space;
    a duplicate one has the role and text of an earlier one; a truncated one does not end
    in one of ``.!?``; the first of these faults counts. Edits are the cheapest that give
    ``(s?(ua)+)?`` as initials of the roles, and of equal ones those that come first in the
    alphabet. A role without a character cannot be kept. Texts are compared by hashes of
    128 bits.

    With a boolean column ``present``, rows where it is not true are no turns, but their
    conversations are told of. A null conv_id is a conversation too; other columns are
    ignored; an empty table gives an empty result. A text of any length is held by one task
    with a block of others, of ``block_rows`` turns and four megabytes at most.
    """
    present = F.coalesce(F.col("present"), F.lit(False)) if "present" in turns.columns else F.lit(True)
    wanted = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), present.alias("present"),
    )
    cut = written(cut_into_blocks(wanted, block_rows), "turn-blocks")
    pieces = [F.col(c) for c in ("conv_id", "block", "single", "report", "audit", "roles", "texts")]
    whole, blocks = cut.where("facts IS NULL").select(*pieces), cut.where("facts IS NOT NULL")
    told = written(_told(blocks), "turn-costs")
    exits = written(_exits(told, _ends(told)), "turn-exits")
    joined = _repaired_blocks(blocks, exits, _entries(exits))
    return whole.union(written(joined, "repaired-blocks"))


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """conv_id, block, place, role, text: the turns of repaired conversations, in order of block and place."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")
    return pieces.select("conv_id", "block", both).select("conv_id", "block", "place", "turn.roles", "turn.texts").toDF(
        "conv_id", "block", "place", "role", "text"
    )


def repaired_digests(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, its report, audit, and sha256 of its turns.

    Turns are spelled ``role:text`` with line ends in between. A conversation of several
    pieces is read as a stream of them.
    """
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    spelled = pieces.select("conv_id", "block", "single", "report", "audit", F.array_join(lines, "\n").alias("text"), F.size("roles").alias("n"))
    columns = ["conv_id", *(f"report.{name}" for name in REPORT), "audit", "repaired_sha256"]
    one = spelled.where("single").withColumn("repaired_sha256", F.sha2("text", 256))
    out = f"conv_id long, report {_REPORT}, audit string, repaired_sha256 string"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
                digest, audits, started, report = hashlib.sha256(), [], False, None
                for _, _, own, audit, text, n in rows:
                    report = own or report
                    audits.append(audit)
                    if n:
                        digest.update(("\n" if started else "").encode() + text.encode("utf-8", "surrogatepass"))
                        started = True
                yield conv_id, report, "".join(audits), digest.hexdigest()

        yield from _batches(found(), schema)

    several = _by_conversation(spelled.where("NOT single").select("conv_id", "block", "report", "audit", "text", "n"), F.asc("block"))
    return one.select(*columns).union(several.mapInArrow(run, out).select(*columns))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: turns with faults put in, by crc32 of ``conv_id:turn`` modulo 20.

    0 leaves the turn out (present is false), 1 empties its text, 2 takes ``.!?`` out of
    it, 3 repeats it, 4 makes it the user's. Nulls of any column are one space here.
    """
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    times = F.explode(F.array_repeat(fault != 0, F.when(fault == 3, 2).otherwise(1)))
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
        times.alias("present"),
    )
