"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks, and a source of weight ``w`` is given one slot for a block
``w`` of the time: block ``j`` is released at slot ``floor(j / w)`` and due by
``ceil((j + 1) / w)``. Released blocks run earliest deadline first, which keeps each source
within one block of its weight at every slot. Release and due times come from the weights
as exact fractions, so a source stays within that block however long the mix is. When a
source has no block left, the others go on with their weights scaled up, in a schedule
that starts there.

Weights are whole numbers in a ratio, and after as many slots as they add up to the
schedule repeats: the table of one such period, for each source that ends, places any
number of blocks. Default weights are chosen so that this is short. Only for given weights
that have no short period, or for very many sources, does the driver compute and hold one
number for each block. With a ``period``, weights are rounded to its fractions instead.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablelift.llm.tables import written
from tablelift.session import small_frame

# Slots of a period where none is given.
PERIOD = 2000
# Slots that default weights are fractions of, and rows of the schedule's table at most.
FRACTIONS, TABLE_ROWS = 10_000, 4_000_000
# Blocks whose slots make up one row of the schedule's table, and those of a table that is broadcast.
ROW_BLOCKS, BROADCAST_BLOCKS = 1000, 4_000_000
# Code points of a block.
BLOCK_CHARS = 50_000
# Rows of a source that are ranked together, on average.
BUCKET_ROWS = 5_000
# Weights by default follow the size of a source to this power.
TEMPERATURE = 0.5


def exact(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the ratio of the weights, floats taken as they are written in decimals."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be above zero")
    found = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*(f.denominator for f in found.values()))
    return {s: int(f * scale) for s, f in found.items()}


def exact_slots(blocks: dict[str, int], weights: dict[str, float]) -> dict[str, array]:
    """The slots of each source's blocks: released blocks, earliest deadline first.

    Of blocks due at once the one of the heavier source goes first, then by name.
    """
    parts = exact({s: weights[s] for s, n in blocks.items() if n > 0})
    names = sorted(parts, key=lambda s: (-parts[s], s))
    part, left = [parts[s] for s in names], [blocks[s] for s in names]
    slots = [array("q") for _ in names]
    total, clock, alive = sum(part), 0, list(range(len(names)))
    while total:
        # In this order first blocks are due one after the other, so a phase looks at no
        # more sources than it has slots.
        if 2 * sum(1 for k in alive[:64] if not left[k]) >= len(alive[:64]):
            alive = [k for k in alive if left[k]]
        waiting: list[tuple] = []
        ready: list[tuple] = []
        done: dict[int, int] = {}
        t, next_new, ended = 0, 0, None
        while ended is None:
            while waiting and waiting[0][0] <= t:
                heapq.heappush(ready, heapq.heappop(waiting)[1:])
            while next_new < len(alive) and not left[alive[next_new]]:
                next_new += 1
            if next_new < len(alive) and (not ready or (-(-total // part[alive[next_new]]), alive[next_new]) < ready[0]):
                k, j = alive[next_new], 1
                next_new += 1
            else:
                k = heapq.heappop(ready)[1]
                j = done[k] + 1
            slots[k].append(clock + t)
            done[k] = j
            left[k] -= 1
            t += 1
            if left[k]:
                heapq.heappush(waiting, (j * total // part[k], -(-(j + 1) * total // part[k]), k))
            else:
                ended = k
        clock += t
        total -= part[ended]
    return dict(zip(names, slots))


def shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of a period for each source: by largest remainder, one at least.

    Sources with less than a slot get one, and the others share what is left.
    """
    if len(weights) > period:
        raise ValueError(f"more than {period} sources; raise the period")
    parts, slots, left = exact(weights), {}, period
    while True:
        total = sum(parts.values())
        few = [s for s, w in parts.items() if w * left < total]
        if not few:
            break
        for s in few:
            slots[s] = 1
            del parts[s]
        left -= len(few)
    slots |= {s: w * left // total for s, w in parts.items()}
    rest = period - sum(slots.values())
    for s in sorted(parts, key=lambda s: (-(parts[s] * left % total), s))[:rest]:
        slots[s] += 1
    return slots


def one_period(slots: dict[str, int]) -> list[str]:
    """The source of each slot of a period: released blocks, earliest deadline first."""
    period = sum(slots.values())
    due = lambda s, j: -(-(j + 1) * period // slots[s])
    released = [[] for _ in range(period)]
    for s, n in slots.items():
        for j in range(n):
            released[j * period // n].append((due(s, j), s))
    ready: list[tuple[int, str]] = []
    order = []
    for blocks in released:
        for block in blocks:
            heapq.heappush(ready, block)
        order.append(heapq.heappop(ready)[1])
    return order


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[tuple]:
    """(source, first block, last, first slot, slots a period, rank in it, place in it).

    A phase ends when one of its sources ends; a row tells where the blocks of one rank in
    a phase's period go. There are at most ``period`` rows for each source that ends.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, clock = [], 0
    while left:
        slots = shares({s: weights[s] for s in left}, period)
        order = one_period(slots)
        places: dict[str, list[int]] = {s: [] for s in left}
        for place, s in enumerate(order):
            places[s].append(place)
        # The slot, within this phase, after the last block of the source that ends first.
        end = {s: (n - 1) // slots[s] * period + places[s][(n - 1) % slots[s]] + 1 for s, n in left.items()}
        length = min(end.values())
        for s in list(left):
            cycles, tail = divmod(length, period)
            ran = cycles * slots[s] + sum(place < tail for place in places[s])
            for rank, place in enumerate(places[s]):
                if rank < ran:
                    rows.append((s, done[s], done[s] + ran, clock, slots[s], rank, place))
            done[s] += ran
            left[s] -= ran
            if not left[s]:
                del left[s]
        clock += length
    return rows


def default_weights(sizes: dict[str, int], temperature: float) -> dict[str, int]:
    """Sizes to the power ``temperature``, as fractions of ``FRACTIONS`` slots or few more."""
    return shares({s: n**temperature for s, n in sizes.items()}, max(FRACTIONS, 2 * len(sizes))) if sizes else {}


def has_short_period(blocks: dict[str, int], weights: dict[str, float]) -> bool:
    """A table of one period for each source that ends is small enough for the driver."""
    parts = exact({s: weights[s] for s, n in blocks.items() if n > 0})
    return len(parts) * (sum(parts.values()) // math.gcd(*parts.values(), 0) if parts else 0) <= TABLE_ROWS


def repeating_phases(blocks: dict[str, int], weights: dict[str, float]) -> list[tuple]:
    """(source, first block, stop, first slot, slots a period, rank in it, place in it, its length).

    The slots are those of ``exact_slots``. A phase ends when one of its sources ends; a row
    tells where the blocks of one rank in the phase's period go.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, clock = [], 0
    while left:
        parts = exact({s: weights[s] for s in left})
        least = math.gcd(*parts.values())
        parts = {s: n // least for s, n in parts.items()}
        period = sum(parts.values())
        # With a block more for each source, none ends within the period.
        own = exact_slots({s: n + 1 for s, n in parts.items()}, parts)
        places = {s: own[s][:n].tolist() for s, n in parts.items()}
        length = min((n - 1) // parts[s] * period + places[s][(n - 1) % parts[s]] + 1 for s, n in left.items())
        cycles, tail = divmod(length, period)
        for s in list(left):
            ran = cycles * parts[s] + bisect_left(places[s], tail)
            for rank, place in enumerate(places[s][:ran]):
                rows.append((s, done[s], done[s] + ran, clock, parts[s], rank, place, period))
            done[s] += ran
            left[s] -= ran
            if not left[s]:
                del left[s]
        clock += length
    return rows


def ranked(docs: DataFrame, size: Column, block_size: int, bucket_rows: int, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the block that holds their first unit of size, size of each source).

    Rows of a source come in the order of a hash of doc_id and n_chars. They are dealt to buckets by
    that hash; what lies before a bucket is summed up over the buckets, and only a bucket's
    own rows are ordered in one task, so a source of any size is spread.
    """
    order = F.xxhash64("doc_id", "n_chars")
    rows = docs.select(
        *keep,
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__source"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(1)).cast("long").alias("__size"),
        order.alias("__order"),
    )
    count = docs.count()
    buckets = max(1, -(-count // bucket_rows))
    # The range of the hash's upper 31 bits, cut evenly.
    bucket = F.shiftright(F.shiftrightunsigned("__order", 33) * buckets, 31)
    rows = rows.withColumn("__bucket", bucket)
    sums = written(rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("total")), "bucket-sizes")
    before = W.partitionBy("__source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    ahead = sums.select("__source", "__bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("__before"))
    near = W.partitionBy("__source", "__bucket").orderBy("__order", "doc_id", "__size")
    within = F.coalesce(F.sum("__size").over(near.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(ahead, ["__source", "__bucket"]).withColumn("__start", F.col("__before") + within)
    placed = placed.withColumn("__block", F.floor(F.col("__start") / F.lit(block_size)).cast("long"))
    return placed, sums.groupBy("__source").agg(F.sum("total").alias("size"))


def _looked_up(docs: DataFrame, placed: DataFrame, slots: dict[str, array]) -> DataFrame:
    """The rows that ``_slotted`` returns, by a table of all blocks' slots."""
    table = [
        (s, first // ROW_BLOCKS, own[first : first + ROW_BLOCKS].tolist())
        for s, own in slots.items() for first in range(0, len(own), ROW_BLOCKS)
    ]
    plan = small_frame(docs.sparkSession, table, "__from string, __part long, __slots array<long>")
    if sum(map(len, slots.values())) <= BROADCAST_BLOCKS:
        plan = F.broadcast(plan)
    part = F.floor(F.col("__block") / F.lit(ROW_BLOCKS)).cast("long")
    out = placed.join(plan, (F.col("__source") == F.col("__from")) & (part == F.col("__part")))
    slot = F.get("__slots", (F.col("__block") % ROW_BLOCKS).cast("int"))
    return out.select(*docs.columns, "__block", slot.alias("__slot"), "__start")


def _slotted(
    docs: DataFrame, weights: dict[str, float] | None, block_chars: int, temperature: float, period: int | None,
    bucket_rows: int,
) -> DataFrame:
    """All rows and columns of ``docs`` with __block, __slot and __start."""
    placed, sizes = ranked(docs, F.col("n_chars"), block_chars, bucket_rows, docs.columns)
    found = {r["__source"]: r["size"] for r in sizes.collect()}
    if weights is None:
        weights = default_weights(found, temperature)
    missing = set(found) - set(weights)
    if missing:
        raise ValueError(f"no weight for sources {sorted(missing)}")
    blocks = {s: -(-size // block_chars) for s, size in found.items()}
    if period is not None:
        table = [(*row, period) for row in phases(blocks, weights, period)]
    elif has_short_period(blocks, weights):
        table = repeating_phases(blocks, weights)
    else:
        return _looked_up(docs, placed, exact_slots(blocks, weights))
    names = [f"__{n}" for n in ("from", "first", "stop", "clock", "slots", "rank", "place", "period")]
    plan = small_frame(docs.sparkSession, table, ", ".join(f"{n} {'long' if i else 'string'}" for i, n in enumerate(names)))
    # Both are of the sources' number and the period alone: a row of a phase for each source
    # that has blocks in it, and one for each slot of the phase's period.
    spans = F.broadcast(plan.where("__rank = 0").drop("__rank", "__place"))
    places = F.broadcast(plan.select(*(F.col(n).alias(f"{n}_") for n in ("__from", "__clock", "__rank", "__place"))))
    in_phase = placed.join(
        spans, (F.col("__source") == F.col("__from")) & (F.col("__block") >= F.col("__first")) & (F.col("__block") < F.col("__stop"))
    )
    local = F.col("__block") - F.col("__first")
    in_phase = in_phase.withColumn("__rank", local % F.col("__slots")).withColumn("__cycle", F.floor(local / F.col("__slots")))
    out = in_phase.join(
        places,
        (F.col("__source") == F.col("__from_")) & (F.col("__clock") == F.col("__clock_")) & (F.col("__rank") == F.col("__rank_")),
    )
    slot = (F.col("__clock") + F.col("__cycle") * F.col("__period") + F.col("__place_")).cast("long")
    return out.select(*docs.columns, "__block", slot.alias("__slot"), "__start")


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    temperature: float = TEMPERATURE,
    period: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """All rows and columns of ``docs`` with source_block, slot and position in the mix.

    ``weights`` gives each source's share of the mix, '' that of a null source; by default
    it follows the source's code points to the power ``temperature``, in multiples of a
    ten-thousandth (or of less, for thousands of sources). Weights are held exactly, or in
    multiples of ``1 / period`` if a period is given. Blocks hold
    ``block_chars`` of a source's code points by n_chars; a row lies in the block in which
    it starts, so a longer row leaves the slots of the blocks it covers to no other row.
    Slots give the order of blocks; ``position`` orders rows within a block's slot.

    A null or zero n_chars counts as one. Every row is in the mix once, repeated rows too.
    Columns named source_block, slot or position are replaced. An empty table gives an
    empty result. A source without a weight is refused.
    """
    added = ("source_block", "slot", "position")
    docs = docs.drop(*added)
    out = _slotted(docs, weights, block_chars, temperature, period, bucket_rows)
    return out.withColumnsRenamed(dict(zip(("__block", "__slot", "__start"), added)))


def in_mix_order(
    docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS,
    temperature: float = TEMPERATURE, period: int | None = None, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of ``docs`` sorted as ``mix`` orders them, with the columns they had."""
    out = _slotted(docs, weights, block_chars, temperature, period, bucket_rows)
    return out.orderBy("__slot", "__start").select(*docs.columns)
