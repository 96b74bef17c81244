"""Cheapest edits that give a conversation's turns the order system?, (user, assistant)*.

A conversation is in one of four states: nothing yet, after the system turn, after a user
turn, after an assistant turn. Keeping a turn costs 0, giving it the role that fits 1,
deleting it 2, inserting an empty turn that fits 5; a truncated turn that stays adds 5. In
each state one role alone can be given or inserted, so a string of edits, by their
initials D, I, K and R, says all.

The cost of the cheapest edits from a turn to the end, by state, follows from that of the
turn after it. Going back over the turns such vectors are kept at every square root of
their number only; going forward again each block is computed once more, and the first
edit in the order of the alphabet that is tight is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isqrt

STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
# Beyond every cost: no way to the end.
NEVER = 1 << 60
DELETE, INSERT, RENAME, CUT_OFF = 2, 5, 1, 5

# What a turn is: its first fault, and the initial of its role.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# (initial before, initial after) that may stand side by side.
SIDE_BY_SIDE = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# The state that a given or inserted turn leads to.
FITS = (USER, USER, ASSISTANT, USER)
KEEPS = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

Vector = tuple[int, int, int, int]


def kind(fault: int, initial: int) -> int:
    return fault * STATES + initial


def with_inserts(v: Vector) -> Vector:
    """Costs when turns may be inserted first."""
    user = min(v[USER], INSERT + v[ASSISTANT])
    assistant = min(v[ASSISTANT], INSERT + v[USER])
    return min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


# After the last turn: nothing and whole exchanges are complete.
END = with_inserts((0, NEVER, NEVER, 0))


def _kept_or_renamed(kind: int, state: int) -> tuple[int | None, int]:
    """(state after keeping a turn, or None if it cannot be kept; cost of a truncated turn)."""
    fault, initial = divmod(kind, STATES)
    return (initial if (state, initial) in KEEPS else None), CUT_OFF if fault == TRUNCATED else 0


def _edits(kind: int) -> list[list[tuple[str, int, int]]]:
    """For each state the (initial, cost, state after) of the edits of such a turn but insertion."""
    out = []
    for state in range(STATES):
        edits = [("D", DELETE, state)]
        if kind // STATES not in (BLANK, DUPLICATE):
            kept, extra = _kept_or_renamed(kind, state)
            if kept is not None:
                edits.append(("K", extra, kept))
            edits.append(("R", RENAME + extra, FITS[state]))
        out.append(edits)
    return out


EDITS = [_edits(k) for k in range(4 * STATES)]


def before(kind: int, v: Vector) -> Vector:
    """Costs before a turn from those after it."""
    return with_inserts(tuple(min(cost + v[to] for _, cost, to in edits) for edits in EDITS[kind]))


def crossing(kinds: Sequence[int]) -> list[int]:
    """The least cost from each state before the turns to each state after them, row by row."""
    ends = [tuple(0 if i == j else NEVER for i in range(STATES)) for j in range(STATES)]
    for turn in reversed(kinds):
        ends = [before(turn, v) for v in ends]
    return [min(ends[j][i], NEVER) for i in range(STATES) for j in range(STATES)]


def across(costs: Sequence[int], v: Vector) -> Vector:
    """Costs before turns from those after them, by their crossing costs."""
    return tuple(min(costs[i * STATES + j] + v[j] for j in range(STATES)) for i in range(STATES))


class Repair:
    """The edits of a run of turns before an end whose costs are ``end``."""

    def __init__(self, kinds: Sequence[int], end: Vector):
        self.kinds = kinds
        self.step = isqrt(len(kinds)) + 1
        self.saved: dict[int, Vector] = {len(kinds): end}
        v = end
        for i in range(len(kinds) - 1, -1, -1):
            v = before(kinds[i], v)
            if i % self.step == 0:
                self.saved[i] = v
        self.start = v

    def _blocks(self) -> Iterator[tuple[int, list[Vector]]]:
        """(first turn, costs before each turn of the block and after its last)."""
        for first in range(0, len(self.kinds), self.step):
            last = min(first + self.step, len(self.kinds))
            costs = [self.saved[last]]
            for i in range(last - 1, first - 1, -1):
                costs.append(before(self.kinds[i], costs[-1]))
            costs.reverse()
            yield first, costs

    def exits(self) -> list[int]:
        """The state after the turns by the state before them."""
        states = list(range(STATES))
        for first, costs in self._blocks():
            for entry, state in enumerate(states):
                for _, _, state in self._walk(first, costs, state):
                    pass
                states[entry] = state
        return states

    def _walk(self, first: int, costs: list[Vector], state: int) -> Iterator[tuple[str, int, int]]:
        for k in range(len(costs) - 1):
            here, after = costs[k], costs[k + 1]
            while True:
                delete, *others = EDITS[self.kinds[first + k]][state]
                if here[state] == delete[1] + after[state]:
                    edit = delete
                elif here[state] == INSERT + here[FITS[state]]:
                    state = FITS[state]
                    yield "I", -1, state
                    continue
                else:
                    edit = next(e for e in others if here[state] == e[1] + after[e[2]])
                state = edit[2]
                yield edit[0], first + k, state
                break

    def edits(self, state: int, last: bool) -> Iterator[tuple[str, int, int]]:
        """(initial, turn or -1, state after) of each edit; ``last``: the conversation ends here."""
        for first, costs in self._blocks():
            for edit in self._walk(first, costs, state):
                state = edit[2]
                yield edit
        while last and END[state]:
            state = FITS[state]
            yield "I", -1, state
