"""Repeatable pseudo-random columns: a draw is a hash of seed, row id and name."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

DRAW_RANGE = 2**31
ANCHOR = "2024-01-01 00:00:00"


class Draws:
    def __init__(self, row: Column, seed: int):
        self.row = row
        self.seed = seed

    def number(self, name: str) -> Column:
        mixed = F.xxhash64(self.row, F.lit(self.seed), F.lit(name))
        return F.pmod(mixed, F.lit(DRAW_RANGE))

    def between(self, name: str, low: int, high: int) -> Column:
        return self.number(name) % (high - low + 1) + low

    def pick(self, name: str, values: tuple[str, ...]) -> Column:
        return F.get(F.array(*map(F.lit, values)), self.between(name, 0, len(values) - 1))

    def chance(self, name: str, percent: int) -> Column:
        return self.between(name, 0, 99) < percent

    def maybe(self, name: str, percent: int, value: Column) -> Column:
        return F.when(self.chance(f"{name}?", percent), value)

    def hundredths(self, name: str, low: int, high: int, kind: str) -> Column:
        """``low``..``high`` hundredths as a decimal or floating type."""
        return scaled(self.between(name, low, high), 2, kind)

    def seconds_ago(self, name: str, limit: int) -> Column:
        ago = -self.between(name, 0, limit - 1)
        return F.timestamp_add("SECOND", ago.cast("int"), anchor())

    def days_ago(self, name: str, low: int, high: int) -> Column:
        return F.date_sub(anchor().cast("date"), self.between(name, low, high).cast("int"))

    def _hex(self, name: str) -> Column:
        """16 hex digits."""
        mixed = F.xxhash64(self.row, F.lit(self.seed), F.lit(name))
        return F.lpad(F.hex(mixed), 16, "0")

    def digest(self, name: str) -> Column:
        """32 hex digits."""
        return F.concat(self._hex(f"{name}/1"), self._hex(f"{name}/2"))

    def uuid(self, name: str) -> Column:
        first, second = self._hex(f"{name}/1"), self._hex(f"{name}/2")
        parts = ((first, 1, 8), (first, 9, 4), (first, 13, 4), (second, 1, 4), (second, 5, 12))
        return F.concat_ws("-", *[F.substring(*part) for part in parts])

    def digits(self, name: str, low: int, high: int, width: int) -> Column:
        return zero_padded(self.between(name, low, high), width)


def anchor() -> Column:
    """The fixed moment that stands for now."""
    return F.lit(ANCHOR).cast("timestamp_ntz")


def scaled(number: Column, digits: int, kind: str) -> Column:
    """A whole number with its decimal point moved left; decimals by a product, which
    costs a third of a division."""
    if kind in ("float", "double"):
        return (number.cast("double") / 10**digits).cast(kind)
    return (number.cast("decimal(12,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(kind)


def zero_padded(number: Column, width: int) -> Column:
    """At least ``width`` digits, longer numbers in full."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))
