"""Reports on generated tables: row counts, and whether columns follow their rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Five standard deviations of a share: a sound table fails once in millions.
DEVIATIONS = 5.0


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, in name order."""
    counts = [
        df.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("tbl")


def profile(
    df: DataFrame, key: str, shares: dict[str, int], ranges: dict[str, tuple]
) -> DataFrame:
    """One row on a table: rows, distinct keys, whether the columns in ``shares`` hold
    values as often (percent) as they should, and whether those in ``ranges`` stay
    within their bounds."""
    total = F.count(F.lit(1))
    shares_hold = F.lit(True)
    for column, percent in shares.items():
        expected = percent / 100
        allowed = DEVIATIONS * F.sqrt(F.lit(expected * (1 - expected)) / total)
        shares_hold = shares_hold & (F.abs(F.count(column) / total - expected) <= allowed)
    ranges_hold = F.lit(True)
    for column, (low, high) in ranges.items():
        ranges_hold = ranges_hold & F.bool_and(F.col(column).between(F.lit(low), F.lit(high)))
    return df.agg(
        total.alias("row_count"),
        F.count_distinct(key).alias("key_count"),
        shares_hold.alias("shares_hold"),
        ranges_hold.alias("ranges_hold"),
    )
