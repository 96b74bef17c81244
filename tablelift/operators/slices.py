"""Slices: predicates that split one table or query into parts."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICE_COLUMN = "__slice_no"
# 1 for a row in the first slice that keeps it, 2 if others keep it too, 0 in those others.
COVER_COLUMN = "__cover"
# How wide a row is, told by one row in so many.
WIDTH_COLUMN = "__width"
WIDTH_EVERY = 256
# Quantiles that make up a slice of even weight.
EVEN_STEPS = 8
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Slice:
    id: str
    predicate: str | None = None


def single_slice() -> list[Slice]:
    return [Slice("single")]


def predicate_slices(predicates: list[str]) -> list[Slice]:
    return [Slice(f"p{i:08d}", text) for i, text in enumerate(predicates)]


def range_slices(
    column: str,
    kind: T.DataType,
    start,
    end,
    count: int,
    label: str = "query",
    nulls: bool = True,
) -> list[Slice]:
    """``count`` disjoint slices that cover ``[start, end]`` of a column.

    All but the last are half-open. Rows without a key get a slice of their own unless
    ``nulls`` is false. Bounds of a zoned timestamp column are datetimes with a zone, or
    microseconds since 1970; a datetime without one is in UTC.
    """
    if count < 1:
        raise ValueError("a range needs at least one slice")
    if isinstance(kind, T.TimestampType):
        start, end = _micros(start), _micros(end)
    edges = _edges(kind, start, end, count)
    slices = []
    for i in range(len(edges) - 1):
        last = "<=" if i == len(edges) - 2 else "<"
        low, high = _literal(kind, edges[i]), _literal(kind, edges[i + 1])
        slices.append(
            Slice(f"{label}/p{i:08d}", f"`{column}` >= {low} AND `{column}` {last} {high}")
        )
    if nulls:
        slices.append(Slice(f"{label}/p{len(slices):08d}", f"`{column}` IS NULL"))
    return slices


def template_slices(
    df: DataFrame, key: str, template: str, count: int, label: str = "query"
) -> list[Slice]:
    """Fill ``{lo}``/``{hi}`` (or ``{start}``/``{end}``) of an inclusive range template.

    Bounds come from one pass over the key. Neighbouring ranges do not touch, as
    the lower one ends a unit (1, a day, a microsecond, a decimal step) earlier.
    """
    kind = df.schema[key].dataType
    # A zoned timestamp comes as an instant, as Python would shift it to its own zone.
    value = F.col(f"`{key}`")
    value = F.unix_micros(value) if isinstance(kind, T.TimestampType) else value
    bounds = df.agg(
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
        F.count_if(F.col(f"`{key}`").isNull()).alias("nulls"),
    ).first()
    slices = []
    if bounds.lo is not None:
        edges = _edges(kind, bounds.lo, bounds.hi, count)
        for i in range(len(edges) - 1):
            last = i == len(edges) - 2
            low = _literal(kind, edges[i])
            high = _literal(kind, edges[i + 1] if last else _before(kind, edges[i + 1]))
            text = template
            for name, value in (("lo", low), ("start", low), ("hi", high), ("end", high)):
                text = text.replace("{" + name + "}", value)
            slices.append(Slice(f"{label}/p{i:08d}", text))
    if bounds.nulls:
        slices.append(Slice(f"{label}/p{len(slices):08d}", f"`{key}` IS NULL"))
    return slices


def even_slices(
    df: DataFrame, key: str, count: int, label: str = "query", steps: int = EVEN_STEPS
) -> list[Slice]:
    """About ``count`` disjoint slices of about equally many rows, whatever the key's spread.

    Quantiles of the key come from one aggregate, ``steps`` of them for each slice. A value
    that holds nearly a slice's share of the rows, or more, is a slice of its own; runs of
    quantiles between such values share the rest. The first slice has no lower bound and
    the last no upper one, so rows that come later are in one of them; rows without a key
    have their own.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, (*INTEGERS, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.FloatType, T.DoubleType)):
        raise ValueError(f"no ranges over a {kind.simpleString()} column")
    if count < 1 or steps < 2:
        raise ValueError("a range needs at least one slice, of two steps")
    value = F.col(f"`{key}`")
    value = F.unix_micros(value) if isinstance(kind, T.TimestampType) else value
    total = count * steps
    shares = [i / total for i in range(1, total)]
    found = df.agg(
        (F.percentile_approx(value, shares, 100 * total) if shares else F.array(F.min(value))).alias("marks"),
        F.max(value).alias("last"), F.count_if(value.isNull()).alias("nulls"),
    ).first()
    slices = []
    if found.last is not None:
        for i, text in enumerate(_even_ranges(f"`{key}`", kind, [*found.marks, found.last], count)):
            slices.append(Slice(f"{label}/p{i:08d}", text))
    if found.nulls:
        slices.append(Slice(f"{label}/p{len(slices):08d}", f"`{key}` IS NULL"))
    return slices


def _even_ranges(key: str, kind: T.DataType, marks: list, count: int) -> list[str]:
    """Predicates of the ranges that quantiles of equal weight, the greatest value last, are cut into."""
    weights = Counter(marks)
    steps = len(marks) / count
    common = {v for v, n in weights.items() if n - 1 >= 0.75 * steps}
    rest = sum(n for v, n in weights.items() if v not in common) + len(common)
    share = rest / max(1, count - len(common))
    # (upper bound, whether it is part of the range, weight); a common value is cut off at both ends.
    ranges, held = [], 0.0
    last = None
    for v in sorted(weights):
        if v in common:
            ranges.append((v, False, held + 1))
            ranges.append((v, True, weights[v]))
            held, last = 0.0, None
            continue
        if last is not None and held + weights[v] > share + 0.5:
            ranges.append((last, True, held))
            held = 0.0
        held += weights[v]
        last = v
    if last is not None:
        ranges.append((last, True, held))
    texts, lower = [], None
    for i, (upper, inside, _) in enumerate(ranges):
        bounds = []
        if lower is not None:
            bounds.append(f"{key} {'>' if lower[1] else '>='} {_literal(kind, lower[0])}")
        if i < len(ranges) - 1:
            bounds.append(f"{key} {'<=' if inside else '<'} {_literal(kind, upper)}")
        texts.append(" AND ".join(bounds) or f"{key} IS NOT NULL")
        lower = (upper, inside)
    return texts


def _micros(value: int | dt.datetime) -> int:
    if isinstance(value, int):
        return value
    zoned = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return (zoned - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _edges(kind: T.DataType, start, end, count: int) -> list:
    """At most ``count + 1`` rising edges from ``start`` to ``end``."""
    if start > end:
        raise ValueError(f"range start {start} is after its end {end}")
    if isinstance(kind, (*INTEGERS, T.TimestampType)):
        inner = [start + (end - start + 1) * i // count for i in range(1, count)]
    elif isinstance(kind, T.DateType):
        inner = [start + (end - start) * i // count for i in range(1, count)]
    elif isinstance(kind, T.TimestampNTZType):
        inner = [start + (end - start) * i / count for i in range(1, count)]
    elif isinstance(kind, T.DecimalType):
        step = Decimal(1).scaleb(-kind.scale)
        inner = [(start + (end - start) * i / count).quantize(step) for i in range(1, count)]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        inner = [start + (end - start) * i / count for i in range(1, count)]
    else:
        raise ValueError(f"no ranges over a {kind.simpleString()} column")
    rising = [start]
    for edge in inner:
        if rising[-1] < edge <= end:
            rising.append(edge)
    return [*rising, end]


def _before(kind: T.DataType, value):
    if isinstance(kind, (*INTEGERS, T.TimestampType)):
        return value - 1
    if isinstance(kind, T.DateType):
        return value - dt.timedelta(days=1)
    if isinstance(kind, T.TimestampNTZType):
        return value - dt.timedelta(microseconds=1)
    if isinstance(kind, T.DecimalType):
        return value - Decimal(1).scaleb(-kind.scale)
    return math.nextafter(value, -math.inf)


def _literal(kind: T.DataType, value) -> str:
    if isinstance(kind, T.DateType):
        return f"DATE '{value.isoformat()}'"
    if isinstance(kind, T.TimestampType):
        return f"timestamp_micros({value})"
    if isinstance(kind, T.TimestampNTZType):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(kind, T.DecimalType):
        return f"{value:f}"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"CAST({float(value)!r} AS DOUBLE)"
    return str(value)


def _conditions(slices: list[Slice]) -> list[Column]:
    return [F.lit(True) if s.predicate is None else F.expr(s.predicate) for s in slices]


def predicate_hash(slices: list[Slice]) -> str:
    """What the predicates of slices are told by in a manifest."""
    texts = [[s.id, s.predicate] for s in slices]
    return hashlib.sha256(json.dumps(texts).encode()).hexdigest()


def _any(conditions: list[Column]) -> Column:
    kept = F.lit(False)
    for condition in conditions:
        kept = kept | condition
    return kept


def slice_numbers(slices: list[Slice]) -> Column:
    """Numbers of all slices a row belongs to, as an array."""
    return F.array_compact(
        F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(_conditions(slices))])
    )


def count_slices(df: DataFrame, slices: list[Slice]) -> tuple[list[int], bool, int]:
    """Rows of every slice, whether no row is in two, and all rows. One pass over the
    columns the predicates name, without a shuffle of rows."""
    return _counted_slices(df, slices, F.lit(None))[:3]


def measure_slices(df: DataFrame, slices: list[Slice]) -> tuple[list[int], bool, int, float | None]:
    """What ``count_slices`` gives, and how wide a row is as JSON, told by some rows of
    every partition. One pass over all columns."""
    some = F.monotonically_increasing_id() % WIDTH_EVERY == 0
    text = F.when(some, F.octet_length(F.to_json(F.struct("*"))))
    return _counted_slices(df.withColumn(WIDTH_COLUMN, text), slices, F.avg(WIDTH_COLUMN))


def _counted_slices(df: DataFrame, slices: list[Slice], width: Column) -> tuple[list[int], bool, int, float | None]:
    conditions = _conditions(slices)
    counts = df.agg(width, F.count(F.lit(1)), F.count_if(_any(conditions)), *map(F.count_if, conditions)).first()
    return list(counts[3:]), sum(counts[3:]) == counts[2], counts[1], counts[0]


def cover_code(slices: list[Slice], number: Column | int) -> Column:
    """What ``COVER_COLUMN`` holds for a row in the slice of this number."""
    hits = slice_numbers(slices)
    code = F.when(F.size(hits) > 1, 2).otherwise(1)
    return F.when(F.get(hits, F.lit(0)) == number, code).otherwise(0).cast("byte")


def uncovered_rows(df: DataFrame, slices: list[Slice]) -> tuple[int, int]:
    """(rows that no slice keeps, rows that several keep)."""
    hits = F.size(slice_numbers(slices))
    found = df.agg(F.count_if(hits == 0), F.count_if(hits > 1)).first()
    return found[0], found[1]


def with_slice_number(
    df: DataFrame, slices: list[Slice], disjoint: bool = False, whole: list[Slice] | None = None
) -> DataFrame:
    """Rows of all given slices from one scan, each with its slice number.

    A row that several predicates keep comes once per slice, as it would from
    separate reads. The disjunction of the predicates reaches the scan. ``whole`` are all
    slices of the table; with them each row tells how they cover it.
    """
    conditions = _conditions(slices)
    kept = df.where(_any(conditions))
    columns = ["*"]
    if whole is not None:
        places = {s.id: i for i, s in enumerate(whole)}
        codes = [cover_code(whole, places[s.id]) for s in slices]
        columns.append(F.array(*codes).alias(COVER_COLUMN))
    if disjoint:
        number = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)])
    else:
        number = F.explode(slice_numbers(slices))
    numbered = kept.select(*columns, number.alias(SLICE_COLUMN))
    if whole is None:
        return numbered
    return numbered.withColumn(COVER_COLUMN, F.get(COVER_COLUMN, F.col(SLICE_COLUMN)))


def slice_report(df: DataFrame, slices: list[Slice], key: str) -> DataFrame:
    """Rows and key bounds of every slice, and of the rows no slice or several keep.

    ``slices_hit`` is 1 for rows in exactly one slice, so that a report without
    other values shows the slices to be disjoint and complete. One scan.
    """
    hits = df.select(F.col(f"`{key}`").alias("key"), slice_numbers(slices).alias("numbers"))
    ids = F.array(*[F.lit(s.id) for s in slices])
    return (
        hits.select("key", F.size("numbers").alias("slices_hit"), F.explode_outer("numbers").alias("n"))
        .groupBy(F.get(ids, F.col("n")).alias("slice_id"), "slices_hit")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("key").alias("min_key"),
            F.max("key").alias("max_key"),
        )
    )
