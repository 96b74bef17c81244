import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tablelift.operators.slices import (
    SLICE_COLUMN,
    count_slices,
    predicate_slices,
    range_slices,
    single_slice,
    slice_report,
    template_slices,
    with_slice_number,
)


def test_single_slice_has_no_predicate():
    assert [(s.id, s.predicate) for s in single_slice()] == [("single", None)]


def test_predicate_list():
    slices = predicate_slices(["id < 1000", "id >= 1000 AND id < 2000", "id >= 2000"])
    assert [s.id for s in slices] == ["p00000000", "p00000001", "p00000002"]
    assert slices[1].predicate == "id >= 1000 AND id < 2000"


def assert_partition(df, slices, key):
    """Every row that any slice should hold is in exactly one."""
    report = slice_report(df, slices, key).collect()
    assert all(r.slices_hit == 1 for r in report), report
    assert sum(r.row_count for r in report) == df.count()


def test_range_is_disjoint_and_includes_both_ends(spark):
    df = spark.range(0, 1001)
    slices = range_slices("id", T.LongType(), 0, 1000, 4, "dbo/t", nulls=False)
    assert [s.id for s in slices] == [f"dbo/t/p{i:08d}" for i in range(4)]
    assert len({s.predicate for s in slices}) == 4
    assert_partition(df, slices, "id")


def test_range_leaves_out_what_is_beyond_its_bounds(spark):
    slices = range_slices("id", T.LongType(), 10, 19, 3)
    counts, disjoint, total = count_slices(spark.range(100), slices)
    assert (sum(counts), disjoint, total) == (10, True, 100)


def test_range_with_more_slices_than_values(spark):
    slices = range_slices("id", T.LongType(), 5, 6, 10)
    assert_partition(spark.range(5, 7), slices, "id")


@pytest.mark.parametrize("start, end", [(3, 1)])
def test_range_backwards_is_refused(start, end):
    with pytest.raises(ValueError):
        range_slices("id", T.LongType(), start, end, 2)
    with pytest.raises(ValueError):
        range_slices("id", T.LongType(), 1, 2, 0)
    with pytest.raises(ValueError):
        range_slices("name", T.StringType(), "a", "b", 2)


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int", [1, 1, 2, 50, 99, None]),
        ("date", [dt.date(2024, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 12, 31), None]),
        (
            "timestamp_ntz",
            [dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1, 1, 2, 3, 456789), dt.datetime(2025, 1, 1)],
        ),
        ("decimal(9,2)", [Decimal("0.01"), Decimal("3.33"), Decimal("10.00"), None]),
        ("double", [0.1, 0.2, 0.30000000000000004, 7.0, -3.5]),
        ("bigint", [7, 7, 7]),
        ("int", [None, None]),
    ],
)
def test_template_slices_cover_every_row_once(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    for template in ("k BETWEEN {lo} AND {hi}", "`k` >= {start} AND `k` <= {end}"):
        assert_partition(df, template_slices(df, "k", template, 3), "k")


def test_overlapping_predicates_give_a_row_to_each_slice(spark):
    df = spark.range(10)
    slices = predicate_slices(["id < 6", "id >= 4", "id = 100"])
    assert count_slices(df, slices) == ([6, 6, 0], False, 10)
    numbered = with_slice_number(df, slices).groupBy(SLICE_COLUMN).count().collect()
    assert {r[0]: r[1] for r in numbered} == {0: 6, 1: 6}


def test_null_predicates_drop_the_row(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    slices = predicate_slices(["k < 5", "k >= 5"])
    assert count_slices(df, slices) == ([1, 0], True, 2)
    assert with_slice_number(df, slices, disjoint=True).count() == 1
    assert with_slice_number(df, slices).count() == 1


def test_slice_predicates_reach_the_scan(spark, lake):
    orders = lake.frame("dbo", "orders")
    slices = range_slices("o_orderkey", T.LongType(), 0, 100, 2, nulls=False)
    numbered = with_slice_number(orders, slices, disjoint=True)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(" in plan
    assert numbered.agg(F.max("o_orderkey")).first()[0] == 100
