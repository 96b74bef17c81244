import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tablelift.datagen.report import profile, row_counts
from tablelift.datagen.tables import GENERATORS, TABLE_ROWS, generate, row_ids


@pytest.mark.parametrize("name", GENERATORS)
def test_tables_are_repeatable_and_full(spark, name):
    df = generate(spark, name, scale=0.001)
    assert df.count() == max(1, round(TABLE_ROWS[name] * 0.001))
    assert same_rows(df, GENERATORS[name](row_ids(spark, df.count()).repartition(3)))
    key = df.columns[0]
    assert df.select(key).distinct().count() == df.count()


def test_other_seed_other_values(spark):
    ids = row_ids(spark, 100)
    build = GENERATORS["dbo.orders"]
    assert not same_rows(build(ids), build(ids, seed=99))


def test_columns_follow_their_rules(spark):
    ids = row_ids(spark, 20_000)
    customers = GENERATORS["dbo.customers"](ids)
    ok = profile(customers, "email", {"gender": 80, "notes": 20}, {"credit_limit": (500, 50_000)})
    assert tuple(ok.first()) == (20_000, 20_000, True, True)
    wrong = profile(customers, "city", {"gender": 50}, {"credit_limit": (500, 600)}).first()
    assert (wrong.key_count, wrong.shares_hold, wrong.ranges_hold) == (20, False, False)
    employees = GENERATORS["hr.employees"](ids)
    heads = employees.where("manager_id IS NULL").agg(F.count("*"), F.max("emp_id")).first()
    assert tuple(heads) == (100, 100)
    orders = GENERATORS["dbo.orders"](ids)
    assert orders.where("required_date < date_add(cast(order_date as date), 3)").isEmpty()
    assert orders.where("shipped_date <= order_date").isEmpty()
    kinds = GENERATORS["sales.transactions"](ids).agg(F.min(F.length("trans_type")), F.max(F.length("trans_type")))
    assert tuple(kinds.first()) == (6, 6)
    raw = GENERATORS["dbo.measurements"](ids).agg(F.max(F.length("raw_bytes")), F.max(F.length("checksum")))
    assert tuple(raw.first()) == (32, 16)


def test_row_count_report_is_ordered(spark):
    report = row_counts({"b": spark.range(3), "a": spark.range(5)}).collect()
    assert [tuple(r) for r in report] == [("a", 5), ("b", 3)]
