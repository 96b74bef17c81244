import pytest
from pyspark.sql import functions as F

from tablelift.functions.names import (
    fill_template,
    glob_match,
    glob_regex,
    path_safe,
    path_safe_text,
    slice_target,
    table_path,
    table_target,
)

TABLES = [
    "plant.reading", "plant.reading_day", "plant.sensor", "plant.old_reading", "plant.draft_reading",
    "plant.reading_2019", "lab.sample", "lab.assay", "ops.shift", "PLANT.reading",
]


def kept(spark, include, exclude):
    names = spark.createDataFrame([(n,) for n in TABLES], "name string")
    return {r.name for r in names.where(glob_match(F.col("name"), include, exclude)).collect()}


def test_no_pattern_keeps_everything(spark):
    assert kept(spark, [], []) == set(TABLES)
    assert kept(spark, ["*.*"], []) == set(TABLES)


def test_star_crosses_dots(spark):
    assert kept(spark, ["*t.reading*"], []) == {"plant.reading", "plant.reading_day", "plant.reading_2019"}
    assert kept(spark, ["*_2019"], []) == {"plant.reading_2019"}


def test_exclude_wins(spark):
    assert kept(spark, ["plant.*"], ["*.old_*", "*.draft_*", "*_2019"]) == {
        "plant.reading", "plant.reading_day", "plant.sensor"
    }
    assert kept(spark, ["lab.*"], ["l*"]) == set()


def test_patterns_are_or_ed_and_case_matters(spark):
    assert kept(spark, ["lab.*", "ops.*"], []) == {"lab.sample", "lab.assay", "ops.shift"}
    assert kept(spark, ["PLANT.*"], []) == {"PLANT.reading"}
    assert kept(spark, ["depot.*"], []) == set()


@pytest.mark.parametrize(
    "pattern, name, matches",
    [
        ("lab.?ssay", "lab.assay", True),
        ("lab.[st]*", "lab.assay", False),
        ("lab.[!st]*", "lab.assay", True),
        ("{plant,ops}.*", "ops.shift", True),
        ("{plant,ops}.*", "lab.sample", False),
        ("plant.{reading{s,_day},x}", "plant.reading_day", True),
        ("a+b.c", "a+b.c", True),
        ("a+b.c", "aab.c", False),
        (r"a\*.c", "a*.c", True),
        (r"a\*.c", "ab.c", False),
    ],
)
def test_glob_syntax(spark, pattern, name, matches):
    row = spark.range(1).select(F.lit(name).rlike(glob_regex(pattern)).alias("m")).first()
    assert row.m is matches


@pytest.mark.parametrize("pattern", ["[abc", "{a,b", "a}", "ab\\", "[]"])
def test_bad_patterns_are_refused(pattern):
    with pytest.raises(ValueError, match="bad pattern"):
        glob_regex(pattern)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_names_made_path_safe(spark):
    odd = 'a/b\\c:d*e?f"g<h>i|j'
    assert one(spark, path_safe(F.lit(odd))) == "a_b_c_d_e_f_g_h_i_j"
    assert path_safe_text(odd) == "a_b_c_d_e_f_g_h_i_j"
    assert one(spark, path_safe(F.lit("a]b c"))) == "a]b c"


def test_templates(spark):
    template = "s3://lake/{database}/{schema}/{table}/{partition}/part-{file_index}.parquet"
    none = F.lit(None).cast("string")
    filled = one(spark, table_target(template, none, F.lit("dbo"), F.lit("a/b")))
    assert filled == "s3://lake/default/dbo/a_b/{partition}/part-{file_index}.parquet"
    filled = one(spark, table_target(template, F.lit("d:b"), F.lit("dbo"), F.lit("t")))
    assert filled.startswith("s3://lake/d_b/dbo/t/")
    query = fill_template("/output/{query}/{unknown}/data/", query=F.lit("daily/orders"))
    assert one(spark, query) == "/output/daily_orders/{unknown}/data/"


def test_table_paths(spark):
    none = F.lit(None).cast("string")
    assert one(spark, table_path(none, F.lit("dbo"), F.lit("t"))) == "dbo/t"
    assert one(spark, table_path(F.lit("db"), F.lit("dbo"), F.lit("t"))) == "db/dbo/t"


def test_slice_folders():
    assert slice_target("/out/t", "dbo/t/p00000001") == "/out/t/dbo_t_p00000001"
    assert slice_target("/out/{partition}/t", "p0") == "/out/p0/t"
