import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tablelift.functions.types import (
    as_text,
    cast_loss,
    conform,
    conform_strict,
    nullable_schema,
    schema_from_columns,
)
from tablelift.sources.catalog import COLUMNS_SCHEMA


def declared(spark, *columns):
    rows = [
        ("dbo", "t", i, name, kind, nullable, precision, scale)
        for i, (name, kind, nullable, precision, scale) in enumerate(columns, start=1)
    ]
    return schema_from_columns(spark.createDataFrame(rows[::-1], COLUMNS_SCHEMA))


@pytest.mark.parametrize(
    "sql_type, spark_type",
    [
        ("bit", T.BooleanType()), ("tinyint", T.ShortType()), ("smallint", T.ShortType()),
        ("int", T.IntegerType()), ("BIGINT", T.LongType()), ("real", T.FloatType()),
        ("float", T.DoubleType()), ("date", T.DateType()), ("datetime", T.TimestampNTZType()),
        ("datetime2", T.TimestampNTZType()), ("SmallDateTime", T.TimestampNTZType()),
        ("datetimeoffset", T.TimestampType()), ("time", T.StringType()),
        ("binary", T.BinaryType()), ("varbinary", T.BinaryType()), ("image", T.BinaryType()),
        ("timestamp", T.BinaryType()), ("rowversion", T.BinaryType()),
        ("uniqueidentifier", T.StringType()), ("nvarchar", T.StringType()),
        ("xml", T.StringType()), ("geometry", T.StringType()),
        ("decimal", T.DecimalType(38, 10)), ("numeric", T.DecimalType(38, 10)),
        ("money", T.DecimalType(38, 10)), ("smallmoney", T.DecimalType(38, 10)),
    ],
)
def test_type_map(spark, sql_type, spark_type):
    schema = declared(spark, ("c", sql_type, "YES", None, None))
    assert schema == T.StructType([T.StructField("c", spark_type, True)])


def test_schema_keeps_order_nullability_and_precision(spark):
    schema = declared(
        spark,
        ("id", "int", "NO", 10, 0),
        ("name", "nvarchar", "YES", None, None),
        ("amount", "decimal", "YES", 18, 2),
    )
    assert schema == T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("name", T.StringType(), True),
            T.StructField("amount", T.DecimalType(18, 2), True),
        ]
    )


def test_conform_turns_bad_values_into_null_and_reports_them(spark):
    rows = [("1", "12.345", "2024-02-30"), ("x", None, "2024-02-29"), (None, "1e9", "")]
    df = spark.createDataFrame(rows, "id string, amount string, day string")
    schema = T.StructType(
        [
            T.StructField("day", T.DateType()),
            T.StructField("id", T.IntegerType()),
            T.StructField("missing", T.LongType()),
            T.StructField("amount", T.DecimalType(6, 2)),
        ]
    )
    out = conform(df, schema)
    assert out.schema == schema
    assert [tuple(r) for r in out.collect()] == [
        (None, 1, None, Decimal("12.35")),
        (dt.date(2024, 2, 29), None, None, None),
        (None, None, None, None),
    ]
    loss = {r.column_name: (r.values_before, r.lost) for r in cast_loss(df, schema).collect()}
    assert loss == {"day": (3, 2), "id": (2, 1), "amount": (2, 1)}


def test_text_fallback(spark):
    df = spark.createDataFrame([(1, 2**40, 1.5, True)], "i int, l long, d double, b boolean")
    assert tuple(as_text(df).first()) == ("1", str(2**40), "1.5", "true")
    assert as_text(df, ["i"]).schema.simpleString() == (
        "struct<i:string,l:bigint,d:double,b:boolean>"
    )


def test_strict_conform_refuses_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    wanted = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())])
    assert conform_strict(df, wanted).columns == ["name", "id"]
    with pytest.raises(Exception):
        conform_strict(df, T.StructType([T.StructField("name", T.IntegerType())])).collect()


def test_inferred_schema_is_nullable(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False)])
    assert nullable_schema(schema)["id"].nullable
