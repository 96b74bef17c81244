"""Declared column types: mapping, conforming, and what conforming loses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Spark type of each declared source type. Types not listed are text.
SPARK_TYPES = {
    "bit": "boolean",
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "real": "float",
    "float": "double",
    "date": "date",
    "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "smalldatetime": "timestamp_ntz",
    "datetimeoffset": "timestamp",
    "time": "string",
    "binary": "binary",
    "varbinary": "binary",
    "image": "binary",
    "timestamp": "binary",
    "rowversion": "binary",
}
DECIMAL_TYPES = ("decimal", "numeric", "money", "smallmoney")
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 10


def declared_type(sql_type: Column, precision: Column, scale: Column) -> Column:
    """Spark type name of a declared column, as an expression over catalog rows."""
    name = F.lower(sql_type)
    pairs = [F.lit(text) for pair in SPARK_TYPES.items() for text in pair]
    decimal = F.concat(
        F.lit("decimal("),
        F.coalesce(precision, F.lit(DEFAULT_PRECISION)).cast("string"),
        F.lit(","),
        F.coalesce(scale, F.lit(DEFAULT_SCALE)).cast("string"),
        F.lit(")"),
    )
    known = F.try_element_at(F.create_map(*pairs), name)
    return F.when(name.isin(*DECIMAL_TYPES), decimal).otherwise(
        F.coalesce(known, F.lit("string"))
    )


def schema_from_columns(columns: DataFrame) -> T.StructType:
    """Table schema from its catalog rows (name, type, nullability, precision, scale).

    Only the column list of one table is read on the driver.
    """
    typed = columns.select(
        "ordinal_position",
        "column_name",
        (F.upper("is_nullable") != "NO").alias("nullable"),
        declared_type(
            F.col("data_type"), F.col("numeric_precision"), F.col("numeric_scale")
        ).alias("spark_type"),
    )
    fields = [
        T.StructField(r.column_name, T._parse_datatype_string(r.spark_type), r.nullable)
        for r in typed.orderBy("ordinal_position").collect()
    ]
    return T.StructType(fields)


def nested_parts(kind: T.DataType) -> list[tuple[str, str | None, T.DataType, bool]]:
    """(part, name, type, nullable) of what a nested type is made of; nothing for others."""
    if isinstance(kind, T.ArrayType):
        return [("element", None, kind.elementType, kind.containsNull)]
    if isinstance(kind, T.MapType):
        return [("key", None, kind.keyType, False), ("value", None, kind.valueType, kind.valueContainsNull)]
    if isinstance(kind, T.StructType):
        return [("field", f.name, f.dataType, f.nullable) for f in kind.fields]
    return []


def schema_from_nested(columns: DataFrame) -> T.StructType:
    """Table schema from its nested catalog rows, arrays, maps and structs at any depth.

    Types of leaves are declared ones, as in the flat catalog. Only the column list of one
    table is read on the driver.
    """
    leaf = declared_type(F.col("data_type"), F.col("numeric_precision"), F.col("numeric_scale"))
    rows = columns.select("*", leaf.alias("spark_type"), (F.upper("is_nullable") != "NO").alias("nullable")).collect()
    children: dict[int | None, list] = {}
    for row in sorted(rows, key=lambda r: r.ordinal_position):
        children.setdefault(row.parent_id, []).append(row)

    def typed(row) -> T.DataType:
        parts = {part.part: part for part in children.get(row.column_id, [])}
        name = row.data_type.lower()
        if name == "array":
            return T.ArrayType(typed(parts["element"]), parts["element"].nullable)
        if name == "map":
            return T.MapType(typed(parts["key"]), typed(parts["value"]), parts["value"].nullable)
        if name == "struct":
            return T.StructType([fielded(part) for part in children.get(row.column_id, [])])
        return T._parse_datatype_string(row.spark_type)

    def fielded(row) -> T.StructField:
        return T.StructField(row.column_name, typed(row), row.nullable)

    return T.StructType([fielded(row) for row in children.get(None, [])])


def nullable_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _conformed(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns, order and types of ``schema``.

    A value its type cannot hold becomes NULL; so does a column ``df`` lacks.
    """
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (_conformed(f) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def conform_strict(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order, types and nullability of ``schema``; fails where ``df`` does not fit."""
    return df.to(schema)


def as_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns of no declared type as text."""
    names = set(df.columns if columns is None else columns)
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c in names else f"`{c}`" for c in df.columns]
    )


def cast_loss(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema``: values before, and values conforming turns to NULL.

    One pass over the data whatever the number of columns.
    """
    present = {name.lower() for name in df.columns}
    fields = [f for f in schema.fields if f.name.lower() in present]
    if not fields:
        empty = F.array().cast("array<struct<column_name: string, values_before: bigint, lost: bigint>>")
        return df.limit(0).select(F.inline(empty))
    counts = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.count(F.col(f"`{f.name}`")).alias("values_before"),
            F.count_if(F.col(f"`{f.name}`").isNotNull() & _conformed(f).isNull()).alias("lost"),
        )
        for f in fields
    ]
    return df.agg(F.array(*counts).alias("per_column")).select(F.inline("per_column"))
