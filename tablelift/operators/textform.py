"""How columns look in text files, and how to get them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Microsecond formats, without which Spark cuts to milliseconds.
TIME_FORMATS = {
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
SEPARATORS = {"csv": ",", "tsv": "\t"}
NESTED = (T.ArrayType, T.MapType, T.StructType)
# Stands for NULL where a lone empty field would be an empty, unreadable line.
LONE_NULL = "\\N"
# Only in readers: what an empty field without quotes is taken for, so that one
# with quotes stays an empty text. No file holds it.
NO_FIELD = "\u0000no field\u0000"


def text_options(fmt: str, columns: int) -> dict[str, str]:
    """Options of the writer of a text format."""
    if fmt == "json":
        return {**TIME_FORMATS, "ignoreNullFields": "true"}
    options = {
        **TIME_FORMATS,
        "sep": SEPARATORS[fmt],
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    if columns == 1:
        options["nullValue"] = LONE_NULL
    return options


def read_options(fmt: str, columns: int) -> dict[str, str]:
    options = text_options(fmt, columns)
    if fmt != "json":
        options.setdefault("nullValue", NO_FIELD)
    return options


def _written_as_text(kind: T.DataType, fmt: str) -> bool:
    return isinstance(kind, T.BinaryType) or (fmt != "json" and isinstance(kind, NESTED))


def to_text(df: DataFrame, fmt: str) -> DataFrame:
    """Binary columns as hex and, where a format is flat, nested ones as JSON."""
    return df.select(*[_text_column(f, fmt).alias(f.name) for f in df.schema.fields])


def _text_column(field: T.StructField, fmt: str) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.lower(F.hex(column))
    if fmt != "json" and isinstance(field.dataType, NESTED):
        return F.to_json(column)
    return column


def text_schema(schema: T.StructType, fmt: str) -> T.StructType:
    """The schema :func:`to_text` gives, all columns nullable."""
    return T.StructType(
        [
            T.StructField(
                f.name, T.StringType() if _written_as_text(f.dataType, fmt) else f.dataType, True
            )
            for f in schema.fields
        ]
    )


def from_text(df: DataFrame, schema: T.StructType, fmt: str) -> DataFrame:
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BinaryType):
            column = F.unhex(column)
        elif fmt != "json" and isinstance(field.dataType, NESTED):
            column = F.from_json(column, field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def text_lines(df: DataFrame, fmt: str, beside: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """Every row as one rendered line with its line end, and the header of a file.

    Columns ``beside`` are not part of the line and stay columns.
    """
    shaped = to_text(df, fmt)
    columns = [c for c in shaped.columns if c not in beside]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    options = text_options(fmt, len(columns))
    if fmt == "json":
        return shaped.select(F.concat(F.to_json(row, options), F.lit("\n")).alias("line"), *beside), ""
    line = F.concat(F.to_csv(row, options), F.lit("\n"))
    header = SEPARATORS[fmt].join(_quoted(c, SEPARATORS[fmt]) for c in columns)
    return shaped.select(line.alias("line"), *beside), header + "\n"


def _quoted(name: str, separator: str) -> str:
    if any(mark in name for mark in (separator, '"', "\n", "\r")):
        return '"' + name.replace('"', '""') + '"'
    return name
