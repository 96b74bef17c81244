"""Reading exported files again, typed by the schema that was exported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tablelift.functions.types import nullable_schema
from tablelift.operators.pointer import current_files
from tablelift.operators.textform import from_text, read_options, text_schema
from tablelift.storage import Store


def read_export(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, one_line_rows: bool = False
) -> DataFrame:
    """All files below ``path``, slices included; no rows where nothing was published.

    Where pointers tell which files are an export's current state, those are read. Text values may hold line ends, so a CSV file is read by one task unless
    ``one_line_rows`` promises that they do not.
    """
    store = Store(spark, path)
    files = current_files(store, path) if store.exists(path) else []
    paths = [path] if files is None else files
    if not paths:
        return spark.createDataFrame([], nullable_schema(schema))
    reader = spark.read.option("recursiveFileLookup", True)
    if fmt == "parquet":
        return reader.schema(nullable_schema(schema)).parquet(*paths)
    reader = reader.schema(text_schema(schema, fmt)).options(
        **read_options(fmt, len(schema.fields)), mode="FAILFAST"
    )
    if fmt == "json":
        return from_text(reader.json(paths), schema, fmt)
    texts = reader.options(header=True, multiLine=not one_line_rows)
    return from_text(texts.csv(paths), schema, fmt)
