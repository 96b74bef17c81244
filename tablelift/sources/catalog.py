"""Catalogs: which tables and columns a source has, as DataFrames."""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablelift.functions.names import glob_match
from tablelift.functions.types import nested_parts
from tablelift.session import small_frame
from tablelift.storage import Store

TABLES_SCHEMA = (
    "table_catalog string, table_schema string, table_name string, table_type string"
)
COLUMNS_SCHEMA = (
    "table_schema string, table_name string, ordinal_position int, column_name string, "
    "data_type string, is_nullable string, numeric_precision int, numeric_scale int"
)


NESTED_SCHEMA = (
    "table_schema string, table_name string, column_id int, parent_id int, ordinal_position int, "
    "part string, column_name string, data_type string, is_nullable string, "
    "numeric_precision int, numeric_scale int"
)


class LakeSource:
    """Parquet tables of one folder, ``<root>/<table>.parquet``, as one schema.

    A table is listed once per source, so everything read through one source sees
    one state of its files.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str = "dbo",
        database: str | None = None,
        names: list[str] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.database = database
        if names is None:
            entries = Store(spark, self.root).files(self.root)
            names = [e[: -len(".parquet")] for e in entries if e.endswith(".parquet")]
        self.names = names
        # Temporary views of a session of its own do not meet those of other sources.
        self._views = spark.newSession()
        self._viewed: set[str] = set()
        self._lock = threading.Lock()
        self._frames: dict[str, DataFrame] = {}

    def tables(self) -> DataFrame:
        rows = [(self.database, self.schema, name, "BASE TABLE") for name in self.names]
        return small_frame(self.spark, rows, TABLES_SCHEMA)

    def frame(self, schema: str, table: str) -> DataFrame:
        if schema.lower() != self.schema.lower() or table not in self.names:
            raise LookupError(f"no table {schema}.{table}")
        if table not in self._frames:
            self._frames[table] = self.spark.read.parquet(f"{self.root}/{table}.parquet")
        return self._frames[table]

    def columns(self, schema: str, table: str) -> DataFrame:
        return frame_columns(self.frame(schema, table), schema, table)

    def query(self, sql: str) -> DataFrame:
        """A query over the tables by their bare names, under the caller's settings."""
        with self._lock:
            same_settings(self.spark, self._views)
            for name in self.names:
                if name not in self._viewed and re.search(rf"\b{re.escape(name)}\b", sql, re.IGNORECASE):
                    self._views.read.parquet(f"{self.root}/{name}.parquet").createOrReplaceTempView(name)
                    self._viewed.add(name)
            return self._views.sql(sql)


def same_settings(source: SparkSession, target: SparkSession) -> None:
    """Give a session the settings that another one has now.

    Functions registered in the other session stay there.
    """
    wanted, known = source.conf.getAll, target.conf.getAll
    for key in known.keys() | wanted.keys():
        if known.get(key) != wanted.get(key) and target.conf.isModifiable(key):
            if key in wanted:
                target.conf.set(key, wanted[key])
            else:
                target.conf.unset(key)


class SparkSource:
    """Tables of the Spark catalog; a Spark database is a schema here."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark = spark
        self.database = database

    def tables(self) -> DataFrame:
        rows = [
            (self.database, db.name, table.name, "BASE TABLE")
            for db in self.spark.catalog.listDatabases()
            for table in self.spark.catalog.listTables(db.name)
            if table.tableType != "VIEW" and not table.isTemporary
        ]
        return small_frame(self.spark, rows, TABLES_SCHEMA)

    def frame(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(f"`{schema}`.`{table}`")

    def columns(self, schema: str, table: str) -> DataFrame:
        return frame_columns(self.frame(schema, table), schema, table)

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)


# The declared type that each Spark type is read back from by ``declared_type``.
DECLARED = {
    "boolean": "bit", "byte": "smallint", "tinyint": "smallint", "float": "real",
    "double": "float", "timestamp_ntz": "datetime2", "timestamp": "datetimeoffset",
    "binary": "varbinary", "string": "nvarchar",
}


def frame_columns(df: DataFrame, schema: str, table: str) -> DataFrame:
    """The column catalog of a frame, in order."""
    rows = []
    for position, field in enumerate(df.schema.fields, start=1):
        kind = field.dataType
        decimal = isinstance(kind, T.DecimalType)
        rows.append(
            (
                schema,
                table,
                position,
                field.name,
                "decimal" if decimal else DECLARED.get(kind.simpleString(), kind.simpleString()),
                "YES" if field.nullable else "NO",
                kind.precision if decimal else None,
                kind.scale if decimal else None,
            )
        )
    return small_frame(df.sparkSession, rows, COLUMNS_SCHEMA).orderBy("ordinal_position")


def nested_columns(df: DataFrame, schema: str, table: str) -> DataFrame:
    """The column catalog of a frame with what nested columns are made of.

    A row is a column of the table, or a part of another row, its parent: the element of an
    array, the key or the value of a map, a field of a struct. Arrays, maps and structs are
    named as such, other types as in the flat catalog.
    """
    rows: list[tuple] = []

    def add(parent: int | None, position: int, part: str, name: str | None, kind: T.DataType, nullable: bool) -> None:
        own = len(rows) + 1
        decimal = isinstance(kind, T.DecimalType)
        parts = nested_parts(kind)
        named = kind.typeName() if parts else DECLARED.get(kind.simpleString(), kind.simpleString())
        rows.append((
            schema, table, own, parent, position, part, name, "decimal" if decimal else named,
            "YES" if nullable else "NO", kind.precision if decimal else None, kind.scale if decimal else None,
        ))
        for i, (inner, inner_name, inner_kind, inner_nullable) in enumerate(parts, start=1):
            add(own, i, inner, inner_name, inner_kind, inner_nullable)

    for i, field in enumerate(df.schema.fields, start=1):
        add(None, i, "column", field.name, field.dataType, field.nullable)
    return small_frame(df.sparkSession, rows, NESTED_SCHEMA).orderBy("column_id")


def base_tables(tables: DataFrame, schema: str | None = None) -> DataFrame:
    """Base tables, of one schema (any case) or all, in name order."""
    chosen = tables.where(F.col("table_type") == "BASE TABLE")
    if schema is not None:
        chosen = chosen.where(F.lower("table_schema") == schema.lower())
    return chosen.orderBy("table_schema", "table_name")


def match_tables(tables: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    """Tables whose dotted name passes the glob patterns; case matters."""
    dotted = F.concat_ws(".", "table_catalog", "table_schema", "table_name")
    return tables.where(glob_match(dotted, include, exclude))


def require_tables(tables: DataFrame, scope: str) -> DataFrame:
    if tables.isEmpty():
        raise LookupError(f"no exportable tables found for {scope}")
    return tables
