"""Relational source over JDBC: tables, catalogs, and slices as JDBC partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablelift.operators.slices import Slice

# Driver class, default port and catalog queries of the source database.
DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
DEFAULT_PORT = 1433
TABLES_QUERY = (
    "select table_catalog, table_schema, table_name, table_type from information_schema.tables"
)
COLUMNS_QUERY = (
    "select table_schema, table_name, ordinal_position, column_name, data_type, is_nullable, "
    "cast(numeric_precision as int) as numeric_precision, "
    "cast(numeric_scale as int) as numeric_scale from information_schema.columns"
)
SNAPSHOT_STATEMENT = "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"


class JdbcSource:
    def __init__(
        self,
        spark: SparkSession,
        host: str,
        database: str,
        user: str | None = None,
        password: str | None = None,
        port: int = DEFAULT_PORT,
        trust_certificate: bool = True,
        snapshot_database: str | None = None,
        fetch_size: int = 10_000,
        consistency: str = "snapshot_transaction",
    ):
        if not host.strip() or not database.strip():
            raise ValueError("host and database are required")
        if consistency == "database_snapshot" and not snapshot_database:
            raise ValueError("database_snapshot needs the name of the snapshot database")
        self.spark = spark
        self.database = snapshot_database or database
        self.consistency = consistency
        self.options = {
            "url": (
                f"jdbc:sqlserver://{host}:{port};databaseName={self.database};"
                f"encrypt=true;trustServerCertificate={str(trust_certificate).lower()}"
            ),
            "driver": DRIVER,
            "fetchsize": str(fetch_size),
            **({"user": user, "password": password or ""} if user else {}),
        }

    def _single(self) -> dict[str, str]:
        """Options of a one-connection read, which one transaction can cover."""
        if self.consistency == "snapshot_transaction":
            return {**self.options, "sessionInitStatement": SNAPSHOT_STATEMENT}
        return dict(self.options)

    def _load(self, **extra: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self._single(), **extra).load()

    def tables(self) -> DataFrame:
        return self._load(query=TABLES_QUERY)

    def columns(self, schema: str, table: str) -> DataFrame:
        rows = self._load(query=COLUMNS_QUERY)
        chosen = rows.where((rows.table_schema == schema) & (rows.table_name == table))
        return chosen.orderBy("ordinal_position")

    def frame(self, schema: str, table: str) -> DataFrame:
        return self._load(dbtable=f"{quoted(schema)}.{quoted(table)}")

    def query(self, sql: str) -> DataFrame:
        return self._load(query=sql)

    def check_slices(self, slices: list[Slice]) -> None:
        """Refuses what no one transaction can cover, however the slices are run."""
        if self.consistency == "snapshot_transaction" and len(slices) > 1:
            raise ValueError("snapshot_transaction reads one slice; use database_snapshot")

    def sliced(self, schema: str, table: str, slices: list[Slice]) -> DataFrame:
        """One JDBC partition per slice, each on its own connection.

        Connections do not share a transaction, so more than one slice is refused
        under ``snapshot_transaction``; a database snapshot has no such limit.
        """
        if self.consistency == "snapshot_transaction":
            self.check_slices(slices)
            df = self.frame(schema, table)
            return df if slices[0].predicate is None else df.where(slices[0].predicate)
        properties = {k: v for k, v in self.options.items() if k != "url"}
        return self.spark.read.jdbc(
            self.options["url"],
            f"{quoted(schema)}.{quoted(table)}",
            predicates=[s.predicate or "1 = 1" for s in slices],
            properties=properties,
        )


def quoted(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"
