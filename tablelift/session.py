"""Where a job may put intermediate files."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tablelift-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short list of the driver's as a frame the optimizer can work on itself.

    Handed over as one Arrow table it is a local relation, so that filters and
    projections of task lists and catalogs need no Spark job.
    """
    fields = T._parse_datatype_string(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    wanted = to_arrow_schema(fields)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, wanted.types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=wanted), fields)
