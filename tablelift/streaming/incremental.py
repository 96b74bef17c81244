"""Incremental export of a growing folder as a stream that ends when caught up."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, types as T

from tablelift.operators.sinks import export_frame
from tablelift.options import ExportOptions


def export_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    options: ExportOptions,
    checkpoint: str,
    files_per_batch: int = 1_000,
) -> int:
    """Export every Parquet file of ``folder`` that no earlier call exported.

    Each micro-batch owns the folder of its number, which a repeated batch
    replaces, so files are exported once even if a run dies. Returns the number
    of rows exported by this call.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    replacing = replace(options, mode="overwrite")
    rows: list[int] = []

    def publish(batch: DataFrame, number: int) -> None:
        done = export_frame(batch, f"{target.rstrip('/')}/batch-{number:08d}", replacing)
        rows.append(done.rows)

    query = (
        arrivals.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(rows)
