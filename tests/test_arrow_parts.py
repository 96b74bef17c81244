"""Parts of files that tasks cut themselves are as large as what they shrink to allows."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tablelift import ExportOptions
from tablelift.operators.sinks import export_frame
from tablelift.sources.readback import read_export
from tablelift.storage import Store

SIZE = 256 * 1024


def test_row_groups_of_rows_that_shrink_are_not_tiny(spark, out):
    rows = spark.range(0, 200_000, 1, 2).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    done = export_frame(rows, out, ExportOptions(target=out, arrow_files=True, compression="zstd", target_file_bytes=SIZE))
    sizes = Store(spark, out).files(out)
    groups = sum(pq.ParquetFile(f"{out}/{name}").metadata.num_row_groups for name in sizes)
    # A row is about 20 bytes in memory; parts of a sixteenth of a file would be over 240.
    assert done.rows == 200_000 and groups <= 120 and max(sizes.values()) <= 1.25 * SIZE
    assert read_export(spark, out, "parquet", rows.schema).select("id").distinct().count() == 200_000


def test_rows_that_stop_shrinking_do_not_pass_the_limit(spark, out):
    text = F.when(F.col("id") % 4_000 < 3_000, F.lit("x" * 64)).otherwise(F.sha2(F.col("id").cast("string"), 256))
    rows = spark.range(0, 80_000, 1, 1).select("id", text.alias("text"))
    for fmt, codec in (("parquet", "zstd"), ("csv", "zstd"), ("json", "gzip")):
        target = f"{out}/{fmt}"
        options = ExportOptions(target=target, format=fmt, compression=codec, arrow_files=True, target_file_bytes=SIZE)
        assert export_frame(rows, target, options).rows == 80_000
        assert max(Store(spark, target).files(target).values()) <= 1.25 * SIZE
