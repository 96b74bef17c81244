import pytest
from pyspark.sql import functions as F

from tablelift import ExportOptions
from tablelift.operators.digest import digest_of
from tablelift.operators.sinks import export_frame, export_slices, verify_export
from tablelift.operators.slices import predicate_slices
from tablelift.sources.readback import read_export
from tablelift.storage import Store

KINDS = [("parquet", "none"), ("parquet", "snappy"), ("parquet", "zstd"), ("csv", "none"), ("csv", "gzip"), ("tsv", "zstd"), ("json", "zstd")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).selectExpr(
        "id", "IF(id % 9 = 0, NULL, CONCAT('t, \"', sha2(string(id), 256), '\n')) AS t", "CAST(id AS decimal(12,3)) AS d",
        "array(id, NULL) AS a", "named_struct('x', id, 'y', date_add(DATE '2024-01-01', 3)) AS s", "map('k', id / 3) AS m",
        "timestamp_micros(id * 1000001) AS at", "CAST(timestamp_micros(id) AS timestamp_ntz) AS local",
        "unhex(hex(id)) AS b", "CAST(id % 100 AS tinyint) AS i", "id / 7 AS f",
    )


@pytest.mark.parametrize(("fmt", "codec"), KINDS)
def test_rows_come_back_and_files_hold_the_size(spark, rows, out, fmt, codec):
    target = 40_000
    options = ExportOptions(target=out, format=fmt, compression=codec, target_file_bytes=target, arrow_files=True, digest=True)
    df = rows.repartition(3)
    done = export_frame(df, out, options)
    assert done.rows == 4000 and done.digest == digest_of(rows)
    verify_export(spark, out, fmt, rows.schema, done.digest)
    sizes = list(Store(spark, out).files(out).values())
    assert done.files == len(sizes) > 4 and done.bytes == sum(sizes)
    assert max(sizes) <= 1.25 * target
    # All but a task's last files are filled.
    assert sum(s < 0.6 * target for s in sizes) <= 4


@pytest.mark.parametrize(("fmt", "codec"), [("parquet", "snappy"), ("csv", "gzip"), ("json", "zstd")])
def test_slices_are_written_from_one_scan(spark, rows, out, fmt, codec):
    slices = predicate_slices(["id < 3000", "id >= 3000 AND id < 3010", "id >= 3010", "id < 0"])
    options = ExportOptions(target=out, format=fmt, compression=codec, arrow_files=True)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    scanned = rows.mapInArrow(counted, rows.schema)
    done = export_slices(scanned, slices, out, options, whole=slices)
    # Once to count the slices, once to write them all.
    assert seen.value == 2 * 4000
    assert [(p.slice_id, p.rows, p.rows_first) for p in done] == [(s.id, n, n) for s, n in zip(slices, (3000, 10, 990, 0))]
    back = read_export(spark, out, fmt, rows.schema)
    assert digest_of(back) == digest_of(rows)
    assert read_export(spark, done[1].target, fmt, rows.schema).count() == 10 and done[3].files == 0


def test_a_row_limit_is_exact(spark, out):
    options = ExportOptions(target=out, max_rows_per_file=70, arrow_files=True)
    export_frame(spark.range(500).coalesce(1), out, options)
    back = spark.read.parquet(out).groupBy(F.col("_metadata.file_name")).count().collect()
    assert sorted(r["count"] for r in back) == [10, *[70] * 7]


def test_a_failed_write_leaves_the_old_slices(spark, out):
    slices = predicate_slices(["id < 50", "id >= 50"])
    options = ExportOptions(target=out, arrow_files=True)
    df = spark.range(100)
    export_slices(df, slices, out, options)
    names = [set(Store(spark, out).files(f"{out}/{s.id}")) for s in slices]
    broken = df.select(F.expr("IF(id = 77, raise_error('no'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        export_slices(broken, slices, out, options)
    assert [set(Store(spark, out).files(f"{out}/{s.id}")) for s in slices] == names
    appended = ExportOptions(target=out, arrow_files=True, mode="append")
    export_slices(df, slices, out, appended)
    assert sorted(r.id for r in read_export(spark, out, "parquet", df.schema).collect()) == sorted([*range(100)] * 2)


def test_nothing_to_write(spark, out):
    options = ExportOptions(target=out, arrow_files=True, format="csv")
    done = export_frame(spark.range(0), out, options)
    assert (done.rows, done.files) == (0, 0) and read_export(spark, out, "csv", spark.range(0).schema).count() == 0
