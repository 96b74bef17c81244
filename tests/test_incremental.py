import random

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tablelift.operators import incremental
from tablelift.operators.incremental import committed_watermark, export_new_rows, late_rows
from tablelift.operators.manifest import Manifest, illegal_moves
from tablelift.options import ExportOptions
from tablelift.sources.readback import read_export
from tablelift.sources.tables import pin_files, read_pinned, scan
from tablelift.streaming.incremental import export_new_files


@pytest.fixture
def manifest(spark, out):
    return Manifest(spark, out + "-manifest")


def run(df, out, manifest):
    done = export_new_rows(df, "mark", out, ExportOptions(target=out), manifest, "job")
    return done.rows if done else None


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int", ["1", "2", "2", "3", "4"]),
        ("timestamp_ntz", [f"2024-01-0{i} 00:00:00.00000{i}" for i in (1, 2, 2, 3, 4)]),
        ("date", ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-04"]),
        ("double", ["0.1", "0.2", "0.2", "0.30000000000000004", "1e300"]),
        ("decimal(20,4)", ["1.0001", "1.0002", "1.0002", "1.0003", "9999999999.0001"]),
        ("string", ["a", "b", "b", "c", "d"]),
    ],
)
def test_each_row_is_exported_once(spark, out, manifest, kind, values):
    rows = [(i, v) for i, v in enumerate(values)]
    everything = spark.createDataFrame(rows, "id int, mark string").select(
        "id", F.col("mark").cast(kind).alias("mark")
    )
    assert run(everything.where("id < 3"), out, manifest) == 3
    assert run(everything, out, manifest) == 2
    assert run(everything, out, manifest) is None
    assert same_rows(read_export(spark, out, "parquet", everything.schema), everything)
    assert illegal_moves(manifest.records()).count() == 0


def test_first_run_takes_rows_without_a_value(spark, out, manifest):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, mark int")
    assert run(df, out, manifest) == 2
    assert run(df, out, manifest) is None


def test_run_that_died_before_its_commit_is_repeated_not_doubled(spark, out, manifest, monkeypatch):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, mark int")
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "finish", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            run(df, out, manifest)
    assert committed_watermark(manifest, "job") == (0, None)
    assert run(df, out, manifest) == 2
    assert committed_watermark(manifest, "job") == (1, "6")
    assert read_export(spark, out, "parquet", df.schema).count() == 2
    assert illegal_moves(manifest.records()).count() == 0


def test_failed_run_is_logged_and_raised(spark, out, manifest):
    df = spark.createDataFrame([(1, 5)], "id int, mark int")
    bad = df.withColumn("x", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        run(bad, out, manifest)
    last = manifest.records().orderBy(F.desc("seq")).first()
    assert last.status == "failed" and last.error
    assert run(df, out, manifest) == 1


@pytest.mark.parametrize("few", [True, False])
def test_late_rows_against_brute_force(spark, monkeypatch, few):
    """One missing key holds a third of the rows; keys and marks may be NULL."""
    if not few:
        monkeypatch.setattr(incremental, "BROADCAST_KEYS", 0)
    draw = random.Random(5)
    source = [
        (
            None if draw.random() < 0.05 else 7 if draw.random() < 0.33 else draw.randrange(40),
            draw.choice(["x", None]),
            None if draw.random() < 0.1 else draw.randrange(100),
            i,
        )
        for i in range(600)
    ]
    exported = [r for r in source if r[0] != 7 and r[0] is not None and r[0] % 3 and draw.random() < 0.8]
    known = {(r[0], r[1]) for r in exported}
    expected = sorted(
        r[3] for r in source if (r[2] is None or r[2] <= 60) and (r[0], r[1]) not in known
    )
    schema = "a int, b string, mark int, n int"
    late = late_rows(
        spark.createDataFrame(source, schema),
        spark.createDataFrame(exported, schema),
        ["a", "b"],
        "mark",
        60,
        salts=4,
    )
    assert late.columns == ["a", "b", "mark", "n"]
    assert sorted(r.n for r in late.collect()) == expected


def test_stream_exports_each_file_once(spark, out):
    landing, state = out + "-landing", out + "-state"
    options = ExportOptions(target=out, format="json", compression="gzip")
    df = spark.range(0, 100, numPartitions=4)
    seen = []
    for low in (0, 100):
        df.select((F.col("id") + low).alias("id")).write.mode("append").parquet(landing)
        seen.append(
            export_new_files(spark, landing, df.schema, out, options, state, files_per_batch=3)
        )
    seen.append(export_new_files(spark, landing, df.schema, out, options, state))
    assert seen == [100, 100, 0]
    assert same_rows(read_export(spark, out, "json", df.schema), spark.range(200))


def test_stream_batch_that_is_repeated_replaces_its_files(spark, out):
    landing = out + "-landing"
    options = ExportOptions(target=out)
    spark.range(10).write.parquet(landing)
    schema = spark.range(1).schema
    # A state folder that was lost: the same files come as batch 0 again.
    for attempt in ("a", "b"):
        export_new_files(spark, landing, schema, out, options, f"{out}-state-{attempt}")
    assert read_export(spark, out, "parquet", schema).count() == 10


def test_pinned_files_hide_later_ones(spark, out):
    spark.range(10).write.parquet(out)
    before = spark.read.parquet(out)
    pin_files(before, out + "-pins")
    spark.range(5).write.mode("append").parquet(out)
    assert spark.read.parquet(out).count() == 15
    assert read_pinned(spark, out + "-pins", before.schema).count() == 10


def test_scan_prunes_and_pushes_down(lake):
    df = scan(lake.frame("dbo", "orders"), ["o_custkey", "o_orderkey"], "o_totalprice > 1000")
    assert df.columns == ["o_custkey", "o_orderkey"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,1000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    assert scan(lake.frame("dbo", "nation")).columns == ["n_nationkey", "n_name", "n_regionkey"]
