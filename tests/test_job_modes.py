"""Jobs whose results depend on modes, limits and faults."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from conftest import SMALL, same_rows
from pyspark.sql import functions as F, types as T

from tablelift.functions.types import cast_loss, schema_from_columns
from tablelift.operators import sinks
from tablelift.operators.incremental import export_new_rows
from tablelift.operators.manifest import Manifest
from tablelift.operators.ordered import previous_by_key
from tablelift.operators.sinks import export_frame
from tablelift.operators.slices import predicate_slices, slice_report, template_slices
from tablelift.options import ExportOptions
from tablelift.plans.job import run_job
from tablelift.plans.tasks import one_table_tasks
from tablelift.sources.catalog import LakeSource, frame_columns
from tablelift.sources.readback import read_export
from tablelift.storage import RENAMING_SCHEMES, Store, file_stats


def nation_tasks(lake, options, predicate=None):
    return one_table_tasks(lake, "dbo", "nation", options, predicate)


def test_options_are_settled_once():
    options = ExportOptions(target="/x", max_rows_per_file=5).checked()
    assert options.checked() is options and options.checked().max_rows_per_file == 5
    both = ExportOptions(target="/x", max_rows_per_file=5, target_file_bytes=100, both_limits=True).checked()
    assert (both.max_rows_per_file, both.target_file_bytes) == (5, 100)


def test_an_empty_append_in_place_keeps_earlier_files(spark, out, monkeypatch):
    monkeypatch.setattr("tablelift.storage.RENAMING_SCHEMES", RENAMING_SCHEMES - {"file"})
    options = ExportOptions(target=out, mode="append")
    first = export_frame(spark.range(10), out, options)
    none = export_frame(spark.range(0), out, options)
    again = export_frame(spark.range(5), out, options)
    assert (none.rows, none.files) == (0, 0) and again.files < file_stats(spark, out).count()
    assert first.rows == 10 and spark.read.parquet(out).count() == 15


def test_zstd_text_is_written_in_place_where_renames_copy(spark, out, monkeypatch):
    monkeypatch.setattr("tablelift.storage.RENAMING_SCHEMES", RENAMING_SCHEMES - {"file"})
    options = ExportOptions(target=out, format="json", compression="zstd")
    for mode, rows, wanted in (("overwrite", 30, 30), ("append", 5, 35), ("append", 0, 35), ("overwrite", 7, 7)):
        done = export_frame(spark.range(rows), out, replace(options, mode=mode))
        assert done.rows == rows
        assert read_export(spark, out, "json", spark.range(1).schema).count() == wanted
    assert done.files == file_stats(spark, out).count()


def test_appends_are_numbered_after_the_highest(spark, out):
    options = ExportOptions(target=out, mode="append")
    for _ in range(3):
        export_frame(spark.range(3).coalesce(1), out, options)
    Store(spark, out).delete(f"{out}/part-00000.parquet")
    export_frame(spark.range(3).coalesce(1), out, options)
    assert sorted(Store(spark, out).files(out)) == [f"part-0000{i}.parquet" for i in (1, 2, 3)]


def test_a_failed_append_leaves_nothing_behind(spark, out, monkeypatch):
    options = ExportOptions(target=out, mode="append", max_rows_per_file=2)
    export_frame(spark.range(2).coalesce(1), out, options)
    monkeypatch.setattr(sinks, "_next_index", lambda files, options: 0)
    with pytest.raises(Exception):
        export_frame(spark.range(6).coalesce(1), out, options)
    assert spark.read.parquet(out).count() == 2


def test_zoned_slices_and_watermarks_hold_in_any_zone(spark, out):
    df = spark.range(400).select("id", F.timestamp_micros(F.col("id") * 3_600_000_001).alias("at"))
    manifest, options = Manifest(spark, out + "-m", "w"), ExportOptions(target=out)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        counts = []
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            report = slice_report(df, template_slices(df, "at", "at BETWEEN {lo} AND {hi}", 5), "at").collect()
            assert {r.slices_hit for r in report} == {1} and sum(r.row_count for r in report) == 400
            done = export_new_rows(df, "at", out, options, manifest, "w")
            counts.append(done.rows if done else 0)
        assert counts == [400, 0, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_modes_that_cannot_hold_are_refused(spark, lake, out):
    with pytest.raises(ValueError, match="watermark_column"):
        options = ExportOptions(target=out, consistency="high_watermark", manifest_dir=out + "-m")
        run_job(lake, nation_tasks(lake, options), options, job_id="j")
    with pytest.raises(ValueError, match="job_id"):
        options = ExportOptions(target=out, resume=True, manifest_dir=out + "-m")
        run_job(lake, nation_tasks(lake, options), options)
    options = ExportOptions(target=out, consistency="database_snapshot")
    assert "manifest_dir" in run_job(lake, nation_tasks(lake, options), options).first().error


class StandIn(LakeSource):
    """A source that reads by slices, as a database does."""

    checked = 0

    def check_slices(self, slices):
        self.checked += 1
        if len(slices) > 2:
            raise ValueError("too many slices")

    def sliced(self, schema, table, slices):
        parts = [self.frame(schema, table).where(s.predicate).coalesce(1) for s in slices]
        return parts[0].union(parts[1]) if len(parts) > 1 else parts[0]


def test_sliced_sources_keep_the_filter_and_are_checked_as_a_whole(spark, out):
    source = StandIn(spark, SMALL)
    options = ExportOptions(target=out + "/{table}", slices_per_pass=1)
    slices = predicate_slices(["n_nationkey < 10", "n_nationkey >= 10"])
    tasks = nation_tasks(source, options, "n_regionkey = 1")
    results = run_job(source, tasks, options, lambda t, f: slices).collect()
    wanted = source.frame("dbo", "nation").where("n_regionkey = 1").count()
    assert sum(r.rows for r in results) == wanted and all(r.status == "completed" for r in results)
    many = run_job(source, tasks, options, lambda t, f: predicate_slices(["true"] * 3)).first()
    assert many.error == "too many slices"


def test_one_bad_slice_fails_alone(spark, lake, out):
    options = ExportOptions(target=out + "/{table}", manifest_dir=out + "-m")
    texts = ["n_nationkey < 10", "no_such_column = 1", "n_nationkey >= 10", "CAST(n_name AS INT) = 1"]
    results = run_job(lake, nation_tasks(lake, options), options, lambda t, f: predicate_slices(texts), "j")
    assert {r.slice_id: r.status for r in results.collect()} == {
        "p00000000": "completed", "p00000001": "failed", "p00000002": "completed", "p00000003": "failed"
    }
    last = Manifest(spark, out + "-m", "j").records().groupBy("partition_id").agg(F.max_by("status", "seq").alias("s"))
    assert {r.partition_id: r.s for r in last.collect()}["p00000002"] == "committed"


def test_queries_of_two_sources_side_by_side(spark, tmp_path):
    roots = [str(tmp_path / name) for name in ("a", "b")]
    for i, root in enumerate(roots):
        spark.range(i, i + 1).write.parquet(f"{root}/t.parquet")
    sources = [LakeSource(spark, root) for root in roots]
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda i: sources[i % 2].query("SELECT id FROM t").first().id, range(40)))
    assert found == [0, 1] * 20


def test_catalog_rows_give_back_their_types(spark):
    fields = {
        "a": T.LongType(), "b": T.BooleanType(), "c": T.DoubleType(), "d": T.FloatType(), "e": T.StringType(),
        "f": T.TimestampType(), "g": T.TimestampNTZType(), "h": T.DateType(), "i": T.BinaryType(),
        "j": T.DecimalType(12, 3), "k": T.IntegerType(), "l": T.ShortType(),
    }
    schema = T.StructType([T.StructField(n, kind, n != "a") for n, kind in fields.items()])
    assert schema_from_columns(frame_columns(spark.createDataFrame([], schema), "s", "t")) == schema


def test_cast_loss_takes_names_in_any_case(spark):
    df = spark.createDataFrame([("1",), ("x",)], "Number string")
    schema = T.StructType([T.StructField("NUMBER", T.IntegerType())])
    assert [(r.values_before, r.lost) for r in cast_loss(df, schema).collect()] == [(2, 1)]
    assert cast_loss(df, T.StructType([T.StructField("other", T.IntegerType())])).collect() == []


def test_previous_rows_of_null_keys_and_orders(spark):
    rows = [(None, 1, "a"), (None, 2, "b"), ("k", None, "c"), ("k", 5, "d"), ("k", 9, "e")]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    for blocks in (1, 4):
        found = previous_by_key(df, "k", "o", "v", "before", blocks).collect()
        assert {r.v: r.before for r in found} == {"a": None, "b": "a", "c": None, "d": "c", "e": "d"}


def test_a_range_of_dates_with_rows_outside_fails_the_task(spark, lake, out):
    options = ExportOptions(target=out + "/{table}")
    tasks = one_table_tasks(lake, "dbo", "orders", options)
    slices = predicate_slices([f"o_orderdate < DATE '{dt.date(1995, 1, 1)}'"])
    assert run_job(lake, tasks, options, lambda t, f: slices * 1).where("status = 'failed'").count() == 1


def test_both_sides_of_a_slice_plan_agree(spark, lake):
    orders = lake.frame("dbo", "orders")
    slices = template_slices(orders, "o_orderkey", "o_orderkey BETWEEN {lo} AND {hi}", 3)
    kept = [orders.where(s.predicate) for s in slices]
    assert same_rows(kept[0].union(kept[1]).union(kept[2]), orders)
