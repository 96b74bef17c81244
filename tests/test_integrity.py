import pytest
from pyspark.sql import functions as F

from tablelift import ExportOptions
from tablelift.operators import manifest as m, pointer
from tablelift.operators.sinks import export_frame, export_slices
from tablelift.operators.slices import COVER_COLUMN, SLICE_COLUMN, predicate_slices, with_slice_number
from tablelift.plans.job import run_job
from tablelift.plans.tasks import one_table_tasks
from tablelift.sources.catalog import LakeSource
from tablelift.sources.readback import read_export
from tablelift.sources.tables import PinnedFilesChanged, changed_files, pin_files, read_pinned
from tablelift.storage import Store

KINDS = [("parquet", "snappy"), ("csv", "none"), ("json", "gzip"), ("csv", "zstd")]


def ids(spark, target, fmt, schema):
    return sorted(r.id for r in read_export(spark, target, fmt, schema).collect())


@pytest.mark.parametrize(("fmt", "codec"), KINDS)
def test_a_failed_overwrite_in_place_leaves_the_old_rows(spark, out, fmt, codec):
    df = spark.range(100).repartition(4)
    options = ExportOptions(target=out, format=fmt, compression=codec, in_place=True)
    assert export_frame(df, out, options).rows == 100
    names = set(Store(spark, out).files(out))
    broken = df.select(F.expr("IF(id = 50, raise_error('no'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        export_frame(broken, out, options)
    assert set(Store(spark, out).files(out)) == names and ids(spark, out, fmt, df.schema) == list(range(100))
    assert export_frame(df.where("id < 3"), out, options).rows == 3
    assert not names & set(Store(spark, out).files(out)) and ids(spark, out, fmt, df.schema) == [0, 1, 2]


@pytest.mark.parametrize(("fmt", "codec"), KINDS)
def test_files_of_a_run_that_died_are_not_read_and_go_with_the_next(spark, out, fmt, codec):
    df = spark.range(10).coalesce(1)
    options = ExportOptions(target=out, format=fmt, compression=codec, in_place=True)
    export_frame(df, out, options)
    store = Store(spark, out)
    name = next(iter(store.files(out)))
    export_frame(df, out + "-other", options)
    store.rename(f"{out}-other/{next(iter(store.files(out + '-other')))}", f"{out}/left-{name}")
    assert ids(spark, out, fmt, df.schema) == list(range(10))
    added = ExportOptions(target=out, format=fmt, compression=codec, in_place=True, mode="append")
    export_frame(df, out, added)
    assert ids(spark, out, fmt, df.schema) == sorted([*range(10)] * 2)
    assert len(store.files(out)) == 2


def test_the_first_write_in_place_keeps_what_lay_there(spark, out):
    spark.range(5).coalesce(1).write.parquet(out)
    options = ExportOptions(target=out, in_place=True)
    broken = spark.range(3).select(F.expr("raise_error('no')").cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        export_frame(broken, out, options)
    assert ids(spark, out, "parquet", spark.range(1).schema) == list(range(5))


def test_an_empty_overwrite_in_place_empties_the_target(spark, out):
    options = ExportOptions(target=out, in_place=True)
    export_frame(spark.range(5), out, options)
    assert export_frame(spark.range(0), out, options).files == 0
    assert ids(spark, out, "parquet", spark.range(1).schema) == []
    refusing = ExportOptions(target=out, in_place=True, mode="errorifexists")
    assert export_frame(spark.range(2), out, refusing).rows == 2
    with pytest.raises(FileExistsError):
        export_frame(spark.range(2), out, refusing)


def test_slices_in_place_are_read_by_their_pointers(spark, out):
    df, slices = spark.range(30), predicate_slices(["id % 3 = 0", "id % 3 = 1", "id % 3 = 2"])
    options = ExportOptions(target=out, in_place=True)
    done = export_slices(df, slices, out, options, whole=slices)
    assert [(p.slice_id, p.rows, p.rows_first, p.rows_several) for p in done] == [
        (s.id, 10, 10, 0) for s in slices
    ]
    store = Store(spark, out)
    assert len(pointer.current_files(store, out)) == sum(p.files for p in done)
    pointer.move(store, done[1].target, [])
    assert ids(spark, out, "parquet", df.schema) == [i for i in range(30) if i % 3 != 1]


@pytest.mark.parametrize("per_pass", [1, 32])
@pytest.mark.parametrize("codec", ["none", "zstd"])
def test_coverage_is_counted_by_row_as_it_is_written(spark, lake, out, per_pass, codec):
    options = ExportOptions(target=out + "/{table}", slices_per_pass=per_pass, format="json", compression=codec)
    texts = ["n_nationkey < 10", "n_nationkey >= 5 AND n_nationkey < 20"]
    results = run_job(lake, one_table_tasks(lake, "dbo", "nation", options), options, lambda t, f: predicate_slices(texts)).collect()
    assert [r.error for r in results] == [None, None, "5 rows are in no slice, 5 in several"]


def test_a_redone_slice_is_checked_with_those_of_earlier_runs(spark, lake, out):
    options = ExportOptions(target=out + "/{table}", manifest_dir=out + "-m", resume=True)
    tasks = one_table_tasks(lake, "dbo", "nation", options)
    broken = ["n_nationkey < 10", "CAST(n_name AS INT) = 1"]
    mended = ["n_nationkey < 10", "n_nationkey >= 12"]
    run_job(lake, tasks, options, lambda t, f: predicate_slices(broken), "j")
    results = run_job(lake, tasks, options, lambda t, f: predicate_slices(mended), "j").collect()
    assert sorted((r.status, r.error or "") for r in results) == [
        ("completed", ""), ("failed", "2 rows are in no slice, 0 in several"), ("skipped", "")
    ]


def test_cover_codes_by_row(spark):
    slices = predicate_slices(["id < 4", "id > 2", "id = 100"])
    rows = with_slice_number(spark.range(6), slices[1:], whole=slices).collect()
    assert sorted((r.id, r[SLICE_COLUMN], r[COVER_COLUMN]) for r in rows) == [(3, 0, 0), (4, 0, 1), (5, 0, 1)]


def test_records_come_after_those_that_were_read(spark, out, monkeypatch):
    key = {"job_id": "j", "table": "t", "partition_id": "p", "file_index": 0}
    manifest = m.Manifest(spark, out)
    item = manifest.open_work([key])[0]
    manifest.start([item])
    manifest.append([manifest.failed(item, "no")])
    # Another driver, with a clock an hour behind.
    now = m.time.time_ns()
    monkeypatch.setattr(m, "_clock", m.Clock())
    monkeypatch.setattr(m.time, "time_ns", lambda: now - 3_600_000_000_000)
    item = manifest.open_work([key])[0]
    assert item["attempt"] == 2
    manifest.start([item])
    manifest.append(manifest.finish(item, row_count=1))
    last = m.latest(manifest.records()).first()
    assert (last.status, last.attempt) == ("committed", 2)
    assert manifest.open_work([key]) == [] and m.illegal_moves(manifest.records()).count() == 0


def test_pins_tell_changed_and_missing_files(spark, out):
    spark.range(100).repartition(3).write.parquet(out)
    pin_files(spark.read.parquet(out), out + "-pins")
    schema = spark.range(1).schema
    assert changed_files(spark, out + "-pins") == [] and read_pinned(spark, out + "-pins", schema).count() == 100
    store = Store(spark, out)
    first, second, *_ = store.files(out)
    store.delete(f"{out}/{first}")
    assert [p.rsplit("/", 1)[1] for p in changed_files(spark, out + "-pins")] == [first]
    with pytest.raises(PinnedFilesChanged, match=first):
        read_pinned(spark, out + "-pins", schema)


def test_a_query_runs_under_its_callers_settings(spark, out):
    spark.range(3).write.parquet(out + "/t.parquet")
    source = LakeSource(spark, out, names=["t"])
    text = "SELECT count(*) AS n FROM t WHERE CAST(timestamp_micros(0) AS STRING) LIKE '%09:00%'"
    assert source.query(text).first().n == 0
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert source.query(text).first().n == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert source.query(text).first().n == 0


def unit(i, **facts):
    return {"job_id": "j", "table": "t", "partition_id": f"p{i}", "file_index": 0, **facts}


def test_a_log_of_many_units_is_read_from_few_files(spark, out):
    manifest = m.Manifest(spark, out, "j", compact_at=20)
    for i in range(90):
        manifest.append([unit(i, status="running", attempt=1), unit(i, status="uploaded", attempt=1)])
        if i % 2:
            manifest.append([unit(i, status="committed", attempt=1, row_count=i)])
    assert manifest.file_count() <= 21
    again = m.Manifest(spark, out, "j")
    assert again.records().count() == 225
    work = again.open_work([unit(i) for i in range(91)])
    assert sorted(int(w["partition_id"][1:]) for w in work) == [*range(0, 90, 2), 90]
    assert m.Manifest(spark, out).records().count() == 225
    # Files on disk: the last two generations, and the tail.
    assert len(Store(spark, out).files(out + "/job-j")) <= 44


def test_logs_merged_at_the_same_time_count_once(spark, out, monkeypatch):
    one, other = (m.Manifest(spark, out, "j", compact_at=1000) for _ in range(2))
    for i in range(6):
        one.append([unit(i, status="running", attempt=1)])
    before = one._listed(one.folder)
    one.compact()
    # The other driver has listed the log before that.
    listed = other._listed
    monkeypatch.setattr(other, "_listed", lambda folder: before)
    other.compact()
    monkeypatch.setattr(other, "_listed", listed)
    assert len(other._listed(other.folder)[0]) == 2 and other.records().count() == 6
    other.append([unit(7, status="running", attempt=1)])
    other.compact()
    assert one.records().count() == 7 and one.file_count() == 1


def test_a_state_that_was_not_finished_does_not_count(spark, out):
    manifest = m.Manifest(spark, out, "j", compact_at=1000)
    manifest.append([unit(1, status="running", attempt=1)])
    manifest.records().drop("stable_id").write.parquet(manifest.folder + "/state-left")
    assert manifest.records().count() == 1


def test_even_slices_of_any_spread(spark):
    from tablelift.operators.slices import even_slices, slice_report

    frames = {
        "cubed": spark.range(4000).selectExpr("id * id * id AS k"),
        "common": spark.range(4000).selectExpr("IF(id % 2 = 0, 7, id) AS k"),
        "nulls": spark.range(400).selectExpr("IF(id % 3 = 0, NULL, id) AS k"),
        "one": spark.range(50).selectExpr("5L AS k"),
        "dates": spark.range(500).selectExpr("date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS k"),
        "instants": spark.range(500).selectExpr("timestamp_micros(id * id * 1000003) AS k"),
        "decimals": spark.range(500).selectExpr("CAST(id / 7 AS decimal(12,3)) AS k"),
        "doubles": spark.range(500).selectExpr("IF(id = 3, double('NaN'), sqrt(id)) AS k"),
    }
    for name, df in frames.items():
        slices = even_slices(df, "k", 8)
        report = slice_report(df, slices, "k").collect()
        assert {r.slices_hit for r in report} == {1}, name
        sizes = sorted(r.row_count for r in report)
        assert sum(sizes) == df.count()
        if name in ("cubed", "instants", "decimals", "doubles"):
            assert len(sizes) == 8 and sizes[-1] <= 1.5 * sum(sizes) / 8, (name, sizes)
    assert even_slices(spark.range(0), "id", 4) == []
    with pytest.raises(ValueError, match="no ranges"):
        even_slices(spark.range(3).selectExpr("string(id) AS k"), "k", 2)


def test_nested_types_read_back(spark):
    from tablelift.functions.types import schema_from_nested
    from tablelift.sources.catalog import nested_columns

    text = (
        "a array<array<float>>, m map<string, struct<x: decimal(9,3), y: array<date>>>, "
        "s struct<t: timestamp_ntz, u: binary, v: struct<w: boolean>>, i int NOT NULL"
    )
    df = spark.createDataFrame([], text)
    assert schema_from_nested(nested_columns(df, "dbo", "t")) == df.schema
    rows = {(r.column_id, r.parent_id, r.part, r.data_type) for r in nested_columns(df, "dbo", "t").collect()}
    assert {(1, None, "column", "array"), (2, 1, "element", "array"), (3, 2, "element", "real")} <= rows


@pytest.mark.parametrize(("fmt", "codec"), KINDS)
def test_a_changed_or_doubled_row_is_found(spark, out, fmt, codec):
    from tablelift.operators.digest import digest_of
    from tablelift.operators.sinks import verify_export

    df = spark.range(40).selectExpr(
        "id", "IF(id = 3, NULL, CONCAT('t', id)) AS t", "id / 3 AS d", "array(id, NULL) AS a", "map('k', id) AS m"
    )
    options = ExportOptions(target=out, format=fmt, compression=codec, digest=True)
    done = export_frame(df, out, options)
    verify_export(spark, out, fmt, df.schema, done.digest)
    assert done.digest == digest_of(df.repartition(7))
    for other in (
        df.withColumn("d", F.expr("IF(id = 7, d + 1e-9, d)")), df.union(df.where("id = 1")), df.where("id <> 2"),
        df.withColumn("m", F.expr("IF(id = 9, map('k', 0), m)")),
    ):
        assert digest_of(other) != done.digest
        export_frame(other, out, ExportOptions(target=out, format=fmt, compression=codec))
        with pytest.raises(ValueError, match="not those"):
            verify_export(spark, out, fmt, df.schema, done.digest)


def test_digests_of_slices_are_of_their_rows(spark, out):
    from tablelift.operators.digest import digest_of

    df, slices = spark.range(30), predicate_slices(["id % 3 = 0", "id % 3 > 0"])
    done = export_slices(df, slices, out, ExportOptions(target=out, digest=True), whole=slices)
    assert [p.digest for p in done] == [digest_of(df.where(s.predicate)) for s in slices]


def test_a_sliced_increment_is_committed_as_a_whole(spark, out):
    from tablelift.operators.incremental import committed_watermark, export_new_slices

    options = ExportOptions(target=out)
    manifest = m.Manifest(spark, out + "-m")
    df = spark.range(20).selectExpr("id", "IF(id < 2, NULL, id) AS mark")
    parts = lambda fresh: predicate_slices(["id % 2 = 0", "id % 2 = 1"])
    lossy = lambda fresh: predicate_slices(["id % 2 = 0", "id % 4 = 1"])
    with pytest.raises(ValueError, match="5 rows are in no slice"):
        export_new_slices(df, "mark", out, options, manifest, "t", lossy)
    assert committed_watermark(manifest, "t") == (0, None)
    assert [p.rows for p in export_new_slices(df, "mark", out, options, manifest, "t", parts)] == [10, 10]
    assert committed_watermark(manifest, "t") == (1, "19")
    assert export_new_slices(df, "mark", out, options, manifest, "t", parts) == []
    more = df.union(spark.range(20, 25).selectExpr("id", "id AS mark"))
    assert [p.rows for p in export_new_slices(more, "mark", out, options, manifest, "t", parts)] == [3, 2]
    assert sorted(r.id for r in read_export(spark, out, "parquet", df.schema).collect()) == list(range(25))


def test_tables_start_in_order_of_size_and_results_stay_in_order(spark, lake, out, monkeypatch):
    from tablelift.plans import job
    from tablelift.plans.tasks import schema_tasks

    started = []
    plain = job._Job.run
    monkeypatch.setattr(job._Job, "run", lambda self, planned: started.append(planned.task.table_name) or plain(self, planned))
    options = ExportOptions(target=out + "/{table}", table_concurrency=1)
    tasks = schema_tasks(lake, "dbo", options, include=["*.nation", "*.lineitem", "*.part"])
    results = run_job(lake, tasks, options).collect()
    assert started == ["lineitem", "part", "nation"]
    assert [r.target.rsplit("/", 1)[1] for r in results] == ["lineitem", "nation", "part"]
