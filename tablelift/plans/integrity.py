"""Named queries on what an export holds to when something goes wrong, and the same as SQL.

Each runs real jobs over whole tables, lets a part of them fail or change, and returns what
is found afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelift.operators.incremental import export_new_rows
from tablelift.operators.manifest import LEGAL_MOVES, PLANNED_AGAIN, Manifest, illegal_moves, latest
from tablelift.functions.types import conform, schema_from_nested
from tablelift.operators.sinks import export_frame, export_slices, verify_export
from tablelift.operators.slices import even_slices, predicate_slices
from tablelift.options import ExportOptions
from tablelift.plans.job import raise_on_failure, run_job, verify_job
from tablelift.plans.queries import lake, table
from tablelift.plans.tasks import one_table_tasks, schema_tasks
from tablelift.session import fresh_dir, small_frame
from tablelift.sources.catalog import LakeSource, nested_columns
from tablelift.sources.readback import read_export
from tablelift.storage import Store

IN_PLACE = (("parquet", "snappy"), ("csv", "none"), ("json", "zstd"))


def overwrite_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written where they stay, then overwritten by an export that fails halfway, and
    by one that does not. What a reader finds after each, and files no reader should find."""
    orders = table(spark, sf_dir, "orders")
    failing = orders.withColumn(
        "o_orderstatus", F.expr("IF(o_orderkey % 1000 = 7, raise_error('cannot be read'), o_orderstatus)")
    )
    dear = orders.where("o_totalprice > 100000")
    found = []
    for fmt, codec in IN_PLACE:
        target = fresh_dir(spark, "in-place")
        options = ExportOptions(target=target, format=fmt, compression=codec, in_place=True)
        for step, rows in (("first", orders), ("failed", failing), ("second", dear)):
            try:
                export_frame(rows, target, options)
            except Exception:
                if step != "failed":
                    raise
            back = read_export(spark, target, fmt, orders.schema)
            stray = len(Store(spark, target).files(target)) - len(back.inputFiles())
            state = back.agg(F.count(F.lit(1)), F.sum("o_orderkey")).first()
            found.append((fmt, step, state[0], state[1], stray))
    return small_frame(spark, found, "format string, step string, row_count long, key_sum long, stray_files long")


def _covered(spark: SparkSession, sf_dir: str, predicates: list[str], runs: int, label: str, **options) -> DataFrame:
    """Results of the runs of one sliced job over orders."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, label)
    wanted = ExportOptions(target=home + "/{table}", manifest_dir=home + "-manifest", resume=True, **options)
    tasks = one_table_tasks(source, "dbo", "orders", wanted)
    results = [
        run_job(source, tasks, wanted, lambda task, frame: predicate_slices(predicates), label)
        .select(F.lit(run).alias("run"), "slice_id", "status", "rows", "error")
        for run in range(1, runs + 1)
    ]
    return reduce(DataFrame.unionByName, results)


def coverage_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that leave as many rows out as they keep twice, so that no total tells."""
    predicates = ["o_orderkey % 4 = 0", "o_orderkey % 4 IN (1, 0)", "o_orderkey % 4 = 2"]
    return _covered(spark, sf_dir, predicates, 1, "balanced").drop("run")


def coverage_after_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that leave rows out: the job fails, and again when it is resumed."""
    predicates = ["o_orderkey % 3 = 0", "o_orderkey % 3 = 1"]
    return _covered(spark, sf_dir, predicates, 2, "resumed", slices_per_pass=1)


def resume_other_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resumed job with other predicates under the same ids: what changed is done again."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "other-predicates")
    options = ExportOptions(target=home + "/{table}", manifest_dir=home + "-manifest", resume=True)
    tasks = one_table_tasks(source, "dbo", "orders", options)
    for texts in (("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"), ("o_orderkey % 2 = 0", "o_orderkey % 2 <> 0")):
        results = run_job(source, tasks, options, lambda task, frame: predicate_slices(list(texts)), "other")
    manifest = Manifest(spark, options.manifest_dir, "other")
    illegal = illegal_moves(manifest.records(), (*LEGAL_MOVES, PLANNED_AGAIN)).count()
    back = read_export(spark, home + "/orders", "parquet", table(spark, sf_dir, "orders").schema)
    state = back.agg(F.count(F.lit(1)).alias("rows_found"), F.count_distinct("o_orderkey").alias("keys_found"))
    last = latest(manifest.records()).select(F.col("partition_id").alias("slice_id"), "attempt")
    return results.select("slice_id", "status").join(last, "slice_id").crossJoin(F.broadcast(state)).withColumn(
        "illegal_moves", F.lit(illegal).cast("long")
    )


def pinned_files_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over pinned files, resumed after one of them was written anew with other rows."""
    home = fresh_dir(spark, "repinned")
    orders = table(spark, sf_dir, "orders")
    orders.repartition(4, "o_orderkey").write.parquet(home + "/lake/orders.parquet")
    options = ExportOptions(
        target=home + "/out/{table}/{partition}", manifest_dir=home + "/manifest", resume=True,
        consistency="database_snapshot", slices_per_pass=1,
    )
    texts = [f"o_orderkey % 3 = {i}" for i in range(3)]
    found = []
    for step in ("first", "unchanged", "changed"):
        if step == "changed":
            store = Store(spark, home)
            name = next(iter(store.files(home + "/lake/orders.parquet")))
            orders.where("o_orderkey % 2 = 0").coalesce(1).write.parquet(home + "/other")
            store.delete(f"{home}/lake/orders.parquet/{name}")
            store.rename(f"{home}/other/{next(iter(store.files(home + '/other')))}", f"{home}/lake/orders.parquet/{name}")
        source = LakeSource(spark, home + "/lake", names=["orders"])
        results = run_job(
            source, one_table_tasks(source, "dbo", "orders", options), options,
            lambda task, frame: predicate_slices(texts), "pinned",
        ).collect()
        error = next((r.error for r in results if r.error), None)
        told = "no error" if error is None else "named" if "1 pinned files have changed" in error and name in error else error
        found.append((step, len(results), results[0].status, sum(r.rows for r in results), told))
    return small_frame(spark, found, "step string, results long, status string, row_count long, told string")


def watermark_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose mark is NULL in all rows, exported three times; then some get one."""
    events = table(spark, sf_dir, "events")
    unmarked = events.withColumn("at", F.lit(None).cast("timestamp_ntz"))
    marked = events.withColumn("at", F.expr("IF(event_id % 2 = 0, ts, NULL)"))
    target = fresh_dir(spark, "all-null")
    manifest = Manifest(spark, target + "-manifest")
    options = ExportOptions(target=target, consistency="high_watermark")
    found = []
    for run, state in enumerate((unmarked, unmarked, unmarked, marked, marked), start=1):
        out = export_new_rows(state, "at", target, options, manifest, "events")
        found.append((run, 0 if out is None else out.rows))
    return small_frame(spark, found, "run int, row_count long")


def query_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query through a source under the settings its caller has at that moment."""
    source = lake(spark, sf_dir)
    text = "SELECT o_orderkey, CAST(timestamp_micros(o_orderkey * 3600000000) AS STRING) AS at, "
    before = {key: spark.conf.get(key, None) for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        rows = source.query(text + "CAST(o_orderstatus AS INT) IS NULL AS unread FROM orders")
        target = fresh_dir(spark, "session")
        export_frame(rows, target, ExportOptions(target=target))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return read_export(spark, target, "parquet", rows.schema)


def slice_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in slices of even weight by a key whose values thin out, and by one that has
    half of the rows at one value; sizes are those of the exported files."""
    home = fresh_dir(spark, "even")
    # The cube of a large key is beyond a long.
    keys = {"cubed": "POW(o_orderkey, 3)", "half": "IF(o_orderkey % 2 = 0, 7, o_orderkey)"}
    found = []
    for name, text in keys.items():
        orders = table(spark, sf_dir, "orders").withColumn("k", F.expr(text))
        slices = even_slices(orders, "k", 8)
        done = export_slices(orders, slices, f"{home}/{name}", ExportOptions(target=home), whole=slices)
        back = read_export(spark, f"{home}/{name}", "parquet", orders.schema)
        sizes = sorted(p.rows for p in done)
        alone = back.where("k = 7").count() if name == "half" else 0
        others = [n for n in sizes if n != alone]
        found.append((
            name, sum(sizes), sum(p.rows_first for p in done), back.select("o_orderkey").distinct().count(),
            max(others) <= 1.5 * sum(others) / len(others), alone == 0 or alone in sizes,
        ))
    return small_frame(spark, found, "key string, row_count long, rows_first long, keys_found long, even boolean, alone boolean")


def catalog_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings, and orders with arrays, maps and structs, conformed to the schemas of
    their own catalog rows and exported; what the columns and values are afterwards."""
    embeddings = table(spark, sf_dir, "embeddings")
    nested = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
            F.array(F.struct(F.col("o_custkey").alias("key"), F.lit(None).cast("date").alias("day"))).alias("customers"),
        ).alias("facts"),
        F.create_map("o_orderstatus", F.array("o_custkey", F.lit(None))).alias("by_status"),
    )
    kept = []
    for name, df in (("embeddings", embeddings), ("orders", nested)):
        schema = schema_from_nested(nested_columns(df, "dbo", name))
        target = fresh_dir(spark, "nested")
        export_frame(conform(df, schema), target, ExportOptions(target=target))
        kept.append(read_export(spark, target, "parquet", schema))
    vectors = kept[0].select(
        F.lit("embeddings").alias("source"), F.col("vec_id").alias("id"), F.typeof("embedding").alias("type"),
        F.size("embedding").cast("long").alias("parts"), F.round(F.col("embedding")[0].cast("double"), 6).alias("value"),
    )
    facts = kept[1].select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
        F.concat_ws(" ", F.typeof("facts"), F.typeof("by_status")).alias("type"),
        F.element_at(F.map_values("by_status"), 1)[0].alias("parts"),
        F.round(F.col("facts.price").cast("double"), 2).alias("value"),
    )
    return vectors.unionByName(facts)


def verify_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliced orders with digests in the manifest, read back: as they are, with a row changed
    in one slice, and with a row twice in another."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "verify")
    options = ExportOptions(target=home + "/{table}", format="csv", manifest_dir=home + "-m", digest=True)
    tasks = one_table_tasks(source, "dbo", "orders", options)
    texts = [f"o_orderkey % 4 = {i}" for i in range(4)]
    raise_on_failure(run_job(source, tasks, options, lambda task, frame: predicate_slices(texts), "verify"))
    manifest = Manifest(spark, options.manifest_dir, "verify")
    schema = source.frame("dbo", "orders").schema
    found = []
    for step in ("exported", "tampered"):
        if step == "tampered":
            changed = F.when(F.col("o_orderkey") == 5, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
            for i, alter in ((1, lambda df: df.withColumn("o_totalprice", changed)), (2, lambda df: df.union(df.where("o_orderkey = 6")))):
                folder = f"{home}/orders/p{i:08d}"
                other = fresh_dir(spark, "tampered")
                alter(read_export(spark, folder, "csv", schema)).select(*schema.names).write.parquet(other)
                export_frame(spark.read.parquet(other), folder, ExportOptions(target=folder, format="csv"))
        told = verify_job(spark, manifest, {"orders": schema}, "csv")
        found.append(told.select(F.lit(step).alias("step"), F.regexp_extract("object_path", r"p\d+$", 0).alias("slice_id"), "row_count", "verified"))
    return reduce(DataFrame.unionByName, found)


def manifest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of what happened to customers, in very many small files: the last state of each
    before and after they are merged, with records that come in between."""
    customers = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n")).collect()
    manifest = Manifest(spark, fresh_dir(spark, "compacted"), "segments", compact_at=40)
    for attempt in range(1, 13):
        for row in sorted(customers, key=lambda r: r.c_mktsegment or ""):
            key = {"job_id": "segments", "table": "customer", "partition_id": row.c_mktsegment, "file_index": 0}
            manifest.append([{**key, "status": "running", "attempt": attempt, "row_count": row.n}])
    files = manifest.file_count()
    last = latest(manifest.records()).select("partition_id", "attempt", "row_count")
    return last.withColumn("few_files", F.lit(files <= 45)).withColumn(
        "records", F.lit(manifest.records().count()).cast("long")
    )


def watermark_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sliced high-watermark job, run over a part of the events, over all, and once more."""
    home = fresh_dir(spark, "watermark-sliced")
    events = table(spark, sf_dir, "events")
    options = ExportOptions(
        target=home + "/out/{table}", consistency="high_watermark", watermark_column="ts", manifest_dir=home + "-manifest",
    )
    texts = [f"event_id % 3 = {i}" for i in range(3)]
    found = []
    for run, where in enumerate(("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'", "true", "true"), start=1):
        folder = f"{home}/lake-{run}"
        events.where(where).write.parquet(folder + "/events.parquet")
        source = LakeSource(spark, folder, names=["events"])
        tasks = one_table_tasks(source, "dbo", "events", options)
        results = run_job(source, tasks, options, lambda task, frame: predicate_slices(texts), "sliced")
        found.append(raise_on_failure(results).select(F.lit(run).alias("run"), "slice_id", "status", F.col("rows").alias("row_count")))
    back = read_export(spark, home + "/out/events", "parquet", events.schema)
    keys = back.select(F.count_distinct("event_id").alias("keys_found"))
    return reduce(DataFrame.unionByName, found).crossJoin(F.broadcast(keys))


def fanout_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in the order in which a job starts them, one at a time: the largest first."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "order")
    options = ExportOptions(target=home + "/{table}", manifest_dir=home + "-manifest", table_concurrency=1)
    tasks = schema_tasks(source, "dbo", options, include=["*.nation", "*.lineitem", "*.orders", "*.region"])
    raise_on_failure(run_job(source, tasks, options, job_id="order"))
    started = Manifest(spark, options.manifest_dir, "order").records().where("status = 'running'")
    rows = started.select("table", "seq").orderBy("seq").collect()
    counts = {name: source.frame("dbo", name).count() for name in ("nation", "lineitem", "orders", "region")}
    found = [(place, row.table, counts[row.table]) for place, row in enumerate(rows, start=1)]
    return small_frame(spark, found, "place long, table_name string, row_count long")


def files_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in files that tasks cut at the bytes they come to, with nothing renamed."""
    lines = table(spark, sf_dir, "lineitem")
    found = []
    for fmt, codec, size in (("parquet", "zstd", 256 * 1024), ("csv", "zstd", 128 * 1024), ("json", "gzip", 256 * 1024)):
        target = fresh_dir(spark, "by-bytes")
        options = ExportOptions(
            target=target, format=fmt, compression=codec, target_file_bytes=size, arrow_files=True, digest=True
        )
        done = export_frame(lines, target, options)
        verify_export(spark, target, fmt, lines.schema, done.digest)
        sizes = Store(spark, target).files(target).values()
        # Each task of the scan may leave one file that is not full.
        tasks = spark.sparkContext.defaultParallelism + len(lines.inputFiles())
        found.append((fmt, done.rows, max(sizes) <= 1.25 * size, sum(n < 0.5 * size for n in sizes) <= tasks))
    return small_frame(spark, found, "format string, row_count long, within boolean, filled boolean")


def slices_by_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight slices of orders as zstd text, written where they stay in one scan."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "one-scan")
    options = ExportOptions(target=home + "/{table}/{partition}", format="json", compression="zstd", arrow_files=True)
    tasks = one_table_tasks(source, "dbo", "orders", options)
    texts = [f"o_orderkey % 8 = {i}" for i in range(8)]
    results = raise_on_failure(run_job(source, tasks, options, lambda task, frame: predicate_slices(texts)))
    schema = source.frame("dbo", "orders").schema
    parts = [
        read_export(spark, row.target, "json", schema).agg(
            F.lit(row.slice_id).alias("slice_id"), F.count(F.lit(1)).alias("row_count"), F.max("o_orderkey").alias("last_key")
        )
        for row in results.collect()
    ]
    return reduce(DataFrame.unionByName, parts)


NAMED = (
    files_by_bytes, slices_by_arrow,
    watermark_sliced, fanout_order,
    manifest_compacted,
    slice_even, catalog_nested, verify_exports,
    overwrite_in_place, coverage_balanced, coverage_after_resume, resume_other_predicates,
    pinned_files_changed, watermark_all_null, query_session_zone,
)

def _overwrite_oracle() -> str:
    steps = (("first", "true"), ("failed", "true"), ("second", "o_totalprice > 100000"))
    return " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, '{step}' AS step, count(*) AS row_count, "
        f"CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS stray_files FROM orders WHERE {where}"
        for fmt, _ in IN_PLACE for step, where in steps
    )


def _slices(predicates: list[str], status: str, rows: str = "count(*)") -> list[str]:
    return [
        f"SELECT 'p{i:08d}' AS slice_id, '{status}' AS status, CAST({rows} AS BIGINT) AS rows, NULL AS error FROM orders WHERE {text}"
        for i, text in enumerate(predicates)
    ]


def _verdict(none: str, several: str) -> str:
    return (
        "SELECT NULL AS slice_id, 'failed' AS status, CAST(0 AS BIGINT) AS rows, "
        f"count(*) FILTER ({none}) || ' rows are in no slice, ' || count(*) FILTER ({several}) || ' in several' AS error FROM orders"
    )


def _coverage_oracles() -> dict[str, str]:
    balanced = ["o_orderkey % 4 = 0", "o_orderkey % 4 IN (1, 0)", "o_orderkey % 4 = 2"]
    resumed = ["o_orderkey % 3 = 0", "o_orderkey % 3 = 1"]
    lost = _verdict("o_orderkey % 3 = 2", "false")
    first = " UNION ALL ".join([*_slices(resumed, "completed"), lost])
    second = " UNION ALL ".join([*_slices(resumed, "skipped", "0 * count(*)"), lost])
    return {
        "coverage_balanced": " UNION ALL ".join(
            [*_slices(balanced, "completed"), _verdict("o_orderkey % 4 = 3", "o_orderkey % 4 = 0")]
        ),
        "coverage_after_resume": f"SELECT 1 AS run, * FROM ({first}) UNION ALL SELECT 2 AS run, * FROM ({second})",
    }


ORACLES = {
    "overwrite_in_place": _overwrite_oracle(),
    **_coverage_oracles(),
    "files_by_bytes": """
        SELECT f AS format, count(*) AS row_count, true AS within, true AS filled
        FROM lineitem, (VALUES ('parquet'), ('csv'), ('json')) AS v(f) GROUP BY f
    """,
    "slices_by_arrow": """
        SELECT 'p0000000' || (o_orderkey % 8) AS slice_id, count(*) AS row_count, max(o_orderkey) AS last_key
        FROM orders GROUP BY o_orderkey % 8
    """,
    "watermark_sliced": """
        SELECT run, 'p0000000' || (event_id % 3) AS slice_id, 'completed' AS status, count(*) AS row_count,
            (SELECT count(DISTINCT event_id) FROM events) AS keys_found
        FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 2 END AS run FROM events) GROUP BY run, event_id % 3
        UNION ALL SELECT 3, 'single', 'skipped', 0, (SELECT count(DISTINCT event_id) FROM events)
    """,
    "fanout_order": """
        SELECT 1 AS place, 'lineitem' AS table_name, count(*) AS row_count FROM lineitem
        UNION ALL SELECT 2, 'orders', count(*) FROM orders
        UNION ALL SELECT 3, 'nation', count(*) FROM nation
        UNION ALL SELECT 4, 'region', count(*) FROM region
    """,
    "manifest_compacted": """
        SELECT c_mktsegment AS partition_id, 12 AS attempt, count(*) AS row_count, true AS few_files,
            12 * (SELECT count(DISTINCT c_mktsegment) FROM customer) AS records
        FROM customer GROUP BY c_mktsegment
    """,
    "slice_even": """
        SELECT key, count(*) AS row_count, count(*) AS rows_first, count(DISTINCT o_orderkey) AS keys_found, true AS even, true AS alone
        FROM orders, (VALUES ('cubed'), ('half')) AS k(key) GROUP BY key
    """,
    "catalog_nested": """
        SELECT 'embeddings' AS source, vec_id AS id, 'array<float>' AS type, len(embedding) AS parts,
            round(CAST(embedding[1] AS DOUBLE), 6) AS value
        FROM embeddings
        UNION ALL SELECT 'orders', o_orderkey,
            'struct<price:decimal(15,2),customers:array<struct<key:bigint,day:date>>> map<string,array<bigint>>',
            o_custkey, round(o_totalprice, 2)
        FROM orders
    """,
    "verify_exports": """
        SELECT step, 'p0000000' || (o_orderkey % 4) AS slice_id, count(*) AS row_count,
            step = 'exported' OR o_orderkey % 4 IN (0, 3) AS verified
        FROM orders, (VALUES ('exported'), ('tampered')) AS s(step) GROUP BY step, o_orderkey % 4
    """,
    "resume_other_predicates": """
        SELECT 'p0000000' || i AS slice_id, CASE i WHEN 0 THEN 'skipped' ELSE 'completed' END AS status,
            i + 1 AS attempt, count(*) AS rows_found, count(DISTINCT o_orderkey) AS keys_found, CAST(0 AS BIGINT) AS illegal_moves
        FROM orders, range(2) AS s(i) GROUP BY i
    """,
    "pinned_files_changed": """
        SELECT 'first' AS step, CAST(3 AS BIGINT) AS results, 'completed' AS status, count(*) AS row_count, 'no error' AS told FROM orders
        UNION ALL SELECT 'unchanged', 3, 'skipped', 0, 'no error'
        UNION ALL SELECT 'changed', 1, 'failed', 0, 'named'
    """,
    "watermark_all_null": """
        SELECT run, CASE run WHEN 1 THEN (SELECT count(*) FROM events)
            WHEN 4 THEN (SELECT count(*) FROM events WHERE event_id % 2 = 0) ELSE 0 END AS row_count
        FROM range(1, 6) AS r(run)
    """,
    "query_session_zone": """
        SELECT o_orderkey, strftime(TIMESTAMP '1970-01-01 09:00:00' + o_orderkey * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS at,
            true AS unread
        FROM orders
    """,
}
