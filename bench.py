"""Times the headline exports; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tablelift.datagen.tables import generate
from tablelift.operators.sinks import export_frame
from tablelift.operators.slices import predicate_slices
from tablelift.options import ExportOptions
from tablelift.plans.corpus import QUERY_TEXTS
from tablelift.plans.job import raise_on_failure, run_job
from tablelift.plans.queries import TABLE_NAMES
from tablelift.plans.tasks import database_tasks, one_table_tasks, query_tasks, schema_tasks
from tablelift.session import fresh_dir
from tablelift.sources.catalog import LakeSource

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RESUME_SLICES = ["l_linenumber <= 2", "l_linenumber > 2 AND l_linenumber <= 4", "l_linenumber > 4"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.source = LakeSource(spark, SF_DIR, names=TABLE_NAMES)
        self.lineitem = self.source.frame("dbo", "lineitem")
        self.resume_home = fresh_dir(spark, "resume")

    def _table(self, name: str = "lineitem", **options) -> None:
        target = fresh_dir(self.spark, "bench")
        frame = self.source.frame("dbo", name)
        export_frame(frame, target, ExportOptions(target=target, **options), frame)

    def _run(self, tasks: DataFrame, options: ExportOptions, slicer=None, job_id=None) -> None:
        raise_on_failure(run_job(self.source, tasks, options, slicer, job_id))

    def table_export(self) -> None:
        self._table()

    def query_export(self) -> None:
        options = ExportOptions(target=fresh_dir(self.spark, "bench") + "/{query}")
        tasks = query_tasks(self.source, "join", QUERY_TEXTS["query_join"], options)
        self._run(tasks, options)

    def schema_fanout(self) -> None:
        options = ExportOptions(target=fresh_dir(self.spark, "bench") + "/{table}")
        self._run(schema_tasks(self.source, "dbo", options), options)

    def database_fanout(self) -> None:
        options = ExportOptions(
            target=fresh_dir(self.spark, "bench") + "/{table}", format="json", compression="none"
        )
        self._run(database_tasks(self.source, options, exclude=["*.documents"]), options)

    def local_sink_latency(self) -> None:
        self._table("region")

    def many_files(self) -> None:
        self._table(max_rows_per_file=10_000, even_files=True)

    def checkpoint_resume(self) -> None:
        """A job whose slices are all committed but one."""
        options = ExportOptions(
            target=self.resume_home + "/{table}/{partition}",
            manifest_dir=self.resume_home + "-manifest",
            resume=True,
        )
        tasks = one_table_tasks(self.source, "dbo", "lineitem", options)
        self._run(tasks, options, lambda t, f: predicate_slices(RESUME_SLICES), "resume")

    def prepare_resume(self) -> None:
        options = ExportOptions(
            target=self.resume_home + "/{table}/{partition}",
            manifest_dir=self.resume_home + "-manifest",
            allow_uncovered=True,
        )
        tasks = one_table_tasks(self.source, "dbo", "lineitem", options)
        self._run(tasks, options, lambda t, f: predicate_slices(RESUME_SLICES[:2]), "resume")

    def parquet_snappy(self) -> None:
        self._table("documents")

    def parquet_zstd(self) -> None:
        self._table("documents", compression="zstd")

    def csv_plain(self) -> None:
        self._table(format="csv", compression="none")

    def csv_gzip(self) -> None:
        self._table(format="csv", compression="gzip", max_rows_per_file=75_000, even_files=True)

    def csv_zstd(self) -> None:
        self._table(format="csv", compression="zstd", max_rows_per_file=75_000, even_files=True)

    def split_by_size(self) -> None:
        self._table("documents", target_file_bytes=2 * 1024 * 1024)

    def sliced_export(self) -> None:
        options = ExportOptions(target=fresh_dir(self.spark, "bench") + "/{table}/{partition}")
        tasks = one_table_tasks(self.source, "dbo", "lineitem", options)
        self._run(tasks, options, lambda t, f: predicate_slices(RESUME_SLICES))

    def generate_events(self) -> None:
        target = fresh_dir(self.spark, "bench")
        made = generate(self.spark, "dbo.events", scale=0.05)
        export_frame(made, target, ExportOptions(target=target))


def main() -> None:
    spark = session()
    bench = Bench(spark)
    rows = bench.lineitem.count()
    bench.prepare_resume()
    names = (
        "table_export", "query_export", "schema_fanout", "database_fanout", "local_sink_latency",
        "many_files", "checkpoint_resume", "parquet_snappy", "parquet_zstd", "csv_plain",
        "csv_gzip", "csv_zstd", "split_by_size", "sliced_export", "generate_events",
    )
    seconds = {}
    for name in names:
        start = time.perf_counter()
        getattr(bench, name)()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "export_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "lineitem_rows": rows,
        "lineitem_rows_per_sec": round(rows / seconds["table_export"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
