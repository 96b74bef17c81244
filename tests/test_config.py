import json

import pytest
from conftest import same_rows

from tablelift.options import DEFAULT_FILE_BYTES
from tablelift.plans.config import options_of, run, tasks_of
from tablelift.plans.job import raise_on_failure
from tablelift.sources.readback import read_export

# The names of a configuration, as plans/config.py has them.
FULL = """{
    "connection_url": "unused", "target": "/out/{schema}/{table}/", "format": "json",
    "compression": "zstd", "consistency": "high_watermark", "target_file_size": 268435456,
    "batch_rows": 65536, "memory_limit_mb": 512, "table_concurrency": 2,
    "partition_concurrency_per_table": 3, "global_io_concurrency": 5,
    "checkpoint_dir": "/state", "resume": true,
    "scope": {"type": "table", "table": {"schema": "dbo", "table": "orders"}, "predicate": null}
}"""


def test_options_come_from_the_configuration():
    options = options_of(json.loads(FULL))
    assert (options.format, options.compression, options.consistency) == (
        "json", "zstd", "high_watermark"
    )
    assert (options.table_concurrency, options.slice_concurrency, options.io_concurrency) == (2, 3, 5)
    assert (options.manifest_dir, options.resume) == ("/state", True)
    assert options_of({"target": "/out"}).target_file_bytes == DEFAULT_FILE_BYTES
    with pytest.raises(ValueError, match="target"):
        options_of({})


def scope(**parts):
    return {"target": "/out/{schema}/{table}/{query}", "scope": parts}


def test_each_scope_gives_its_tasks(lake):
    def ids(**parts):
        return {t.task_id for t in tasks_of(lake, scope(**parts)).collect()}

    assert ids(type="table", table={"table": "orders"}) == {"table:dbo/orders"}
    assert ids(type="query", name="q/1", sql="select 1") == {"query:q_1"}
    assert ids(type="schema", schema="DBO", include=["*.n*"]) == {"table:dbo/nation"}
    assert len(ids(type="database", exclude=["*.nation"])) == 13
    with pytest.raises(ValueError, match="unknown scope"):
        ids(type="server")


def test_a_configured_query_is_sliced_by_its_template(spark, lake, out):
    config = {
        "target": out + "/{query}",
        "format": "csv",
        "compression": "none",
        "scope": {
            "type": "query",
            "name": "open",
            "sql": "SELECT * FROM orders WHERE o_orderstatus = 'O'",
            "partition_template": "o_orderkey BETWEEN {lo} AND {hi}",
        },
    }
    results = raise_on_failure(run(lake, config, slice_key="o_orderkey"))
    assert results.count() == 4
    frame = lake.query(config["scope"]["sql"])
    assert same_rows(read_export(spark, out + "/open", "csv", frame.schema), frame)
