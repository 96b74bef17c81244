import hashlib
import json
import random

import pytest

from tablelift.operators.manifest import (
    KEY_FIELDS,
    KEY_TYPES,
    Manifest,
    illegal_moves,
    latest,
    lookup,
    skip_committed,
    stable_id,
)
from tablelift.operators.ordered import previous_by_key

KEY = dict(zip(KEY_FIELDS, ("job", "db", "dbo", "orders", None, "p0", 0)))


def keyed(spark, *keys):
    rows = [tuple(k[f] for f in KEY_FIELDS) for k in keys]
    return spark.createDataFrame(rows, KEY_TYPES).withColumn("stable_id", stable_id())


@pytest.mark.parametrize(
    "change",
    [{}, {"table": 'a"b\\c/d'}, {"table": "žluť 数据 🙂"}, {"query_name": "q", "table": None}, {"file_index": 7}],
)
def test_stable_id_is_the_hash_of_the_compact_json(spark, change):
    key = {**KEY, **change}
    text = json.dumps(key, separators=(",", ":"), ensure_ascii=False)
    expected = hashlib.sha256(text.encode()).hexdigest()
    assert keyed(spark, key).first().stable_id == expected


def test_every_field_is_part_of_the_key(spark):
    keys = [KEY, *({**KEY, f: "x" if f != "file_index" else 9} for f in KEY_FIELDS)]
    assert keyed(spark, *keys).select("stable_id").distinct().count() == len(keys)


@pytest.fixture
def manifest(spark, out):
    return Manifest(spark, out)


def test_last_record_wins(spark, manifest):
    assert latest(manifest.records()).count() == 0
    manifest.append([{**KEY, "status": "planned"}, {**KEY, "status": "running", "attempt": 1}])
    manifest.append([{**KEY, "status": "uploaded", "row_count": 5}])
    manifest.append([{**KEY, "partition_id": "p1", "status": "planned"}])
    last = {r.partition_id: (r.status, r.row_count) for r in latest(manifest.records()).collect()}
    assert last == {"p0": ("uploaded", 5), "p1": ("planned", None)}
    found = lookup(manifest.records(), keyed(spark, {**KEY, "partition_id": "p1"}))
    assert [r.status for r in found.collect()] == ["planned"]
    assert lookup(manifest.records(), keyed(spark, {**KEY, "partition_id": "p2"})).count() == 0


@pytest.mark.parametrize("status", ["planned", "running", "uploaded", "failed", "committed"])
def test_only_committed_work_is_skipped(spark, manifest, status):
    manifest.append([{**KEY, "status": status, "attempt": 2, "error": "lost"}])
    todo = keyed(spark, KEY, {**KEY, "file_index": 1})
    left = {r.file_index for r in skip_committed(todo, manifest.records()).collect()}
    assert left == ({1} if status == "committed" else {0, 1})
    work = {w["file_index"]: w for w in manifest.open_work([KEY, {**KEY, "file_index": 1}])}
    assert set(work) == left
    assert (work[1]["attempt"], work[1]["last_status"]) == (1, None)
    if status != "committed":
        assert (work[0]["attempt"], work[0]["last_error"]) == (3, "lost")


def test_other_jobs_do_not_count(spark, out):
    one, other = Manifest(spark, out, "one"), Manifest(spark, out, "other")
    one.append([{**KEY, "job_id": "one", "status": "committed"}])
    assert len(other.open_work([{**KEY, "job_id": "other"}])) == 1
    assert one.open_work([{**KEY, "job_id": "one"}]) == []
    other.append([{**KEY, "job_id": "other", "status": "planned"}])
    assert Manifest(spark, out).records().count() == 2


def test_lifecycle_helpers_make_legal_moves(manifest):
    for fails in (True, True, False):
        item = manifest.open_work([KEY])[0]
        manifest.start([item])
        rows = [manifest.failed(item, "boom")] if fails else manifest.finish(item, row_count=3)
        manifest.append(rows)
    assert illegal_moves(manifest.records()).count() == 0
    last = latest(manifest.records()).first()
    assert (last.status, last.attempt, last.row_count) == ("committed", 3, 3)
    assert manifest.open_work([KEY]) == []


def test_interrupted_run_is_closed_before_the_next(manifest):
    manifest.start(manifest.open_work([KEY]))
    item = manifest.open_work([KEY])[0]
    assert item["last_status"] == "running"
    manifest.start([item])
    states = [r.status for r in manifest.records().orderBy("seq").collect()]
    assert states == ["planned", "running", "failed", "running"]
    assert illegal_moves(manifest.records()).count() == 0


@pytest.mark.parametrize(
    "states, wrong",
    [
        (["planned", "running", "uploaded", "committed"], 0),
        (["planned", "running", "failed", "running", "uploaded", "committed"], 0),
        (["running"], 1),
        (["planned", "committed"], 1),
        (["planned", "running", "uploaded", "committed", "running"], 1),
        (["planned", "running", "committed", "failed"], 2),
    ],
)
def test_illegal_moves(manifest, states, wrong):
    manifest.append([{**KEY, "status": s} for s in states])
    assert illegal_moves(manifest.records()).count() == wrong


@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
def test_previous_row_against_brute_force(spark, blocks):
    """One key holds most rows, so it spans many blocks."""
    draw = random.Random(blocks)
    rows = [
        ("hot" if draw.random() < 0.7 else f"k{draw.randrange(5)}", i * i, draw.choice(["a", "b", None]))
        for i in range(400)
    ]
    expected, last = {}, {}
    for key, order, value in rows:
        expected[order] = last.get(key)
        last[key] = value
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, v string").repartition(3)
    found = previous_by_key(df, "k", "o", "v", "before", blocks=blocks)
    assert {r.o: r.before for r in found.collect()} == expected


def test_previous_row_of_nothing(spark):
    df = spark.createDataFrame([], "k string, o long, v string")
    assert previous_by_key(df, "k", "o", "v", "before").count() == 0


def test_latest_reduces_before_it_shuffles(spark, manifest):
    manifest.append([{**KEY, "status": "planned"}])
    plan = latest(manifest.records())._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
