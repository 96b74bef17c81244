"""The export manifest: an append-only log of what happened to each unit."""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablelift.functions.names import path_safe_text
from tablelift.operators.ordered import previous_by_key
from tablelift.session import small_frame
from tablelift.storage import Store

# Key fields in their order, states, and the moves between states.
KEY_FIELDS = ("job_id", "database", "schema", "table", "query_name", "partition_id", "file_index")
PLANNED, RUNNING, UPLOADED, COMMITTED, FAILED = (
    "planned",
    "running",
    "uploaded",
    "committed",
    "failed",
)
LEGAL_MOVES = (
    (None, PLANNED),
    (PLANNED, RUNNING),
    (RUNNING, UPLOADED),
    (UPLOADED, COMMITTED),
    (RUNNING, FAILED),
    (FAILED, RUNNING),
)
KEY_TYPES = (
    "job_id string, database string, schema string, table string, query_name string, "
    "partition_id string, file_index long"
)
RECORD_SCHEMA = KEY_TYPES + (
    ", status string, object_path string, row_count long, "
    "bytes_uncompressed long, bytes_compressed long, etag string, attempt int, error string, "
    "watermark string, seq long, "
    "predicate_hash string, slices_hash string, rows_first long, rows_several long, row_digest string"
)
# Appends that are merged into a state, the rows of a state's file, and what a state is made of.
COMPACT_AT, STATE_ROWS = 512, 1_000_000
MERGED = "_merged.json"
# A committed unit that is to be done again, as its predicate is another one now.
PLANNED_AGAIN = (COMMITTED, PLANNED)


def stable_id(**fields: Column) -> Column:
    """SHA-256 hex of the key as compact JSON, with fields in order and nulls kept."""
    key = F.struct(*[fields.get(n, F.col(f"`{n}`")).alias(n) for n in KEY_FIELDS])
    return F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256)


def latest(records: DataFrame) -> DataFrame:
    """The last record of every key.

    An aggregate, so that a key with very many records is reduced where they lie.
    """
    columns = [c for c in records.columns if c != "stable_id"]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.col("seq"))
    return (
        records.groupBy("stable_id").agg(newest.alias("last")).select("stable_id", "last.*")
    )


def lookup(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Last record of each of the given keys."""
    wanted = keys.select("stable_id").distinct()
    return latest(records.join(wanted, "stable_id", "left_semi"))


def skip_committed(todo: DataFrame, records: DataFrame) -> DataFrame:
    """Work whose last state is not ``committed``."""
    done = latest(records).where(F.col("status") == COMMITTED)
    return todo.join(done.select("stable_id"), "stable_id", "left_anti")


def next_attempts(todo: DataFrame, records: DataFrame) -> DataFrame:
    """Open work with the number of its next attempt, and how the last one ended."""
    last = latest(records).select(
        "stable_id",
        F.col("attempt").alias("last_attempt"),
        F.col("status").alias("last_status"),
        F.col("error").alias("last_error"),
    )
    still_open = F.col("last_status").isNull() | (F.col("last_status") != COMMITTED)
    return todo.join(last, "stable_id", "left").where(still_open).select(
        *[F.col(f"`{c}`") for c in todo.columns],
        (F.coalesce("last_attempt", F.lit(0)) + 1).alias("attempt"),
        "last_status",
        "last_error",
    )


class Clock:
    """Numbers that rise: by the time, and beyond every number seen in a log.

    Whoever goes on from a state has read it, so its records come after those it read,
    however far behind the clock of its machine is.
    """

    def __init__(self):
        self._last = 0
        self._lock = threading.Lock()

    def saw(self, number: int | None) -> None:
        with self._lock:
            self._last = max(self._last, number or 0)

    def next(self) -> int:
        with self._lock:
            self._last = max(self._last + 1, time.time_ns())
            return self._last


_clock = Clock()


def illegal_moves(records: DataFrame, legal_moves: tuple = LEGAL_MOVES) -> DataFrame:
    """Records whose state may not follow the state before it."""
    moves = previous_by_key(records, "stable_id", "seq", "status", "previous_status")
    legal = F.lit(False)
    for before, after in legal_moves:
        legal = legal | (
            F.col("previous_status").eqNullSafe(F.lit(before)) & (F.col("status") == after)
        )
    return moves.where(~legal)


class Manifest:
    """The log of one job, or with no job named, of all jobs in a folder.

    Every append is a file of its own, as appends may run at the same time. Its few rows
    are written by the driver that has them, as JSON lines; no job runs for them. When
    ``compact_at`` of them have come together they are merged into a Parquet state, so that
    a log is read from a bounded number of files, whatever the number of units.
    """

    def __init__(self, spark: SparkSession, folder: str, job_id: str | None = None, compact_at: int = COMPACT_AT):
        self.spark = spark
        self.folder = folder.rstrip("/")
        if job_id is not None:
            self.folder += f"/job-{path_safe_text(job_id)}"
        self.compact_at = compact_at
        self._appended = 0
        self._lock = threading.Lock()

    def _listed(self, folder: str) -> tuple[dict[str, dict], list[str]]:
        """(states that count, with what they are made of; appends that no state has)."""
        store = Store(self.spark, folder)
        names = store.files(folder)
        marks = {n: store.read_text(f"{folder}/{n}/{MERGED}") for n in names if n.startswith("state-")}
        # A state counts from when it says what it is made of, which is written last.
        states = {n: json.loads(text) for n, text in marks.items() if text is not None}
        replaced = {old for state in states.values() for old in state["states"]}
        merged = {name for state in states.values() for name in state["appends"]}
        live = {n: state for n, state in states.items() if n not in replaced}
        return live, [n for n in names if n.startswith("append-") and n not in merged]

    def _folders(self) -> list[str]:
        below = Store(self.spark, self.folder).files(self.folder)
        return [self.folder, *(f"{self.folder}/{name}" for name in below if name.startswith("job-"))]

    def file_count(self) -> int:
        """Files and states a reader opens now."""
        return sum(len(part) for folder in self._folders() for part in self._listed(folder))

    def records(self) -> DataFrame:
        states, appends = [], []
        for folder in self._folders():
            live, tail = self._listed(folder)
            states += [f"{folder}/{name}" for name in live]
            appends += [f"{folder}/{name}" for name in tail]
        return self._read(states, appends).withColumn("stable_id", stable_id())

    def _read(self, states: list[str], appends: list[str]) -> DataFrame:
        reader = self.spark.read.schema(RECORD_SCHEMA)
        parts = [reader.json(appends)] if appends else []
        parts += [reader.parquet(*states)] if states else []
        if not parts:
            return small_frame(self.spark, [], RECORD_SCHEMA)
        records = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        # Two drivers that merged at the same time have some records in both states.
        return records.dropDuplicates() if len(states) > 1 else records

    def compact(self) -> None:
        """Merge all appends and states of this job's log into one state.

        Nobody waits: the new state says what it is made of, and readers leave that out.
        What states were made of that are replaced now is deleted, so that those who listed
        the log before still find what they listed; what is merged now goes the next time.
        """
        store = Store(self.spark, self.folder)
        live, tail = self._listed(self.folder)
        if not tail and len(live) < 2:
            return
        name = f"state-{uuid.uuid4().hex}"
        records = self._read([f"{self.folder}/{n}" for n in live], [f"{self.folder}/{n}" for n in tail])
        count = records.count()
        records.coalesce(max(1, count // STATE_ROWS)).write.parquet(f"{self.folder}/{name}")
        made_of = {"states": sorted(live), "appends": sorted(tail)}
        store.replace_text(f"{self.folder}/{name}/{MERGED}", json.dumps(made_of))
        for old in live.values():
            for gone in old["states"] + old["appends"]:
                store.delete(f"{self.folder}/{gone}")

    def states(self, keys: list[dict]) -> list[dict]:
        """The given keys, each with its next attempt and with its last record as ``last_...``."""
        fields = KEY_TYPES.split(", ")
        rows = [tuple(key.get(f.split()[0]) for f in fields) for key in keys]
        todo = small_frame(self.spark, rows, KEY_TYPES).withColumn("stable_id", stable_id())
        last = latest(self.records())
        told = [c for c in last.columns if c not in KEY_FIELDS and c != "stable_id"]
        last = last.select("stable_id", *[F.col(c).alias(f"last_{c}") for c in told])
        found = [row.asDict() for row in todo.join(last, "stable_id", "left").collect()]
        for item in found:
            item["attempt"] = (item["last_attempt"] or 0) + 1
            _clock.saw(item["last_seq"])
        return found

    def open_work(self, keys: list[dict]) -> list[dict]:
        """The given keys without the committed ones, with attempt and last state."""
        return [item for item in self.states(keys) if item["last_status"] != COMMITTED]

    def start(self, work: list[dict]) -> None:
        """Log that an attempt at each piece of work begins.

        An attempt that was running when its driver died is closed as failed.
        """
        rows = []
        for item in work:
            key = {f: item.get(f) for f in KEY_FIELDS}
            if item["last_status"] in (None, COMMITTED):
                rows.append({**key, "status": PLANNED})
            elif item["last_status"] == RUNNING:
                ended = {"attempt": item["attempt"] - 1, "error": "interrupted"}
                rows.append({**key, **ended, "status": FAILED})
            rows.append({**key, "status": RUNNING, "attempt": item["attempt"]})
        self.append(rows)

    def finish(self, item: dict, **facts) -> list[dict]:
        """The two records that close a piece of work; append them in one go."""
        key = {f: item.get(f) for f in KEY_FIELDS}
        row = {**key, "attempt": item["attempt"], **facts}
        return [{**row, "status": UPLOADED}, {**row, "status": COMMITTED}]

    def failed(self, item: dict, error: str) -> dict:
        key = {f: item.get(f) for f in KEY_FIELDS}
        return {**key, "attempt": item["attempt"], "status": FAILED, "error": error}

    def append(self, rows: list[dict]) -> None:
        fields = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
        rows = [{**row, "seq": _clock.next()} for row in rows]
        lines = [json.dumps({f: row.get(f) for f in fields if row.get(f) is not None}) for row in rows]
        if lines:
            store = Store(self.spark, self.folder)
            store.write_text(f"{self.folder}/append-{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")
            with self._lock:
                self._appended += 1
                if self._appended >= self.compact_at:
                    self._appended = 0
                    self.compact()
