"""Bottom-k sketches of shingle hashes as document fingerprints.

A fingerprint is the ``k`` smallest hashes of a text's distinct five-word shingles, and how
many there are if fewer. Sketches of parts merge into the sketch of the whole, and two of
them give estimates of resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablelift.llm.words import shingle_sets

K = 128
SPACE = float(1 << 64)


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of a sorted set of hashes."""
    return hashes[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of a union, from the sketches of its parts."""
    return np.union1d(a, b)[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[-1]) + 1) / SPACE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Shared share of the union's sketch. Two empty texts are alike, one is like nothing."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]
    union = both[np.concatenate(([True], ~twice))][:k]
    shared = np.searchsorted(both[1:][twice], union[-1], "right")
    return float(shared / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of ``a``'s shingles that are in ``b`` too."""
    if not len(a):
        return 1.0
    union = distinct_count(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """The sketch of each text; a null text is an empty one."""
    return [bottom_k(s, k) for _, sets in shingle_sets(texts) for s in sets]


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, fingerprint, n_shingles (estimated) of every row, one for one.

    Null and empty texts have the empty fingerprint. Equal texts have equal fingerprints.
    Other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches(batch.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([to_text(s) for s in found], pa.string()),
                    pa.array([distinct_count(s, k) for s in found], pa.float64()),
                ],
                names=["doc_id", "fingerprint", "n_shingles"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string, n_shingles double")


# Fingerprints of edited texts, each edited with the help of the next row

# Rows of one run of neighbouring ids at most.
RUN_ROWS = 100_000
LEAST_ID = -(1 << 63)
EDITED_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def run_starts(ids: DataFrame, run_rows: int = RUN_ROWS) -> np.ndarray:
    """Ids at which runs of neighbouring ids begin: quantiles, one less than there are runs.

    There are as many runs as shuffle partitions, or more if runs would get longer than
    ``run_rows``. Rows of one id stay together.
    """
    rows = ids.count()
    spread = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = min(max(spread, -(-rows // run_rows)), max(rows, 1))
    shares = [i / runs for i in range(1, runs)]
    found = ids.approxQuantile("place", shares, 0.1 / runs) if shares else []
    return np.unique(np.array(found, np.float64).astype(np.int64))


def in_runs(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """run, ahead, doc_id, text: rows dealt to runs of neighbouring ids, and sorted.

    Within a run rows descend by doc_id (null last), rows of one id ascend by text. After
    a run's own rows comes a copy of the first rows of the next run, marked ``ahead``; the
    first run stands behind the last, so that the order closes to a ring. Only the runs'
    first ids, one each, pass through the driver, and each text is shuffled once.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("place", F.coalesce("doc_id", F.lit(LEAST_ID)))
    ids = rows.select("place")
    starts = run_starts(ids, run_rows)

    @F.pandas_udf("int")
    def run_of(place):
        return place.__class__(len(starts) - np.searchsorted(starts, place.to_numpy(), "right"))

    firsts = ids.groupBy(run_of("place").alias("run")).agg(F.max("place").alias("first")).collect()
    firsts = sorted((r.run, r.first) for r in firsts)
    before = dict(zip((first for _, first in firsts), [firsts[-1][0]] + [r for r, _ in firsts]) if firsts else ())

    @F.pandas_udf("int")
    def run_before(place):
        return place.map(before).astype("Int32")

    copies = F.array_compact(
        F.array(
            F.struct(F.col("own").alias("run"), F.lit(False).alias("ahead")),
            F.when(F.col("above").isNotNull(), F.struct(F.col("above").alias("run"), F.lit(True).alias("ahead"))),
        )
    )
    dealt = (
        rows.withColumn("own", run_of("place"))
        .withColumn("above", run_before("place"))
        .withColumn("copy", F.explode(copies))
        .select("copy.run", "copy.ahead", "place", "doc_id", "text")
    )
    order = ("run", "ahead", F.desc("place"), "text")
    return dealt.repartitionById(len(starts) + 1, F.col("run")).sortWithinPartitions(*order).drop("place")


def edited_fingerprints(docs: DataFrame, k: int = K, run_rows: int = RUN_ROWS) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how alike they look.

    The edited text ends with the first code points of the next row by descending doc_id
    (after the last row: of the first) in place of its last floor(n_chars / 2) ones.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next, the resemblance to the edited and to the next text by fingerprint.

    A null text is an empty one. Rows with the same doc_id follow each other by text; rows
    with a null doc_id come last. One row alone is its own next. An empty table gives an
    empty result, and other columns are ignored.
    """

    def pairs(
        runs: list[int], ahead: list[bool], ids: list, texts: list[str], prints: list[np.ndarray]
    ) -> list[tuple]:
        own = [i for i in range(len(ids) - 1) if not ahead[i] and runs[i] == runs[i + 1]]
        edited = []
        for i in own:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
        found = sketches(pa.array(edited, pa.string()), k)
        return [
            (
                ids[i], len(texts[i]), hashlib.sha256(text.encode()).hexdigest(),
                to_text(prints[i]), to_text(sketch),
                resemblance(prints[i], sketch, k), resemblance(prints[i], prints[i + 1], k),
            )
            for i, text, sketch in zip(own, edited, found)
        ]

    kinds = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 2
    names = [field.split()[0] for field in EDITED_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                columns = [c.to_pylist() for c in part.columns] + [sketches(part.column(3), k)]
                held = [a + b for a, b in zip(held, columns)]
                if rows := pairs(*held):
                    arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                held = [column[-1:] for column in held]

    return in_runs(docs, run_rows).mapInArrow(run, EDITED_SCHEMA)
