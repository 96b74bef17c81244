"""Compression of vectors to codes: a codebook for each of eight parts, fitted exactly.

Components are integers. A task cuts its vectors into chunks and builds a metric tree over
each part of a chunk, once; the trees are written. Every round of fitting sends the
codebooks, which have the same size whatever the table, to the trees, and sums come back:
from a ball that one entry owns at once, whatever number of points it holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablelift.llm.ball_trees import Forest, Owners, build_forest
from tablelift.llm.tables import written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Components of a chunk of vectors.
CHUNK_VALUES = 1 << 19
# A label is sent to all tasks if one in so many rows, or more, has it.
COMMON = 10_000

_TREE = [name for name in Forest.KINDS if name != "order"]


def _cut(dims: int) -> int:
    return max(256, CHUNK_VALUES // dims)


def _kept(vectors: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows that can be coded, their lengths, starts of the rows, integer components)."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    flat = vectors.flatten()
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    fit = (lengths > 0) & (lengths % parts == 0) & (bad[starts[1:]] == bad[starts[:-1]])
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * np.where(np.isfinite(values), values, 0))
    return np.flatnonzero(fit), lengths, starts, scaled


def chunk_trees(vectors: DataFrame, parts: int, seeds: int) -> DataFrame:
    """One row for each chunk of vectors of one length: dims, n, vec_ids, labels, first, and its trees.

    ``first`` are the ``seeds`` rows of smallest vec_id. ``vectors`` has columns vec_id,
    embedding (array of double) and label. Rows that cannot be coded are left out.
    """
    label = vectors.schema["label"].dataType
    first = T.ArrayType(T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vector", T.ArrayType(T.IntegerType()))]))
    schema = T.StructType(
        [T.StructField("dims", T.IntegerType()), T.StructField("n", T.LongType()),
         T.StructField("vec_ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)),
         T.StructField("first", first)]
        + [T.StructField(name, T.BinaryType()) for name in Forest.KINDS]
    )

    def chunk(dims: int, ids: pa.Array, labels: pa.Array, points: np.ndarray) -> pa.RecordBatch:
        if 4 * int(np.abs(points).max()) ** 2 * dims >= 1 << 63:
            raise ValueError("components this large have squared distances beyond 64 bits")
        points = points.astype(np.int64)
        known, numbers = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        order = np.lexsort((*points.T[::-1], numbers, known))[:seeds]
        smallest = [{"vec_id": ids[i].as_py(), "vector": points[i].tolist()} for i in order.tolist()]
        forest = build_forest(points.reshape(len(points), parts, -1).transpose(1, 0, 2)).packed()
        one = {
            "dims": pa.array([dims], pa.int32()), "n": pa.array([len(points)], pa.int64()),
            "vec_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "labels": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), labels),
            "first": pa.array([smallest], pa.list_(pa.struct([("vec_id", pa.int64()), ("vector", pa.list_(pa.int32()))]))),
            **{name: pa.array([data], pa.binary()) for name, data in forest.items()},
        }
        return pa.RecordBatch.from_arrays(list(one.values()), names=list(one))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def emptied(dims: int, least: int) -> Iterator[pa.RecordBatch]:
            ids, labels = (pa.concat_arrays([h[i] for h in held[dims]]) for i in (0, 1))
            points = np.concatenate([h[2] for h in held[dims]])
            first = 0
            while len(ids) - first >= least and first < len(ids):
                last = min(first + _cut(dims), len(ids))
                yield chunk(dims, ids[first:last], labels[first:last], points[first:last])
                first = last
            held[dims] = [(ids[first:], labels[first:], points[first:])]

        for batch in batches:
            rows, lengths, starts, values = _kept(batch.column(1), parts)
            for dims in np.unique(lengths[rows]).tolist():
                some = rows[lengths[rows] == dims]
                points = values[starts[some][:, None] + np.arange(dims)]
                held.setdefault(dims, []).append((batch.column(0).take(pa.array(some)), batch.column(2).take(pa.array(some)), points))
                if sum(len(h[0]) for h in held[dims]) >= _cut(dims):
                    yield from emptied(dims, _cut(dims))
        for dims in held:
            yield from emptied(dims, 1)

    return vectors.mapInArrow(run, schema)


def _forests(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, int, Forest]]:
    for batch in batches:
        for i in range(batch.num_rows):
            columns = {name: batch.column(name)[i].as_buffer() for name in batch.schema.names if name in Forest.KINDS}
            yield batch, i, Forest.unpacked(columns, width)


def fit_codebooks(trees: DataFrame, entries: np.ndarray, rounds: int) -> np.ndarray:
    """``entries`` (parts, entries, components) after ``rounds`` of assigning and averaging."""
    parts, k, width = entries.shape
    for _ in range(rounds):
        now = entries

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((parts, k, width + 1), np.int64)
            for _, _, forest in _forests(batches, width):
                counts, sums = Owners(forest, now).totals()
                total[:, :, 0] += counts
                total[:, :, 1:] += sums
            slots = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total.reshape(-1)[slots])], names=["slot", "value"])

        found = trees.select(*_TREE).mapInArrow(run, "slot long, value long")
        found = found.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(parts * k * (width + 1), np.int64)
        total[found["slot"].to_numpy()] = found["value"].to_numpy()
        total = total.reshape(parts, k, width + 1)
        counts = total[:, :, :1]
        entries = np.where(counts > 0, total[:, :, 1:] // np.maximum(counts, 1), entries)
    return entries


def coded_vectors(trees: DataFrame, entries: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector in ``trees``."""
    parts, k, width = entries.shape
    digits = np.array([list(f"{j:02x}".encode()) for j in range(k)], np.uint8)
    label = trees.schema["labels"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, forest in _forests(batches, width):
            entry, error = Owners(forest, entries).assigned()
            spelled = digits[entry].reshape(len(entry), -1)
            ends = np.arange(len(entry) + 1, dtype=np.int32) * spelled.shape[1]
            codes = pa.StringArray.from_buffers(len(entry), pa.py_buffer(ends), pa.py_buffer(spelled.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_ids")[i].values, batch.column("labels")[i].values, codes, pa.array(error.sum(axis=1))],
                names=["vec_id", "label", "code", "error"],
            )

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return trees.select("vec_ids", "labels", *Forest.KINDS).mapInArrow(run, schema)


def with_label_error(coded: DataFrame, rows: int) -> DataFrame:
    """``coded`` with label_error, the error summed over the rows with an equal label.

    Nulls are equal. Labels of a ten-thousandth of all ``rows`` or more, of which there are
    ten thousand at most, are sent to all tasks; the others are joined.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__rows"))
    sums = written(sums.withColumnRenamed("label", "__label"), "label-errors")
    common = sums["__rows"] * COMMON >= rows
    often, rare = sums.where(common).drop("__rows"), sums.where(~common).drop("__rows")
    same = F.col("label").eqNullSafe(F.col("__label"))
    first = coded.join(F.broadcast(often), same)
    rest = coded.join(F.broadcast(often.select("__label")), same, "left_anti")
    return first.union(rest.join(rare, same)).drop("__label")


def codebook_text(entries: np.ndarray) -> str:
    """All components of all entries, by part, entry and position, with commas in between."""
    return ",".join(map(str, entries.reshape(-1).tolist()))


def vector_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error and label_error of every vector kept; the codebooks).

    A component x counts as floor(4096 x), a vector is cut into ``parts`` equal consecutive
    parts, and codebooks are (parts, entries, components). They start as the parts of the
    vectors of smallest vec_id, nulls last and equal ids in the order of their components,
    and follow ``rounds`` of assigning every part to its nearest entry, ties to the lower
    index, and of moving every entry that has parts to their floored mean. ``code`` has the
    index of each part's entry in two hex digits, ``error`` the squared distances in all.

    Left out are vectors that are null, that hold a null or a number that is not finite, and
    those of another length than most vectors have (of lengths alike in number the longer),
    or of one that ``parts`` does not divide, an empty one among them. Rows with equal or
    null vec_id are coded each by itself, null labels are alike, other columns are ignored.
    With fewer vectors than entries there are as many entries as vectors; an empty table
    gives no rows and empty codebooks. Components so large that a squared distance does not
    fit 64 bits are an error. ``entries`` is 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    wanted = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").alias("label"),
    )
    trees = written(chunk_trees(wanted, parts, entries), "ball-trees")
    sizes = trees.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if sizes is None:
        schema = T.StructType([T.StructField("vec_id", T.LongType()), wanted.schema["label"], T.StructField("code", T.StringType()),
                               T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType())])
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    trees = trees.where(F.col("dims") == sizes.dims)
    seeds = trees.select(F.inline("first")).orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    start = np.array([row.vector for row in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    books = fit_codebooks(trees, np.ascontiguousarray(start), rounds)
    coded = written(coded_vectors(trees, books), "vector-codes")
    return with_label_error(coded, sizes.n), books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(codebook_text(books).encode()).hexdigest()
