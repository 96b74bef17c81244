"""Files written by tasks themselves from Arrow batches, cut at the bytes they come to.

A task writes the rows of each slice to files of that slice's folder, under names of their
own, and starts the next one where the bytes written so far reach the limit. No sample says
how large a row will be, no file is written again, and one scan serves all slices whatever
the file system: nothing is renamed. Text lines are rendered by Spark, Parquet is written
from the columns as they come.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs

from tablelift.operators.zstd_text import FRAME_BYTES, SMALL_FRAME_BYTES, _bytes_of, filesystem_of

WRITTEN_SCHEMA = "slice_no int, file_name string, row_count long, byte_count long"
# A row group, or a run of lines, comes to about this part of a file, and before it is
# compressed to at most LEAST_PARTS of one: rows that do not shrink like those before them
# must not run far past the limit.
PARTS_OF_FILE = 16
LEAST_PARTS = 5
# What a Parquet footer takes for a column of a row group, about.
LEAF_BYTES = 100


@dataclass(frozen=True)
class ArrowFiles:
    """Where and how tasks write; ``folders`` by slice number, the last column if there are several."""

    folders: tuple[str, ...]
    parquet: bool
    header: str
    suffix: str
    codec: str
    level: int
    max_rows: int | None
    max_bytes: int | None
    row_group_bytes: int
    dictionary: bool

    def part_bytes(self, most: int, shrunk: float) -> int:
        """Bytes that are compressed at once, of rows that shrink to this share of them."""
        if not self.max_bytes:
            return most
        part = min(self.max_bytes / PARTS_OF_FILE / max(shrunk, 1e-3), self.max_bytes / LEAST_PARTS)
        return max(SMALL_FRAME_BYTES, min(most, int(part)))


class _Lines:
    """A text file that knows how many bytes it holds so far."""

    def __init__(self, raw, plan: ArrowFiles, schema: pa.Schema):
        self._raw, self._plan = raw, plan
        self._gzip = zlib.compressobj(6, zlib.DEFLATED, 31) if plan.codec == "gzip" else None
        self._zstd = pa.Codec("zstd", compression_level=plan.level) if plan.codec == "zstd" else None
        self._pending, self._pending_bytes = [plan.header.encode()], len(plan.header)
        self._shrunk = 1.0

    def write(self, rows: pa.RecordBatch) -> None:
        data = _bytes_of(rows.column(0))
        self._pending.append(data)
        self._pending_bytes += len(data)
        if self._pending_bytes >= self._plan.part_bytes(FRAME_BYTES, self._shrunk):
            self._flush()

    def _flush(self) -> None:
        data = b"".join(self._pending)
        if data:
            before = self._raw.tell()
            if self._gzip:
                # What is flushed can be counted.
                self._raw.write(self._gzip.compress(data) + self._gzip.flush(zlib.Z_SYNC_FLUSH))
            else:
                self._raw.write(self._zstd.compress(data, asbytes=True) if self._zstd else data)
            self._shrunk = max(1, self._raw.tell() - before) / len(data)
        self._pending, self._pending_bytes = [], 0

    def written(self) -> float:
        return self._raw.tell() + self._pending_bytes * self._shrunk

    def shrunk(self) -> float:
        return self._shrunk

    def close(self) -> int:
        self._flush()
        if self._gzip:
            self._raw.write(self._gzip.flush())
        size = self._raw.tell()
        self._raw.close()
        return size


def _leaves(kind: pa.DataType) -> int:
    return sum(_leaves(kind.field(i).type) for i in range(kind.num_fields)) if kind.num_fields else 1


class _Parquet:
    """A Parquet file that knows how many bytes it holds so far; rows wait for a row group."""

    def __init__(self, raw, plan: ArrowFiles, schema: pa.Schema):
        self._raw, self._plan = raw, plan
        codec = {"none": "NONE"}.get(plan.codec, plan.codec)
        level = plan.level if plan.codec == "zstd" else None
        self._writer = pq.ParquetWriter(
            raw, schema, compression=codec, compression_level=level, use_dictionary=plan.dictionary
        )
        self._pending, self._pending_bytes, self._shrunk = [], 0, 1.0
        # The footer tells of every leaf, and of every leaf of every row group.
        self._leaf_bytes = LEAF_BYTES * sum(_leaves(field.type) for field in schema)
        self._footer_bytes = self._leaf_bytes

    def write(self, rows: pa.RecordBatch) -> None:
        self._pending.append(rows)
        self._pending_bytes += rows.nbytes
        if self._pending_bytes >= self._plan.part_bytes(self._plan.row_group_bytes, self._shrunk):
            self._flush()

    def _flush(self) -> None:
        if self._pending:
            before = self._raw.tell()
            self._writer.write_table(pa.Table.from_batches(self._pending))
            self._shrunk = (self._raw.tell() - before) / max(1, self._pending_bytes)
            self._footer_bytes += self._leaf_bytes
        self._pending, self._pending_bytes = [], 0

    def written(self) -> float:
        return self._raw.tell() + self._pending_bytes * self._shrunk + self._footer_bytes

    def shrunk(self) -> float:
        return self._shrunk

    def close(self) -> int:
        self._flush()
        self._writer.close()
        size = self._raw.tell()
        self._raw.close()
        return size


def batch_writer(plan: ArrowFiles) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that writes rows and returns the files it wrote.

    Names are unique per attempt. The driver lists the files that successful tasks report;
    those of lost or repeated attempts are listed by nobody.
    """
    kind = _Parquet if plan.parquet else _Lines

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        places: dict[int, tuple[pafs.FileSystem, str]] = {}
        opened: dict[int, tuple[str, object, int]] = {}
        done: list[tuple] = []

        def opening(number: int, schema: pa.Schema) -> tuple[str, object, int]:
            if number not in places:
                places[number] = filesystem_of(plan.folders[number])
                places[number][0].create_dir(places[number][1])
            filesystem, root = places[number]
            name = f"{stem}-{len(done) + len(opened):05d}{plan.suffix}"
            return name, kind(filesystem.open_output_stream(f"{root}/{name}", compression=None), plan, schema), 0

        def closing(number: int) -> None:
            name, out, rows = opened.pop(number)
            done.append((number, name, rows, out.close()))

        def add(number: int, rows: pa.RecordBatch) -> None:
            start = 0
            while start < rows.num_rows:
                if number not in opened:
                    opened[number] = opening(number, rows.schema)
                name, out, held = opened[number]
                part = rows.slice(start)
                count = part.num_rows
                if plan.max_rows:
                    count = min(count, plan.max_rows - held)
                if plan.max_bytes:
                    each = max(1e-9, part.nbytes / part.num_rows)
                    # Not more at once than makes a part, so that what it comes to is known.
                    count = min(count, max(1, int(plan.part_bytes(plan.row_group_bytes, out.shrunk()) / each)))
                    room = plan.max_bytes - out.written()
                    count = min(count, max(1, int(room / (each * out.shrunk()))))
                out.write(part.slice(0, count))
                opened[number] = name, out, held + count
                start += count
                full = plan.max_rows and held + count >= plan.max_rows
                if full or (plan.max_bytes and out.written() >= plan.max_bytes):
                    closing(number)

        for batch in batches:
            if len(plan.folders) == 1:
                add(0, batch)
                continue
            numbers = batch.column(batch.num_columns - 1).to_numpy()
            rows = batch.select(batch.schema.names[:-1])
            for number in np.unique(numbers).tolist():
                mine = numbers == number
                add(number, rows if mine.all() else rows.filter(pa.array(mine)))
        for number in list(opened):
            closing(number)
        columns = list(zip(*done)) or [()] * 4
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["slice_no", "file_name", "row_count", "byte_count"]
        )

    return write
