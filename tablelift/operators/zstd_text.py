"""Zstandard-compressed text files, which Spark's own text writer does not offer.

Spark renders every row to a line; a task only compresses the bytes of each Arrow
batch and starts a new file at a limit, so no row becomes a Python object.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs

LINE_COLUMN = "line"
WRITTEN_SCHEMA = "file_name string, row_count long"
FRAME_BYTES = 4 * 1024 * 1024
SMALL_FRAME_BYTES = 16 * 1024


@dataclass(frozen=True)
class ZstdFiles:
    """Where and how a task writes its files."""

    folder: str
    header: str
    suffix: str
    level: int
    max_rows: int | None
    max_bytes: int | None

    def frame_bytes(self) -> int:
        if not self.max_bytes:
            return FRAME_BYTES
        return max(SMALL_FRAME_BYTES, min(FRAME_BYTES, self.max_bytes // 8))


def filesystem_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path with a scheme, and the path within it."""
    scheme, _, path = folder.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + path.lstrip("/")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def batch_writer(
    plan: ZstdFiles,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that writes lines and returns what it wrote.

    Names are unique per attempt. The driver keeps the files that successful
    tasks report; those of lost or repeated attempts are deleted.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, root = filesystem_of(plan.folder)
        filesystem.create_dir(root)
        stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        names: list[str] = []
        counts: list[int] = []
        out = None
        for batch in batches:
            lines = batch.column(0)
            start = 0
            while start < len(lines):
                if out is None:
                    names.append(f"{stem}-{len(names):05d}{plan.suffix}")
                    counts.append(0)
                    out = _CountedZstd(filesystem, f"{root}/{names[-1]}", plan)
                    out.write(plan.header.encode())
                count = _next_chunk(lines, start, out.written(), counts[-1], plan)
                out.write(_bytes_of(lines.slice(start, count)))
                start += count
                counts[-1] += count
                if (plan.max_rows and counts[-1] >= plan.max_rows) or (
                    plan.max_bytes and out.written() >= plan.max_bytes
                ):
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64())],
            names=["file_name", "row_count"],
        )

    return write


def _next_chunk(lines: pa.Array, start: int, written: int, rows: int, plan: ZstdFiles) -> int:
    """Lines to add before the limits are looked at again."""
    count = len(lines) - start
    if plan.max_rows:
        count = min(count, plan.max_rows - rows)
    if plan.max_bytes:
        # Even text that does not shrink must not run far past the limit.
        room = max(1, plan.max_bytes - written)
        average = max(1, lines.slice(start).nbytes // (len(lines) - start))
        count = min(count, max(1, room // average))
    return count


class _CountedZstd:
    """A zstd file that knows how many bytes it holds so far.

    It is a run of frames, which the format allows, as a finished frame is the
    only part with a known size.
    """

    def __init__(self, filesystem: pafs.FileSystem, path: str, plan: ZstdFiles):
        self._raw = filesystem.open_output_stream(path, compression=None)
        self._codec = pa.Codec("zstd", compression_level=plan.level)
        self._frame_bytes = plan.frame_bytes()
        # Views of Arrow's buffers, which they keep alive.
        self._pending: list[memoryview | bytes] = []
        self._pending_bytes = 0

    def write(self, data) -> None:
        self._pending.append(data)
        self._pending_bytes += len(data)
        if self._pending_bytes >= self._frame_bytes:
            self._flush()

    def written(self) -> int:
        return self._raw.tell() + self._pending_bytes

    def _flush(self) -> None:
        if self._pending:
            self._raw.write(self._codec.compress(b"".join(self._pending), asbytes=True))
            self._pending = []
            self._pending_bytes = 0

    def close(self) -> None:
        self._flush()
        self._raw.close()


def _bytes_of(lines: pa.Array) -> memoryview:
    """The text of a string array, which Arrow stores back to back."""
    if lines.null_count:
        raise ValueError("a rendered line is never NULL")
    wide = lines.cast(pa.large_string())
    offsets = memoryview(wide.buffers()[1]).cast("q")
    first, last = offsets[wide.offset], offsets[wide.offset + len(wide)]
    return memoryview(wide.buffers()[2] or b"")[first:last]
