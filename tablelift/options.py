"""Job options and the rules that settle them before anything runs."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

log = logging.getLogger("tablelift")

MB = 1024 * 1024

# The formats, codecs and limits of the export tool this job set replaces.
FORMATS = ("parquet", "csv", "tsv", "json")
CODECS = ("none", "snappy", "zstd", "gzip")
CONSISTENCY_MODES = ("none", "snapshot_transaction", "database_snapshot", "high_watermark")
WRITE_MODES = ("overwrite", "append", "errorifexists")
FILE_EXTENSIONS = {"parquet": "parquet", "csv": "csv", "tsv": "tsv", "json": "jsonl"}
CODEC_EXTENSIONS = {"none": "", "gzip": ".gz", "zstd": ".zst"}
DEFAULT_FILE_BYTES = 256 * MB
LARGE_FILE_BYTES = 512 * MB
MAX_FILE_BYTES = 1024 * MB
MIN_MEMORY_MB = 64
ROW_GROUP_BYTES = 128 * MB


@dataclass(frozen=True)
class ExportOptions:
    target: str
    format: str = "parquet"
    compression: str = "snappy"
    target_file_bytes: int | None = None
    max_rows_per_file: int | None = None
    mode: str = "overwrite"
    consistency: str = "snapshot_transaction"
    memory_limit_mb: int = 512
    table_concurrency: int = 4
    slice_concurrency: int = 4
    io_concurrency: int = 16
    manifest_dir: str | None = None
    resume: bool = False
    # Slices of one table that share one scan; 1 gives every slice its own job.
    slices_per_pass: int = 32
    # Names the storage account of az:// and abfs:// targets that do not.
    azure_account: str | None = None
    # True numbers files part-00000 upwards, False leaves Spark's names. None: by file system.
    numbered_files: bool | None = None
    # True writes files where they stay, False moves them there. None: by file system.
    in_place: bool | None = None
    # Tasks write files themselves and cut them at the bytes they come to; they stay in place.
    arrow_files: bool = False
    # Take a digest of the rows as they are written, for verify_export.
    digest: bool = False
    # Fill files by a shuffle instead of by merging scan partitions.
    even_files: bool = False
    row_group_bytes: int = ROW_GROUP_BYTES
    dictionary: bool = True
    zstd_level: int = 3
    # A size and a row limit given together both hold; otherwise the size wins.
    both_limits: bool = False
    # Column that a high_watermark export follows.
    watermark_column: str | None = None
    # Rows that no slice or several slices keep fail a sliced task, unless this is set.
    allow_uncovered: bool = False
    # Conflicts are settled once: a default filled in is not taken for a wish later.
    settled: bool = False
    # Name of a file, with {file_index} for its number; by default part-NNNNN and the format.
    name_template: str | None = None

    def checked(self) -> ExportOptions:
        """The same options with invalid ones refused and conflicts settled."""
        if self.settled:
            return self
        if not self.target.strip():
            raise ValueError("target is required")
        for value, allowed, what in (
            (self.format, FORMATS, "format"),
            (self.compression, CODECS, "compression"),
            (self.consistency, CONSISTENCY_MODES, "consistency"),
            (self.mode, WRITE_MODES, "mode"),
        ):
            if value not in allowed:
                raise ValueError(f"unknown {what} {value!r}, expected one of {allowed}")
        limits = (self.table_concurrency, self.slice_concurrency, self.io_concurrency)
        if min(*limits, self.slices_per_pass) < 1:
            raise ValueError("concurrency values must be greater than zero")
        if self.memory_limit_mb < MIN_MEMORY_MB:
            raise ValueError(f"memory_limit_mb must be at least {MIN_MEMORY_MB}")
        if self.resume and not self.manifest_dir:
            raise ValueError("resume needs a manifest_dir")
        size, rows = settle_file_limits(
            self.target_file_bytes, self.max_rows_per_file, self.both_limits
        )
        return replace(
            self,
            compression=settle_codec(self.format, self.compression),
            target_file_bytes=size,
            max_rows_per_file=rows,
            settled=True,
        )

    def file_name(self, index: int) -> str:
        if self.name_template:
            return self.name_template.replace("{file_index}", f"{index:05d}")
        suffix = "" if self.format == "parquet" else CODEC_EXTENSIONS[self.compression]
        return f"part-{index:05d}.{FILE_EXTENSIONS[self.format]}{suffix}"


def settle_file_limits(
    size: int | None, rows: int | None, both: bool = False
) -> tuple[int | None, int | None]:
    """(size, rows): a given size wins over given rows unless ``both`` hold, and a size over
    the maximum falls back to the default. A row limit alone keeps the default size."""
    if size is not None and rows is not None and not both:
        log.warning("both a file size and a row limit given, the row limit is ignored")
        rows = None
    if rows is not None and rows < 1:
        raise ValueError("max_rows_per_file must be greater than zero")
    size = DEFAULT_FILE_BYTES if size is None else size
    if size < 1:
        raise ValueError("target_file_bytes must be greater than zero")
    if size > MAX_FILE_BYTES:
        log.warning("file size %d is above the maximum, using %d", size, DEFAULT_FILE_BYTES)
        size = DEFAULT_FILE_BYTES
    elif size > LARGE_FILE_BYTES:
        log.warning("files of %d MB may slow down readers", size // MB)
    return size, rows


def settle_codec(fmt: str, codec: str) -> str:
    """Codecs a format is not offered with are replaced, with a warning."""
    fallback = {"gzip": "snappy"} if fmt == "parquet" else {"snappy": "gzip"}
    if codec in fallback:
        log.warning("%s is not used with %s, writing %s", codec, fmt, fallback[codec])
    return fallback.get(codec, codec)
