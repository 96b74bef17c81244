"""File operations through the Hadoop file system of a path."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tablelift.session import small_frame

# Schemes where a rename is a metadata operation. Elsewhere it copies the bytes.
RENAMING_SCHEMES = {"file", "hdfs", "viewfs", "abfs", "abfss"}


def hadoop_uri(target: str, azure_account: str | None = None) -> str:
    """A storage target as the URI its Hadoop connector expects."""
    match = re.match(r"^([a-z0-9]+)://(.*)$", target)
    if not match:
        return target
    scheme, rest = match.groups()
    if scheme == "file":
        return target
    bucket, _, path = rest.partition("/")
    if not bucket:
        raise ValueError(f"target {target!r} names no bucket or container")
    if scheme in ("az", "abfs", "abfss"):
        if "@" not in bucket:
            if not azure_account:
                raise ValueError(f"target {target!r} needs an azure account")
            bucket = f"{bucket}@{azure_account}.dfs.core.windows.net"
        return f"abfss://{bucket}/{path}"
    if scheme == "s3":
        return f"s3a://{bucket}/{path}"
    return target


class Store:
    """Existence, listing, rename and delete for one path's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.can_rename = self._fs.getUri().getScheme() in RENAMING_SCHEMES

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def qualified(self, path: str) -> str:
        """The path with its scheme, for readers that know no default file system."""
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, source: str, dest: str) -> None:
        if not self._fs.rename(self._path(source), self._path(dest)):
            raise OSError(f"cannot rename {source} to {dest}")

    def write_text(self, path: str, text: str) -> None:
        """A small file, which readers see whole or not at all."""
        folder, _, name = path.rpartition("/")
        hidden = f"{folder}/_{name}" if self.can_rename else path
        out = self._fs.create(self._path(hidden), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if hidden != path:
            self.rename(hidden, path)

    def replace_text(self, path: str, text: str) -> None:
        """A small file, in place of the one that is there: readers see one or the other whole."""
        hidden = path
        if self.can_rename:
            folder, _, name = path.rpartition("/")
            hidden = f"{folder}/_{uuid.uuid4().hex}-{name}"
        out = self._fs.create(self._path(hidden), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if hidden != path:
            hadoop = self._jvm.org.apache.hadoop.fs
            over = self._gateway.new_array(hadoop.Options.Rename, 1)
            over[0] = hadoop.Options.Rename.OVERWRITE
            files = hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
            files.rename(self._path(hidden), self._path(path), over)

    def read_text(self, path: str) -> str | None:
        """What a small file holds; None if there is none."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def identity(self, path: str, tail: int) -> tuple[int, int, str] | None:
        """(length, modification time, SHA-256 of the last ``tail`` bytes) of a file, if it is there."""
        if not self.exists(path):
            return None
        status = self._fs.getFileStatus(self._path(path))
        stream = self._fs.open(self._path(path))
        try:
            stream.seek(max(0, status.getLen() - tail))
            digest = self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
        return status.getLen(), status.getModificationTime(), digest

    def identities(self, paths: list[str], tail: int, threads: int) -> list[tuple[int, int, str] | None]:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            return list(pool.map(lambda path: self.identity(path, tail), paths))

    def find(self, folder: str, name: str, depth: int) -> list[str]:
        """Paths of the files of this name in a folder and ``depth`` levels below it."""
        found = []
        for level in range(depth + 1):
            statuses = self._fs.globStatus(self._path("/".join([folder.rstrip("/"), *["*"] * level, name])))
            found += [status.getPath().toString() for status in statuses or []]
        return found

    def walk(self, path: str) -> list[str]:
        """Paths of all visible files below a folder."""
        found, folders = [], [self._fs.makeQualified(self._path(path))]
        while folders:
            for status in self._fs.listStatus(folders.pop()):
                if not status.getPath().getName().startswith((".", "_")):
                    if status.isDirectory():
                        folders.append(status.getPath())
                    else:
                        found.append(status.getPath().toString())
        return found

    def rename_all(self, pairs: list[tuple[str, str]], threads: int) -> None:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            list(pool.map(lambda pair: self.rename(*pair), pairs))

    def files(self, path: str) -> dict[str, int]:
        """Visible entries of a folder with their sizes, in name order."""
        if not self.exists(path):
            return {}
        listed = self._fs.listStatus(self._path(path))
        sizes = {status.getPath().getName(): status.getLen() for status in listed}
        return {n: sizes[n] for n in sorted(sizes) if not n.startswith((".", "_")) or "=" in n}

    def usage(self, path: str) -> tuple[int, int]:
        """(bytes, files) below a path."""
        if not self.exists(path):
            return 0, 0
        summary = self._fs.getContentSummary(self._path(path))
        return summary.getLength(), summary.getFileCount()


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row (path, bytes) per file below ``path``; no rows if it does not exist.

    The listing is Spark's own parallel one and no file is opened.
    """
    if not Store(spark, path).exists(path):
        return small_frame(spark, [], "path string, bytes long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.selectExpr("path", "length AS bytes")
