"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import local

from pyspark.sql import DataFrame, SparkSession

from tablelift.session import fresh_dir
from tablelift.storage import Store

_open = local()


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table, read back: computed once, with no lineage behind it.

    Inside ``scratch`` the table is gone when that ends.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    for made in getattr(_open, "made", [])[-1:]:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread writes inside are deleted at the end.

    What is computed from them must have been written elsewhere by then.
    """
    _open.made = [*getattr(_open, "made", []), []]
    try:
        yield
    finally:
        *_open.made, paths = _open.made
        for path in paths:
            Store(spark, path).delete(path)
