"""A digest of a table's rows that no order changes, to hold an export against its source.

Every row has two hashes of 64 bits, and the digest is their sums and the number of rows:
rows may come in any order and from any number of files, but one that is changed, missing
or there twice makes another digest. Sums are taken right below a write, without a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Wide enough for the sums of any table.
HASH = "decimal(28,0)"


def _hashable(field: T.StructField) -> Column:
    """A column as the hash takes it; maps, which it does not take, by their sorted entries."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    return F.to_json(column) if "map<" in field.dataType.simpleString() else column


def digest_parts(schema: T.StructType, own: Column | bool = True) -> list[Column]:
    """The aggregates that ``digest_text`` makes a digest of, over the rows for which ``own`` holds."""
    columns = [_hashable(f) for f in schema.fields]
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
    own = F.lit(own) if isinstance(own, bool) else own
    return [F.count_if(own), *(F.sum(F.when(own, h.cast(HASH))) for h in hashes)]


def digest_text(parts: list) -> str:
    return "-".join(str(int(part or 0)) for part in parts)


def digest_of(df: DataFrame) -> str:
    """The digest of a frame's rows; one aggregate."""
    return digest_text(list(df.agg(*digest_parts(df.schema)).first()))
