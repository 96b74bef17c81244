"""Looking at the previous row of a key without bringing a key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of a block, on average.
BLOCK_ROWS = 200_000
PERCENTILE_ACCURACY = 10_000


def previous_by_key(
    df: DataFrame, key: str, order: str, value: str, alias: str, blocks: int | None = None
) -> DataFrame:
    """``df`` with the ``value`` of the row before, in ``order`` within ``key``.

    The order range is cut at its quantiles, so a key with most of the rows falls
    apart into blocks that are windows of their own, as many as the rows fill. Rows
    without a key are one key, those without an order come first. The first row of a block
    takes its value from the last row of the key's block before, which comes from
    one pre-aggregated row per key and block.
    """
    block = "__block"
    blocks = blocks or max(1, -(-df.count() // BLOCK_ROWS))
    blocked = df.withColumn(block, _block_number(df, order, blocks))
    within = Window.partitionBy(key, block).orderBy(order)
    rows = blocked.withColumn("__row", F.row_number().over(within)).withColumn(
        "__before", F.lag(value).over(within)
    )
    carried = (
        blocked.groupBy(key, block)
        .agg(F.max(F.struct(order, value))[value].alias("__last"))
        .withColumn("__carry", F.lag("__last").over(Window.partitionBy(key).orderBy(block)))
        .select(key, block, "__carry")
    )
    carried = carried.select(F.col(key).alias("__key"), F.col(block).alias("__in"), "__carry")
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(block) == F.col("__in"))
    return rows.join(carried, same).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(F.col("__row") == 1, F.col("__carry")).otherwise(F.col("__before")).alias(alias),
    )


def _block_number(df: DataFrame, order: str, blocks: int) -> Column:
    shares = [i / blocks for i in range(1, blocks)]
    cuts = df.agg(F.percentile_approx(order, shares, PERCENTILE_ACCURACY)).first()[0] or []
    edges = sorted(set(cuts))
    return F.aggregate(
        F.array(*[F.lit(edge) for edge in edges]) if edges else F.array().cast("array<long>"),
        F.lit(0),
        lambda number, edge: number + F.coalesce((F.col(order) > edge).cast("int"), F.lit(0)),
    )
