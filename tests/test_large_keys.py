"""Named queries on tables whose keys are larger than those of the test data."""

from pyspark.sql import functions as F

from tablelift.plans import integrity


def test_slices_of_even_weight_by_the_cube_of_a_large_key(spark, tmp_path):
    orders = spark.range(4_000).select(
        (F.col("id") * 1_000 + 3_000_000_000).alias("o_orderkey"), F.lit("O").alias("o_orderstatus")
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = {row.key: row for row in integrity.slice_even(spark, str(tmp_path)).collect()}
    for key in ("cubed", "half"):
        row = found[key]
        assert (row.row_count, row.rows_first, row.keys_found, row.even, row.alone) == (4_000, 4_000, 4_000, True, True)
