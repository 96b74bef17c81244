import os

from tablelift.llm.tables import scratch, written
from tablelift.session import shared_dir


def labelled(spark, label):
    return [n for n in os.listdir(shared_dir(spark)) if n.startswith(label)]


def test_tables_of_a_scratch_are_gone_when_it_ends(spark):
    kept = written(spark.range(3), "kept-table")
    with scratch(spark):
        outer = written(spark.range(5), "outer-table")
        with scratch(spark):
            assert written(spark.range(7), "inner-table").count() == 7
        assert not labelled(spark, "inner-table") and outer.count() == 5
    assert not labelled(spark, "outer-table")
    assert kept.count() == 3 and len(labelled(spark, "kept-table")) == 1
