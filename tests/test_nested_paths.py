"""Paths of deep elements hold each path above them once."""

from pyspark.sql import functions as F

from ironsift.operators.nested_rules import _below


def test_paths_grow_with_their_depth(spark):
    def deep(x):
        for k in range(6):
            x = _below(x, f"n{k}")
        return x

    df = spark.createDataFrame([(["a"],)], "p array<string>").select(F.transform("p", deep).alias("paths"))
    assert df.first().paths == ["a/n0/n1/n2/n3/n4/n5"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("lambda x") <= 2
