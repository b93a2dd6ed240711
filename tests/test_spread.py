"""Rows of one small file are worked on by all cores."""

import pytest

from tidemark.operators.sides import spread
from tidemark.plans import registry


@pytest.mark.parametrize("name", ["token_features", "token_places"])
def test_token_queries_use_all_cores(spark, tmp_path, name):
    rows = [(i, f"name {i}", "brand", "type") for i in range(50)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    out = registry.queries()[name](spark, str(tmp_path))
    sizes = [n for n in out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert out.select("p_partkey").distinct().count() == 50


def test_rows_that_are_spread_stay_where_they_are(spark):
    df = spark.range(0, 100, 1, 9)
    assert spread(df) is df
