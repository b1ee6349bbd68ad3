import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import folding, positions, selection
from tidemark.sources import scratch


def files(spark):
    root = scratch._run_folder(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}


def entries(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_a_lifetime_leaves_nothing(spark, tmp_path):
    before, known = files(spark), entries(spark)
    df = spark.range(500).selectExpr("id % 5 k", "cast(id as double) v")
    with scratch.lifetime(spark):
        scratch.bucketed(df, "some-rows", 3, ["k"]).write.parquet(f"{tmp_path}/rows")
        selection.quantiles(df, "k", "v").write.parquet(f"{tmp_path}/quantiles")
        positions.numbered(df, ["v"]).write.parquet(f"{tmp_path}/positions")
        folding.fold_by_key(df, ["k"], ["v"], folding.average()).collect()
        assert len(files(spark)) > len(before) and len(entries(spark)) == len(known) + 1
    assert files(spark) == before and entries(spark) == known
    assert spark.read.parquet(f"{tmp_path}/positions").count() == 500


def test_a_failure_leaves_nothing(spark):
    before, known = files(spark), entries(spark)
    with pytest.raises(RuntimeError), scratch.lifetime(spark):
        scratch.bucketed(spark.range(3), "rows", 2, ["id"])
        raise RuntimeError
    assert files(spark) == before and entries(spark) == known


def test_lifetimes_lie_in_each_other(spark):
    with scratch.lifetime(spark):
        with scratch.lifetime(spark):
            inner = scratch.written(spark.range(4), "inner")
            kept = scratch.written(inner.select((F.col("id") + 1).alias("id")), "kept", outside=True)
        assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4]
        with pytest.raises(Exception, match="(?i)exist|found"):
            inner.collect()
    with pytest.raises(Exception, match="(?i)exist|found"):
        kept.collect()


def test_bucketed_rows_need_no_shuffle(spark, executed, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    with scratch.lifetime(spark):
        rows = spark.range(100).selectExpr("id", "id % 9 k")
        a, b = (scratch.bucketed(rows, "rows", 4, ["id"]) for _ in range(2))
        assert "Exchange" not in executed(a.join(b, "id"))
