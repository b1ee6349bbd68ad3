import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile, selection


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_against_numpy(spark, parts):
    pick = random.Random(parts)
    rows = []
    for key, n, spread in (("a", 4000, 10**9), ("b", 500, 5), ("c", 1, 9), (None, 37, 100), ("d", 2, 50)):
        rows += [(key, pick.randint(-spread, spread)) for _ in range(n)]
    rows += [("e", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(5)
    fractions = (0.0, 0.1, 0.5, 0.75, 1.0)
    found = selection.quantiles(df, "k", "v", fractions, parts).collect()
    by_key = {}
    for key, value in rows:
        if value is not None:
            by_key.setdefault(key, []).append(value)
    assert {(r.k, r.fraction) for r in found} == {(k, f) for k in by_key for f in fractions}
    for r in found:
        own = sorted(by_key[r.k])
        place = (len(own) - 1) * r.fraction
        assert (r.n, r.lower, r.upper) == (len(own), own[int(place)], own[int(np.ceil(place))])
        assert r.quantile == pytest.approx(np.quantile(own, r.fraction), rel=1e-12, abs=1e-9)


def test_doubles_and_nan(spark):
    rows = [("a", v) for v in (1.5, float("nan"), -2.0, 0.25)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.fraction: r for r in selection.quantiles(df, "k", "v", (0.0, 0.5, 1.0)).collect()}
    assert (found[0.0].quantile, found[0.5].lower, found[0.5].upper) == (-2.0, 0.25, 1.5)
    assert np.isnan(found[1.0].lower)


def test_equals_the_median_of_profile(spark):
    df = spark.range(5000).selectExpr("id % 7 k", "pmod(xxhash64(id), 1000) v")
    expected = {tuple(r) for r in profile.median_per_key(df, "k", "v").collect()}
    assert {tuple(r) for r in selection.medians(df, "k", "v", 5).collect()} == expected


def test_no_task_takes_a_key(spark):
    """One key with half a million different values: every range has its share of them."""
    df = spark.range(500_000).select(F.lit("hot").alias("k"), F.xxhash64("id").alias("v"))
    table = selection._parted(df, "k", "v", 20)
    sizes = [r["count"] for r in table.groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 500_000 / 20
    [row] = selection.quantiles(df, "k", "v", (0.5,), 20).collect()
    assert row.quantile == df.agg(F.percentile("v", F.lit(0.5))).first()[0]


def test_wrong_fractions_and_empty(spark):
    df = spark.createDataFrame([], "k string, v bigint")
    assert selection.quantiles(df, "k", "v").count() == 0
    for fractions in ((), (1.5,), (-0.1,)):
        with pytest.raises(ValueError, match="between 0 and 1"):
            selection.quantiles(df, "k", "v", fractions)
