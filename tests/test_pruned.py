import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import centres, pruned
from tidemark.sources import scratch

SCHEMA = "label int, review_id bigint, pos int, vector array<double>"


def clustered(spark, n=3000, classes=3, size=12, spread=0.15, seed=5):
    """Vectors in tight clusters, some clusters in a class."""
    dice = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = i % classes
        middle = np.random.default_rng([label, i // classes % 6]).standard_normal(size)
        vector = middle + spread * dice.standard_normal(size)
        rows.append((None if label == 2 else label, i, i % 4, vector.tolist()))
    rows += [(0, n, 0, [0.0] * size), (9, n + 1, 0, [1.0] * size), (8, n + 2, 0, [2.0] * size),
             (8, n + 3, 0, [1.0] + [0.0] * (size - 1)), (0, 3, 3, rows[3][3])]
    df = spark.createDataFrame(rows, SCHEMA)
    return scratch.written(centres.unit_vectors(df, "label"), "units")


def found_by_all(units, k):
    return sorted(tuple(r) for r in centres.nearest_to_centres(units, "label", k=k).collect())


@pytest.mark.parametrize("k, pivots", [(1, 1), (10, 4), (10, 16), (700, 8)])
def test_equal_to_the_search_over_all(spark, k, pivots):
    units = clustered(spark).withColumn("label", F.coalesce("label", F.lit(-1)))
    units = scratch.written(units, "units")
    layout = pruned.laid_out(units, "label", pivots, row_group=1 << 14)
    centre = centres.centre_rows(centres.directed_units(units, "label", None), "label")
    found = sorted(tuple(r) for r in pruned.nearest_to_centres(layout, centre, k).collect())
    assert found == found_by_all(units, k) and len(found) > 3


def test_a_class_without_a_name(spark):
    units = clustered(spark, n=600)
    layout = pruned.laid_out(units, "label", 4)
    filled = scratch.written(units.withColumn("label", F.coalesce("label", F.lit(-1))), "units")
    centre = centres.centre_rows(centres.directed_units(filled, "label", None), "label")
    centre = centre.withColumn("label", F.when(F.col("label") != -1, F.col("label")))
    found = pruned.nearest_to_centres(layout, centre, 5).collect()
    named = sorted((-1 if r.label is None else r.label, *tuple(r)[1:]) for r in found)
    assert named == found_by_all(filled, 5) and any(r.label is None for r in found)


def test_fewer_vectors_are_read(spark):
    """Of clustered vectors the conditions of the scan leave a small part."""
    units = clustered(spark, n=9000, spread=0.05).filter("label is not null")
    layout = pruned.laid_out(units, "label", 24, row_group=1 << 14)
    centre = centres.centre_rows(centres.directed_units(units, "label", None), "label")
    some = pruned.candidates(layout, centre, 10)
    assert 30 < len(some.collect()) < 0.2 * layout.total
    scan = some._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().get("numOutputRows").get().value()
    assert 30 < read < 0.4 * layout.total  # row groups beyond the bounds are not read
    print(f"vectors: {layout.total}, read by the scan: {read}, left: {some.count()}")


def test_bounds_beyond_the_conditions_are_joined(spark, monkeypatch):
    units = clustered(spark, n=900).filter("label is not null")
    layout = pruned.laid_out(units, "label", 5)
    centre = centres.centre_rows(centres.directed_units(units, "label", None), "label")
    expected = sorted(map(tuple, pruned.nearest_to_centres(layout, centre).collect()))
    monkeypatch.setattr(pruned, "CONDITIONS", 2)
    assert sorted(map(tuple, pruned.nearest_to_centres(layout, centre).collect())) == expected


def test_empty(spark):
    units = clustered(spark, n=60).limit(0)
    layout = pruned.laid_out(units, "label")
    centre = centres.centre_rows(centres.directed_units(units, "label", None), "label")
    assert layout.total == 0 and pruned.nearest_to_centres(layout, centre).count() == 0
