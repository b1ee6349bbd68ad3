"""What the physical plans must and must not contain."""

import pytest

from tidemark.plans import tables
from tidemark.plans.queries import QUERIES
from tidemark.sources import gzip_members, readers, scratch, sinks

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


FILES = ("q36", "q37", "q42", "q43", "q44", "q46", "q47", "q48")
#: Unit vectors, exact products and loaded models run over Arrow batches.
VECTORS = ("q20", "q21", "q22", "q23", "q24", "q39", "q40", "q41")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(FILES)])
def test_no_python_and_no_cross_joins(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if not name.startswith(VECTORS):
        assert not any(node in plan for node in PYTHON)


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of the tables that a query writes while it is built, by name."""
    plans = {}

    def keep(df, name, partition_by=None, written=scratch.written):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name, partition_by)

    monkeypatch.setattr(scratch, "written", keep)
    return plans


def test_cascade_counts_pairs_before_it_cuts(spark, sf_dir, written_plans):
    QUERIES["q12_active_by_median"](spark, sf_dir)
    assert set(written_plans) == {"pair-counts", "kept-customer_id", "kept-product_id"}
    (pairs,) = written_plans["pair-counts"]
    assert "partial_count(1)" in pairs and "ReadSchema: struct<text:string,lang:string,n_chars:bigint>" in pairs
    for key in ("kept-customer_id", "kept-product_id"):
        (kept,) = written_plans[key]
        assert "partial_sum(n" in kept and "documents.parquet" not in kept.split("Subquery")[0]


@pytest.mark.parametrize("name", ["q19_hashed_vectors", "q20_mean_distances", "q22_nearest_sentences",
                                  "q37_review_file", "q39_encoded_vectors", "q42_video_file"])
def test_no_round_robin(spark, sf_dir, written_plans, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for part in [plan, *(p for plans in written_plans.values() for p in plans)]:
        assert "RoundRobin" not in part


def test_embeddings_are_read_once(spark, sf_dir, written_plans):
    plan = QUERIES["q41_label_nearest"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    every = [plan, *(p for plans in written_plans.values() for p in plans)]
    assert sum(p.count("embeddings.parquet") for p in every) == 1


def test_class_sums_are_made_in_the_map_tasks(spark, sf_dir, written_plans):
    QUERIES["q21_class_centres"](spark, sf_dir)
    (means,) = written_plans["class-means"]
    assert means.index("Exchange") < means.index("MapInArrow") and "partial_sum(" in means


@pytest.mark.parametrize(
    "name",
    ["q06_top_customers", "q07_top_products", "q14_top_customers_by_sentences",
     "q15_top_products_by_sentences", "q28_top_growth"],
)
def test_top_k_is_a_heap_per_task(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize(
    "name, read",
    [
        ("q06_top_customers", "struct<o_custkey:bigint>"),
        ("q02_distinct_customers", "struct<o_custkey:bigint>"),
        ("q31_average_rating_per_genre", "struct<l_partkey:bigint,l_quantity:double>"),
        ("q25_countries_per_video", "struct<l_partkey:bigint,l_suppkey:bigint>"),
    ],
)
def test_scans_read_only_the_needed_columns(spark, sf_dir, name, read):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: {read}" in plan


def test_product_filter_reaches_the_scan(spark, sf_dir):
    df = QUERIES["q16_class_split"](spark, sf_dir)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(lang,en)" in plan


def test_ratings_are_summed_before_the_join(spark, sf_dir):
    df = QUERIES["q31_average_rating_per_genre"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("partial_sum(rating")


@pytest.mark.parametrize("name", ["q22_nearest_sentences", "q41_label_nearest"])
def test_neighbours_are_cut_before_the_shuffle(spark, sf_dir, written_plans, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 10, Partial" in plan
    (centre,) = written_plans["centre-ids"]
    assert "row_number(), 1, Partial" in centre


def test_files_follow_the_input(spark, sf_dir, monkeypatch):
    """No task writes or sorts a fixed share of the input."""
    written, read, ordered = [], [], []

    def write_lines(lines, *rest, write=gzip_members.write_lines):
        written.append(lines.rdd.getNumPartitions())
        return write(lines, *rest)

    def read_videos(spark, path, read_all=readers.read_videos, **options):
        read.append(len(spark.read.text(path).inputFiles()))
        return read_all(spark, path, **options)

    def write_ordered(rows, path, order, parts, write=sinks.write_ordered):
        ordered.append(parts)
        return write(rows, path, order, parts)

    monkeypatch.setattr(readers, "read_videos", read_videos)
    monkeypatch.setattr(sinks, "write_ordered", write_ordered)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    monkeypatch.setattr(tables, "FILE_ROWS", rows // 8)
    QUERIES["q57_growth_by_arrival"](spark, sf_dir)
    QUERIES["q58_ordered_files"](spark, sf_dir)
    assert read[0] >= 8 and ordered[0] >= 8
    monkeypatch.setattr(gzip_members, "write_lines", write_lines)
    monkeypatch.setattr(tables, "FILE_BYTES", tables.text_bytes(spark, sf_dir) // 5)
    QUERIES["q49_gzip_members"](spark, sf_dir)
    assert written[0] >= 5
