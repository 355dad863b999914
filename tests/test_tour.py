import random

import pytest
from pyspark.sql import functions as F

from spanloom.engine import TraceEngine
from spanloom.operators import tour, tree
from spanloom.operators.tree import nested_sets

SPANS = "trace_id string, span_id string, parent_span_id string, start_ns long"


def random_traces(rng):
    rows = []
    for t in range(8):
        n = rng.choice([1, 5, 60, 400])
        for i in range(n):
            parent = None if rng.random() < 0.02 or i == 0 else f"{rng.randrange(n) if rng.random() < 0.05 else rng.randrange(i)}"
            rows.append((f"t{t}", f"{i}", rng.choice([parent, parent, "gone" if rng.random() < 0.05 else parent]), rng.randrange(50)))
        rows.append((f"t{t}", "0", "1" if n > 1 else None, 99))  # repeats an id
    return rows + [("loop", "a", "b", 1), ("loop", "b", "a", 2), ("loop", "c", "c", 3), ("two", "r", "", 1), ("two", "q", None, 2), ("two", "k", "q", 0)]


def sets(df):
    return {(r.trace_id, r.span_id): (r.nested_left, r.nested_right, r.nested_parent, r.child_count) for r in df.collect()}


@pytest.mark.parametrize("one_task", [1 << 20, 400])
def test_ranking_equals_numbering(spark, monkeypatch, one_task):
    monkeypatch.setattr(tour, "ONE_TASK", one_task)
    monkeypatch.setattr(tour, "SPACING", 4)
    spans = spark.createDataFrame(random_traces(random.Random(one_task)), SPANS)
    assert sets(tour.tour_sets(spans)) == sets(nested_sets(spans))
    assert tour.tour_sets(spans.limit(0)).count() == 0


def test_a_chain_of_many_spans(spark, monkeypatch):
    monkeypatch.setattr(tour, "ONE_TASK", 1 << 15)
    n = 100_000
    ids = F.format_string("%06d", "id")
    spans = spark.range(n).select(F.lit("t").alias("trace_id"), ids.alias("span_id"), F.when(F.col("id") > 0, F.format_string("%06d", F.col("id") - 1)).alias("parent_span_id"), F.col("id").alias("start_ns"))
    got = tour.tour_sets(spans).withColumn("i", F.col("span_id").cast("int"))
    assert got.count() == n
    assert got.where((F.col("nested_left") != F.col("i") + 1) | (F.col("nested_right") != 2 * n - F.col("i")) | (F.col("nested_parent") != F.when(F.col("i") > 0, F.col("i")).otherwise(-1))).isEmpty()


def test_large_traces_are_measured_and_ranked(spark):
    rows = [(t, s, p, n, 10, f"n{s}", "s") for t, s, p, n in random_traces(random.Random(3))]
    spans = spark.createDataFrame(rows, SPANS + ", duration_ns long, name string, service_name string")
    query = '{ name =~ "n[0-4].*" } >> { name =~ ".*[13579]" }'
    pairs = lambda: sorted((r.trace_id, r.span_id) for r in TraceEngine(spans).spans_of(query).collect())
    plain, numbers = pairs(), sets(nested_sets(spans))
    spark.conf.set(tree.LARGEST, "30")
    try:
        assert pairs() == plain and sets(nested_sets(spans)) == numbers and plain
    finally:
        spark.conf.unset(tree.LARGEST)
