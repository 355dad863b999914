"""The span tree of each trace as nested sets: left, right, the parent's left, and the number of children."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.resolve import quoted

from .tour import checkpointed, large_traces, tour_sets

SCHEMA = (
    "trace_id string, span_id string, nested_left int, nested_right int, nested_parent int, child_count int"
)


def number_spans(pdf: pd.DataFrame) -> pd.DataFrame:
    """Nested sets of whole traces, sorted by trace, start and span id. All traces are numbered at once, level by level.

    Roots are numbered in start order by one counter per trace and have parent -1. A span whose ancestors don't lead to a
    root (a missing parent, a cycle) keeps 0, 0, 0. A parent id that occurs twice means the first span; a span that
    repeats an id is left out, and takes its first bearer's place.
    """
    pdf = pdf.drop_duplicates(["trace_id", "span_id"]).reset_index(drop=True)
    n = len(pdf)
    trace = pd.factorize(pdf["trace_id"])[0]
    is_root = (pdf["parent_span_id"].isna() | (pdf["parent_span_id"] == "")).to_numpy()
    at = pd.DataFrame({"t": trace, "id": pdf["span_id"], "row": np.arange(n)})
    wanted = pd.DataFrame({"t": trace, "id": pdf["parent_span_id"]}).merge(at, "left", ["t", "id"])["row"]
    parent = wanted.fillna(-1).to_numpy(dtype=np.int64)
    parent[is_root] = -1

    children = np.bincount(parent[parent >= 0], minlength=n).astype(np.int64)
    # rows in order of their parents, so that a level's children are found by slices
    by_parent = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[by_parent], np.arange(n))
    levels = [np.flatnonzero(is_root)]
    while len(levels[-1]):
        above = levels[-1][children[levels[-1]] > 0]
        k = children[above]
        starts = np.repeat(first[above] - (np.cumsum(k) - k), k)
        levels.append(by_parent[starts + np.arange(k.sum())])
    size = np.zeros(n, dtype=np.int64)
    for rows in reversed(levels):
        size[rows] += 1
        inner = rows[parent[rows] >= 0]
        np.add.at(size, parent[inner], size[inner])
    left = np.zeros(n, dtype=np.int64)
    for depth, rows in enumerate(levels):
        if not len(rows):
            break
        group = trace[rows] if depth == 0 else parent[rows]
        through = np.cumsum(size[rows])
        begins = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
        base = np.repeat((through - size[rows])[begins], np.diff(np.append(begins, len(rows))))
        before = through - size[rows] - base
        left[rows] = 1 + 2 * before + (0 if depth == 0 else left[parent[rows]])
    placed = left > 0
    right = np.where(placed, left + 2 * size - 1, 0)
    above = np.where(placed, np.where(is_root, -1, left[np.maximum(parent, 0)]), 0)
    return pd.DataFrame(
        {
            "trace_id": pdf["trace_id"], "span_id": pdf["span_id"], "nested_left": left.astype(np.int32),
            "nested_right": right.astype(np.int32), "nested_parent": above.astype(np.int32),
            "child_count": children.astype(np.int32),
        }
    )


def _whole_traces(batches):
    """Batches in trace order, regrouped so that none ends within a trace. Parts of a trace are joined once."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        ids = pdf["trace_id"]
        if held and ids.iloc[-1] == held[-1]["trace_id"].iloc[-1]:
            held.append(pdf)  # all of one trace, as traces come in order
            continue
        cut = int(ids.searchsorted(ids.iloc[-1], side="left"))
        if held or cut:
            yield pd.concat([*held, pdf.iloc[:cut]], ignore_index=True)
        held = [pdf.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


#: A session's setting: traces of more spans than this are numbered over the cluster. Where it is set, traces are measured.
LARGEST = "spanloom.largestTrace"


def _apart(spans: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Spans of the traces that one task numbers, and of those that are too large for it, if any."""
    most = spans.sparkSession.conf.get(LARGEST, None)
    if most is None:
        return spans, None
    large = checkpointed(large_traces(spans, int(most)))
    if large.isEmpty():
        return spans, None
    return spans.join(large, "trace_id", "left_anti"), spans.join(large, "trace_id", "left_semi")


def nested_sets(spans: DataFrame) -> DataFrame:
    """One row per distinct (trace_id, span_id). One shuffle by trace; a task holds one batch and the trace at its end.

    Where LARGEST is set, larger traces are ranked over the cluster, see tour.tour_sets.
    """
    spans, large = _apart(spans)
    found = _nested_sets(spans)
    return found if large is None else found.union(tour_sets(large))


def _nested_sets(spans: DataFrame) -> DataFrame:
    keys = spans.select("trace_id", "span_id", "parent_span_id", "start_ns")
    ordered = keys.repartition("trace_id").sortWithinPartitions("trace_id", "start_ns", "span_id")

    def run(batches):
        for pdf in _whole_traces(p for p in batches if len(p)):
            yield number_spans(pdf)

    return ordered.mapInPandas(run, SCHEMA)


NUMBERS = "struct<nested_left: int, nested_right: int, nested_parent: int, child_count: int>"


def _number_rows(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """The numbers of rows in trace order, for each row; rows that repeat an id have the same."""
    names = ["trace_id", "span_id", "parent_span_id", "start_ns"]
    for pdf in _whole_traces(pd.concat(c, axis=1, keys=names) for c in columns if len(c[0])):
        found = number_spans(pdf)
        if len(found) < len(pdf):
            found = pdf[["trace_id", "span_id"]].merge(found, "left", ["trace_id", "span_id"])
        yield found.drop(columns=["trace_id", "span_id"])


def with_tree(spans: DataFrame) -> DataFrame:
    """spans with the numbers of nested_sets, by one shuffle.

    The numbers are a column that is computed over the sorted rows of a partition: workers see four columns of them, and all
    others wait in Spark, on disk if need be, until the trace is numbered. The column isn't deterministic to Spark, which
    therefore puts no filter below it.
    """
    spans, large = _apart(spans)
    ordered = spans.repartition("trace_id").sortWithinPartitions("trace_id", "start_ns", "span_id")
    numbers = F.pandas_udf(_number_rows, NUMBERS).asNondeterministic()
    made = ordered.withColumn("__tree", numbers("trace_id", "span_id", "parent_span_id", "start_ns"))
    made = made.select(*map(quoted, spans.columns), "__tree.*")
    return made if large is None else made.unionByName(large.join(tour_sets(large), ["trace_id", "span_id"]))
