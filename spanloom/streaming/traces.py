"""Traces of a stream: the values of whole traces, given out when a trace has been silent for a while."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanloom.functions.predicate import Predicates
from spanloom.functions.resolve import TRACE, Resolver
from spanloom.plans import ast as A
from spanloom.plans.parser import parse

TRACE_ROW = (
    "trace_id string, trace_start_ns long, trace_duration_ns long, root_name string, root_service_name string, span_count long, error_count long"
)
STATE = "start_ns long, end_ns long, child int, root_start long, root_id string, name string, service string, spans long, errors long, last_ms long"


def _closer(gap_ms: int):
    def close(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Take a trace's new spans in, or give out the trace when its time is over. The state is one row, however many spans."""
        if state.hasTimedOut:
            start, end, _, _, _, name, service, spans, errors, _ = state.get
            state.remove()
            yield pd.DataFrame([(key[0], start, end - start, name, service, spans, errors)], columns=[c.split()[0] for c in TRACE_ROW.split(", ")])
            return
        now = state.get if state.exists else None
        for pdf in batches:
            child = (pdf["parent_span_id"].fillna("") != "").astype(int)
            best = pdf.assign(child=child).sort_values(["child", "start_ns", "span_id"]).iloc[0]
            own = (int(best["child"]), int(best["start_ns"]), best["span_id"], best["name"], best["service_name"])
            ends = pdf["start_ns"] + pdf["duration_ns"]
            made = [int(pdf["start_ns"].min()), int(ends.max()), *own, len(pdf), int((pdf["status"] == "error").sum()), int(pdf["start_ns"].max() // 1_000_000)]
            if now is not None:
                root = min(own[:3], tuple(now[2:5]))
                made[:2] = min(made[0], now[0]), max(made[1], now[1])
                made[2:7] = own if root == own[:3] else now[2:7]
                made[7:] = made[7] + now[7], made[8] + now[8], max(made[9], now[9])
            now = tuple(made)
        if now is not None:
            state.update(now)
            state.setTimeoutTimestamp(max(now[-1] + gap_ms, state.getCurrentWatermarkMs() + 1))
        yield from ()

    return close


def closed_traces(spans: DataFrame, gap: str = "30 seconds", lateness: str = "1 minute") -> DataFrame:
    """Values of whole traces, as operators.rollup.trace_rollup has them, with spans and errors; append mode.

    spans: a streaming canonical spans DataFrame. A trace is closed once the watermark, ``lateness`` behind the latest start,
    is ``gap`` past the start of its last span. Spans may come in any order until then; later than the watermark they are
    dropped. A trace that goes on after its gap is given out again as another part.
    """
    millis = int(pd.Timedelta(gap).total_seconds() * 1000)
    columns = ["trace_id", "span_id", "parent_span_id", "start_ns", "duration_ns", "name", "service_name", "status"]
    timed = spans.select(*columns, F.timestamp_micros(F.expr("start_ns div 1000")).alias("ts")).withWatermark("ts", lateness)
    return timed.groupBy("trace_id").applyInPandasWithState(_closer(millis), TRACE_ROW, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def matching_traces(spans: DataFrame, query: str, gap: str = "30 seconds", lateness: str = "1 minute") -> DataFrame:
    """Closed traces that meet a filter of trace values, such as ``{ traceDuration > 2s && rootServiceName = "cart" }``."""
    root = parse(query).root
    stages = root.stages if isinstance(root, A.Pipeline) else ()
    asked = [n for s in stages for n in A.walk(s) if isinstance(n, A.Attr) or isinstance(n, A.Intrinsic) and n.name not in TRACE]
    if not stages or asked or not all(isinstance(s, A.SpansetFilter) for s in stages):
        raise A.UnsupportedQuery("a stream of traces takes filters of traceDuration, rootName and rootServiceName")
    out = closed_traces(spans, gap, lateness)
    for stage in stages:
        out = out.where(Predicates(Resolver(out)).boolean(stage.expr))
    return out
