"""Rate, errors and duration as a stream: the metrics plan over Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.predicate import Predicates
from spanloom.functions.resolve import Resolver
from spanloom.plans import ast as A
from spanloom.plans.parser import parse


def red_metrics(spans: DataFrame, query: str, step: str = "1 minute", lateness: str = "5 minutes") -> DataFrame:
    """Per bucket and label set of a query such as ``{ kind = server } | rate() by (name)``: spans, errors, seconds.

    spans: a canonical spans DataFrame, streaming or not. Spans later than ``lateness`` are dropped by the watermark, which
    also ends the state of old buckets. Conditions on whole traces or structure need all of a trace and are refused.
    """
    root = parse(query).root
    if not isinstance(root, A.MetricsQuery) or root.agg.fn not in ("rate", "count_over_time") or root.second:
        raise A.UnsupportedQuery("a stream takes rate() or count_over_time() of a filter")
    from spanloom.operators.search import mentions, needs_tree
    from spanloom.functions.resolve import TRACE

    if needs_tree(root) or mentions(root, TRACE) or not all(isinstance(s, A.SpansetFilter) for s in root.stages):
        raise A.UnsupportedQuery("a stream takes conditions on single spans only")
    predicates = Predicates(Resolver(spans))
    rows = spans
    for stage in root.stages:
        rows = rows.where(predicates.boolean(stage.expr))
    keys = []
    for node in root.agg.by:
        value = predicates.value(node)
        text = value.text() if value is not None else F.lit(None).cast("string")
        keys.append(text.alias(node.text))
    timed = rows.select(
        F.timestamp_micros(F.expr("start_ns div 1000")).alias("ts"), *keys, "duration_ns", (F.col("status") == "error").alias("failed")
    )
    names = [F.col(f"`{n.text}`") for n in root.agg.by]
    for c in names:
        timed = timed.where(c.isNotNull())
    return (
        timed.withWatermark("ts", lateness)
        .groupBy(F.window("ts", step), *names)
        .agg(
            F.count(F.lit(1)).alias("spans"), F.count_if("failed").alias("errors"), F.sum("duration_ns").alias("duration_ns"),
        )
        .select(F.unix_millis("window.start").alias("bucket_ms"), *names, "spans", "errors", "duration_ns")
    )
