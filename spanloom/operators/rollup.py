"""Values of whole traces: duration, root name and service, span counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.resolve import quoted


def trace_rollup(spans: DataFrame) -> DataFrame:
    """One row per trace: the span of the root is the first parentless one by start, or else the first by start.

    One partial aggregation; ties go by span id.
    """
    child = (F.coalesce(quoted("parent_span_id"), F.lit("")) != "").cast("int")
    order = F.struct(child, quoted("start_ns"), quoted("span_id"))
    root = F.min_by(F.struct(quoted("name").alias("name"), quoted("service_name").alias("service")), order)
    return (
        spans.groupBy("trace_id")
        .agg(
            F.min("start_ns").alias("trace_start_ns"),
            (F.max(quoted("start_ns") + quoted("duration_ns")) - F.min("start_ns")).alias("trace_duration_ns"),
            root.alias("root"),
        )
        .select(
            "trace_id", "trace_start_ns", "trace_duration_ns", F.col("root.name").alias("root_name"),
            F.col("root.service").alias("root_service_name"),
        )
    )


def service_stats(spans: DataFrame) -> DataFrame:
    """Spans and errors of each service of each trace."""
    return spans.groupBy("trace_id", "service_name").agg(
        F.count(F.lit(1)).alias("span_count"), F.count_if(F.col("status") == "error").alias("error_count")
    )
