"""One trace by id, flat or nested as resource, scope and spans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from spanloom.functions.resolve import RESOURCE_MAP, RESOURCE_PREFIX, SPAN_MAP, TOP_RESOURCE, quoted
from spanloom.plans import ast as A


def normal_id(trace_id: str) -> str:
    text = trace_id.strip().lower()
    if not re.fullmatch(r"[0-9a-f]{1,32}", text):
        raise A.QueryError(f"not a trace id: {trace_id!r}")
    return text.zfill(32)


def trace_by_id(spans: DataFrame, trace_id: str, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
    """The trace's spans in the range. Ids are compared as 32 digits; rows whose id is so stored already use pushdown."""
    wanted = normal_id(trace_id)
    short = sorted({wanted, wanted.lstrip("0") or "0", wanted[16:] if wanted.startswith("0" * 16) else wanted})
    rows = spans.where(F.col("trace_id").isin(*short, *(s.upper() for s in short)))
    if start_ns is not None:
        rows = rows.where(F.col("start_ns") >= start_ns)
    if end_ns is not None:
        rows = rows.where(F.col("start_ns") < end_ns)
    return rows


def _json(spans: DataFrame, column: str) -> list:
    """A map or variant column as JSON with its keys in order, so that equal ones are equal texts; [] without it."""
    if column not in spans.columns:
        return []
    value = quoted(column)
    if isinstance(spans.schema[column].dataType, T.MapType):
        value = F.map_from_entries(F.array_sort(F.map_entries(value)))
    return [F.to_json(value).alias("custom_attributes")]


def nested(spans: DataFrame) -> DataFrame:
    """trace_id and resource_spans: resources, each with scopes, each with spans by start.

    Spans share a resource if all its attributes are equal, those of its map included.
    """
    names = spans.columns
    flat = [n for n in names if n in TOP_RESOURCE or (n.startswith(RESOURCE_PREFIX) and n != RESOURCE_MAP)]
    resource = F.struct(
        quoted("service_name").alias("service.name"), *[quoted(n).cast("string").alias(n.removeprefix(RESOURCE_PREFIX)) for n in flat],
        *_json(spans, RESOURCE_MAP),
    )
    inner = [n for n in ("span_id", "parent_span_id", "trace_state", "start_ns", "duration_ns", "name", "kind", "status", "status_message", "events", "links") if n in names]
    attributes = [n for n in names if n.startswith("attributes.") and n != SPAN_MAP]
    custom = _json(spans, SPAN_MAP)
    span = F.struct(
        "start_ns", "span_id", *[quoted(n) for n in inner if n not in ("start_ns", "span_id")],
        (F.col("start_ns") + F.col("duration_ns")).alias("end_ns"),
        *([F.struct(*[quoted(n).alias(n.removeprefix("attributes.")) for n in attributes]).alias("attributes")] if attributes else []),
        *custom,
    )
    scope = F.struct(
        (quoted("scope_name") if "scope_name" in names else F.lit(None).cast("string")).alias("name"),
        (quoted("scope_version") if "scope_version" in names else F.lit(None).cast("string")).alias("version"),
    )
    rows = spans.select(F.lpad("trace_id", 32, "0").alias("trace_id"), resource.alias("resource"), scope.alias("scope"), span.alias("span"))
    by_span = _ordered("start_ns", "span_id")
    scopes = rows.groupBy("trace_id", "resource", "scope").agg(F.array_sort(F.collect_list("span"), by_span).alias("spans"))
    keyed = F.struct(F.to_json("scope").alias("key"), "scope", "spans")
    resources = scopes.groupBy("trace_id", "resource").agg(F.array_sort(F.collect_list(keyed), _ordered("key")).alias("scope_spans"))
    keyed = F.struct(F.to_json("resource").alias("key"), "resource", "scope_spans")
    whole = resources.groupBy("trace_id").agg(F.array_sort(F.collect_list(keyed), _ordered("key")).alias("resource_spans"))
    bare = F.transform(
        "resource_spans",
        lambda r: F.struct(
            r["resource"].alias("resource"),
            F.transform(r["scope_spans"], lambda s: s.dropFields("key")).alias("scope_spans"),
        ),
    )
    return whole.select("trace_id", bare.alias("resource_spans"))


def _ordered(*names: str):
    """A comparison of structs by some of their fields, as maps in them have no order."""

    def compare(a, b):
        out = F.lit(0)
        for n in reversed(names):
            x, y = a[n], b[n]
            out = F.when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(out)
        return out

    return compare
