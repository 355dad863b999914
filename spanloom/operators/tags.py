"""Tag names and tag values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.predicate import Predicates, _is_nested, _item_value
from spanloom.functions.resolve import (
    RESOURCE_MAP, RESOURCE_PREFIX, SPAN_MAP, SPAN_PREFIX, TOP_RESOURCE, TRACE, TREE, Resolver, quoted,
)
from spanloom.functions.variants import flattened
from spanloom.plans import ast as A
from spanloom.plans.parser import parse, parse_attribute

from .search import enrich

#: Scopes in their order, and the intrinsics offered as tags.
SCOPES = ("resource", "span", "event", "link", "intrinsic")
INTRINSICS = (
    "duration", "event:name", "event:timeSinceStart", "instrumentation:name", "instrumentation:version", "kind", "name",
    "rootName", "rootServiceName", "span:duration", "span:kind", "span:name", "span:status", "span:statusMessage",
    "status", "statusMessage", "trace:duration", "trace:rootName", "trace:rootService", "traceDuration",
)
#: Tag values returned at most.
MOST_VALUES = 5000


def _sampled(rows: DataFrame, sampled: int | None) -> DataFrame:
    return rows if sampled is None else rows.limit(sampled)


def _map_keys(spans: DataFrame, column: str, sampled: int | None) -> DataFrame | None:
    kind = dict((f.name, f.dataType) for f in spans.schema.fields).get(column)
    rows = _sampled(spans.where(quoted(column).isNotNull()).select(quoted(column).alias("m")), sampled) if kind else None
    if isinstance(kind, T.MapType):
        return rows.select(F.explode(F.map_keys("m")).alias("tag"))
    if isinstance(kind, T.VariantType):
        return rows.select(F.explode(F.transform(flattened(F.col("m")), lambda e: e["key"])).alias("tag"))
    return None


def tag_names(spans: DataFrame, scope: str | None = None, sampled: int | None = None, limit: int | None = None) -> DataFrame:
    """(scope, tag): flat columns by the schema, keys of maps, events and links from all rows.

    With ``limit``, the first so many by scope and tag. With ``sampled``, keys come from that many rows with a map or an array, whichever Spark reads first.
    """
    spark = spans.sparkSession
    names = [f.name for f in spans.schema.fields]
    flat: dict[str, list[str]] = {s: [] for s in SCOPES}
    flat["resource"] = [n for n in TOP_RESOURCE if n in names]
    if "service_name" in names:
        flat["resource"].append("service.name")
    for prefix, holder, where in ((SPAN_PREFIX, SPAN_MAP, "span"), (RESOURCE_PREFIX, RESOURCE_MAP, "resource")):
        flat[where] += [n[len(prefix) :] for n in names if n.startswith(prefix) and n != holder]
    flat["intrinsic"] = list(INTRINSICS)
    known = [(s, t) for s in SCOPES for t in flat[s]]
    found = spark.createDataFrame(known, "scope string, tag string")
    for where, holder in (("span", SPAN_MAP), ("resource", RESOURCE_MAP)):
        if (keys := _map_keys(spans, holder, sampled)) is not None:
            found = found.union(keys.select(F.lit(where), "tag"))
    for prefix, where in ((SPAN_PREFIX, "span"), (RESOURCE_PREFIX, "resource")):
        for n in flat[where]:
            if (keys := _map_keys(spans, prefix + n, sampled)) is not None:  # an object in a column of its own
                found = found.union(keys.select(F.lit(where), F.concat(F.lit(n + "."), "tag")))
    for where, holder in (("event", "events"), ("link", "links")):
        if holder in names:
            rows = _sampled(spans.where(F.size(holder) > 0).select(holder), sampled)
            keys = rows.select(F.explode(holder).alias("e")).select(F.explode(F.map_keys("e.attributes")).alias("tag"))
            found = found.union(keys.select(F.lit(where), "tag"))
    found = found.distinct()
    found = found.where(F.col("scope") == scope) if scope else found
    if limit is None:
        return found
    # scopes in their order, and tags within them
    place = F.array_position(F.array(*map(F.lit, SCOPES)), F.col("scope"))
    return found.orderBy(place, "tag").limit(limit)


def tag_names_v1(spans: DataFrame) -> DataFrame:
    """Resource and span tags without their scope, sorted."""
    return tag_names(spans).where("scope in ('resource', 'span')").select("tag").distinct().orderBy("tag")


def _matching(spans: DataFrame, query: str) -> DataFrame:
    """Spans that the filters of a search query match; all of them if the query can't be read or isn't a search."""
    try:
        root = parse(query).root
        stages = [s for s in (root.stages if isinstance(root, A.Pipeline) else ()) if isinstance(s, A.SpansetFilter)]
        out = spans
        for stage in stages:  # values of traces and trees are those of all spans
            out = enrich(out, spans, stage)
        for stage in stages:
            out = out.where(Predicates(Resolver(out)).boolean(stage.expr))
    except A.QueryError:
        return spans
    return out.select(*map(quoted, spans.columns))


def tag_values(spans: DataFrame, tag: str, query: str | None = None, limit: int | None = MOST_VALUES) -> DataFrame:
    """(value, type, n): the tag's most frequent values, ties by value; all of them with limit None.

    A query that can't be read filters nothing. Filters come before events are expanded. Values of links and of
    event:timeSinceStart aren't listed.
    """
    node = parse_attribute(tag)
    whole = spans
    if query:
        spans = _matching(spans, query)
    empty = spans.sparkSession.createDataFrame([], "value string, type string, n long")
    if isinstance(node, A.Intrinsic):
        if node.name == "event:timeSinceStart" or node.name.startswith("link:") or node.name == "parent":
            return empty
        plain = {"rootName": A.Intrinsic("name"), "rootServiceName": A.Attr("resource", "service.name")}
        node = plain.get(node.name, node)
        if node.name in TREE or node.name in TRACE:
            spans = enrich(spans, whole, node)
    if _is_nested(node):
        if isinstance(node, A.Attr) and node.scope == "link" or "events" not in spans.columns:
            return empty
        kind = "string"
        values = spans.select(F.explode("events").alias("e")).select(_item_value(node, F.col("e")).text().alias("value"))
        values = values.where("value <> ''")
    else:
        value = Predicates(Resolver(spans)).value(node)
        if value is None:
            return empty
        kind = {"status": "keyword", "kind": "keyword", "unknown": "string", "array": "string"}.get(value.type, value.type)
        values = spans.select(value.text().alias("value"))
    counted = values.where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), "value")
    return (ordered if limit is None else ordered.limit(limit)).select("value", F.lit(kind).alias("type"), "n")
