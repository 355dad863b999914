"""compare(): counts of attribute values among selected spans and all others, in one pass over the spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.predicate import Predicates, two_valued
from spanloom.functions.resolve import RESOURCE_MAP, RESOURCE_PREFIX, SPAN_MAP, SPAN_PREFIX, TRACE, Resolver, quoted
from spanloom.plans import ast as A

#: Fixed value: the marker of attributes with more values than are shown.
TOO_MANY = "__too_many_values__"


def compared_attributes(spans: DataFrame, most: int | None = None) -> list[tuple[str, str]]:
    """(label, column) of what is compared: service, name, status, kind, then flat span and resource attributes by label.

    With ``most``, at most so many.
    """
    first = [("resource.service.name", "service_name"), ("name", "name"), ("status", "status"), ("kind", "kind")]
    kinds = {f.name: f.dataType for f in spans.schema.fields}
    flat = []
    for prefix, holder, scope in ((SPAN_PREFIX, SPAN_MAP, "span."), (RESOURCE_PREFIX, RESOURCE_MAP, "resource.")):
        for name, kind in kinds.items():
            if name.startswith(prefix) and name != holder and not isinstance(kind, T.MapType | T.VariantType | T.ArrayType):
                flat.append((scope + name[len(prefix) :], name))
    return ([(x, c) for x, c in first if c in kinds] + sorted(flat))[:most]


def compare_series(spans: DataFrame, query: A.MetricsQuery, window):
    """Series with labels __meta_type, attribute, attribute_value and __meta_error; counts are zero-filled.

    Totals have neither attribute nor value. Of each attribute the ``top`` values by selected spans, then by all spans,
    then by text are shown; an attribute with more has one more row marked so, without a bucket or value.
    """
    from .metrics import Series, filtered
    from .search import mentions, needs_tree
    from .tree import with_tree

    agg = query.agg
    if mentions(agg.selection, TRACE):
        raise A.UnsupportedQuery("a selection by values of the trace isn't supported")
    if any(needs_tree(n) for n in (*query.stages, agg.selection)):
        spans = with_tree(spans)
    rows = filtered(spans, query.stages, spans)
    chosen = two_valued(Predicates(Resolver(rows)).boolean(agg.selection.expr))
    if agg.start_ns is not None:
        chosen = chosen & (F.col("start_ns") >= agg.start_ns) & (F.col("start_ns") < agg.end_ns)
    bucket = window.bucket_ns()
    pairs = [
        F.struct(F.lit(label).alias("attribute"), quoted(column).cast("string").alias("attribute_value"))
        for label, column in compared_attributes(rows, window.most_attributes)
    ]
    total = F.struct(F.lit(None).cast("string").alias("attribute"), F.lit(None).cast("string").alias("attribute_value"))
    long = rows.select(bucket, chosen.alias("sel"), F.explode(F.array(total, *pairs)).alias("pair")).select(
        "bucket_ns", "sel", "pair.*"
    ).where("attribute is null or attribute_value is not null")
    counts = long.groupBy("attribute", "attribute_value", "sel", "bucket_ns").agg(F.count(F.lit(1)).alias("n"))
    n_of = lambda side: F.filter("cells", lambda c: c["sel"] == F.lit(side))
    chosen_n = F.sum(F.when(F.col("sel"), F.col("n")).otherwise(0)).alias("chosen")
    per_value = counts.groupBy("attribute", "attribute_value").agg(
        chosen_n, F.sum("n").alias("all"), F.collect_list(F.struct("sel", "bucket_ns", "n")).alias("cells")
    )
    rank = Window.partitionBy("attribute").orderBy(F.desc("chosen"), F.desc("all"), "attribute_value")
    # Spark takes the first of each task before it shuffles them; totals are the only value of theirs
    ranked = per_value.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= agg.top + 1)

    def filled(side: bool):
        """A value's counts on a side, zeros in the buckets that it isn't in."""
        missing = F.array_except(window.buckets(), F.transform(n_of(side), lambda c: c["bucket_ns"]))
        return F.concat(n_of(side), F.transform(missing, lambda t: F.struct(F.lit(side).alias("sel"), t.alias("bucket_ns"), F.lit(0).cast("long").alias("n"))))

    mark = F.array(F.struct(F.lit(None).cast("boolean").alias("sel"), F.lit(None).cast("long").alias("bucket_ns"), F.lit(None).cast("long").alias("n")))
    cells = ranked.select(
        "attribute", "attribute_value",
        F.explode(F.when((F.col("rank") > agg.top) & F.col("attribute").isNotNull(), mark).otherwise(F.concat(filled(True), filled(False)))).alias("c"),
    )
    side = F.when(F.col("c.sel"), "selection").otherwise("baseline")
    made = cells.select(
        F.concat(side, F.when(F.col("attribute").isNull(), "_total").otherwise("")).alias("__meta_type"), "attribute",
        F.when(F.col("c.sel").isNotNull(), F.col("attribute_value")).alias("attribute_value"),
        F.when(F.col("c.sel").isNull(), TOO_MANY).alias("__meta_error"), F.col("c.bucket_ns").alias("bucket_ns"),
        F.col("c.n").cast("double").alias("value"),
    )
    return Series(made, ["__meta_type", "attribute", "attribute_value", "__meta_error"])
