"""TraceQL search: spanset expressions, pipelines, and the shape of results.

A spanset expression is a boolean column over the spans, so filters, set operations and structural relations of one query
share one scan and one shuffle by trace. Nested sets never overlap in part, so "has an ancestor in A" is "the largest
right end of A's spans further left exceeds mine", a running maximum, and needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.predicate import Predicates, compare
from spanloom.functions.resolve import OWN, TRACE, TREE, Resolver, quoted
from spanloom.plans import ast as A

from .rollup import service_stats, trace_rollup
from .tree import nested_sets, with_tree


def mentions(node, names) -> bool:
    return any(isinstance(n, A.Intrinsic) and n.name in names for n in A.walk(node))


def only_root_tests(node) -> bool:
    """Whether the tree's values are asked for only where the parent id answers: nestedSetParent against 0 or -1."""
    asked = [n for n in A.walk(node) if isinstance(n, A.Intrinsic) and n.name in TREE]
    tests = [
        n for n in A.walk(node)
        if isinstance(n, A.Binary) and isinstance(n.left, A.Intrinsic) and n.left.name == "nestedSetParent"
        and isinstance(n.right, A.Static) and (n.op, n.right.value) in {
            ("<", 0), ("<=", -1), ("=", -1), (">=", 0), (">", -1), ("!=", -1)
        }
    ]
    return len(asked) == len(tests)


def needs_tree(node) -> bool:
    structural = any(isinstance(n, A.SpansetOp) and n.op not in ("&&", "||") for n in A.walk(node))
    return structural or not only_root_tests(node)


def enrich(spans: DataFrame, whole: DataFrame, node) -> DataFrame:
    """spans with the trace values and tree columns that a query mentions; ``whole`` are all spans of the traces."""
    if mentions(node, TRACE) and "trace_duration_ns" not in spans.columns:
        spans = spans.join(trace_rollup(whole), "trace_id")
    if needs_tree(node) and "nested_left" not in spans.columns:
        spans = with_tree(spans) if spans is whole else spans.join(nested_sets(whole), ["trace_id", "span_id"])
    return spans


#: Values of a trace's root, and the span's own values that they are.
ROOT = {"rootName": A.Intrinsic("name"), "rootServiceName": A.Attr("resource", "service.name")}


def root_like(expr) -> list:
    """Conditions that a trace's root meets as a span if the trace meets expr: conjuncts on the root's values alone."""
    if isinstance(expr, A.Binary) and expr.op == "&&":
        return root_like(expr.left) + root_like(expr.right)
    asked = {n.name for n in A.walk(expr) if isinstance(n, A.Intrinsic)}
    attributes = any(isinstance(n, A.Attr) for n in A.walk(expr))
    if expr is None or attributes or not asked or not asked <= ROOT.keys():
        return []
    return [A.replace(expr, lambda n: ROOT.get(n.name, n) if isinstance(n, A.Intrinsic) else n)]


def with_root_like(spans: DataFrame, expr) -> DataFrame:
    """Spans of the traces that can meet a condition on their root: those with any span that would meet it as the root.

    The ids are distinct before they are shuffled. Spark broadcasts them if they are few, or else filters the spans by them
    before their shuffle.
    """
    conditions = root_like(expr)
    if not conditions:
        return spans
    like = F.lit(True)
    for c in conditions:
        like = like & Predicates(Resolver(spans)).boolean(c)
    return spans.join(spans.where(like).select("trace_id").distinct(), "trace_id", "left_semi")


class Spansets:
    """Evaluates spanset expressions on spans, adding columns as needed."""

    def __init__(self, spans: DataFrame):
        self.spans, self.made = spans, 0

    def flag(self, node) -> Column:
        """A column that is true for the spans of the expression's result."""
        if isinstance(node, A.SpansetFilter):
            return self._keep(Predicates(Resolver(self.spans)).boolean(node.expr))
        if isinstance(node, A.Pipeline):
            return self._pipeline(node)
        left, right = self.flag(node.left), self.flag(node.right)
        if node.op == "||":
            return left | right
        trace = Window.partitionBy("trace_id")
        if node.op == "&&":
            both = F.max(left).over(trace) & F.max(right).over(trace)
            return self._keep((left | right) & both)
        relation = node.op.lstrip("!&")
        related = self._keep(right & self._related(relation, left))
        if node.op[0] == "!":
            return right & ~related
        if node.op[0] != "&":
            return related
        back = {">>": "<<", "<<": ">>", ">": "<", "<": ">", "~": "~"}[relation]
        return related | self._keep(left & self._related(back, right))

    def _keep(self, c: Column) -> Column:
        self.made += 1
        name = f"__flag{self.made}"
        self.spans = self.spans.withColumn(name, F.coalesce(c, F.lit(False)))
        return F.col(name)

    def _related(self, relation: str, of: Column) -> Column:
        """Whether a span is a descendant (>>), ancestor, child (>), parent or sibling of a span in ``of``."""
        placed = of & (F.col("nested_left") > 0)
        order = Window.partitionBy("trace_id").orderBy("nested_left")
        here = F.col("nested_left") > 0
        if relation == ">>":
            before = order.rangeBetween(Window.unboundedPreceding, -1)
            return here & (F.max(F.when(placed, F.col("nested_right"))).over(before) > F.col("nested_right"))
        if relation == "<<":
            after = order.rangeBetween(1, Window.unboundedFollowing)
            return here & (F.min(F.when(placed, F.col("nested_left"))).over(after) < F.col("nested_right"))
        if relation == "~":
            family = Window.partitionBy("trace_id", "nested_parent")
            others = F.count_if(placed).over(family) - F.when(placed, 1).otherwise(0)
            return here & (others > 0)
        # a span stands twice: among its parent's children, and as the parent of its own. A parent's left is its
        # children's nested_parent, so both stand in one family, and no span is looked up.
        self.made += 1
        name = f"__in{self.made}"
        both = self.spans.withColumn("__parent", F.explode(F.array(F.lit(False), F.lit(True))))
        as_parent = F.col("__parent")
        family = Window.partitionBy("trace_id", F.when(as_parent, F.col("nested_left")).otherwise(F.col("nested_parent")))
        child = relation == ">"
        met = F.max(placed & (as_parent if child else ~as_parent)).over(family)
        self.spans = both.withColumn(name, met).where(~as_parent if child else as_parent).drop("__parent")
        return here & F.coalesce(F.col(name), F.lit(False))

    def _pipeline(self, node: A.Pipeline) -> Column:
        """A pipeline as an operand: its spans, without groups."""
        found = run_stages(self.spans, node.stages).select("trace_id", "span_id", "start_ns").distinct()
        self.made += 1
        name = f"__in{self.made}"
        self.spans = self.spans.join(found.withColumn(name, F.lit(True)), ["trace_id", "span_id", "start_ns"], "left")
        return F.coalesce(F.col(name), F.lit(False))


def _scalar(node, spans: DataFrame, spanset) -> Column:
    """A scalar expression as a column that is equal for all spans of a spanset; durations are nanoseconds."""
    if isinstance(node, A.Static):
        return F.lit(float(node.value))
    if isinstance(node, A.Binary):
        x, y = _scalar(node.left, spans, spanset), _scalar(node.right, spans, spanset)
        return {"+": x + y, "-": x - y, "*": x * y, "/": F.try_divide(x, y), "%": F.try_mod(x, y), "^": F.pow(x, y)}[node.op]
    if node.fn == "count":
        return F.count(F.lit(1)).over(spanset).cast("double")
    value = Predicates(Resolver(spans)).value(node.expr)
    if value is None:
        return F.lit(None).cast("double")
    if value.type in ("int", "duration") and node.fn != "avg":
        return getattr(F, node.fn)(value.cast("bigint")).over(spanset).cast("double")
    if value.type in ("int", "duration"):
        whole = value.cast("bigint")
        return F.try_divide(F.sum(whole).over(spanset).cast("double"), F.count(whole).over(spanset))
    return getattr(F, node.fn)(value.cast("double")).over(spanset)


def run_stages(spans: DataFrame, stages: tuple, within: Column | None = None) -> DataFrame:
    """The spans that a pipeline returns, with a column ``spanset``, a list of values that by() adds to and coalesce() drops.

    Only spans for which ``within`` holds can match; others are there for the structure.
    """
    now = spans if "spanset" in spans.columns else spans.withColumn("spanset", F.lit(None).cast("array<string>"))
    for stage in stages:
        if isinstance(stage, A.SpansetFilter | A.SpansetOp | A.Pipeline):
            made = Spansets(now)
            flag = made.flag(stage)
            now = made.spans.where(flag if within is None else flag & within)
            now = now.drop(*[c for c in now.columns if c.startswith(("__flag", "__in"))])
        elif isinstance(stage, A.ScalarFilter):
            spanset = Window.partitionBy("trace_id", "spanset")
            holds = compare(stage.op, _scalar(stage.left, now, spanset), _scalar(stage.right, now, spanset))
            now = now.withColumn("__flag", holds).where("__flag").drop("__flag")
        elif isinstance(stage, A.GroupBy):
            value = Predicates(Resolver(now)).value(stage.expr)
            key = value.text() if value is not None else F.lit(None).cast("string")
            above = F.coalesce("spanset", F.array().cast("array<string>"))
            now = now.withColumn("spanset", F.concat(above, F.array(key)))
        elif isinstance(stage, A.Coalesce):
            now = now.withColumn("spanset", F.lit(None).cast("array<string>"))
    return now


def conjuncts(expr) -> list:
    if isinstance(expr, A.Binary) and expr.op == "&&":
        return conjuncts(expr.left) + conjuncts(expr.right)
    return [] if expr is None else [expr]


def _own(expr, predicates: Predicates) -> Column:
    """What a filter asks of a span's own row: the conjuncts that ask nothing of the trace or its tree."""
    out = F.lit(True)
    for c in conjuncts(expr):
        out = out if mentions(c, (*TRACE, *TREE)) else out & predicates.boolean(c)
    return out


def trace_needs(node, predicates: Predicates) -> Column | None:
    """What a trace must have for a spanset expression to match any of its spans, as an aggregate over its spans.

    Conditions on the root alone ask for a span that would meet them as the root. None where nothing follows from single
    spans, as with negated relations of no left side.
    """
    if isinstance(node, A.SpansetFilter):
        like = F.lit(True)
        for c in root_like(node.expr):
            like = like & predicates.boolean(c)
        return F.max(_own(node.expr, predicates)) & F.max(like)
    if isinstance(node, A.Pipeline):
        return trace_needs(node.stages[0], predicates)
    if not isinstance(node, A.SpansetOp):
        return None
    left, right = trace_needs(node.left, predicates), trace_needs(node.right, predicates)
    if node.op == "||":
        return None if left is None or right is None else left | right
    if node.op.startswith("!"):
        return right
    return right if left is None else left if right is None else left & right


def _filters(node) -> list:
    return [n.expr for n in A.walk(node) if isinstance(n, A.SpansetFilter)]


def candidates(spans: DataFrame, root: A.Pipeline) -> DataFrame:
    """Spans of the traces that can match a pipeline's first stage: one partial aggregation and a semi-join, before any
    tree is numbered."""
    needed = trace_needs(root.stages[0], Predicates(Resolver(spans)))
    if needed is None:
        return spans
    traces = spans.groupBy("trace_id").agg(needed.alias("__needed")).where("__needed").select("trace_id")
    return spans.join(traces, "trace_id", "left_semi")


#: Parts of the range of starts by which a budget is cut; their sums are the rows of one small table.
PARTS = 4096


def within_budget(spans: DataFrame, query: A.Query, most: int, within: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Spans of the candidate traces that come first, whole traces only, ``most`` spans together at the most; and the
    candidates, trace_id and fits.

    Candidates go by the latest start of their first span that a filter can match. The first trace that doesn't fit ends the
    row: it and all after it are left out. The prefix sum has two levels: parts of the range of starts are summed, and only in
    the part where the budget ends are traces put in order.
    """
    root = query.root
    if not isinstance(root, A.Pipeline):
        raise A.QueryError("a metrics query has no spans; use metrics()")
    predicates = Predicates(Resolver(spans))
    matches = F.lit(False)
    for expr in _filters(root.stages[0]):
        matches = matches | _own(expr, predicates)
    if within is not None:
        matches = matches & within
    needed = trace_needs(root.stages[0], predicates)
    traces = spans.groupBy("trace_id").agg(
        F.min(F.when(matches, F.col("start_ns"))).alias("first"), F.count(F.lit(1)).alias("n"), (F.lit(True) if needed is None else needed).alias("needed")
    ).where("needed and first is not null").drop("needed")
    ends = traces.agg(F.min("first").alias("low"), F.max("first").alias("high"))  # one row
    part = F.floor((F.col("high") - F.col("first")).cast("double") / (F.col("high") - F.col("low") + 1) * PARTS)
    parted = traces.join(F.broadcast(ends)).withColumn("part", part).drop("low", "high")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = parted.groupBy("part").agg(F.sum("n").alias("all")).withColumn("through", F.sum("all").over(order))
    sums = sums.select("part", "through", (F.col("through") - F.col("all")).alias("before"))
    placed = parted.join(F.broadcast(sums), "part")  # PARTS rows at the most
    cut = (F.col("before") <= most) & (F.col("through") > most)
    inner = Window.partitionBy("part").orderBy(F.desc("first"), "trace_id").rowsBetween(Window.unboundedPreceding, 0)
    split = placed.where(cut).withColumn("fits", F.col("before") + F.sum("n").over(inner) <= most)
    marked = placed.where(~cut).withColumn("fits", F.col("through") <= most).unionByName(split).select("trace_id", "fits")
    return spans.join(marked.where("fits").select("trace_id"), "trace_id", "left_semi"), marked


def matching_spans(spans: DataFrame, query: A.Query, within: Column | None = None, prefilter: bool = False) -> DataFrame:
    """All spans that a search query matches, with every column and their spanset.

    With ``prefilter``, traces that can't match are left out first, which pays where conditions are selective; conditions on
    the root alone always narrow so.
    """
    root = query.root
    if not isinstance(root, A.Pipeline):
        raise A.QueryError("a metrics query has no spans; use metrics()")
    if prefilter or any(root_like(e) for e in _filters(root.stages[0])):
        spans = candidates(spans, root)
    return run_stages(enrich(spans, spans, root), root.stages, within)


def attribute_name(node) -> str:
    return node.name if isinstance(node, A.Attr) else node.name.replace(":", "_")


def exposed(query: A.Query) -> list:
    """Attributes that a query mentions outside aggregates, each once."""
    out = {}
    for n in A.walk(query.root):
        nested = isinstance(n, A.Attr) and n.scope in ("event", "link", "parent")
        if isinstance(n, A.Attr) and not nested or isinstance(n, A.Intrinsic) and ":" not in n.name:
            out.setdefault(attribute_name(n), n)
    return [n for k, n in out.items() if k not in ("name", "duration", "parent")]


def search(
    spans: DataFrame, query: A.Query, limit: int = 20, spss: int = 3, within: Column | None = None, prefilter: bool = False,
    services: bool = False,
) -> DataFrame:
    """The best traces and their first spans.

    Traces go by the latest start of their first matching span; where the query selects attributes, traces with more of
    them present go first. At most ``limit`` traces, and ``spss`` spans per spanset by start (0: all). One row per span:
    the trace's values, spanset, matched (spans of the spanset), the span, and attr.<name> for each exposed attribute; with
    ``services`` also service_stats, the spans and errors of each service of the trace.
    """
    found = matching_spans(spans, query, within, prefilter)
    values, late = {}, {}
    predicates = Predicates(Resolver(found))
    for node in exposed(query):
        if isinstance(node, A.Intrinsic) and node.name in TREE and "nested_left" not in found.columns:
            late[f"attr.{attribute_name(node)}"] = quoted(TREE[node.name][0]).cast("string")  # of the best traces only
            continue
        value = predicates.resolver.resolve(node) if not isinstance(node, A.Intrinsic) or node.name in _all_names() else None
        values[f"attr.{attribute_name(node)}"] = value.text() if value is not None else F.lit(None).cast("string")
    found = found.withColumns(values) if values else found
    selected = [f"attr.{attribute_name(a)}" for s in query.root.stages if isinstance(s, A.Select) for a in s.attrs]
    score = F.lit(0)
    for name in dict.fromkeys(n for n in selected if n in values):
        score = score + F.max(quoted(name).isNotNull().cast("int"))
    best = (
        found.groupBy("trace_id")
        .agg(score.alias("preferred"), F.min("start_ns").alias("matched_start_ns"))
        .orderBy(F.desc("preferred"), F.desc("matched_start_ns"), "trace_id")
        .limit(limit)
    )
    first = Window.partitionBy("trace_id", "spanset").orderBy("start_ns", "span_id")
    spanset = Window.partitionBy("trace_id", "spanset")
    rows = (
        found.join(best, "trace_id")
        .withColumn("matched", F.count(F.lit(1)).over(spanset))
        .withColumn("position", F.row_number().over(first))
    )
    rows = rows.where(F.col("position") <= spss) if spss else rows
    whole = spans.join(best.select("trace_id"), "trace_id", "left_semi")
    if late:
        rows = rows.join(nested_sets(whole), ["trace_id", "span_id"], "left").withColumns(late)
    traces = trace_rollup(whole)
    extra = []
    if services:
        each = F.struct(F.col("service_name").alias("service"), "span_count", "error_count")
        stats = service_stats(whole).groupBy("trace_id").agg(F.array_sort(F.collect_list(each)).alias("service_stats"))
        rows, extra = rows.join(stats, "trace_id"), ["service_stats"]
    rows = rows.drop("trace_start_ns", "trace_duration_ns", "root_name", "root_service_name").join(traces, "trace_id")
    return rows.select(
        F.lpad("trace_id", 32, "0").alias("trace_id"), "root_service_name", "root_name", "trace_start_ns",
        F.floor(F.col("trace_duration_ns") / 1_000_000).cast("long").alias("trace_duration_ms"), "spanset", "matched",
        "position", "span_id", "name", "start_ns", "duration_ns", *[quoted(v) for v in (values | late)], *extra,
    )


def _all_names() -> set[str]:
    return {*OWN, *TRACE, *TREE}


def legacy_query(tags: dict[str, str], min_duration: str | None = None, max_duration: str | None = None) -> str:
    """A TraceQL query for a search by tags (values are found within, in any case) and durations."""
    import re

    from spanloom.plans.parser import duration_ns

    def quote(text: str) -> str:
        return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

    if min_duration and max_duration and duration_ns(max_duration) < duration_ns(min_duration):
        raise A.QueryError("maxDuration is less than minDuration")
    special = {"status": "status", "kind": "kind", "name": "name"}
    parts = []
    for key, value in tags.items():
        if key in ("status", "kind"):
            parts.append(f"{special[key]} = {value}")
            continue
        left = special.get(key) or f".{key}"
        parts.append(f"{left} =~ {quote('(?is).*' + re.escape(value) + '.*')}")
    parts += [f"duration >= {min_duration}"] if min_duration else []
    parts += [f"duration <= {max_duration}"] if max_duration else []
    return "{ " + " && ".join(parts) + " }"
