"""TraceQL metrics: time-bucketed series as long DataFrames.

A result has one row per series and bucket: the labels (a string column each), bucket_ms and value, and bucket_ns where steps
aren't whole milliseconds; with exemplars also ex_trace_id, ex_ts_ms and ex_value. Inside, buckets are in nanoseconds. All aggregates, the exemplar included, come from one partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from spanloom.functions.predicate import Predicates, compare
from spanloom.functions.resolve import TRACE, Resolver, quoted
from spanloom.plans import ast as A

from .rollup import trace_rollup
from .quantiles import quantiles as exact_quantiles
from .search import Spansets, enrich, mentions, needs_tree, with_root_like
from .tree import with_tree

#: Default and largest number of exemplars a series.
EXEMPLARS, MOST_EXEMPLARS = 100, 1000
FILLED = ("rate", "count_over_time")
SECOND = 10**9


@dataclass(frozen=True)
class Range:
    """A query's time range in nanoseconds. aligned() floors the start and ceils the end to the step.

    Buckets begin at the origin and at multiples of the step from it. compare() looks at ``most_attributes`` attributes
    at most, if that is given. With ``infinite``, arithmetic keeps infinite values and NaN, as in a division by zero;
    otherwise it leaves such buckets out.
    """

    start_ns: int
    end_ns: int
    step_ns: int = 0
    origin_ns: int = 0
    most_attributes: int | None = None
    infinite: bool = False

    def aligned(self) -> Range:
        step = self.step_ns or default_step(self.end_ns - self.start_ns)
        return Range(self.start_ns // step * step, -(-self.end_ns // step) * step, step, 0, self.most_attributes, self.infinite)

    def bucket_ns(self) -> Column:
        """The start of a span's bucket, in whole numbers throughout."""
        o, step = self.origin_ns, self.step_ns
        return F.expr(f"(start_ns - {o}) div {step} * {step} + {o}").alias("bucket_ns")

    def buckets(self) -> Column:
        """The starts of all buckets of the range."""
        last = max(self.start_ns, self.end_ns - self.step_ns)
        return F.sequence(*(F.lit(x).cast("long") for x in (self.start_ns, last, self.step_ns)))


def default_step(window_ns: int) -> int:
    """A 240th of the window, rounded down to a round number."""
    base = window_ns // 240
    if window_ns < 60 * SECOND:
        return max(base // 50_000_000 * 50_000_000, 50_000_000)
    for unit in (3600, 300, 60, 15, 5, 1):
        if unit * SECOND < base:
            return base // (unit * SECOND) * unit * SECOND
    return SECOND


@dataclass
class Series:
    """A long DataFrame and its label columns. empty is set where the query can match nothing."""

    frame: DataFrame
    labels: list[str]
    exemplars: bool = False
    key: list[str] = field(default_factory=list)


def label_text(node) -> str:
    return node.text


def split_conditions(expr) -> tuple[list, list]:
    """Top-level conjuncts of a filter that concern the trace, and those that concern the span."""
    if isinstance(expr, A.Binary) and expr.op == "&&":
        a, b = split_conditions(expr.left), split_conditions(expr.right)
        return a[0] + b[0], a[1] + b[1]
    if expr is None:
        return [], []
    if not mentions(expr, TRACE):
        return [], [expr]
    others = [
        n for n in A.walk(expr) if isinstance(n, A.Attr) or (isinstance(n, A.Intrinsic) and n.name not in TRACE)
    ]
    if others:
        raise A.UnsupportedQuery("a condition mixes values of the trace and of the span")
    return [expr], []


def conjunction(parts: list):
    out = None
    for p in parts:
        out = p if out is None else A.Binary("&&", out, p)
    return out


def filtered(spans: DataFrame, stages: tuple, whole: DataFrame) -> DataFrame:
    """Spans that pass the filters of a metrics query; ``whole`` are all spans in range, which decide what concerns traces.

    Conditions on the trace join as a semi-join: Spark broadcasts the ids only if they are few. What they imply for single
    spans narrows the traces that are rolled up.
    """
    if any(isinstance(s, A.ScalarFilter | A.GroupBy | A.Coalesce) for s in stages):
        raise A.UnsupportedQuery("a metrics query takes spanset filters only")
    for stage in stages:
        if isinstance(stage, A.Select):
            continue
        if not isinstance(stage, A.SpansetFilter):
            made = Spansets(enrich(spans, whole, stage))
            flag = made.flag(stage)
            spans = made.spans.where(flag).select(*map(quoted, spans.columns))
            continue
        on_trace, on_span = split_conditions(stage.expr)
        if on_span:
            spans = spans.where(Predicates(Resolver(spans)).boolean(conjunction(on_span)))
        if on_trace:
            condition = conjunction(on_trace)
            traces = trace_rollup(with_root_like(whole, condition))
            ids = traces.where(Predicates(Resolver(traces)).boolean(condition)).select("trace_id")
            spans = spans.join(ids, "trace_id", "left_semi")
    return spans


def exemplar_count(wanted: int | None, hints: dict) -> int:
    n = hints.get("exemplars", wanted)
    if n is False:
        return 0
    if n is True or n is None or n == 0:
        n = EXEMPLARS
    return max(0, min(int(n), MOST_EXEMPLARS))


def _exemplar(slowest: Column, best, start: Column) -> Column:
    ident = F.lpad(F.lower(F.trim(quoted("trace_id"))), 32, "0")
    order = F.struct(slowest, start, quoted("span_id"))
    return best(F.struct(ident.alias("id"), start.alias("start"), slowest.alias("value")), order)


def evaluate(spans: DataFrame, query: A.MetricsQuery, window: Range, exemplars: int = 0) -> Series:
    """A metrics query over spans of the window, not yet thinned."""
    agg = query.agg
    spans = spans.where((F.col("start_ns") >= window.start_ns) & (F.col("start_ns") < window.end_ns))
    if agg.fn == "compare":
        from .compare import compare_series

        return _second(compare_series(spans, query, window), query.second)
    whole = spans
    asked = [n for n in (agg.attr, *agg.by) if n is not None]
    for node in (*query.stages, *asked):  # the tree of whole traces, once
        if needs_tree(node) and "nested_left" not in spans.columns:
            spans = with_tree(spans)
    spans = filtered(spans, query.stages, whole)
    for node in asked:
        spans = enrich(spans, whole, node)
    predicates = Predicates(Resolver(spans))
    keys: dict[str, Column] = {}
    missing = False
    for node in agg.by:
        value = predicates.value(node)
        missing |= value is None
        keys[label_text(node)] = value.text() if value is not None else F.lit(None).cast("string")
    value = None
    if agg.attr is not None:
        value = predicates.value(agg.attr)
        missing |= value is None
    bucket = window.bucket_ns()
    labels = list(keys)
    rows = spans.select(
        *[c.alias(f"__k{i}") for i, c in enumerate(keys.values())], bucket, "start_ns", "duration_ns", "span_id", "trace_id",
        *([_number(value).alias("__v")] if value is not None else []),
    )
    for i in range(len(keys)):
        rows = rows.where(F.col(f"__k{i}").isNotNull())
    if value is not None:
        rows = rows.where(F.col("__v").isNotNull())
    if missing:
        rows = rows.where(F.lit(False))
    by = [f"__k{i}" for i in range(len(keys))]
    seconds = value is not None and value.type == "duration"
    # durations are reported in seconds, from whole nanoseconds
    shown = lambda c: c / F.lit(1e9) if seconds else c
    extra: list[Column] = []
    if exemplars:
        kind = F.min_by if agg.fn == "min_over_time" else F.max_by
        of = F.col("__v") if value is not None and agg.fn != "histogram_over_time" else F.col("duration_ns")
        extra = [_exemplar(of, kind, F.col("start_ns")).alias("__ex")]
    out_labels = list(labels)
    if agg.fn == "histogram_over_time":
        edge = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("__v"))))
        rows = rows.where("__v > 0").withColumn("__edge", (edge / F.lit(1e9) if seconds else edge))
        frame = rows.groupBy(*by, "__edge", "bucket_ns").agg(F.count(F.lit(1)).cast("double").alias("value"), *extra)
        frame = frame.withColumn("__bucket", F.col("__edge").cast("string")).drop("__edge")
        out_labels.append("__bucket")
    elif agg.fn == "quantile_over_time":
        group = [*by, "bucket_ns"]
        frame = exact_quantiles(rows.select(*group, "__v"), group, "__v", list(agg.quantiles), "__q")
        if exemplars:
            frame = frame.join(rows.groupBy(*group).agg(*extra), group)
        pairs = F.arrays_zip(F.transform("__q", shown).alias("value"), F.array(*(F.lit(_plain(q)) for q in agg.quantiles)).alias("p"))
        if exemplars:  # the exemplar goes to the quantile nearest to it
            gaps = F.transform(F.col("__q"), lambda q: F.abs(q - F.col("__ex.value")))
            frame = frame.withColumn("__near", F.array_position(gaps, F.array_min(gaps)))
        frame = frame.select("*", F.posexplode(pairs).alias("__at", "__pair")).withColumns(
            {"value": F.col("__pair.value"), "p": F.col("__pair.p")}
        )
        if exemplars:
            frame = frame.withColumn("__ex", F.when(F.col("__at") + 1 == F.col("__near"), F.col("__ex")))
        out_labels.append("p")
    else:
        frame = rows.groupBy(*by, "bucket_ns").agg(_aggregate(agg.fn, window, shown, value).alias("value"), *extra)
    if agg.fn in FILLED:
        frame = _fill(frame, by, window, not labels and not missing)
    if exemplars:
        own = agg.fn in ("rate", "count_over_time", "histogram_over_time")
        shown_value = F.col("value") if own else shown(F.col("__ex.value").cast("double"))
        some = F.col("__ex.id").rlike("^[0-9a-f]{32}$") & (F.col("__ex.start") > 0) & (shown_value != 0)
        frame = frame.withColumns(
            {
                "ex_trace_id": F.when(some, F.col("__ex.id")),
                "ex_ts_ms": F.when(some, F.expr("__ex.start div 1000000")),
                "ex_value": F.when(some, shown_value),
            }
        )
    named = [F.col(f"__k{i}").alias(name) for i, name in enumerate(labels)]
    named += [F.col(n) for n in out_labels[len(labels) :]]
    tail = ["ex_trace_id", "ex_ts_ms", "ex_value"] if exemplars else []
    return _second(Series(frame.select(*named, "bucket_ns", "value", *tail), out_labels, bool(exemplars)), query.second)


def _plain(q: float) -> str:
    return f"{q:g}"


def _number(value) -> Column:
    return value.cast("bigint") if value.type == "duration" else value.cast("double")


def _aggregate(fn: str, window: Range, shown, value) -> Column:
    if fn == "rate":
        return F.count(F.lit(1)) / F.lit(window.step_ns / 1e9)
    if fn == "count_over_time":
        return F.count(F.lit(1)).cast("double")
    v = F.col("__v")
    if fn == "avg_over_time" and value.type == "duration":
        return F.sum(v).cast("double") / F.count(v) / F.lit(1e9)
    whole = {"min_over_time": F.min, "max_over_time": F.max, "sum_over_time": F.sum, "avg_over_time": F.avg}[fn](v)
    return shown(whole.cast("double"))


def _fill(frame: DataFrame, by: list[str], window: Range, always: bool) -> DataFrame:
    """A zero for every bucket in which a series has no span; a query without labels has one series at least.

    A series' buckets meet in one row, which is as large as its part of the answer, and the missing ones join them there:
    the spans are read once.
    """
    if not by and not always:
        return frame
    rest = [n for n in frame.columns if n not in (*by, "bucket_ns")]
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    found = frame.groupBy(*by).agg(F.collect_list(F.struct("bucket_ns", *rest)).alias("__found"))
    missing = F.array_except(window.buckets(), F.transform("__found", lambda x: x["bucket_ns"]))
    none = F.transform(missing, lambda b: F.struct(b.alias("bucket_ns"), *(F.lit(None).cast(kinds[n]).alias(n) for n in rest)))
    filled = found.select(*by, F.explode(F.concat("__found", none)).alias("__at")).select(*by, "__at.*")
    return filled.withColumn("value", F.coalesce("value", F.lit(0.0)))


def series_key(labels: list[str]) -> Column:
    return F.concat_ws("\x1f", *(F.coalesce(quoted(x), F.lit("nil")) for x in labels)) if labels else F.lit("")


def _second(series: Series, stages: tuple) -> Series:
    frame = series.frame
    for stage in stages:
        if isinstance(stage, A.Threshold):
            frame = frame.where(compare(stage.op, F.col("value"), F.lit(float(stage.value))))
            continue
        if stage.n <= 0:
            frame = frame.where(F.lit(False))
            continue
        frame = frame.where(F.col("value").isNotNull() & ~F.isnan("value"))
        order = F.desc("value") if stage.fn == "topk" else F.asc("value")
        rank = F.row_number().over(Window.partitionBy("bucket_ns").orderBy(order, series_key(series.labels)))
        frame = frame.withColumn("__rank", rank).where(F.col("__rank") <= stage.n).drop("__rank")
    return Series(frame, series.labels, series.exemplars)


def _compute(op: str, x: Column, y: Column, infinite: bool) -> Column:
    """A division by zero is null, or with ``infinite`` that of IEEE 754: infinity by the signs of both, NaN of two zeros."""
    by_zero = x * F.pow(y, F.lit(-1.0)) if infinite else F.lit(None).cast("double")
    quotient = lambda: F.when(y == 0, by_zero).otherwise(F.try_divide(x, y))
    return {"+": lambda: x + y, "-": lambda: x - y, "*": lambda: x * y, "/": quotient}[op]()


def combine(spans: DataFrame, node, window: Range, exemplars: int = 0) -> Series | float:
    """A metrics query or arithmetic of them."""
    if isinstance(node, float):
        return node
    if isinstance(node, A.MetricsQuery):
        return evaluate(spans, node, window, exemplars)
    if not isinstance(node, A.Math):
        raise A.QueryError("not a metrics query")
    if fused := _fused(spans, node, window):
        return _second(fused, node.second)
    left, right = combine(spans, node.left, window, exemplars), combine(spans, node.right, window, exemplars)
    if isinstance(left, float) and isinstance(right, float):
        raise A.QueryError("arithmetic of numbers alone isn't a query")
    if isinstance(left, float) or isinstance(right, float):
        series = right if isinstance(left, float) else left
        x = F.lit(left) if isinstance(left, float) else F.col("value")
        y = F.lit(right) if isinstance(right, float) else F.col("value")
        frame = series.frame.withColumn("value", _compute(node.op, x, y, window.infinite))
        made = Series(frame, series.labels, series.exemplars)
    else:
        made = _join(node.op, left, right, window.infinite)
    frame = made.frame.where(F.col("value").isNotNull())
    if not window.infinite:
        frame = frame.where(~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))))
    return _second(Series(frame, made.labels, made.exemplars), node.second)


def _join(op: str, left: Series, right: Series, infinite: bool) -> Series:
    """Series of equal labels by bucket; a single series without labels goes with each of the other side's."""
    if left.labels == right.labels or set(left.labels) == set(right.labels):
        labels = left.labels
    elif not left.labels or not right.labels:
        labels = left.labels or right.labels
    else:
        return Series(left.frame.where(F.lit(False)).select(*map(quoted, left.labels), "bucket_ns", "value"), left.labels)
    shared = [x for x in labels if x in left.labels and x in right.labels]
    x, y = left.frame.alias("x"), right.frame.alias("y")
    on = F.col("x.bucket_ns") == F.col("y.bucket_ns")
    for name in shared:
        on = on & F.col(f"x.`{name}`").eqNullSafe(F.col(f"y.`{name}`"))
    side = {name: "x" if name in left.labels else "y" for name in labels}
    return Series(
        x.join(y, on).select(
            *[F.col(f"{side[n]}.`{n}`").alias(n) for n in labels], F.col("x.bucket_ns").alias("bucket_ns"),
            _compute(op, F.col("x.value"), F.col("y.value"), infinite).alias("value"),
        ),
        labels,
    )


def _fused(spans: DataFrame, node: A.Math, window: Range) -> Series | None:
    """Arithmetic of two counts with equal labels as one pass: conditional counts in one aggregation."""
    sides = (node.left, node.right)
    if not all(isinstance(s, A.MetricsQuery) and s.agg.fn in FILLED and not s.second for s in sides):
        return None
    if node.left.agg.by != node.right.agg.by or node.left.agg.fn != node.right.agg.fn:
        return None
    if not all(len(s.stages) == 1 and isinstance(s.stages[0], A.SpansetFilter) for s in sides):
        return None
    exprs = [s.stages[0].expr for s in sides]
    if any(mentions(e, TRACE) or (e is not None and not _row_only(e)) for e in exprs):
        return None
    rows = spans.where((F.col("start_ns") >= window.start_ns) & (F.col("start_ns") < window.end_ns))
    predicates = Predicates(Resolver(rows))
    keys = [predicates.value(b) for b in node.left.agg.by]
    if any(k is None for k in keys):
        return None
    labels = [label_text(b) for b in node.left.agg.by]
    a, b = (predicates.boolean(e) for e in exprs)
    bucket = window.bucket_ns()
    by = [f"__k{i}" for i in range(len(keys))]
    rows = rows.where(a | b).select(*[k.text().alias(n) for k, n in zip(keys, by, strict=True)], bucket, a.alias("__a"), b.alias("__b"))
    for n in by:
        rows = rows.where(F.col(n).isNotNull())
    frame = rows.groupBy(*by, "bucket_ns").agg(F.count_if("__a").alias("__na"), F.count_if("__b").alias("__nb"))
    filled = _fill(frame.withColumn("value", F.lit(0.0)), by, window, not by)
    # a series exists on a side only if that side has a span with its labels
    if by:
        whole = Window.partitionBy(*by)
        filled = filled.withColumns({"__sa": F.sum("__na").over(whole), "__sb": F.sum("__nb").over(whole)}).where(
            "__sa > 0 and __sb > 0"
        )
    per = F.lit(window.step_ns / 1e9 if node.left.agg.fn == "rate" else 1.0)
    x, y = F.coalesce("__na", F.lit(0)) / per, F.coalesce("__nb", F.lit(0)) / per
    value = _compute(node.op, x, y, window.infinite)
    named = [F.col(n).alias(name) for n, name in zip(by, labels, strict=True)]
    out = filled.select(*named, "bucket_ns", value.alias("value")).where("value is not null")
    return Series(out, labels)


def _row_only(expr) -> bool:
    return not needs_tree(expr)


def thin(series: Series, wanted: int) -> Series:
    """At most ``wanted`` exemplars a series, evenly spaced in time order."""
    if not series.exemplars:
        return series
    key = series_key(series.labels)
    some = F.col("ex_trace_id").isNotNull()
    whole = Window.partitionBy(key, some)
    at = F.row_number().over(whole.orderBy("bucket_ns")) - 1
    n = F.count(F.lit(1)).over(whole)
    # i is kept if it is the integer part of k * n / wanted for some k
    kept = (n <= wanted) | (
        F.floor((at * wanted + n - 1) / n) * n < (at + 1) * wanted
    )
    frame = series.frame.withColumn("__keep", kept & some)
    cleared = {c: F.when(F.col("__keep"), F.col(c)) for c in ("ex_trace_id", "ex_ts_ms", "ex_value")}
    return Series(frame.withColumns(cleared).drop("__keep"), series.labels, True)


def capped(series: Series, most: int | None) -> tuple[Series, Observation | None]:
    """The series of the first ``most`` label keys; what is observed as n when they are read tells if there are more.

    One row per series is kept, ``most`` and one at the most, so the query runs once.
    """
    if not most:
        return series, None
    rest = [c for c in series.frame.columns if c not in series.labels]
    keyed = series.frame.groupBy(series_key(series.labels).alias("__key"), *map(quoted, series.labels))
    first = keyed.agg(F.collect_list(F.struct(*map(quoted, rest))).alias("__rows")).orderBy("__key").limit(most + 1)
    seen = Observation()
    first = first.observe(seen, F.count(F.lit(1)).alias("n"))
    ranked = first.withColumn("__rank", F.row_number().over(Window.orderBy("__key"))).where(F.col("__rank") <= most)
    frame = ranked.select(*map(quoted, series.labels), F.inline("__rows"))
    return Series(frame, series.labels, series.exemplars), seen


def shown(series: Series, window: Range) -> DataFrame:
    """The result's columns: labels, bucket_ms, value and exemplars; bucket_ns too if whole milliseconds don't tell buckets apart."""
    ms = F.expr("bucket_ns div 1000000").alias("bucket_ms")
    whole = window.origin_ns == window.start_ns or window.step_ns % 1_000_000 == 0  # a single bucket, or whole steps
    tail = [c for c in series.frame.columns if c not in (*series.labels, "bucket_ns")]
    return series.frame.select(*map(quoted, series.labels), ms, *([] if whole else ["bucket_ns"]), *map(quoted, tail))


def query_range(spans: DataFrame, query: A.Query, window: Range, exemplars: int = 0) -> Series:
    window = window.aligned()
    wanted = exemplar_count(exemplars, query.hints) if exemplars or "exemplars" in query.hints else 0
    series = combine(spans, query.root, window, wanted)
    if isinstance(series, float):
        raise A.QueryError("a query is more than a number")
    return thin(series, wanted)


def query_instant(spans: DataFrame, query: A.Query, start_ns: int, end_ns: int, infinite: bool = False) -> DataFrame:
    """One value per series over exactly the range: a single bucket that begins with it, whatever the function."""
    length = max(1, end_ns - start_ns)
    window = Range(start_ns, start_ns + length, length, start_ns, infinite=infinite)
    series = combine(spans, query.root, window, 0)
    if isinstance(series, float):
        raise A.QueryError("a query is more than a number")
    return shown(series, window)
