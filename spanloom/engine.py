"""The library's API: TraceQL over a spans DataFrame or a source of spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.resolve import type_of
from spanloom.operators import metrics, otlp, search
from spanloom.operators import tags as tag_lists
from spanloom.plans.ast import QueryError, UnsupportedQuery
from spanloom.plans.parser import parse
from spanloom.sources.adapters import OtelSource

__all__ = ["Catalog", "MetricsResult", "QueryError", "SearchResult", "TraceEngine", "UnsupportedQuery"]


class MetricsResult:
    """The series of a metrics query: frame, a lazy DataFrame.

    partial says whether max_series left some out, which message then tells. The query itself counts them while it runs, so
    they are known once rows() has run it; before that, asking for them runs it.
    """

    def __init__(self, frame: DataFrame, most: int | None = None, seen: Observation | None = None):
        self.frame, self._most, self._seen, self._found = frame, most, seen, None

    def rows(self) -> list[Row]:
        found = self.frame.collect()
        self._observe(len(found))
        return found

    def _observe(self, rows: int) -> None:
        # what Spark finds to be empty it doesn't observe
        self._found = self._seen.get["n"] if self._seen is not None and rows else 0

    @property
    def partial(self) -> bool:
        if self._seen is not None and self._found is None:
            self._observe(self.frame.count())
        return self._seen is not None and self._found > self._most

    @property
    def message(self) -> str:
        return f"more than {self._most} series" if self.partial else ""


class SearchResult:
    """The traces of a search: frame, a lazy DataFrame. Every trace is whole."""

    def __init__(self, frame: DataFrame, candidates: DataFrame | None = None):
        self.frame, self._candidates = frame, candidates

    @property
    def dropped_traces(self) -> int:
        """How many candidate traces max_spans left out; counted by a query of its own, without the search."""
        return 0 if self._candidates is None else self._candidates.where("not fits").count()

    @property
    def partial(self) -> bool:
        return self.dropped_traces > 0


class TraceEngine:
    """Answers TraceQL on canonical spans (see sources.adapters). Everything returned is a lazy DataFrame.

    spans: a DataFrame, or a source with spans(start_ns, end_ns, trace_id), such as sources.adapters.OtelSource, which puts
    the range and the id below its adapter, where the scan sees them.

    A time range is [start_ns, end_ns). Searches may see spans up to padding_ns around it, so that traces at its edges
    are whole, but only match spans within. max_series and max_attributes bound the series of a metrics query and the
    attributes of compare(); max_spans bounds the spans that a search pulls, whole traces only. By default nothing is
    bounded. prefilter: see operators.search.candidates. infinite: whether arithmetic of metrics keeps buckets whose value
    is infinite or NaN, as in a division by zero.
    """

    def __init__(
        self, spans, max_series: int | None = None, padding_ns: int = 3600 * 10**9, max_attributes: int | None = None,
        prefilter: bool = False, max_spans: int | None = None, infinite: bool = False,
    ):
        self.source, self.max_spans, self.infinite = spans, max_spans, infinite
        self.max_series, self.padding_ns, self.max_attributes, self.prefilter = max_series, padding_ns, max_attributes, prefilter

    @property
    def spans(self) -> DataFrame:
        return self._within(None, None)

    def _within(self, start_ns: int | None, end_ns: int | None) -> DataFrame:
        if start_ns is not None and end_ns is not None and end_ns < start_ns:
            raise QueryError("the range ends before it starts")
        out = self.source if isinstance(self.source, DataFrame) else self.source.spans(start_ns, end_ns)
        return _inside(out, start_ns, end_ns)

    def spans_of(self, query: str, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
        """All matching spans, with their columns and spanset."""
        return search.matching_spans(self._within(start_ns, end_ns), parse(query), prefilter=self.prefilter)

    def search(self, query: str, *args, **options) -> DataFrame:
        """The frame of search_result."""
        return self.search_result(query, *args, **options).frame

    def search_result(
        self, query: str, start_ns: int | None = None, end_ns: int | None = None, limit: int = 20, spss: int | None = None,
        services: bool = False,
    ) -> SearchResult:
        """The best traces and their first spans, see operators.search.search."""
        low = None if start_ns is None else start_ns - self.padding_ns
        high = None if end_ns is None else end_ns + self.padding_ns
        if start_ns is not None and end_ns is not None and end_ns <= start_ns:
            raise QueryError("the range ends before it starts")
        within = None
        if start_ns is not None:
            within = F.col("start_ns") >= start_ns
        if end_ns is not None:
            before = F.col("start_ns") < end_ns
            within = before if within is None else within & before
        seen = self._within(low, high)
        parsed, marked = parse(query), None
        if self.max_spans is not None:
            seen, marked = search.within_budget(seen, parsed, self.max_spans, within)
        found = search.search(seen, parsed, limit, 3 if spss is None else spss, within, self.prefilter, services)
        return SearchResult(found, marked)

    def search_tags(self, tags: dict[str, str], min_duration: str | None = None, max_duration: str | None = None, **options) -> DataFrame:
        return self.search(search.legacy_query(tags, min_duration, max_duration), **options)

    def metrics_result(self, query: str, start_ns: int, end_ns: int, step_ns: int = 0, exemplars: int = 0) -> MetricsResult:
        window = metrics.Range(start_ns, end_ns, step_ns, most_attributes=self.max_attributes, infinite=self.infinite)
        at = window.aligned()
        made = metrics.query_range(self._within(at.start_ns, at.end_ns), parse(query), window, exemplars)
        kept, seen = metrics.capped(made, self.max_series)
        return MetricsResult(metrics.shown(kept, at), self.max_series, seen)

    def metrics(self, query: str, start_ns: int, end_ns: int, step_ns: int = 0, exemplars: int = 0) -> DataFrame:
        return self.metrics_result(query, start_ns, end_ns, step_ns, exemplars).frame

    def instant(self, query: str, start_ns: int, end_ns: int) -> DataFrame:
        spans = self._within(start_ns, max(end_ns, start_ns + 1))
        return metrics.query_instant(spans, parse(query), start_ns, end_ns, self.infinite)

    def trace(self, trace_id: str, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
        if isinstance(self.source, DataFrame):
            return otlp.trace_by_id(self.source, trace_id, start_ns, end_ns)
        return otlp.trace_by_id(self.source.spans(start_ns, end_ns, otlp.normal_id(trace_id)), trace_id, start_ns, end_ns)

    def trace_otlp(self, trace_id: str, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
        return otlp.nested(self.trace(trace_id, start_ns, end_ns))

    def fields(self) -> list[tuple[str, str]]:
        """Name and type of every column of the spans: string, int, float, bool, duration, array, map or unknown."""
        held = ((f.name, f.dataType) for f in self.spans.schema.fields)
        return [(name, "map" if isinstance(kind, T.MapType | T.VariantType) else type_of(kind)) for name, kind in held]

    def tags(
        self, scope: str | None = None, start_ns: int | None = None, end_ns: int | None = None, limit: int | None = None,
        sampled: int | None = None,
    ) -> DataFrame:
        """Tag names from all rows; with ``sampled``, keys of maps come from that many rows."""
        return tag_lists.tag_names(self._within(start_ns, end_ns), scope, sampled, limit)

    def tag_values(
        self, tag: str, query: str | None = None, limit: int | None = tag_lists.MOST_VALUES, start_ns: int | None = None,
        end_ns: int | None = None,
    ) -> DataFrame:
        return tag_lists.tag_values(self._within(start_ns, end_ns), tag, query, limit)


def _inside(spans: DataFrame, start_ns: int | None, end_ns: int | None) -> DataFrame:
    if start_ns is not None:
        spans = spans.where(F.col("start_ns") >= start_ns)
    return spans if end_ns is None else spans.where(F.col("start_ns") < end_ns)


class Catalog:
    """Datasets by name, each a function that gives its spans or source; with ``allowed``, only those names are served."""

    def __init__(self, datasets: dict, default: str | None = None, allowed: list[str] | None = None):
        self._datasets = {n: d for n, d in datasets.items() if allowed is None or n in allowed}
        self._default = default

    @classmethod
    def of_tables(cls, spark: SparkSession, database: str | None = None, time: str = "_time", **options) -> Catalog:
        """The tables and views of a database of the session that hold spans: those with trace and span ids and a time."""
        found = {}
        for table in spark.catalog.listTables(database):
            parts = [*(table.namespace or []), table.name] if not table.isTemporary else [table.name]
            name = ".".join("`" + p.replace("`", "``") + "`" for p in parts)
            if {"trace_id", "span_id", time} <= set(spark.table(name).columns):
                found[table.name] = lambda name=name: OtelSource(spark.table(name), time)
        return cls(found, **options)

    def names(self) -> list[str]:
        return sorted(self._datasets)

    def datasets(self) -> list[tuple[str, str, list[str]]]:
        """Of each dataset: its name, what it holds, and its columns that are maps of attributes."""
        out = []
        for name in self.names():
            found = self.engine(name).fields()
            out.append((name, "traces", [n for n, kind in found if kind == "map"]))
        return out

    def engine(self, name: str | None = None, **options) -> TraceEngine:
        name = self._default if name is None else name
        if name not in self._datasets:
            raise QueryError(f"no such dataset: {name!r}")
        return TraceEngine(self._datasets[name](), **options)
