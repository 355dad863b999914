"""Syntax tree of TraceQL queries."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


class QueryError(ValueError):
    """The query text is malformed."""


class UnsupportedQuery(QueryError):
    """The query is well-formed but can't be answered."""


@dataclass(frozen=True)
class Static:
    """kind: nil, string, int, float, bool, duration (nanoseconds), status or kind."""

    kind: str
    value: object = None


@dataclass(frozen=True)
class Attr:
    """scope: '' (span, else resource), span, resource, event, link, instrumentation or parent."""

    scope: str
    name: str

    @property
    def text(self) -> str:
        return f"{self.scope}.{self.name}"


@dataclass(frozen=True)
class Intrinsic:
    name: str
    text: str = field(default="", compare=False)


@dataclass(frozen=True)
class Unary:
    op: str
    expr: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class SpansetFilter:
    expr: object | None


@dataclass(frozen=True)
class SpansetOp:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Aggregate:
    fn: str
    expr: object | None


@dataclass(frozen=True)
class ScalarFilter:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class GroupBy:
    expr: object


@dataclass(frozen=True)
class Coalesce:
    pass


@dataclass(frozen=True)
class Select:
    attrs: tuple


@dataclass(frozen=True)
class Pipeline:
    stages: tuple


@dataclass(frozen=True)
class MetricsAgg:
    fn: str
    attr: object | None = None
    quantiles: tuple = ()
    by: tuple = ()
    selection: SpansetFilter | None = None
    top: int = 10
    start_ns: int | None = None
    end_ns: int | None = None


@dataclass(frozen=True)
class Rank:
    """topk or bottomk."""

    fn: str
    n: int


@dataclass(frozen=True)
class Threshold:
    op: str
    value: float


@dataclass(frozen=True)
class MetricsQuery:
    stages: tuple
    agg: MetricsAgg
    second: tuple = ()


@dataclass(frozen=True)
class Math:
    """left and right: MetricsQuery, Math or float; second stages apply to the result."""

    op: str
    left: object
    right: object
    second: tuple = ()


@dataclass(frozen=True)
class Query:
    root: object
    hints: dict = field(default_factory=dict, hash=False)


def walk(node):
    """All nodes of a tree, the node itself first."""
    yield node
    if hasattr(node, "__dataclass_fields__"):
        for name in node.__dataclass_fields__:
            value = getattr(node, name)
            for child in value if isinstance(value, tuple) else (value,):
                if hasattr(child, "__dataclass_fields__"):
                    yield from walk(child)


def replace(node, change):
    """The tree with change applied to every node, the leaves first."""
    if not hasattr(node, "__dataclass_fields__"):
        return node
    inner = {n: getattr(node, n) for n in node.__dataclass_fields__}
    made = {n: tuple(replace(c, change) for c in v) if isinstance(v, tuple) else replace(v, change) for n, v in inner.items()}
    return change(dataclasses.replace(node, **made))
