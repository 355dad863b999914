"""Attributes and intrinsics of spans as columns, found by the DataFrame's schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.plans import ast as A

from .variants import at_key

# Fixed values of the data model: resource attributes with a column of their own, and the columns of attribute maps.
TOP_RESOURCE = (
    "service.name", "service.version", "service.instance.id", "service.namespace", "telemetry.sdk.language",
    "telemetry.sdk.name", "telemetry.sdk.version",
)
SPAN_MAP, RESOURCE_MAP = "attributes.custom", "resource.custom"
SPAN_PREFIX, RESOURCE_PREFIX = "attributes.", "resource."

#: Intrinsics that a span's own row answers: name -> (column, type).
OWN = {
    "duration": ("duration_ns", "duration"), "name": ("name", "string"), "status": ("status", "status"),
    "statusMessage": ("status_message", "string"), "kind": ("kind", "kind"), "trace:id": ("trace_id", "string"),
    "span:id": ("span_id", "string"), "span:parentID": ("parent_span_id", "string"),
    "instrumentation:name": ("scope_name", "string"), "instrumentation:version": ("scope_version", "string"),
}
#: Intrinsics that need the trace's rollup, and those that need its tree.
TRACE = {
    "traceDuration": ("trace_duration_ns", "duration"), "rootName": ("root_name", "string"),
    "rootServiceName": ("root_service_name", "string"),
}
TREE = {
    "nestedSetLeft": ("nested_left", "int"), "nestedSetRight": ("nested_right", "int"),
    "nestedSetParent": ("nested_parent", "int"), "childCount": ("child_count", "int"),
}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class Value:
    """A typed source of one value per span. type: string, int, float, bool, duration, status, kind, array or unknown."""

    type: str
    column: Column | None = None
    #: How to read the value as a Spark type; by default a cast of the column.
    read: object = None

    def cast(self, kind: str) -> Column:
        if self.read is not None:
            return self.read(kind)
        return self.column.try_cast(kind)

    def text(self) -> Column:
        return self.cast("string")

    def present(self) -> Column:
        return (self.column if self.column is not None else self.text()).isNotNull()


def type_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StringType):
        return "string"
    if isinstance(data_type, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "int"
    if isinstance(data_type, T.FloatType | T.DoubleType | T.DecimalType):
        return "float"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    if isinstance(data_type, T.DayTimeIntervalType):
        return "duration"
    return "array" if isinstance(data_type, T.ArrayType) else "unknown"


class Resolver:
    """Finds what an attribute stands for in a spans DataFrame; None where the data has no such attribute."""

    def __init__(self, spans: DataFrame):
        self.fields = {f.name: f.dataType for f in spans.schema.fields}

    def has(self, column: str) -> bool:
        return column in self.fields

    def resolve(self, node) -> Value | None:
        return self._intrinsic(node.name) if isinstance(node, A.Intrinsic) else self._attribute(node)

    def _intrinsic(self, name: str) -> Value | None:
        for table in (OWN, TRACE, TREE):
            if name in table:
                column, kind = table[name]
                return Value(kind, quoted(column)) if self.has(column) or table is not OWN else None
        if name == "parent":
            return None
        raise A.UnsupportedQuery(f"{name} isn't a value of a span's row")

    def _attribute(self, node: A.Attr) -> Value | None:
        if node.scope == "span":
            return self._flat_or_map(SPAN_PREFIX + node.name, SPAN_MAP, node.name)
        if node.scope == "resource":
            if node.name in TOP_RESOURCE:
                column = "service_name" if node.name == "service.name" and self.has("service_name") else node.name
                if self.has(column):
                    return self._column(column)
            return self._flat_or_map(RESOURCE_PREFIX + node.name, RESOURCE_MAP, node.name)
        if node.scope == "":
            return self._either(A.Attr("span", node.name), A.Attr("resource", node.name))
        if node.scope == "instrumentation":
            column = {"name": "scope_name", "version": "scope_version"}.get(node.name)
            return self._column(column) if column and self.has(column) else None
        return None  # parent.* never matches

    def _column(self, name: str) -> Value:
        return Value(type_of(self.fields[name]), quoted(name))

    def _flat_or_map(self, flat: str, holder: str, key: str) -> Value | None:
        kind = self.fields.get(flat)
        if kind is not None and not isinstance(kind, T.MapType | T.VariantType):
            return self._column(flat)
        if isinstance(kind, T.VariantType) and flat != holder:
            return Value("unknown", read=lambda t: F.try_variant_get(quoted(flat), "$", t))
        kind = self.fields.get(holder)
        own = self._inside_column(flat)
        if isinstance(kind, T.VariantType):
            read = lambda t: at_key(quoted(holder), key, t)
            return Value("unknown", read=read if own is None else lambda t: F.coalesce(own.cast(t), read(t)))
        if own is not None:
            return own
        if isinstance(kind, T.MapType):
            return Value(
                "unknown" if isinstance(kind.valueType, T.StringType) else type_of(kind.valueType),
                F.try_element_at(quoted(holder), F.lit(key)),
            )
        return None

    def _inside_column(self, flat: str) -> Value | None:
        """A key inside a VARIANT column: attributes.a.b.c may be b.c of attributes.a."""
        place = flat.rfind(".")
        while place > 0:
            column, rest = flat[:place], flat[place + 1 :]
            if column not in (SPAN_MAP, RESOURCE_MAP) and isinstance(self.fields.get(column), T.VariantType):
                return Value("unknown", read=lambda t: at_key(quoted(column), rest, t))
            place = flat.rfind(".", 0, place)
        return None

    def _either(self, first: A.Attr, second: A.Attr) -> Value | None:
        a, b = self.resolve(first), self.resolve(second)
        if a is None or b is None:
            return a or b
        kind = a.type if a.type == b.type else "unknown"
        return Value(kind, read=lambda t: F.coalesce(a.cast(t), b.cast(t)))
