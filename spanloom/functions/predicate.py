"""Field expressions as boolean columns.

Predicates are two-valued: a comparison with an attribute that a span doesn't have is false, whatever the operator, but
``= nil`` is true; so negation is plain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.plans import ast as A

from .regex import jvm_pattern
from .resolve import Resolver, Value, quoted

FLIP = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}
NUMERIC = ("int", "float", "duration")


def two_valued(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def compare(op: str, left: Column, right: Column) -> Column:
    return {
        "=": lambda: left == right, "!=": lambda: left != right, "<": lambda: left < right,
        "<=": lambda: left <= right, ">": lambda: left > right, ">=": lambda: left >= right,
    }[op]()


def anchored(pattern: str) -> str:
    """A pattern that matches whole values only; one anchored at both ends already stays as it is but for its end.

    ``$`` would also match before a last newline, which ``\\z`` doesn't.
    """
    pattern = jvm_pattern(pattern)
    if pattern.startswith("^") and pattern.endswith("$") and not pattern.endswith("\\$"):
        return pattern[:-1] + "\\z"
    return f"^(?:{pattern})\\z"


def matches(op: str, value: Column, literal: str) -> Column:
    """A text comparison with a literal, regular expressions included."""
    if op in ("=~", "!~"):
        found = value.rlike(anchored(literal))
        return found if op == "=~" else ~found
    return compare(op, value, F.lit(literal))


class Predicates:
    """Compiles field expressions against a resolver."""

    def __init__(self, resolver: Resolver):
        self.resolver = resolver

    def boolean(self, node) -> Column:
        if node is None:
            return F.lit(True)
        if isinstance(node, A.Static):
            if node.kind != "bool":
                raise A.QueryError(f"{node.value!r} isn't a condition")
            return F.lit(node.value)
        if isinstance(node, A.Unary) and node.op == "!":
            return ~self.boolean(node.expr)
        if isinstance(node, A.Binary) and node.op in ("&&", "||"):
            left, right = self.boolean(node.left), self.boolean(node.right)
            return left & right if node.op == "&&" else left | right
        if isinstance(node, A.Binary) and node.op in ("=", "!=", "<", "<=", ">", ">=", "=~", "!~"):
            return two_valued(self._compare(node.op, node.left, node.right))
        if isinstance(node, A.Attr):
            return self._nested(node, "=", A.Static("bool", True)) if node.scope in ("event", "link") else self._flag(node)
        raise A.QueryError("a filter needs a condition")

    def _flag(self, node) -> Column:
        value = self.resolver.resolve(node)
        return F.lit(False) if value is None else two_valued(value.cast("boolean") == F.lit(True))

    def _compare(self, op: str, left, right) -> Column:
        if isinstance(left, A.Static) and not isinstance(right, A.Static):
            left, right, op = right, left, FLIP.get(op, op)
        if _is_nested(left) or _is_nested(right):
            if not isinstance(right, A.Static):
                raise A.UnsupportedQuery("events and links are compared with literals only")
            return self._nested(left, op, right)
        if isinstance(right, A.Static):
            if isinstance(left, A.Static):
                return self._statics(op, left, right)
            return self._with_literal(op, left, right)
        return self._with_expression(op, left, right)

    def _statics(self, op: str, left: A.Static, right: A.Static) -> Column:
        if op in ("=~", "!~"):
            return matches(op, F.lit(str(left.value)), str(right.value))
        if left.kind == right.kind or {left.kind, right.kind} <= set(NUMERIC):
            return compare(op, F.lit(left.value), F.lit(right.value))
        return F.lit(op == "!=")

    def _with_literal(self, op: str, node, literal: A.Static) -> Column:
        if isinstance(node, A.Intrinsic) and node.name == "nestedSetParent":
            if (found := self._root_test(op, literal)) is not None:
                return found
        value = self.value(node)
        if literal.kind == "nil":
            if op not in ("=", "!="):
                raise A.QueryError("nil is only compared by = and !=")
            if value is None:
                return F.lit(op == "=")
            return value.present() if op == "!=" else ~value.present()
        if value is None:
            return F.lit(False)
        if op in ("=~", "!~") and literal.kind != "string":
            raise A.QueryError("a regular expression is a string")
        if literal.kind in ("status", "kind") or value.type in ("status", "kind"):
            if op not in ("=", "!=", "=~", "!~"):
                raise A.QueryError("status and kind have no order")
            return matches(op, value.text(), str(literal.value))
        if value.type == "array":
            return self._array(op, value, literal)
        return self._leaf(op, value, literal)

    def _leaf(self, op: str, value: Value, literal: A.Static) -> Column:
        if literal.kind == "string":
            return matches(op, value.text(), literal.value)
        if literal.kind == "bool":
            return compare(op, value.cast("boolean"), F.lit(literal.value))
        whole = literal.kind in ("int", "duration") and value.type in ("int", "duration")
        kind = "bigint" if whole else "double"
        return compare(op, value.cast(kind), F.lit(literal.value).cast(kind))

    def _array(self, op: str, value: Value, literal: A.Static) -> Column:
        """= and =~ hold if any element does, != and !~ if none is equal."""
        positive = {"!=": "=", "!~": "=~"}.get(op, op)
        found = F.exists(value.column, lambda x: two_valued(self._leaf(positive, Value("unknown", x), literal)))
        return ~two_valued(found) & value.present() if op in ("!=", "!~") else found

    def _root_test(self, op: str, literal: A.Static) -> Column | None:
        """Comparisons with nestedSetParent that tell roots (-1) from all others (0 or more)."""
        if literal.kind not in ("int", "float"):
            return None
        root = F.coalesce(quoted("parent_span_id"), F.lit("")) == ""
        n = literal.value
        if (op, n) in (("<", 0), ("<=", -1), ("=", -1)):
            return root
        if (op, n) in ((">=", 0), (">", -1), ("!=", -1)):
            return ~root
        return None

    def _with_expression(self, op: str, left, right) -> Column:
        if op in ("=~", "!~"):
            raise A.UnsupportedQuery("a regular expression is a literal")
        a, b = self.value(left), self.value(right)
        if a is None or b is None:
            return F.lit(False)
        if a.type in NUMERIC or b.type in NUMERIC:
            whole = a.type in ("int", "duration") and b.type in ("int", "duration")
            kind = "bigint" if whole else "double"
        elif "bool" in (a.type, b.type):
            kind = "boolean"
        else:
            kind = "string"
        return compare(op, a.cast(kind), b.cast(kind))

    # values
    def value(self, node) -> Value | None:
        if isinstance(node, A.Static):
            return Value(node.kind, F.lit(node.value))
        if isinstance(node, A.Attr | A.Intrinsic):
            return self.resolver.resolve(node)
        if isinstance(node, A.Unary) and node.op == "-":
            inner = self.value(node.expr)
            return inner and Value(_numeric(inner), -inner.cast(_spark(_numeric(inner))))
        if isinstance(node, A.Binary) and node.op in "+-*/%^":
            return self._arithmetic(node)
        return Value("bool", self.boolean(node))

    def _arithmetic(self, node: A.Binary) -> Value | None:
        a, b = self.value(node.left), self.value(node.right)
        if a is None or b is None:
            return None
        ka, kb = _numeric(a, b), _numeric(b, a)
        kind = next(k for k in ("float", "duration", "int") if k in (ka, kb))
        spark = _spark(kind) if node.op not in "/^" else "double"
        x, y = a.cast(spark), b.cast(spark)
        out = {
            "+": lambda: F.try_add(x, y), "-": lambda: F.try_subtract(x, y), "*": lambda: F.try_multiply(x, y),
            "/": lambda: F.try_divide(x, y), "%": lambda: F.try_mod(x, y), "^": lambda: F.pow(x, y),
        }[node.op]()
        return Value("float" if spark == "double" and kind != "duration" else kind, out)

    # events and links
    def _nested(self, node, op: str, literal: A.Static) -> Column:
        """Holds if it does for any event or link; != and !~ hold if none is equal and at least one has the attribute."""
        if not _is_nested(node):
            raise A.UnsupportedQuery("events and links are compared with literals only")
        place = "links" if (node.scope if isinstance(node, A.Attr) else node.name.partition(":")[0]) == "link" else "events"
        if not self.resolver.has(place):
            return F.lit(literal.kind == "nil" and op == "=")
        items = F.coalesce(quoted(place), F.array().cast(self.resolver.fields[place]))
        read = lambda e: _item_value(node, e)
        present = F.exists(items, lambda e: read(e).present())
        if literal.kind == "nil":
            return present if op == "!=" else ~present
        positive = {"!=": "=", "!~": "=~"}.get(op, op)
        found = F.exists(items, lambda e: two_valued(self._leaf(positive, read(e), literal)))
        return present & ~found if op in ("!=", "!~") else found


def _is_nested(node) -> bool:
    if isinstance(node, A.Attr):
        return node.scope in ("event", "link")
    return isinstance(node, A.Intrinsic) and node.name.partition(":")[0] in ("event", "link")


def _item_value(node, item: Column) -> Value:
    """A value of one event or link."""
    if isinstance(node, A.Attr):
        return Value("unknown", F.try_element_at(item["attributes"], F.lit(node.name)))
    if node.name == "event:timeSinceStart":
        return Value("duration", item["time_ns"] - quoted("start_ns"))
    return Value("string", item[{"event:name": "name", "link:traceID": "trace_id", "link:spanID": "span_id"}[node.name]])


def _numeric(value: Value, other: Value | None = None) -> str:
    if value.type in NUMERIC:
        return value.type
    return other.type if other is not None and other.type in NUMERIC else "float"


def _spark(kind: str) -> str:
    return "double" if kind == "float" else "bigint"
