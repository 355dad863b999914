"""Adapters from tables to the canonical spans DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.resolve import TOP_RESOURCE, quoted
from spanloom.functions.variants import as_object, flattened, text_of

#: Canonical columns of every spans DataFrame; attribute columns come beside them.
CANONICAL = {
    "trace_id": "string", "span_id": "string", "parent_span_id": "string", "start_ns": "bigint", "duration_ns": "bigint",
    "name": "string", "kind": "string", "status": "string", "status_message": "string", "service_name": "string",
}
# Fixed values of OpenTelemetry exports: names of kinds and statuses by number.
KIND_NUMBERS = {"0": "unspecified", "1": "internal", "2": "server", "3": "client", "4": "producer", "5": "consumer"}
STATUS_NUMBERS = {"0": "unset", "1": "ok", "2": "error"}


def _hex(c: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(c)), width, "0")


def events_as_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table: a trace is a user's week, a span's parent the event at half its place."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    week_us = 604_800_000_000
    rows = e.withColumn("start_us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn(
        "week", F.expr(f"start_us div {week_us}")
    )
    place = Window.partitionBy("user_id", "week").orderBy("start_us", "event_id")
    numbered = rows.withColumn("span_no", F.row_number().over(place)).withColumn("parent_no", F.expr("span_no div 2"))
    above = numbered.select("user_id", "week", F.col("span_no").alias("parent_no"), F.col("event_id").alias("parent_event"))
    rows = numbered.join(above, ["user_id", "week", "parent_no"], "left")
    parent = F.col("parent_event")
    parent_id = F.when(F.col("span_no") == 1, F.lit(None).cast("string")).when(
        F.col("event_id") % 97 == 0, F.lit("f" * 16)
    ).otherwise(_hex(parent, 16))
    kind = F.col("event_type")
    kinds = {"click": "client", "view": "server", "purchase": "producer", "signup": "consumer", "error": "internal"}
    mapped = F.lit("unspecified")
    for k, v in kinds.items():
        mapped = F.when(kind == k, v).otherwise(mapped)
    start_ns = F.col("start_us") * 1000
    exception = F.array(
        F.struct(
            F.lit("exception").alias("name"), (start_ns + F.col("event_id") % 7 * 300_000_000).alias("time_ns"),
            F.create_map(F.lit("exception.type"), F.concat(F.lit("E"), (F.col("event_id") % 7).cast("string"))).alias("attributes"),
        )
    )
    return rows.select(
        _hex(F.col("user_id") * 100000 + F.col("week"), 32).alias("trace_id"), _hex(F.col("event_id"), 16).alias("span_id"),
        parent_id.alias("parent_span_id"), start_ns.alias("start_ns"),
        (F.round(F.col("value") * 100).cast("long") * 10000).alias("duration_ns"), F.col("event_type").alias("name"),
        mapped.alias("kind"),
        F.when(kind == "error", "error").when(F.col("event_id") % 3 == 0, "ok").otherwise("unset").alias("status"),
        F.lit(None).cast("string").alias("status_message"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string")).alias("service_name"),
        F.try_parse_json("props").alias("attributes.custom"), F.when(kind == "error", exception).alias("events"),
    )


def events_as_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as an OpenTelemetry export would hold it, in the spellings that exports have, logs included."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ident, us = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp"))
    iso = F.concat(F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    kind = F.when(F.col("event_type") == "view", F.element_at(F.array(*map(F.lit, ("SPAN_KIND_SERVER", "2", "Server"))), (ident % 3 + 1).cast("int")))
    status = F.when(F.col("event_type") == "error", F.when(ident % 2 == 0, "STATUS_CODE_ERROR").otherwise("Unset")).otherwise("OK")
    k = F.get_json_object("props", "$.k")
    nested = F.when(ident % 2 == 0, F.concat(F.lit('{"a": {"k": '), k, F.lit("}}"))).otherwise(F.concat(F.lit('{"a.k": '), k, F.lit("}")))
    happened = F.concat(F.lit('[{"Name": "exception", "timeUnixNano": "'), (us * 1000 + 7).cast("string"), F.lit('", "attributes": {"exception": {"type": "E'), (ident % 7).cast("string"), F.lit('"}}}]'))
    return e.select(
        F.when(ident % 11 != 0, F.upper(F.hex(F.col("user_id") + 10))).alias("trace_id"), F.hex(ident).alias("span_id"),
        F.when(ident % 5 == 0, iso).otherwise(us.cast("string")).alias("_time"),
        F.concat((F.round(F.col("value") * 100).cast("long") * 10).cast("string"), F.lit("us")).alias("duration"), F.col("event_type").alias("name"),
        kind.alias("kind"), status.alias("status.code"), (F.col("event_type") == "error").alias("error"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string")).alias("service.name"), (ident % 4 == 0).cast("string").alias("attributes.flag"),
        F.try_parse_json(nested).alias("attributes.custom"), F.when(F.col("event_type") == "error", happened).alias("events"),
    )


def orders_as_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as roots, their line items as children."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    start = (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000)
    none = F.lit(None)
    roots = o.select(
        _hex(F.col("o_orderkey"), 32).alias("trace_id"), _hex(F.col("o_orderkey") * 1000, 16).alias("span_id"),
        none.cast("string").alias("parent_span_id"), start.alias("start_ns"),
        (F.round(F.col("o_totalprice") * 100).cast("long") * 1000).alias("duration_ns"), F.col("o_orderpriority").alias("name"),
        F.lit("server").alias("kind"),
        F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "error").otherwise("unset").alias("status"),
        none.cast("string").alias("status_message"), F.lit("orders").alias("service_name"),
        none.cast("double").alias("attributes.quantity"), none.cast("int").alias("attributes.linenumber"),
    )
    rest = [c for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", *rest)
    numbered = li.withColumn("no", F.row_number().over(place))
    lines = numbered.join(o.select("o_orderkey", start.alias("root_ns")), F.col("l_orderkey") == F.col("o_orderkey"))
    children = lines.select(
        _hex(F.col("l_orderkey"), 32), _hex(F.col("l_orderkey") * 1000 + F.col("no"), 16), _hex(F.col("l_orderkey") * 1000, 16),
        F.col("root_ns") + F.col("no") * 1_000_000, F.round(F.col("l_extendedprice") * 100).cast("long") * 1000,
        F.col("l_returnflag"), F.lit("client"), F.when(F.col("l_linestatus") == "F", "ok").otherwise("unset"),
        none.cast("string"), F.concat(F.lit("supp-"), (F.col("l_suppkey") % 10).cast("string")), F.col("l_quantity"),
        F.col("l_linenumber").cast("int"),
    )
    return roots.union(children)


def canonical_kind(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.trim(c.cast("string"))), "^span_kind_", "")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in KIND_NUMBERS.items() for x in kv]), text), text, F.lit("unspecified"))


def canonical_status(c: Column, error: Column) -> Column:
    """error, ok or unset; an error flag turns unset to error."""
    text = F.regexp_replace(F.lower(F.trim(c.cast("string"))), "^status_code_", "")
    code = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STATUS_NUMBERS.items() for x in kv]), text), text)
    known = F.when(code.isin("error", "ok"), code).otherwise("unset")
    return F.when((known == "unset") & F.coalesce(error, F.lit(False)), "error").otherwise(known)


def duration_text_ns(c: Column) -> Column:
    """Nanoseconds of a number, or of text such as 1m2.5s; null for anything else."""
    text = F.trim(c.cast("string"))
    units = {"ns": 1, "us": 1_000, "µs": 1_000, "μs": 1_000, "ms": 1_000_000, "s": 10**9, "m": 60 * 10**9, "h": 3600 * 10**9}
    table = F.create_map(*[F.lit(x) for kv in units.items() for x in kv])
    unit = "(ns|us|µs|μs|ms|s|m|h)"
    parts = F.regexp_extract_all(text, F.lit(rf"(\d+(?:\.\d+)?){unit}"), F.lit(0))
    each = F.transform(
        parts,
        lambda p: F.round(F.regexp_extract(p, r"^[\d.]+", 0).try_cast("decimal(28,9)") * F.element_at(table, F.regexp_extract(p, r"[^\d.]+$", 0))).cast("long"),
    )
    total = F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)
    sign = F.when(text.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    return F.when(text.rlike(rf"^[+-]?(?:\d+(?:\.\d+)?{unit})+\z"), sign * total).otherwise(text.try_cast("bigint"))


def event_time_ns(c: Column, kind: T.DataType) -> Column:
    """Nanoseconds of a timestamp, RFC 3339 text or an integer whose size tells seconds, ms, µs and ns apart."""
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")) * 1000
    n = c.try_cast("bigint")
    scaled = (
        F.when(F.abs(n) < 10**12, n * 10**9).when(F.abs(n) < 10**15, n * 10**6).when(F.abs(n) < 10**18, n * 1000).otherwise(n)
    )
    if isinstance(kind, T.StringType):
        nanos = F.rpad(F.regexp_extract(c, r"\.(\d{1,9})", 1), 9, "0").try_cast("bigint")
        seconds = F.unix_seconds(F.regexp_replace(c, r"\.\d+", "").try_cast("timestamp"))
        return F.coalesce(scaled, seconds * 10**9 + F.coalesce(nanos, F.lit(0)))
    return scaled


def otel_as_spans(rows: DataFrame, time: str = "_time") -> DataFrame:
    """Rows of an OpenTelemetry export: known names become canonical columns, others become attributes.

    attributes.* and resource.* stay flat, fields of structs become columns of their own; names that begin with _ are dropped;
    any other column is a span attribute under its own name. Events and links may be arrays of structs, or VARIANT or JSON text
    of any fields, one value or an array of them. Rows without a trace id or span id, such as logs, are dropped.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    get = lambda n, t="string": quoted(n).cast(t) if n in kinds else F.lit(None).cast(t)
    ident = lambda n, w: F.when(F.trim(get(n)) != "", F.lpad(F.lower(F.trim(get(n))), w, "0"))
    error = quoted("error").try_cast("boolean") if "error" in kinds else F.lit(None).cast("boolean")
    start = event_time_ns(quoted(time), kinds[time])
    if isinstance(kinds.get("duration"), T.DayTimeIntervalType):
        duration = F.expr("cast(extract(epoch from duration) * 1000000000 as bigint)")
    else:
        duration = duration_text_ns(quoted("duration")) if "duration" in kinds else F.lit(None).cast("bigint")
    own = {
        "trace_id": ident("trace_id", 32), "span_id": ident("span_id", 16), "parent_span_id": ident("parent_span_id", 16),
        "start_ns": start, "duration_ns": F.coalesce(duration, F.lit(0)), "name": get("name"), "kind": canonical_kind(get("kind")),
        "status": canonical_status(get("status.code"), error), "status_message": get("status.message"),
        "service_name": get("service.name"), "scope_name": get("scope.name"), "scope_version": get("scope.version"),
        "trace_state": get("trace_state"),
    }
    used = {"trace_id", "span_id", "parent_span_id", "duration", "name", "kind", "status.code", "status.message", "service.name",
            "scope.name", "scope.version", "trace_state", "error", "events", "links", time}
    rest = {}
    for n in kinds:
        if n in used or (n.startswith("_")):
            continue
        known = n.startswith(("attributes.", "resource.")) or n in TOP_RESOURCE
        rest |= _columns(n if known else f"attributes.{n}", quoted(n), kinds[n])
    extra = {}
    if "events" in kinds:
        extra["events"] = _items("events", kinds["events"], ("name",), True)
    if "links" in kinds:
        extra["links"] = _items("links", kinds["links"], ("trace_id", "span_id", "trace_state"), False)
    made = rows.select(*[c.alias(n) for n, c in (own | rest | extra).items()], error.alias("error"))
    return made.where("trace_id is not null and span_id is not null")


def _columns(name: str, value: Column, kind: T.DataType) -> dict[str, Column]:
    """A column, or one for each field of a struct, names joined by dots."""
    if not isinstance(kind, T.StructType):
        return {name: value}
    out = {}
    for f in kind.fields:
        out |= _columns(f"{name}.{f.name}", value.getField(f.name), f.dataType)
    return out


#: Whole seconds around a range that time zones of texts without one, or of local timestamps, may shift.
ZONES = 26 * 3600


class OtelSource:
    """Rows of an OpenTelemetry export as a source of spans whose range and trace id reach the scan.

    Ranges are put on the time column itself: on timestamps; on whole numbers, as bounds in each unit that their size may
    tell; on texts if ``dated_text`` says that all are RFC 3339. ``date`` names a column, best a partition's, with the day of the
    time in UTC, as a date or as YYYY-MM-DD (see with_date). Such filters only narrow the scan; the exact limits are put on
    the spans. Trace ids are put there if ``canonical_ids``, which says that the export holds them as 32 digits in lower
    case; otherwise they are compared after the adapter has padded them.
    """

    def __init__(self, rows: DataFrame, time: str = "_time", canonical_ids: bool = False, date: str | None = None, dated_text: bool = False):
        self.rows, self.time, self.canonical_ids, self.date, self.dated_text = rows, time, canonical_ids, date, dated_text

    def spans(self, start_ns: int | None = None, end_ns: int | None = None, trace_id: str | None = None) -> DataFrame:
        rows = self.rows.where(self._near(start_ns, end_ns))
        if trace_id is not None and self.canonical_ids:
            rows = rows.where(quoted("trace_id") == trace_id)
        return otel_as_spans(rows.drop(self.date) if self.date else rows, self.time)

    def _near(self, start_ns: int | None, end_ns: int | None) -> Column:
        """A condition that all rows of the range meet, and few others."""
        if start_ns is None and end_ns is None:
            return F.lit(True)
        kind, c = self.rows.schema[self.time].dataType, quoted(self.time)
        found = F.lit(True)
        if isinstance(kind, T.TimestampType):
            stamp = lambda ns: F.timestamp_micros(F.lit(ns))
            found = _bounds(c, start_ns, end_ns, 1000, 0, stamp)
        elif isinstance(kind, T.TimestampNTZType):
            local = lambda us: F.lit(dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us))
            found = _bounds(c, start_ns, end_ns, 1000, ZONES * 10**6, local)
        elif isinstance(kind, T.IntegralType):
            found = F.lit(False)
            for unit in (10**9, 10**6, 1000, 1):
                found = found | _bounds(c, start_ns, end_ns, unit, 0, lambda n: F.lit(n).cast("bigint"))
        elif isinstance(kind, T.StringType) and self.dated_text:
            found = _bounds(c, start_ns, end_ns, 10**9, ZONES, lambda s: F.lit(_day(s)), after=86_400)
        if self.date is not None:
            day = (lambda s: F.lit(_day(s))) if isinstance(self.rows.schema[self.date].dataType, T.StringType) else lambda s: F.lit(_day(s)).cast("date")
            found = found & _bounds(quoted(self.date), start_ns, end_ns, 10**9, 0, day)
        return found


def _day(seconds: int) -> str:
    return (dt.date(1970, 1, 1) + dt.timedelta(days=seconds // 86_400)).isoformat()


def _bounds(c: Column, start_ns: int | None, end_ns: int | None, unit: int, around: int, literal, after: int = 0) -> Column:
    """c between the range's limits in a unit, widened by ``around`` on both sides and ``after`` at the end."""
    found = F.lit(True) if start_ns is None else c >= literal(start_ns // unit - around)
    return found if end_ns is None else found & (c <= literal(-(-end_ns // unit) + around + after))


def with_date(rows: DataFrame, time: str = "_time", name: str = "date") -> DataFrame:
    """rows with the day of their time in UTC, to partition a table by."""
    days = F.floor(event_time_ns(quoted(time), rows.schema[time].dataType) / (86_400 * 10**9))
    return rows.withColumn(name, F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")))


# Spellings of the fields of events and links in exports.
ITEM_FIELDS = {
    "trace_id": ("trace_id", "traceid"), "span_id": ("span_id", "spanid"), "trace_state": ("trace_state", "tracestate"), "name": ("name",),
}
ITEM_TIMES = ("timestamp", "time", "time_unix_nano", "timeunixnano", "_time", "time_ns")


#: Fields of events and links that aren't attributes.
DROPPED = ("dropped_attributes_count", "droppedattributescount")


def _items(column: str, kind: T.DataType, texts: tuple[str, ...], timed: bool) -> Column:
    """Events or links with canonical fields; unknown fields join the attributes."""
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if isinstance(inner, T.StructType):
        return _struct_items(column, inner, texts, timed)
    whole = quoted(column)
    if isinstance(kind, T.ArrayType) and isinstance(inner, T.VariantType):
        items = whole
    elif isinstance(kind, T.ArrayType):
        items = F.transform(whole, (lambda x: F.try_parse_json(x)) if isinstance(inner, T.StringType) else lambda x: F.try_parse_json(F.to_json(x)))
    else:
        v = whole if isinstance(kind, T.VariantType) else F.try_parse_json(whole.cast("string"))
        one = F.when(as_object(v).isNotNull(), F.array(v))
        items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), one)
    return F.transform(F.filter(items, lambda e: as_object(e).isNotNull()), lambda e: _variant_item(e, texts, timed))


def _variant_item(e: Column, texts: tuple[str, ...], timed: bool) -> Column:
    """An event or link of any fields, in any case; nested objects join the attributes under dotted keys."""
    entries = as_object(e)

    def field(names: tuple[str, ...]) -> Column:
        found = F.filter(entries, lambda x: F.lower(x["key"]).isin(*names))
        return F.try_variant_get(F.try_element_at(found, F.lit(1))["value"], "$", "string")

    out = [field(ITEM_FIELDS[t]).alias(t) for t in texts]
    if timed:
        out.append(event_time_ns(field(ITEM_TIMES), T.StringType()).alias("time_ns"))
    known = [*(a for t in texts for a in ITEM_FIELDS[t]), *(ITEM_TIMES if timed else ()), *DROPPED]
    # what stands under attributes goes by its own keys, and all other fields by theirs
    inner = F.transform(flattened(e), lambda x: F.struct(
        F.regexp_replace(x["key"], r"^(?i:attributes)\.", "").alias("key"), text_of(x["value"]).alias("value"), x["key"].alias("path"),
    ))
    kept = F.filter(inner, lambda x: ~F.lower(x["path"]).isin(*known) & (F.lower(x["path"]) != "attributes") & x["value"].isNotNull())
    names = F.array_distinct(F.transform(kept, lambda x: x["key"]))
    first = F.transform(names, lambda k: F.element_at(F.filter(kept, lambda x: x["key"] == k), 1)["value"])
    out.append(F.coalesce(F.map_from_arrays(names, first), F.create_map().cast("map<string,string>")).alias("attributes"))
    return F.struct(*out)


def _struct_items(column: str, kind: T.StructType, texts: tuple[str, ...], timed: bool) -> Column:
    fields = {f.name.lower(): f for f in kind.fields}
    alias = ITEM_FIELDS
    times = [n for n in ITEM_TIMES if n in fields]
    used = {a for t in texts for a in alias[t]} | set(times) | {"attributes", *DROPPED}

    def one(e: Column) -> Column:
        out = []
        for t in texts:
            name = next((a for a in alias[t] if a in fields), None)
            out.append((e[fields[name].name].cast("string") if name else F.lit(None).cast("string")).alias(t))
        if timed:
            found = [event_time_ns(e[fields[n].name], fields[n].dataType) for n in times]
            out.append((F.coalesce(*found) if found else F.lit(None).cast("bigint")).alias("time_ns"))
        maps = [e[fields["attributes"].name].cast("map<string,string>")] if "attributes" in fields and isinstance(fields["attributes"].dataType, T.MapType) else []
        others = [f for n, f in fields.items() if n not in used and not isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType)]
        if others:
            maps.append(F.create_map(*[x for f in others for x in (F.lit(f.name), e[f.name].cast("string"))]))
        if "attributes" in fields and isinstance(fields["attributes"].dataType, T.StructType):
            inner = fields["attributes"].dataType.fields
            maps.append(F.create_map(*[x for f in inner for x in (F.lit(f.name), e[fields["attributes"].name][f.name].cast("string"))]))
        whole = F.map_concat(*[F.coalesce(m, F.create_map().cast("map<string,string>")) for m in maps]) if maps else F.create_map().cast("map<string,string>")
        out.append(F.map_filter(whole, lambda k, v: v.isNotNull()).alias("attributes"))
        return F.struct(*out)

    return F.transform(quoted(column), one)
