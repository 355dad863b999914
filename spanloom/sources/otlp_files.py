"""OTLP JSON files, one export request a line, as a Spark data source: read in parts, filtered while read, and written.

    spark.dataSource.register(OtlpFiles)
    spark.read.format("otlp").load(path)                  # rows as ROW says
    TraceEngine(OtlpFileSource(spark, path))              # canonical spans, ranges and ids pushed to the files
    write_otlp(spans, path)
"""

from __future__ import annotations

import base64
import io
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)

from spanloom.functions.resolve import RESOURCE_MAP, RESOURCE_PREFIX, SPAN_MAP, SPAN_PREFIX, quoted

#: Bytes of a file that one task reads, unless an option says otherwise; lines belong to the part that they begin in.
PART_BYTES = 64 << 20
ITEM = "struct<name: string, time_ns: bigint, attributes: map<string, string>>"
LINK = "struct<trace_id: string, span_id: string, trace_state: string, attributes: map<string, string>>"
ROW = (
    "trace_id string, span_id string, parent_span_id string, trace_state string, start_ns bigint, duration_ns bigint, name string, kind string, "
    "status string, status_message string, service_name string, scope_name string, scope_version string, attributes string, resource string, "
    f"events array<{ITEM}>, links array<{LINK}>"
)
# Fixed values of OTLP: kinds and status codes by number.
KINDS = ("unspecified", "internal", "server", "client", "producer", "consumer")
CODES = ("unset", "ok", "error")
SERVICE = "service.name"


def plain_value(v: dict):
    """The value of an AnyValue."""
    for kind, x in (v or {}).items():
        if kind == "intValue":
            return int(x)
        if kind == "arrayValue":
            return [plain_value(y) for y in x.get("values", [])]
        if kind == "kvlistValue":
            return plain_attributes(x.get("values", []))
        if kind == "bytesValue":
            return base64.b64decode(x).hex()
        return x
    return None


def plain_attributes(pairs: list) -> dict:
    return {p["key"]: plain_value(p.get("value")) for p in pairs or []}


def any_value(x) -> dict:
    """A plain value as an AnyValue."""
    if isinstance(x, bool):
        return {"boolValue": x}
    if isinstance(x, int):
        return {"intValue": str(x)}
    if isinstance(x, float):
        return {"doubleValue": x}
    if isinstance(x, list):
        return {"arrayValue": {"values": [any_value(y) for y in x]}}
    if isinstance(x, dict):
        return {"kvlistValue": {"values": any_attributes(x)}}
    return {} if x is None else {"stringValue": str(x)}


def any_attributes(values: dict | None) -> list:
    return [{"key": k, "value": any_value(v)} for k, v in sorted((values or {}).items())]


def _text(x) -> str:
    return x if isinstance(x, str) else json.dumps(x, ensure_ascii=False, separators=(",", ":"))


def _texts(pairs: list) -> dict:
    return {k: _text(v) for k, v in plain_attributes(pairs).items() if v is not None}


def _of(names: tuple, value, prefix: str) -> str:
    if isinstance(value, int):
        return names[value] if 0 <= value < len(names) else names[0]
    return str(value or names[0]).lower().removeprefix(prefix)


def _id(text: str | None, width: int) -> str | None:
    return text.lower().rjust(width, "0") if text else None


def rows_of(request: dict) -> Iterator[tuple]:
    """The spans of an export request as ROW says."""
    for block in request.get("resourceSpans", []):
        resource = plain_attributes((block.get("resource") or {}).get("attributes"))
        service = resource.pop(SERVICE, None)
        for part in block.get("scopeSpans", []):
            scope = part.get("scope") or {}
            for s in part.get("spans", []):
                start, status = int(s.get("startTimeUnixNano", 0)), s.get("status") or {}
                events = [(e.get("name"), int(e.get("timeUnixNano", 0)), _texts(e.get("attributes"))) for e in s.get("events", [])]
                links = [(_id(k.get("traceId"), 32), _id(k.get("spanId"), 16), k.get("traceState"), _texts(k.get("attributes"))) for k in s.get("links", [])]
                yield (
                    _id(s.get("traceId"), 32), _id(s.get("spanId"), 16), _id(s.get("parentSpanId"), 16), s.get("traceState"), start,
                    int(s.get("endTimeUnixNano", start)) - start, s.get("name"), _of(KINDS, s.get("kind"), "span_kind_"),
                    _of(CODES, status.get("code"), "status_code_"), status.get("message"), None if service is None else _text(service),
                    scope.get("name"), scope.get("version"), json.dumps(plain_attributes(s.get("attributes")), ensure_ascii=False),
                    json.dumps(resource, ensure_ascii=False), events or None, links or None,
                )


def request_of(rows: list) -> dict:
    """The export request of spans: rows are grouped by resource, then by scope."""
    resources: dict = {}
    for r in rows:
        own = {**json.loads(r.resource or "{}"), **({} if r.service_name is None else {SERVICE: r.service_name})}
        key = json.dumps(own, sort_keys=True)
        scopes = resources.setdefault(key, (own, {}))[1]
        scopes.setdefault((r.scope_name, r.scope_version), []).append(r)
    some = lambda **fields: {k: v for k, v in fields.items() if v not in (None, [], {})}
    return {"resourceSpans": [
        {"resource": {"attributes": any_attributes(own)}, "scopeSpans": [
            {"scope": some(name=name, version=version), "spans": [
                some(
                    traceId=r.trace_id, spanId=r.span_id, parentSpanId=r.parent_span_id, traceState=r.trace_state, name=r.name,
                    kind=KINDS.index(r.kind) if r.kind in KINDS else 0, startTimeUnixNano=str(r.start_ns), endTimeUnixNano=str(r.start_ns + (r.duration_ns or 0)),
                    attributes=any_attributes(json.loads(r.attributes or "{}")), status=some(code=CODES.index(r.status) if r.status in CODES[1:] else None, message=r.status_message),
                    events=[some(name=e.name, timeUnixNano=str(e.time_ns or 0), attributes=any_attributes(e.attributes)) for e in r.events or []],
                    links=[some(traceId=k.trace_id, spanId=k.span_id, traceState=k.trace_state, attributes=any_attributes(k.attributes)) for k in r.links or []],
                ) for r in found
            ]} for (name, version), found in scopes.items()
        ]} for own, scopes in resources.values()
    ]}


def _store(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


class Part(InputPartition):
    """The lines of a file that begin in a range of its bytes."""

    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class OtlpReader(DataSourceReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes, self.low, self.high, self.ids = path, part_bytes, None, None, None

    def pushFilters(self, filters):
        """Bounds of start_ns and an equal trace_id are met while files are read; Spark checks all others."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("start_ns",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
                low = value + isinstance(f, GreaterThan)
                self.low = low if self.low is None else max(low, self.low)
            elif column == ("start_ns",) and isinstance(f, LessThan | LessThanOrEqual):
                high = value - isinstance(f, LessThan)
                self.high = high if self.high is None else min(high, self.high)
            elif column == ("trace_id",) and isinstance(f, EqualTo):
                self.ids = {value} if self.ids is None else self.ids & {value}
            else:
                yield f

    def _wanted(self, start: int, end: int) -> bool:
        return (self.low is None or end >= self.low) and (self.high is None or start <= self.high)

    def partitions(self):
        from pyarrow import fs

        store, path = _store(self.path)
        found = store.get_file_info(path)
        files = [found] if found.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        out = []
        for f in sorted(files, key=lambda f: f.path):
            if not f.is_file or f.base_name.startswith(("_", ".")):
                continue
            bounds = f.base_name.split("-")  # files that were written here say what starts they hold
            if bounds[0] == "spans" and len(bounds) > 3 and not self._wanted(int(bounds[1]), int(bounds[2])):
                continue
            out += [Part(f.path, at, min(at + self.part_bytes, f.size)) for at in range(0, f.size, self.part_bytes)]
        return out or [Part("", 0, 0)]

    def read(self, part: Part):
        if not part.file:
            return
        with io.BufferedReader(_store(self.path)[0].open_input_file(part.file)) as file:
            at = part.start
            if at:  # the line that begins before belongs to the part before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            while at < part.end and (line := file.readline()):
                at += len(line)
                if line.strip():
                    for row in rows_of(json.loads(line)):
                        if row[0] and row[1] and self._wanted(row[4], row[4]) and (self.ids is None or row[0] in self.ids):
                            yield row


class Written(WriterCommitMessage):
    def __init__(self, files: list):
        self.files = files


class OtlpWriter(DataSourceWriter):
    """Each task writes files of its own under names that readers skip; they get theirs when all tasks are done."""

    def __init__(self, path: str, overwrite: bool, rows: int):
        self.path, self.overwrite, self.rows = path, overwrite, rows

    def write(self, iterator):
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        ident, held, low, high = uuid.uuid4().hex, [], None, None
        hidden = f"{path}/.{ident}"
        with store.open_output_stream(hidden) as out:
            def put():
                out.write((json.dumps(request_of(held), ensure_ascii=False) + "\n").encode())
                held.clear()

            for r in iterator:
                held.append(r)
                low, high = r.start_ns if low is None else min(low, r.start_ns), r.start_ns if high is None else max(high, r.start_ns)
                if len(held) >= self.rows:
                    put()
            if held:
                put()
        return Written([(hidden, None if low is None else f"{path}/spans-{max(low, 0)}-{max(high, 0)}-{ident}.jsonl")])

    def commit(self, messages):
        from pyarrow import fs

        store, path = _store(self.path)
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(path, recursive=True)):
                if f.is_file and not f.base_name.startswith("."):
                    store.delete_file(f.path)
        for m in messages:
            for hidden, name in m.files if m else ():
                store.move(hidden, name) if name else store.delete_file(hidden)

    def abort(self, messages):
        store = _store(self.path)[0]
        for m in messages:
            for hidden, _ in m.files if m else ():
                store.delete_file(hidden)


class OtlpFiles(DataSource):
    """Data source ``otlp``. Options: path; part_bytes, what a task reads of a file; rows, the spans of a line that is written (1000)."""

    @classmethod
    def name(cls):
        return "otlp"

    def schema(self):
        return ROW

    def reader(self, schema):
        return OtlpReader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)))

    def writer(self, schema, overwrite):
        return OtlpWriter(self.options["path"], overwrite, int(self.options.get("rows", "1000")))


class OtlpFileSource:
    """OTLP JSON files as a source of canonical spans; ranges and trace ids are pushed to the files."""

    def __init__(self, spark: SparkSession, path: str, part_bytes: int = PART_BYTES):
        spark.dataSource.register(OtlpFiles)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        self.spark, self.path, self.part_bytes = spark, path, part_bytes

    def spans(self, start_ns: int | None = None, end_ns: int | None = None, trace_id: str | None = None) -> DataFrame:
        rows = self.spark.read.format("otlp").option("part_bytes", str(self.part_bytes)).load(self.path)
        if start_ns is not None:
            rows = rows.where(F.col("start_ns") >= start_ns)
        if end_ns is not None:
            rows = rows.where(F.col("start_ns") < end_ns)
        if trace_id is not None:
            rows = rows.where(F.col("trace_id") == trace_id)
        rest = [c for c in rows.columns if c not in ("attributes", "resource")]
        return rows.select(*rest, F.try_parse_json("attributes").alias(SPAN_MAP), F.try_parse_json("resource").alias(RESOURCE_MAP))


def write_otlp(spans: DataFrame, path: str, mode: str = "append", rows: int = 1000) -> None:
    """Write canonical spans as OTLP JSON files; flat attribute columns and maps become attributes alike."""
    spans.sparkSession.dataSource.register(OtlpFiles)
    names = spans.columns
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(ROW).fields}

    def attributes(prefix: str, holder: str):
        flat = [n for n in names if n.startswith(prefix) and n != holder]
        parts = [F.to_json(F.struct(*(quoted(n).alias(n[len(prefix) :]) for n in flat)))] if flat else []
        parts += [F.to_json(quoted(holder))] if holder in names else []
        inner = F.filter(F.array(*(F.regexp_replace(p, r"^\{|\}$", "") for p in parts)), lambda p: p.isNotNull() & (p != "")) if parts else F.array(F.lit("")).cast("array<string>")
        return F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))

    made = {"attributes": attributes(SPAN_PREFIX, SPAN_MAP), "resource": attributes(RESOURCE_PREFIX, RESOURCE_MAP)}
    columns = [(made.get(n) if n in made else quoted(n).cast(k) if n in names else F.lit(None).cast(k)).alias(n) for n, k in kinds.items()]
    spans.select(*columns).write.format("otlp").option("rows", str(rows)).mode(mode).save(path)
