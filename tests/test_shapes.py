"""Nested attributes, events and links of any shape, and ranges on any kind of time."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from spanloom.engine import TraceEngine
from spanloom.functions.variants import flattened, paths_to, text_of
from spanloom.operators import tags
from spanloom.sources.adapters import OtelSource, otel_as_spans, with_date

BASE = dt.datetime(2026, 9, 2, 12, tzinfo=dt.timezone.utc)
NS = int(BASE.timestamp()) * 10**9


def flat(value, prefix=""):
    out = {}
    for k, v in value.items():
        key = f"{prefix}.{k}" if prefix else k
        if isinstance(v, dict):
            out |= flat(v, key)
        elif v is not None:
            out[key] = v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))
    return out


def test_flattening(spark):
    values = [{"a": 1}, {"a": {"b": 1, "c": {"d": {"e": "x{y}", "f": [1, {"g": 2}]}}}, "z": None, "t": True}, {}, {"a": {}}, {"a.b": {"c": 1.5}, "é": "ü"}]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(9, "[1]"), (10, None), (11, "3")], "i long, j string")
    pairs = F.transform(flattened(F.try_parse_json("j")), lambda e: F.struct(e["key"], text_of(e["value"])))
    got = {r.i: r.p and dict(map(tuple, r.p)) for r in df.select("i", pairs.alias("p")).collect()}
    assert {i: got[i] or {} for i in range(len(values))} == {i: flat(v) for i, v in enumerate(values)}
    assert not got[9] and not got[10] and not got[11]
    assert set(paths_to("a.b.c")) == {'$["a.b.c"]', '$["a"]["b.c"]', '$["a.b"]["c"]', '$["a"]["b"]["c"]'}


def spans_of(engine, query):
    return sorted(r.span_id for r in engine.spans_of(query).collect())


def test_nested_attributes(spark):
    rows = [("1", '{"a": {"b": 1, "c": {"d": "x"}}}', '{"m": {"n": 5}}', (7, ("p",))), ("2", '{"a.b": 2}', None, (8, (None,))), ("3", '{"a": 3}', '{"m.n": "6"}', None)]
    raw = spark.createDataFrame([("t", i, BASE, j, k, s) for i, j, k, s in rows], "trace_id string, span_id string, _time timestamp, j string, k string, `attributes.http` struct<code:int,peer:struct<name:string>>")
    raw = raw.withColumn("attributes.custom", F.try_parse_json("j")).withColumn("attributes.obj", F.try_parse_json("k")).drop("j", "k")
    engine = TraceEngine(otel_as_spans(raw))
    pad = lambda *i: [x.zfill(16) for x in i]
    assert spans_of(engine, "{ span.a.b = 1 }") == pad("1") and spans_of(engine, "{ .a.b >= 1 }") == pad("1", "2")
    assert spans_of(engine, '{ span.a.c.d = "x" }') == pad("1") and spans_of(engine, "{ span.a = 3 }") == pad("3")
    assert spans_of(engine, "{ span.a.b = nil }") == pad("3")
    assert spans_of(engine, "{ span.obj.m.n >= 5 }") == pad("1", "3")
    assert spans_of(engine, "{ span.http.code > 7 }") == pad("2") and spans_of(engine, '{ span.http.peer.name = "p" }') == pad("1")
    names = {(r.scope, r.tag) for r in engine.tags().collect()}
    assert {("span", x) for x in ("a.b", "a.c.d", "a", "obj.m.n", "http.code", "http.peer.name")} <= names and ("span", "a.c") not in names
    assert "a.b" in [r.tag for r in tags.tag_names_v1(engine.spans).collect()]
    compared = {r.attribute for r in engine.metrics("{} | compare({ span.http.code = 7 })", NS, NS + 10**9, 10**9).collect()}
    assert {"span.http.code", "span.http.peer.name"} <= compared


EVENTS = [{"Name": "e", "timeUnixNano": str(NS + 5), "attributes": {"k": {"x": 1}, "s": "t"}, "extra": True, "deep": {"y": None, "z": [1, 2]}, "dropped_attributes_count": 3}, {"name": "f", "time": "2026-09-02T12:00:01.5Z"}]
LINKS = [{"traceID": "ab", "SpanId": "cd", "traceState": "s", "attributes": {"why": "retry"}}]
SHAPES = {
    "text": lambda t: F.col(t), "variant": lambda t: F.try_parse_json(t), "array of variants": lambda t: F.try_variant_get(F.try_parse_json(t), "$", "array<variant>"),
    "array of texts": lambda t: F.transform(F.try_variant_get(F.try_parse_json(t), "$", "array<variant>"), lambda v: F.to_json(v)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_events_and_links_of_any_shape(spark, shape):
    rows = [("t", "1", BASE, json.dumps(EVENTS), json.dumps(LINKS)), ("t", "2", BASE, None, "[]"), ("t", "3", BASE, "{", "[3, null]")]
    raw = spark.createDataFrame(rows, "trace_id string, span_id string, _time timestamp, e string, l string")
    made = otel_as_spans(raw.select("trace_id", "span_id", "_time", SHAPES[shape]("e").alias("events"), SHAPES[shape]("l").alias("links"))).cache()
    first = {r.span_id[-1]: r for r in made.collect()}
    e, f = first["1"].events
    assert (e.name, e.time_ns, e.attributes) == ("e", NS + 5, {"k.x": "1", "s": "t", "extra": "true", "deep.z": "[1,2]"})
    assert (f.name, f.time_ns, f.attributes) == ("f", NS + 1_500_000_000, {})
    link = first["1"].links[0]
    assert (link.trace_id, link.span_id, link.trace_state, link.attributes) == ("ab", "cd", "s", {"why": "retry"})
    assert not first["2"].events and not first["3"].events and not first["2"].links and not first["3"].links
    engine = TraceEngine(made)
    assert spans_of(engine, '{ event.k.x = 1 && event:name = "f" && event:timeSinceStart > 1s }') == ["1".zfill(16)]
    assert spans_of(engine, '{ link:traceID = "ab" && link.why = "retry" }') == ["1".zfill(16)]
    assert {("event", "k.x"), ("event", "extra"), ("link", "why")} <= {(r.scope, r.tag) for r in engine.tags().collect()}


def test_a_single_event_without_a_list(spark):
    raw = spark.createDataFrame([("t", "1", BASE, '{"name": "e", "a": 1}')], "trace_id string, span_id string, _time timestamp, events string")
    assert otel_as_spans(raw).first().events[0].attributes == {"a": "1"}


TIMES = {
    "seconds": lambda s: int(BASE.timestamp()) + s, "millis": lambda s: (int(BASE.timestamp()) + s) * 1000, "micros": lambda s: (int(BASE.timestamp()) + s) * 10**6,
    "nanos": lambda s: NS + s * 10**9, "text": lambda s: (BASE + dt.timedelta(seconds=s)).isoformat(), "local": lambda s: (BASE + dt.timedelta(seconds=s)).replace(tzinfo=None),
}


@pytest.mark.parametrize("kind", TIMES)
def test_ranges_reach_the_scan_for_any_time(spark, tmp_path, kind):
    sort = {"text": "string", "local": "timestamp_ntz"}.get(kind, "long")
    days = 86_400
    rows = [(f"{i:032x}", f"{i:016x}", TIMES[kind](i * days + 3)) for i in range(-5, 6) if i] + [(f"{9:032x}", f"{9:016x}", TIMES[kind](0))]
    rows = [(t.replace("-", "f"), s.replace("-", "f"), x) for t, s, x in rows]
    raw = with_date(spark.createDataFrame(rows, f"trace_id string, span_id string, _time {sort}"))
    raw.write.partitionBy("date").parquet(str(tmp_path / "rows"))
    back = spark.read.parquet(str(tmp_path / "rows"))
    for source in (OtelSource(back, date="date", dated_text=True), OtelSource(back.withColumn("date", F.col("date").cast("string")), date="date"), OtelSource(back.drop("date"), dated_text=True)):
        found = TraceEngine(source).spans_of("{}", NS, NS + days * 10**9)
        assert spans_of(TraceEngine(source), "{}") and len(TraceEngine(source).spans.collect()) == 11
        assert [r.span_id for r in found.collect()] == [f"{9:016x}"]
    plan = TraceEngine(OtelSource(back, date="date", dated_text=True)).spans_of("{}", NS, NS + days * 10**9)._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in partition and ">=" in partition and "_time" in plan.split("PushedFilters: [")[1].split("]")[0]
