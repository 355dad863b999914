import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.engine import Catalog, QueryError, TraceEngine, UnsupportedQuery
from spanloom.functions.regex import jvm_pattern
from spanloom.operators import tags
from spanloom.operators.tree import nested_sets
from spanloom.sources.adapters import OtelSource, duration_text_ns, otel_as_spans
from spanloom.streaming.red import red_metrics

BASE = dt.datetime(2026, 9, 2, 12, tzinfo=dt.timezone.utc)
NS = int(BASE.timestamp()) * 10**9
TRACE_A, TRACE_B = "0af7651916cd43dd8448eb211c80319c", "1af7651916cd43dd8448eb211c80319d"
A1, A2, A3, B1 = "a" * 14 + "01", "a" * 14 + "02", "a" * 14 + "03", "b" * 14 + "01"

ROWS = [
    # trace, span, parent, offset ms, duration, name, kind, service, status code, error, message, method, code, custom, pod
    (TRACE_A, A1, None, 0, "120ms", "GET /cart", "server", "frontend", "OK", False, None, "GET", 200, {"app.user.id": "u-1", "cart.items": "3"}, "frontend-abc", None),
    (TRACE_A, A2, A1, 10, "100ms", "call backend", "client", "frontend", "OK", False, None, "POST", 500, {"peer.service": "backend"}, "frontend-abc", None),
    (TRACE_A, A3, A2, 20, "80ms", "POST /checkout", "SPAN_KIND_SERVER", "backend", "STATUS_CODE_UNSET", True, "boom", "POST", 500, {"db.system.name": "postgres"}, "backend-xyz",
     [("exception", "2026-09-02T12:00:00.050Z", {"exception.message": "boom", "exception.type": "DbError"})]),
    (TRACE_B, B1, "", -60_000, "5ms", "GET /health", "2", "frontend", "OK", False, None, "GET", 200, {}, "frontend-abc", None),
    (None, None, None, 5, None, "a log line", None, None, None, None, None, None, None, None, None, None),
]
SCHEMA = (
    "trace_id string, span_id string, parent_span_id string, _time timestamp, duration string, name string, kind string, `service.name` string, "
    "`status.code` string, error boolean, `status.message` string, `attributes.http.method` string, `attributes.http.status_code` int, "
    "`attributes.custom` map<string,string>, `resource.k8s.pod.name` string, events array<struct<name:string,timestamp:string,attributes:map<string,string>>>"
)


@pytest.fixture(scope="module")
def spans(spark):
    rows = [(*r[:3], BASE + dt.timedelta(milliseconds=r[3]), *r[4:]) for r in ROWS]
    made = spark.createDataFrame(rows, SCHEMA)
    made = made.withColumn("scope.name", F.lit("http")).withColumn("resource.custom", F.create_map(F.lit("deployment.environment"), F.lit("prod")))
    return otel_as_spans(made).cache()


@pytest.fixture(scope="module")
def engine(spans):
    return TraceEngine(spans)


def ids(df):
    return sorted(r.span_id for r in df.select("span_id").collect())


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("{ status = error }", [A3]), ("{ status = ok }", [A1, A2, B1]), ("{ kind = server }", [A1, A3, B1]), ("{ kind != server }", [A2]),
        ('{ resource.service.name = "frontend" } >> { status = error }', [A3]), ("{ status = error } << { kind = server }", [A1]),
        ('({nestedSetParent<0 && true && status = error} &>> {status = error}) || ({nestedSetParent<0 && true && status = error})', []),
        ('({nestedSetParent<0 && resource.service.name = "frontend"} &>> {status = error}) || ({nestedSetParent<0 && resource.service.name = "frontend"})', [A1, A3, B1]),
        ("{nestedSetParent<0 && true && duration > 100ms}", [A1]), ('{nestedSetParent<0 && true && span.app.user.id = "u-1"}', [A1]),
        ('{ rootServiceName = "frontend" && traceDuration > 100ms }', [A1, A2, A3]), ("{ span.http.status_code = 500 }", [A2, A3]),
        ('{ span.http.status_code = "200" }', [A1, B1]), ("{ span.http.status_code >= 200.5 }", [A2, A3]), ("{ .http.method = `GET` }", [A1, B1]),
        ('{ span.cart.items > 2 }', [A1]), ("{ .deployment.environment = `prod` && name =~ `GET.*` }", [A1, B1]), ("{ name =~ `GET` }", []),
        ("{ span.missing != `x` }", []), ("{ span.missing = nil && name = `GET /health` }", [B1]), ("{ !(span.missing = 1) }", [A1, A2, A3, B1]),
        ("{ parent.name = `x` }", []), ('{ event.exception.type = "DbError" }', [A3]), ('{ event.exception.type != "Other" }', [A3]), ("{ event:timeSinceStart > 29ms }", [A3]),
        ("{ link:traceID = `x` }", []), ("{ statusMessage = `boom` }", [A3]), ("{ trace:id = `" + TRACE_B + "` }", [B1]), ("{ childCount = 1 }", [A1, A2]),
        ("{ nestedSetLeft = 2 }", [A2]), ("{ kind = server } > { kind = client }", [A2]), ("{ kind = client } < { kind = server }", [A1]), ("{} !> { }", [A1, B1]),
        ("{ kind = server } ~ { kind = server }", []), ("{ name = `GET /cart` } && { status = error }", [A1, A3]), ("{ name = `GET /health` } && { status = error }", []),
        ("{ } | count() > 2", [A1, A2, A3]), ("{ } | avg(duration) = 100ms", [A1, A2, A3]), ("{ } | by(resource.service.name) | count() > 1", [A1, A2]),
        ("{ } | by(name) | count() > 1", []), ("{ } | by(name) | coalesce() | count() > 2", [A1, A2, A3]), ("{ } | max(duration) + 1ms < 7ms", [B1]),
        ("{ instrumentation:name = `http` && span.http.status_code % 100 = 0 && -span.http.status_code < -300 }", [A2, A3]),
        ("{ resource.k8s.pod.name =~ `^frontend.*$` }", [A1, A2, B1]),
    ],
)
def test_searches(engine, query, expected):
    assert ids(engine.spans_of(query)) == sorted(expected)


def test_search_shape(engine):
    rows = engine.search("{ status = error }").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.trace_id, r.root_service_name, r.root_name, r.trace_duration_ms, r.matched, r["attr.status"]) == (TRACE_A, "frontend", "GET /cart", 120, 1, "error")
    rows = engine.search("{nestedSetParent<0 && true} | select(resource.service.name, span.http.method)").collect()
    assert {(x.span_id, x["attr.service.name"], x["attr.http.method"], x["attr.nestedSetParent"]) for x in rows} == {
        (A1, "frontend", "GET", "-1"), (B1, "frontend", "GET", "-1")
    }
    assert [x.trace_id for x in engine.search("{}", limit=1, spss=0).collect()] == [TRACE_A] * 3
    assert len(engine.search("{}", limit=1, spss=2).collect()) == 2
    inside = engine.search("{}", NS - 1, NS + 10**9).collect()
    assert {x.trace_id for x in inside} == {TRACE_A}
    assert ids(engine.search_tags({"service.name": "FRONT"}, "50ms")) == [A1, A2]


def test_metrics_and_instant(engine):
    minute = 60 * 10**9
    rows = engine.metrics("{ kind = server } | rate() by (resource.service.name)", NS - minute, NS + minute, minute).collect()
    assert {(r["resource.service.name"], r.bucket_ms * 10**6 - NS, r.value) for r in rows} == {
        ("frontend", -minute, 1 / 60), ("frontend", 0, 1 / 60), ("backend", -minute, 0.0), ("backend", 0, 1 / 60)
    }
    rows = engine.metrics("{ name = `none` } | rate()", NS, NS + minute, minute).collect()
    assert [(r.value) for r in rows] == [0.0]
    assert engine.metrics("{} | rate() by (span.missing)", NS, NS + minute, minute).count() == 0
    assert engine.metrics("{} | avg_over_time(span.missing)", NS, NS + minute, minute).count() == 0
    assert [r.value for r in engine.instant("{} | count_over_time()", NS - minute - 7, NS + 11 * 10**6 + 3).collect()] == [3.0]
    rows = engine.metrics("({ status = error } | rate()) / ({} | rate())", NS - minute, NS + minute, minute).orderBy("bucket_ms").collect()
    assert [r.value for r in rows] == [0.0, 1 / 3]
    with pytest.raises(UnsupportedQuery):
        engine.metrics("{ traceDuration > duration } | rate()", NS, NS + minute, minute)
    with pytest.raises(QueryError):
        engine.metrics("{}", NS, NS + minute, minute).count()


def test_exemplars(engine):
    minute = 60 * 10**9
    rows = engine.metrics("{} | quantile_over_time(duration, 0.5, 1)", NS, NS + minute, minute, exemplars=5).collect()
    got = {r.p: (r.value, r.ex_trace_id, r.ex_value) for r in rows}
    assert got == {"0.5": (0.1, None, None), "1": (0.12, TRACE_A, 0.12)}
    rows = engine.metrics("{} | min_over_time(duration)", NS, NS + minute, minute, exemplars=5).collect()
    assert [(r.value, r.ex_ts_ms, r.ex_value) for r in rows] == [(0.08, NS // 10**6 + 20, 0.08)]


def test_exemplars_are_thinned(spark):
    rows = [(f"{i:032x}", f"{i:016x}", None, i * 10**9 + 10**6, 5, "n") for i in range(10)]
    spans = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, start_ns long, duration_ns long, name string")
    got = TraceEngine(spans.withColumn("service_name", F.lit("s"))).metrics("{} | rate()", 0, 10 * 10**9, 10**9, exemplars=3)
    assert [r.bucket_ms for r in got.where("ex_trace_id is not null").orderBy("bucket_ms").collect()] == [0, 3000, 6000]


def test_compare(engine):
    minute = 60 * 10**9
    rows = engine.metrics("{} | compare({ status = error }, 1)", NS, NS + minute, minute).collect()
    got = {(r["__meta_type"], r.attribute, r.attribute_value): r.value for r in rows if r["__meta_error"] is None}
    assert got["selection_total", None, None] == 1 and got["baseline_total", None, None] == 2
    assert got["selection", "resource.service.name", "backend"] == 1 and got["baseline", "resource.service.name", "backend"] == 0
    assert {r.attribute for r in rows if r["__meta_error"]} >= {"name", "resource.service.name"}


def test_tags(engine):
    got = {(r.scope, r.tag) for r in engine.tags().collect()}
    assert {("span", "http.method"), ("span", "app.user.id"), ("resource", "k8s.pod.name"), ("resource", "deployment.environment"), ("event", "exception.type"), ("resource", "service.name"), ("intrinsic", "duration")} <= got
    assert "http.method" in [r.tag for r in tags.tag_names_v1(engine.spans).collect()]
    assert [(r.value, r.n) for r in engine.tag_values("resource.service.name").collect()] == [("frontend", 3), ("backend", 1)]
    assert [(r.value, r.type) for r in engine.tag_values("status", "{ kind = client }").collect()] == [("ok", "keyword")]
    assert [r.value for r in engine.tag_values("event.exception.type").collect()] == ["DbError"]
    assert engine.tag_values("event:timeSinceStart").count() == 0 and engine.tag_values("link:traceID").count() == 0
    assert len(engine.tag_values("name", "{ not a query").collect()) == 4


def test_tags_of_rare_keys(spark):
    rare = F.when(F.col("id") == 4999, "rare").otherwise("usual")
    texts = F.create_map(rare, F.lit("x"))
    items = lambda: F.array(F.struct(texts.alias("attributes")))
    made = spark.range(0, 5000, 1, 1).select(
        F.col("id").cast("string").alias("trace_id"), texts.alias("resource.custom"), items().alias("events"), items().alias("links"),
        F.try_parse_json(F.concat(F.lit('{"'), rare, F.lit('": 1}'))).alias("attributes.custom"),
    )
    found = {(r.scope, r.tag) for r in tags.tag_names(made).collect()}
    assert {(s, "rare") for s in ("span", "resource", "event", "link")} <= found
    assert ("span", "rare") not in {(r.scope, r.tag) for r in tags.tag_names(made, sampled=2000).collect()}


def test_trace_by_id(engine):
    assert ids(engine.trace(TRACE_A.lstrip("0").upper())) == [A1, A2, A3]
    with pytest.raises(QueryError):
        engine.trace("xyz")
    r = engine.trace_otlp(TRACE_A).first()
    assert len(r.resource_spans) == 2
    spans = {s.span_id: s for x in r.resource_spans for y in x.scope_spans for s in y.spans}
    assert len(spans) == 3 and spans[A3].duration_ns == 80 * 10**6 and len(spans[A3].events) == 1


def test_tree(spark):
    rows = [("t", "a", None, 1), ("t", "b", "a", 2), ("t", "c", "a", 3), ("t", "d", "b", 4), ("t", "orphan", "zz", 5), ("u", "x", "y", 1), ("u", "y", "x", 2), ("v", "r", "", 1), ("v", "q", None, 2)]
    spans = spark.createDataFrame([(*r, 10, r[1], "s") for r in rows], "trace_id string, span_id string, parent_span_id string, start_ns long, duration_ns long, name string, service_name string")
    got = {r.span_id: (r.nested_left, r.nested_right, r.nested_parent, r.child_count) for r in nested_sets(spans).collect()}
    assert got["a"] == (1, 8, -1, 2) and got["b"] == (2, 5, 1, 1) and got["d"] == (3, 4, 2, 0) and got["c"] == (6, 7, 1, 0)
    assert got["orphan"] == (0, 0, 0, 0) and got["x"][:3] == (0, 0, 0) and got["r"] == (1, 2, -1, 0) and got["q"] == (3, 4, -1, 0)
    engine = TraceEngine(spans)
    pick = lambda names: " || ".join(f'name = "{n}"' for n in names.split())
    for left, op, right, expected in [
        ("a", ">>", "b c d orphan", "b c d"), ("d", "<<", "a b c", "a b"), ("a", "!>>", "b d orphan", "orphan"), ("a", "&>>", "b d orphan", "a b d"),
        ("a", ">", "b c d", "b c"), ("d", "<", "a b", "b"), ("b", "~", "a c d b", "c"), ("r", "~", "q", "q"),
    ]:
        assert ids(engine.spans_of(f"{{ {pick(left)} }} {op} {{ {pick(right)} }}")) == sorted(expected.split()), (left, op, right)


def test_deep_chain(spark):
    n = 3000
    rows = [("t", f"{i:05d}", f"{i - 1:05d}" if i else None, i) for i in range(n)]
    spans = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, start_ns long")
    got = {r.span_id: (r.nested_left, r.nested_right) for r in nested_sets(spans).collect()}
    assert got == {f"{i:05d}": (i + 1, 2 * n - i) for i in range(n)}


def test_adapter_rows(spark, spans):
    assert spans.count() == 4
    texts = [("120ms", 120 * 10**6), ("1m2.5s", 62_500_000_000), ("-1s", -(10**9)), ("17", 17), ("x", None), ("1.5us", 1500)]
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select(duration_text_ns(F.col("t"))).collect()
    assert [r[0] for r in got] == [v for _, v in texts]


def test_streaming(spark, spans, tmp_path):
    flat = spans.select("trace_id", "span_id", "parent_span_id", "start_ns", "duration_ns", "name", "kind", "status", "service_name")
    flat.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(flat.schema).parquet(str(tmp_path / "in"))
    query = red_metrics(stream, "{ kind = server } | rate() by (resource.service.name)")
    running = query.writeStream.format("memory").queryName("red").outputMode("complete").start()
    running.processAllAvailable()
    running.stop()
    got = {(r["resource.service.name"], r.spans, r.errors) for r in spark.table("red").collect()}
    assert got == {("frontend", 1, 0), ("backend", 1, 1)}
    with pytest.raises(UnsupportedQuery):
        red_metrics(stream, "{ traceDuration > 1s } | rate()")


def test_arrays_and_variants(spark):
    rows = [("t", "1", None, 1, 10, "n", ["x", "y"], '{"a.b": 5, "s": "7"}'), ("t", "2", "1", 2, 10, "n", ["z"], None), ("t", "3", "1", 3, 10, "n", None, '{"a.b": 1}')]
    spans = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, start_ns long, duration_ns long, name string, `attributes.list` array<string>, j string")
    engine = TraceEngine(spans.withColumn("attributes.custom", F.try_parse_json("j")).drop("j").withColumn("service_name", F.lit("s")))
    assert isinstance(engine.spans.schema["attributes.custom"].dataType, T.VariantType)
    assert ids(engine.spans_of('{ span.list = "x" }')) == ["1"] and ids(engine.spans_of('{ span.list != "x" }')) == ["2"]
    assert ids(engine.spans_of("{ span.a.b > 2 }")) == ["1"] and ids(engine.spans_of("{ .s = 7 }")) == ["1"] and ids(engine.spans_of("{ .a.b != 5 }")) == ["3"]


def test_trace_conditions_see_the_whole_trace(engine):
    minute = 60 * 10**9
    count = lambda q: sum(r.value for r in engine.metrics(q + " | count_over_time()", NS - minute, NS + minute, minute).collect())
    assert count("{ status = error && traceDuration > 100ms }") == 1
    assert count("{ status = error } | { traceDuration > 100ms }") == 1
    assert count("{ traceDuration > 100ms } | { status = error }") == 1
    assert count("{ status = error } | { rootName = `POST /checkout` }") == 0


def test_instant_reads_events_at_their_time(engine):
    minute = 60 * 10**9
    query = "{ event:timeSinceStart > 29ms && event:timeSinceStart < 31ms } | count_over_time()"
    assert [r.value for r in engine.instant(query, NS - minute - 7, NS + minute).collect()] == [1.0]
    assert [r.value for r in engine.instant("{ name = `GET /cart` } | count_over_time()", NS, NS).collect()] == [1.0]


def test_spans_in_the_padding_do_not_match(engine):
    found = engine.search("{}", NS - 1, NS + 15 * 10**6, spss=0).collect()
    assert sorted(r.span_id for r in found) == [A1, A2] and {r.matched for r in found} == {2}
    assert found[0].trace_duration_ms == 120
    assert engine.search("{ status = error } << { kind = client }", NS, NS + 15 * 10**6).count() == 1
    assert engine.search("{} | count() > 2", NS, NS + 15 * 10**6).count() == 0


def test_resources_differ_by_their_map(spans):
    env = F.create_map(F.lit("zone"), F.lit("a"), F.lit("env"), F.when(F.col("span_id") == A2, "dev").otherwise("prod"))
    r = TraceEngine(spans.withColumn("resource.custom", env)).trace_otlp(TRACE_A).first()
    found = {(x.resource["service.name"], x.resource["custom_attributes"]) for x in r.resource_spans}
    assert found == {("frontend", '{"env":"prod","zone":"a"}'), ("frontend", '{"env":"dev","zone":"a"}'), ("backend", '{"env":"prod","zone":"a"}')}
    assert all(s.end_ns == s.start_ns + s.duration_ns for x in r.resource_spans for y in x.scope_spans for s in y.spans)


def test_ranges_and_ids_reach_the_scan(spark, tmp_path):
    rows = [(f"{i:032x}", f"{i:016x}", BASE + dt.timedelta(seconds=i), "1ms", "n") for i in range(20)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "trace_id string, span_id string, _time timestamp, duration string, name string").write.parquet(path)
    engine = TraceEngine(OtelSource(spark.read.parquet(path), canonical_ids=True))
    second = 10**9
    found = engine.spans_of("{ name = `n` }", NS + 5 * second, NS + 8 * second)
    assert ids(found) == [f"{i:016x}" for i in (5, 6, 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_time" in plan and "LessThanOrEqual(_time" in plan
    one = engine.trace("7")
    assert ids(one) == [f"{7:016x}"] and f"EqualTo(trace_id,{7:032x})" in one._jdf.queryExecution().executedPlan().toString()
    assert sum(r.value for r in engine.metrics("{} | count_over_time()", NS, NS + 10 * second, second).collect()) == 10


def test_partial_results_are_told(engine):
    minute = 60 * 10**9
    few = TraceEngine(engine.spans, max_series=2)
    found = few.metrics_result("{} | rate() by (name)", NS - minute, NS + minute, minute)
    assert found.partial and "2" in found.message and found.frame.select("name").distinct().count() == 2
    assert not engine.metrics_result("{} | rate() by (name)", NS - minute, NS + minute, minute).partial
    found = few.metrics_result("{} | rate() by (name)", NS - minute, NS + minute, minute)
    tracker = engine.spans.sparkSession.sparkContext.statusTracker()
    rows, jobs = found.rows(), set(tracker.getJobIdsForGroup(None))
    assert found.partial and found.message == "more than 2 series" and set(tracker.getJobIdsForGroup(None)) == jobs  # no more jobs
    assert {r.name for r in rows} == {"GET /cart", "GET /health"} and len(rows) == 4
    found = TraceEngine(engine.spans, max_series=4).metrics_result("{ name = `none` } | rate() by (name)", NS, NS + minute, minute)
    assert not found.partial and found.rows() == []
    few = TraceEngine(engine.spans, max_attributes=2)
    rows = few.metrics("{} | compare({ status = error })", NS, NS + minute, minute).collect()
    assert {r.attribute for r in rows} == {None, "resource.service.name", "name"}


def test_catalog_of_datasets(spans):
    data = Catalog({"a": lambda: spans, "b": lambda: spans.limit(0), "c": lambda: spans}, default="a", allowed=["a", "b"])
    assert data.names() == ["a", "b"] and data.engine().spans.count() == 4 and data.engine("b").spans.count() == 0
    with pytest.raises(QueryError):
        data.engine("c")


def test_services_and_prefilter(engine):
    r = engine.search("{ status = error }", services=True).first()
    assert [(s.service, s.span_count, s.error_count) for s in r.service_stats] == [("backend", 1, 1), ("frontend", 2, 0)]
    fast = TraceEngine(engine.spans, prefilter=True)
    for query in ("{ kind = server } >> { status = error }", "{} !> { }", "{ name = `GET /cart` } && { status = error }", "{ kind = client } &> { }",
                  "{ status = error } || { name = `GET /health` }", "{ rootName = `GET /cart` }", "({ status = error } | count() > 0) && { kind = client }"):
        assert ids(fast.spans_of(query)) == ids(engine.spans_of(query)), query


def test_tag_ranges_and_limits(engine):
    assert [r.value for r in engine.tag_values("name", start_ns=NS, end_ns=NS + 10**9).orderBy("value").collect()] == ["GET /cart", "POST /checkout", "call backend"]
    assert engine.tag_values("name", limit=None).count() == 4
    assert engine.tag_values("name", "{} | rate()").count() == 4
    first = [(r.scope, r.tag) for r in engine.tags(limit=2).collect()]
    assert first == [("resource", "deployment.environment"), ("resource", "k8s.pod.name")]


@pytest.mark.parametrize(("text", "value", "expected"), [
    ("(?P<x>r).*", "rst", True), ("(?<x>r)+", "rr", True), ("[[:alpha:]]+", "ab", True), ("[[:^alpha:]]+", "12", True), ("[]a]+", "]a", True),
    ("[^]]", "]", False), ("[a&&b]+", "&a", True), ("[[]x", "[x", True), ("\\Qa.b\\E", "a.b", True), ("\\Qa.b\\E", "axb", False), ("a\\(b", "a(b", True), ("(?i)AB", "ab", True),
])
def test_patterns(spark, text, value, expected):
    assert spark.range(1).select(F.lit(value).rlike(f"^(?:{jvm_pattern(text)})\\z")).first()[0] is expected


@pytest.mark.parametrize("text", ["(?=a)", "(?<!a)b", "(a)\\1", "(a", "a)", "[a", "a\\"])
def test_patterns_that_re2_refuses(text):
    with pytest.raises(QueryError):
        jvm_pattern(text)
