"""OTLP files, datasets of a session, streams of traces."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom.engine import Catalog, TraceEngine, UnsupportedQuery
from spanloom.operators.rollup import trace_rollup
from spanloom.plans.catalogue import events_as_export, events_as_spans
from spanloom.sources.otlp_files import OtlpFileSource, write_otlp
from spanloom.streaming.traces import closed_traces, matching_traces


def pushed(df):
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return plan.split("PushedFilters: [")[1].split("]")[0]


def rows_of(df):
    shown = [F.to_json(f"`{c}`").alias(c) if c.endswith(".custom") else F.col(c) for c in df.columns]
    return sorted(map(str, df.select(*sorted(shown, key=str)).collect()))


def test_otlp_files_hold_what_was_written(spark, sf_dir, tmp_path):
    custom = F.parse_json(F.to_json(F.struct(F.lit("x").alias("zone"), F.struct(F.lit(1).alias("b")).alias("a"), F.array(F.lit(1.5), F.lit(2.0)).alias("l"), F.lit(True).alias("t"))))
    spans = events_as_spans(spark, sf_dir).withColumn("resource.custom", custom).withColumn("scope_name", F.lit("lib"))
    spans = spans.withColumn("links", F.when(F.col("kind") == "server", F.array(F.struct(F.lit("a" * 32).alias("trace_id"), F.lit("b" * 16).alias("span_id"), F.lit("s").alias("trace_state"), F.create_map(F.lit("k"), F.lit("v")).alias("attributes")))))
    path = str(tmp_path / "otlp")
    write_otlp(spans.repartition(3), path, rows=37)
    engine = TraceEngine(OtlpFileSource(spark, path, part_bytes=50_000))
    back = engine.spans
    assert back.rdd.getNumPartitions() > 3
    same = [c for c in spans.columns if c in back.columns]
    assert rows_of(back.select(*[f"`{c}`" for c in same])) == rows_of(spans.select(*[f"`{c}`" for c in same]))
    first, last = spans.agg(F.min("start_ns"), F.max("start_ns")).first()
    middle = (first + last) // 2
    found = engine.spans_of("{ status = error }", middle, last)
    assert "GreaterThanOrEqual(start_ns" in pushed(found) and "LessThan(start_ns" in pushed(found)
    assert found.count() == spans.where((F.col("start_ns") >= middle) & (F.col("start_ns") < last) & (F.col("status") == "error")).count() > 0
    wanted = spans.first().trace_id
    one = engine.trace(wanted)
    assert one.count() == spans.where(F.col("trace_id") == wanted).count() and "EqualTo(trace_id" in pushed(one)
    assert engine.spans_of("{ resource.a.b = 1 && resource.t = true && link.k = `v` }").count() == spans.where("kind = 'server'").count()
    write_otlp(spans.limit(5), path, mode="overwrite")
    assert TraceEngine(OtlpFileSource(spark, path)).spans.count() == 5
    empty = str(tmp_path / "none")
    write_otlp(spans.limit(0), empty)
    assert TraceEngine(OtlpFileSource(spark, empty)).spans.count() == 0


def test_requests_of_other_exporters(spark, tmp_path):
    value = lambda **v: v
    request = {"resourceSpans": [{"resource": {"attributes": [{"key": "service.name", "value": value(stringValue="cart")}, {"key": "n", "value": value(intValue="7")}]}, "scopeSpans": [
        {"scope": {"name": "s", "version": "1"}, "spans": [
            {"traceId": "ABC", "spanId": "1", "name": "x", "kind": "SPAN_KIND_CLIENT", "startTimeUnixNano": "5", "endTimeUnixNano": 9, "status": {"code": "STATUS_CODE_ERROR", "message": "m"},
             "attributes": [{"key": "l", "value": value(arrayValue={"values": [value(boolValue=True), value(doubleValue=0.5)]})}, {"key": "o", "value": value(kvlistValue={"values": [{"key": "p", "value": value(bytesValue="AQI=")}]})}, {"key": "none"}],
             "events": [{"name": "e", "timeUnixNano": "6", "attributes": [{"key": "i", "value": value(intValue=3)}]}]},
            {"spanId": "2", "name": "without a trace"}]}, {"spans": [{"traceId": "abc", "spanId": "3", "parentSpanId": "1", "kind": 2}]}]}]}
    (tmp_path / "a.json").write_text("\n" + json.dumps(request) + "\n\n" + json.dumps({}) + "\n")
    engine = TraceEngine(OtlpFileSource(spark, str(tmp_path)))
    x, y = sorted(engine.spans.collect(), key=lambda r: r.span_id)
    assert (x.trace_id, x.span_id, x.parent_span_id, x.start_ns, x.duration_ns, x.kind, x.status, x.status_message, x.service_name) == ("abc".zfill(32), "1".zfill(16), None, 5, 4, "client", "error", "m", "cart")
    assert (x.events[0].name, x.events[0].time_ns, x.events[0].attributes) == ("e", 6, {"i": "3"}) and (y.kind, y.parent_span_id, y.scope_name) == ("server", "1".zfill(16), None)
    assert [r.span_id for r in engine.spans_of("{ span.o.p = `0102` && resource.n = 7 }").collect()] == ["1".zfill(16)]
    assert [r.span_id for r in engine.spans_of("{} > {}").collect()] == ["3".zfill(16)]


def test_datasets_of_a_session(spark, sf_dir):
    events_as_export(spark, sf_dir).createOrReplaceTempView("exported")
    spark.range(3).createOrReplaceTempView("numbers")
    data = Catalog.of_tables(spark, default="exported")
    assert data.names() == ["exported"] and data.datasets() == [("exported", "traces", ["attributes.custom"])]
    fields = dict(data.engine().fields())
    assert fields["duration_ns"] == "int" and fields["attributes.flag"] == "string" and fields["events"] == "array" and fields["attributes.custom"] == "map"
    assert data.engine().spans_of("{ span.flag }").count() > 0
    spark.catalog.dropTempView("exported")


def test_budget_keeps_whole_traces(spark):
    def made(n, each):
        rows = [(f"{t:032x}", f"{t}-{i}", None, t * 1000 + i, 5, f"n{i}", "s", "unset") for t in range(n) for i in range(each)]
        return spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, start_ns long, duration_ns long, name string, service_name string, status string")

    found = TraceEngine(made(4, 2), max_spans=5).search_result("{}", spss=0)
    rows = found.frame.collect()
    assert {int(r.trace_id, 16) for r in rows} == {3, 2} and all(r.matched == 2 for r in rows) and len(rows) == 4
    assert found.dropped_traces == 2 and found.partial
    found = TraceEngine(made(6, 2), max_spans=8).search_result("{}", spss=0)
    assert {int(r.trace_id, 16) for r in found.frame.collect()} == {5, 4, 3, 2} and found.dropped_traces == 2
    found = TraceEngine(made(6, 2), max_spans=12).search_result("{ name = `n1` }")
    assert len(found.frame.collect()) == 6 and found.dropped_traces == 0 and not found.partial
    assert TraceEngine(made(3, 2), max_spans=1).search_result("{} >> {}").dropped_traces == 3
    assert TraceEngine(made(3, 2)).search_result("{}").dropped_traces == 0
    assert TraceEngine(made(2, 2).limit(0), max_spans=3).search_result("{}").dropped_traces == 0


ROWS = "trace_id string, span_id string, parent_span_id string, start_ns long, duration_ns long, name string, service_name string, status string"


def test_traces_of_a_stream(spark, tmp_path):
    s = 10**9
    batches = [
        [("a", "3", "1", 12 * s, s, "late child", "x", "error"), ("b", "1", None, 11 * s, s, "b root", "y", "ok")],
        [("a", "1", None, 10 * s, 5 * s, "a root", "x", "ok"), ("a", "2", "1", 11 * s, 9 * s, "child", "z", "ok")],
        [("c", "1", None, 200 * s, s, "c root", "x", "ok")],  # moves the watermark, which closes a and b in the next batch
        [("c", "2", "1", 201 * s, s, "c child", "x", "ok")],
        [("a", "9", "1", 13 * s, 99 * s, "too late", "x", "error"), ("d", "1", None, 400 * s, s, "d root", "x", "ok")],
        [("e", "1", None, 900 * s, s, "e root", "x", "ok")],
    ]
    source = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(source))
    stream = lambda: spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(source))

    def run(df, name):
        running = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).start()
        running.processAllAvailable()
        running.stop()
        return {tuple(r) for r in spark.table(name).collect()}

    got = run(closed_traces(stream(), "30 seconds", "20 seconds"), "closed")
    kept = [r for rows in batches for r in rows if r[1] != "9" and r[0] != "e"]
    want = {(r.trace_id, r.trace_start_ns, r.trace_duration_ns, r.root_name, r.root_service_name) for r in trace_rollup(spark.createDataFrame(kept, ROWS)).collect()}
    assert {r[:5] for r in got} == want and {(r[0], r[5], r[6]) for r in got} == {("a", 3, 1), ("b", 1, 0), ("c", 2, 0), ("d", 1, 0)}
    assert {r[0] for r in run(matching_traces(stream(), "{ traceDuration > 2s && rootName = `a root` }", "30 seconds", "20 seconds"), "matching")} == {"a"}
    with pytest.raises(UnsupportedQuery):
        matching_traces(stream(), "{ status = error }")
