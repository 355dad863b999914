"""Divisions by zero: m_math_join keeps them as its SQL does, the engine leaves them out unless it is asked to."""

import datetime as dt
import math

import duckdb
from pyspark.sql import functions as F

from spanloom.engine import TraceEngine
from spanloom.operators.metrics import _compute
from spanloom.plans import catalogue

DAY0 = dt.datetime(2024, 1, 2)
EVENTS = [  # name, day, value: a zero minimum, two zeros, no zero
    ("click", 0, 0.0), ("click", 0, 5.0), ("view", 0, 0.0), ("view", 1, 2.0), ("view", 1, 8.0), ("error", 2, 0.0), ("error", 2, 0.004),
]


def _tables(spark, tmp_path):
    rows = [(i, DAY0 + dt.timedelta(days=d, seconds=i), i, n, v, '{"k": 1}') for i, (n, d, v) in enumerate(EVENTS)]
    made = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    made.write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_math_join_equals_its_sql_where_a_minimum_is_zero(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    got = sorted(map(str, catalogue.queries()["m_math_join"](spark, sf_dir).select("name", "bucket_ms", "value").collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet/*.parquet'")
    sql = catalogue.oracle_sql()["m_math_join"]
    want = con.sql(f"SELECT name, bucket_ms, value FROM ({sql})").fetchall()
    assert got == sorted(f"Row(name={n!r}, bucket_ms={b}, value={v})" for n, b, v in want)
    assert sum(math.isinf(v) for *_, v in want) == 1 and sum(math.isnan(v) for *_, v in want) == 2


def test_engine_leaves_divisions_by_zero_out_unless_asked(spark, tmp_path):
    spans = catalogue.events_as_spans(spark, _tables(spark, tmp_path))
    queries = ["({} | max_over_time(duration) by (name)) / ({} | min_over_time(duration) by (name))", "({} | rate()) / ({ kind = client } | rate())"]
    for query, few, all_rows in zip(queries, (1, 1), (4, 30), strict=True):
        for infinite, n in ((False, few), (True, all_rows)):
            got = TraceEngine(spans, infinite=infinite).metrics(query, catalogue.START, catalogue.END, catalogue.DAY).collect()
            assert len(got) == n and all(math.isfinite(r.value) for r in got) != infinite


def test_division_by_zero_has_the_signs_of_both(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (1.0, -0.0), (0.0, 0.0), (3.0, 2.0), (None, 0.0)], "x double, y double")
    inf = math.inf
    for infinite, want in ((True, [inf, -inf, -inf, math.nan, 1.5, None]), (False, [None, None, None, None, 1.5, None])):
        got = [r[0] for r in df.select(_compute("/", F.col("x"), F.col("y"), infinite)).collect()]
        assert str(got) == str(want)
