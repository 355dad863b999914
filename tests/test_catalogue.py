import os

import duckdb
import pytest
from pyspark.sql import functions as F

from spanloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    rows = [tuple(r) for r in found.select(*[f"`{c}`" for c in columns]).collect()]
    names = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(rows, key=key) == sorted(expected, key=key)


def test_orders_metrics_leave_no_row_out(spark, sf_dir):
    spans = catalogue.orders_as_spans(spark, sf_dir)
    lo, hi = catalogue.whole(spans)
    assert spans.where((F.col("start_ns") < lo) | (F.col("start_ns") >= hi)).isEmpty()
    counted = sum(round(r.value * catalogue.O_STEP / 1e9) for r in QUERIES["o_rate_all"](spark, sf_dir).collect())
    assert counted == spans.where("status = 'ok'").count()
    buckets = {r.bucket_ms * 10**6 for r in QUERIES["o_quantile_all"](spark, sf_dir).collect()}
    wanted = spans.where("`attributes.quantity` > 10").select("start_ns").collect()
    assert buckets == {r.start_ns // catalogue.O_STEP * catalogue.O_STEP for r in wanted}
    assert catalogue.whole(spans.limit(0)) == (0, 1)


def test_instant_leaves_no_event_out(spark, sf_dir):
    counted = sum(r.value for r in QUERIES["m_instant_all"](spark, sf_dir).collect())
    assert counted == spark.read.parquet(f"{sf_dir}/events.parquet").count()
