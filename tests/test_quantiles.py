import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.quantiles import ordered_key, quantiles

ASKED = [0.0, 0.3, 0.5, 0.99, 1.0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_quantiles_equal_percentile(spark, kind):
    rng = random.Random(1)
    draw = {
        "bigint": [lambda: rng.randrange(10), lambda: rng.randrange(-(10**18), 10**18), lambda: 7, lambda: rng.choice([-(2**63), 2**63 - 1, 0])],
        "double": [lambda: rng.gauss(0, 1), lambda: rng.uniform(-1, 1) * 10.0 ** rng.randrange(-308, 308), lambda: 0.5, lambda: rng.choice([0.0, -0.0, 5e-324, -5e-324])],
    }[kind]
    rows = [(g, str(g % 2), draw[g % 4]()) for g in range(40) for _ in range(rng.choice([1, 2, 3, 50, 300]))]
    df = spark.createDataFrame(rows, f"g long, h string, v {kind}")
    got = quantiles(df, ["g", "h"], "v", ASKED)
    assert "percentile" not in plan_of(got)
    wanted = df.groupBy("g", "h").agg(F.percentile("v", F.array(*map(F.lit, ASKED))).alias("q"))
    found = {r.g: (r.h, r.quantiles) for r in got.collect()}
    assert found == {r.g: (r.h, r.q) for r in wanted.collect()} and len(found) == 40
    whole = quantiles(df, [], "v", ASKED).first().quantiles
    assert whole == df.agg(F.percentile("v", F.array(*map(F.lit, ASKED)))).first()[0]
    assert quantiles(df.limit(0), ["g"], "v", ASKED).count() == 0


def test_keys_are_in_the_order_of_numbers(spark):
    rng = random.Random(2)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, 1.0, math.nextafter(1, 2), math.nextafter(2, 1)]
    values += [rng.uniform(1, 2) * 2.0**e for e in range(-1070, 1023, 7)] + [2.0**e for e in range(-1074, 1024)]
    values = sorted({*values, *(-v for v in values)})
    df = spark.createDataFrame([(v,) for v in [*values, math.nan]], "v double")
    keys = {r.v: r.k for r in df.select("v", ordered_key(F.col("v"), T.DoubleType()).alias("k")).collect() if r.v == r.v}
    assert [keys[v] for v in values] == sorted(keys.values()) and len(set(keys.values())) == len(values)
    nan = df.where(F.isnan("v")).select(ordered_key(F.col("v"), T.DoubleType())).first()[0]
    assert nan > max(keys.values())


def test_one_group_of_ten_million_values(spark):
    n = 10_000_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 7_919 + 3).alias("v"))
    got = quantiles(df, ["g"], "v", [0.5, 0.9]).first().quantiles
    assert got == [7_919 * 0.5 * (n - 1) + 3, pytest.approx(7_919 * 0.9 * (n - 1) + 3)]


def test_all_passes_share_one_count_of_the_rows(spark, tmp_path):
    rows = [(g, i % 7 * 1.5 if i % 11 else None) for g in (1, 2, None) for i in range(200)]
    spark.createDataFrame(rows, "g long, v double").repartition(3).write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows").select((F.col("g") * 2).alias("h"), F.col("v")).where("v is not null")
    got = quantiles(read, ["h"], "v", ASKED)
    wanted = read.groupBy("h").agg(F.percentile("v", F.array(*map(F.lit, ASKED))).alias("q"))
    assert {r.h: r.quantiles for r in got.collect()} == {r.h: r.q for r in wanted.collect()}
    final = plan_of(got).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
