"""The panel's cost per row: few orders of its rows, no frame aggregates where lags do."""

import math

import __spark_entry__ as entry
import pytest
from conftest import SF001
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout
from tidecast.plans.common import finish, half_away


@pytest.mark.parametrize("name, sorts", [("features_panel", 4), ("features_panel_halo", 24)])
def test_panel_orders_its_rows_few_times(spark, name, sorts):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("- Sort [") + plan.count(") Sort [") <= sorts and "regr_" not in plan


def test_known_length_changes_no_value(spark):
    rows = [(s, k, None if (k * s) % 7 == 3 else float((k * 37 * s) % 101)) for s in (1, 2, 3) for k in range(120)]
    df = spark.createDataFrame(rows, "series int, ts int, close double").withColumn("i", F.col("ts").cast("long"))

    def all_of(lay):
        return sorted(map(tuple, ti.rsi(ti.macd(ti.ema(df, 20, layout=lay), layout=lay), 14, layout=lay).collect()))

    assert all_of(Layout(distinct=True, longest=120)) == all_of(Layout())


def test_trend_equals_regression(spark):
    rows = [("a", k, float((k * 7919) % 1000) / 100) for k in range(40)] + [("b", k, 4.1) for k in range(40)]
    rows += [("c", k, None if k == 20 else k * 0.5) for k in range(40)] + [("d", 0, 1.0)]
    df = spark.createDataFrame(rows, "series string, i long, close double")
    for n in (1, 2, 5, 20):
        f = Window.partitionBy("series").orderBy("i").rowsBetween(1 - n, 0)
        full = F.count("close").over(f) == n
        want = df.select("series", "i", *[F.when(full, fn("close", F.col("i").cast("double")).over(f)).alias(name) for name, fn in (("s", F.regr_slope), ("r", F.regr_r2))])
        plain = fe.rolling_trend(df, "close", n)
        reused = fe.rolling_trend(fe.rolling(df, "close", n, ["std"]), "close", n)
        for got in (plain, reused):
            for r in want.join(got, ["series", "i"]).collect():
                for a, b in ((r.s, r[f"close_slope{n}"]), (r.r, r[f"close_r2_{n}"])):
                    assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), (n, r)


def test_rounding_is_that_of_round(spark):
    xs = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5, 9007199254740993.0, 1e300, -0.2, 0.0, 7.25, -1234.5,
          float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", half_away(F.col("x")).alias("a"), F.round("x", 0).alias("b")).collect():
        assert r.a == r.b or (r.a != r.a and r.b != r.b), r
    many = finish(df.select(*[F.col("x").alias(f"x{k}") for k in range(10)]), digits=1, by={"x1": 3})
    few = finish(df.select(F.col("x").alias("x0"), F.col("x").alias("x1")), digits=1, by={"x1": 3})
    assert many.columns == [f"x{k}" for k in range(10)]
    assert sorted(map(str, many.select("x0", "x1").collect())) == sorted(map(str, few.collect()))
