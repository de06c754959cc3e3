"""Exact distributed quantiles against brute force."""

import math

import pytest
from pyspark.sql import functions as F

from tidecast.functions.expr import md5_uniform
from tidecast.operators.quantiles import exact_quantiles

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


def brute(values, p):
    v = sorted(values)
    r = max(1, math.ceil(p * len(v)))
    return v[r - 1]


@pytest.mark.parametrize("most", [5, 300, 50_000])
def test_exact_quantiles_grouped(spark, most):
    # group 'hot' holds most rows; values have many ties (rounded)
    df = spark.range(6000).select(
        F.when(F.col("id") % 11 == 4, F.lit(None)).when(F.col("id") % 5 < 3, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.round(md5_uniform(F.lit(3), F.col("id")) * 50, 0).alias("x"))
    got = {(r["g"], r["p"]): r["value"] for r in exact_quantiles(df, "x", PS, by=["g"], most=most).collect()}
    rows = df.collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["g"], []).append(r["x"])
    for g, vals in groups.items():
        for p in PS:
            assert got[(g, p)] == brute(vals, p), (g, p)


def test_exact_quantiles_global_and_constant(spark):
    df = spark.range(3000).select(F.lit(7.0).alias("x"))
    got = {r["p"]: r["value"] for r in exact_quantiles(df, "x", PS, most=20).collect()}
    assert all(got[p] == 7.0 for p in PS)
    df2 = spark.range(2001).select((F.col("id") * 3 % 2001).cast("double").alias("x"))
    got2 = {r["p"]: r["value"] for r in exact_quantiles(df2, "x", PS, most=20).collect()}
    vals = [r["x"] for r in df2.collect()]
    assert all(got2[p] == brute(vals, p) for p in PS)


def test_one_value_of_most_rows_and_wide_tails(spark):
    """Half of the rows hold one value, the rest spans 600 orders of magnitude."""
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(1.5)).otherwise(F.exp((F.col("id") - 2000) / 3.0) * F.when(F.col("id") % 3 == 0, -1).otherwise(1)).alias("x"))
    vals = [r["x"] for r in df.collect()]
    got = {r["p"]: r["value"] for r in exact_quantiles(df, "x", PS, most=10).collect()}
    assert all(got[p] == brute(vals, p) for p in PS)


def test_empty_tables_and_null_values(spark):
    df = spark.createDataFrame([("a", None), (None, 2.0), (None, 1.0)], "g string, x double")
    assert {tuple(r) for r in exact_quantiles(df, "x", [0.5], by=["g"]).collect()} == {(None, 0.5, 1.0)}
    none = exact_quantiles(df.limit(0), "x", [0.5], by=["g"])
    assert none.columns == ["g", "p", "value"] and none.collect() == []
    assert exact_quantiles(df.limit(0), "x", [0.5]).collect() == []
