"""Causality and leakage properties."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators import validation as va
from tidecast.operators.ordered import Layout, bar_index
from tidecast.sources.tables import FIXTURES


def causal_features(bars):
    lay = Layout()
    d = bar_index(bars, lay)
    d = fe.rolling(d, "close", 10, layout=lay)
    d = ti.ema(d, 12, layout=lay)
    d = ti.rsi(d, 14, layout=lay)
    d = ti.obv(d, layout=lay)
    d = fe.zscore(d, "close", 10, layout=lay)
    return d.drop("open", "high", "low", "close", "volume")


def test_features_do_not_read_the_future(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day").cache()
    cut = bars.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.6)).first()[0]
    before = F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(cut)
    # perturb every row after the cut
    changed = bars.withColumn("close", F.when(before, F.col("close")).otherwise(F.col("close") * 3 + 7)) \
                  .withColumn("volume", F.when(before, F.col("volume")).otherwise(F.col("volume") + 99))
    a = {(r["series"], r["ts"]): r for r in causal_features(bars).where(before).collect()}
    b = {(r["series"], r["ts"]): r for r in causal_features(changed).where(before).collect()}
    bars.unpersist()
    assert a == b and len(a) > 0


def test_walk_forward_has_no_leakage(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    spec = va.WalkForward(initial=100, test=30, gap=2)
    f = va.walk_forward(bars, spec)
    stats = f.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("t"))).alias("tr"),
                                  F.min(F.when(F.col("role") == "test", F.col("t"))).alias("te"),
                                  F.max(F.when(F.col("role") == "train", F.col("ts"))).alias("tr_ts"),
                                  F.min(F.when(F.col("role") == "test", F.col("ts"))).alias("te_ts")).collect()
    assert stats
    for r in stats:
        assert r["tr"] + spec.gap < r["te"]
        assert r["tr_ts"] < r["te_ts"]


def test_sliding_walk_forward_window(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    spec = va.WalkForward(initial=50, test=20, gap=1, mode="sliding")
    f = va.walk_forward(bars, spec)
    for r in f.where("role = 'train'").groupBy("fold").agg(F.countDistinct("t").alias("n")).collect():
        assert r["n"] == 50


def test_scaler_ignores_test_rows(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    end = "1998-01-01 00:00:00"
    changed = bars.withColumn("close", F.when(F.col("ts") < F.lit(end).cast("timestamp_ntz"), F.col("close"))
                              .otherwise(F.col("close") * 100))
    a = {(r["series"], r["ts"]): r["close_scaled"] for r in fe.scaler(bars, ["close"], end).where(
        F.col("ts") < F.lit(end).cast("timestamp_ntz")).collect()}
    b = {(r["series"], r["ts"]): r["close_scaled"] for r in fe.scaler(changed, ["close"], end).where(
        F.col("ts") < F.lit(end).cast("timestamp_ntz")).collect()}
    assert a == b


def test_chrono_split_is_ordered(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    s = va.chrono_split(bars, 0.6, 0.2)
    r = s.groupBy("split").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    by = {x["split"]: x for x in r}
    assert by["train"]["hi"] < by["val"]["lo"] <= by["val"]["hi"] < by["test"]["lo"]
    assert dt.datetime(1990, 1, 1) < by["train"]["lo"]
