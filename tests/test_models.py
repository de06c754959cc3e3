"""Model sanity on generated AR(1) data (the fixture prices are white noise,
so accuracy is never asserted on them)."""

import datetime as dt

from pyspark.sql import functions as F

from tidecast.functions.expr import md5_uniform
from tidecast.operators import evaluate as ev
from tidecast.operators import features as fe
from tidecast.operators import models as mo
from tidecast.operators import validation as va
from tidecast.operators.naive import naive_forecast
from tidecast.operators.ordered import Layout, linear_scan

PHI = 0.6


def ar1_bars(spark, n=1500, series=("a", "b")):
    """x_t = PHI x_{t-1} + e_t with e ~ N(0, 1) from md5 draws (Box-Muller),
    generated by the engine's own scan: alpha = 1 - PHI, input e / alpha."""
    base = dt.datetime(2020, 1, 1)
    rows = spark.range(n * len(series)).select(
            F.element_at(F.array(*[F.lit(s) for s in series]), (F.col("id") % len(series) + 1).cast("int")).alias("series"),
            (F.col("id") / len(series)).cast("long").alias("i"))
    u1 = md5_uniform(F.lit(1), F.col("series"), F.col("i"))
    u2 = md5_uniform(F.lit(2), F.col("series"), F.col("i"))
    e = F.sqrt(-2 * F.log(F.greatest(u1, F.lit(1e-12)))) * F.cos(2 * 3.141592653589793 * u2)
    d = rows.withColumn("x", e / F.lit(1 - PHI))
    d = linear_scan(d, "x", 1 - PHI, "ar", layout=Layout())
    close = F.lit(100.0) + F.col("ar")
    return d.select("series", "i", (F.lit(base) + F.make_interval(days=F.col("i").cast("int"))).cast("timestamp_ntz").alias("ts"),
                    close.alias("open"), close.alias("high"), close.alias("low"), close.alias("close"),
                    F.lit(1.0).alias("volume"))


def test_models_beat_naive_on_ar1(spark):
    bars = ar1_bars(spark).cache()
    d = fe.lags(bars, "close", [1, 2, 3], layout=Layout())
    d = fe.target(d, 1, "price", layout=Layout())
    d = mo.window_frame(d, 5)
    s = va.chrono_split(d, 0.7, 0.0)
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    label = "target_price_1"
    gbt = mo.gbt_forecast(train, ["close", "close_lag1", "close_lag2", "close_lag3"], label, maxIter=20)
    p_gbt = gbt.transform(test).select(F.lit("gbt").alias("model"), "series", F.col(label).alias("y"), "yhat")
    p_naive = test.select(F.lit("naive").alias("model"), "series", F.col(label).alias("y"), F.col("close").alias("yhat"))
    # linear AR on levels: lookback scaled by the last close, label as a ratio
    lin = mo.window_regression(train.withColumn("ratio", F.col(label) / F.col("close")), 5, "ratio")
    p_lin = lin.transform(test).select(F.lit("linear").alias("model"), "series", F.col(label).alias("y"),
                                       (F.col("yhat") * F.col("close")).alias("yhat"))
    scores = {r["model"]: r["rmse"] for r in ev.rmse(p_gbt.unionByName(p_naive).unionByName(p_lin), ["model"]).collect()}
    bars.unpersist()
    assert scores["gbt"] < scores["naive"] * 0.97, scores
    assert scores["linear"] < scores["naive"] * 0.95, scores


def test_weighted_ensemble_no_worse_than_worst_member(spark):
    bars = ar1_bars(spark, n=800).cache()
    p = naive_forecast(bars, ["last", "ma", "drift"], n=5).withColumn(
        "fold", F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2020-01-01").cast("date")) / 100).cast("int"))
    ens = mo.ensemble_weighted(p)
    allp = p.select("model", "series", "fold", "ts", "y", "yhat").unionByName(ens.select("model", "series", "fold", "ts", "y", "yhat"))
    scores = {r["model"]: r["rmse"] for r in ev.rmse(allp, ["model"]).collect()}
    bars.unpersist()
    worst = max(v for k, v in scores.items() if k != "ensemble_w")
    assert scores["ensemble_w"] <= worst, scores
