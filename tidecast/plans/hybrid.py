"""The hybrid workflow: indicator features -> members (boosted trees,
lookback ridge, last value) fit per walk-forward fold -> inverse-RMSE ensemble from
earlier folds, and a linear stack fitted on the first half of the folds for the rest ->
metrics and ranks of all models on the folds that all of them predict -> scenarios of
each series from its best model's errors.  Everything is in next-bar return space, so
members and ensembles are comparable across series of any price level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.operators import evaluate as ev
from tidecast.operators import models as mo
from tidecast.operators import scenarios as sc
from tidecast.operators import validation as va
from tidecast.operators.linear import walk_forward_linear
from tidecast.operators.ordered import join_null_safe
from tidecast.plans.catalog import query
from tidecast.plans.common import finish
from tidecast.plans.modelling import FEATURES, LABEL, WF_MODELS, model_rows
from tidecast.session import cut_lineage

LOOKBACK = 10
MEMBERS = ["gbt_xgb", "window_linear", "naive_last"]


def hybrid_predictions(spark: SparkSession, sf_dir: str, spec: va.WalkForward = WF_MODELS) -> tuple[DataFrame, int]:
    """Out-of-fold predictions of members and ensembles, and the first fold that all of them predict."""
    base, layout = model_rows(spark, sf_dir)
    table = cut_lineage(mo.window_frame(base, LOOKBACK, layout=layout))
    scored = mo.known(FEATURES)  # every member predicts the same rows
    keys = ["series", "ts", F.col(LABEL).alias("y")]

    def fit_predict(train, test, k):
        return mo.gbt_forecast(train, FEATURES, LABEL).transform(test).select(F.lit("gbt_xgb").alias("model"), *keys, "yhat")

    trees = va.walk_forward_run(table, spec, fit_predict, label_ts="label_ts")
    lin = walk_forward_linear(table, spec, [(mo.lookback_names(LOOKBACK), 1e-3)], LABEL, label_ts="label_ts")
    lin = lin.select(F.lit("window_linear").alias("model"), *keys, F.when(scored, F.col("yhat")).alias("yhat"), "fold")
    last = va.fold_ranges(table, spec).where("test_fold IS NOT NULL").select(
        F.lit("naive_last").alias("model"), *keys, F.when(scored, F.lit(0.0)).alias("yhat"), F.col("test_fold").alias("fold"))
    preds = trees.unionByName(lin).unionByName(last).withColumn("horizon", F.lit(1))
    preds = cut_lineage(preds)  # fits happen once; ensembles and metrics reuse them
    cols = ["model", "fold", "series", "ts", "horizon", "y", "yhat"]
    split = (preds.agg(F.max("fold")).first()[0] or 0) // 2 + 1
    stack = mo.ensemble_stack(preds, MEMBERS, train_folds=range(split))  # the stack learns from the first half of the folds
    return preds.select(cols).unionByName(mo.ensemble_weighted(preds).select(cols)).unionByName(stack.select(cols)), split


@query("hybrid_walk_forward_ensemble")
def q_hybrid(spark, sf_dir):
    """Members, their weighted ensemble and their stack scored per (model, series) over the
    out-of-fold predictions of the folds that all of them predict, with each model's rank per series."""
    preds, first = hybrid_predictions(spark, sf_dir)
    common = preds.where(F.col("fold") >= first)
    board = ev.leaderboard(ev.rmse(common, ["model", "series", "fold"]), 5).select("series", "model", "rank")
    return finish(join_null_safe(ev.metrics(common, ["model", "series"]), board, ["series", "model"], "left"))


@query("hybrid_scenarios")
def q_hybrid_scenarios(spark, sf_dir):
    """Scenario stage: per series, its best model's last forecast plus bootstrapped errors of
    that model on the common folds, as a fan of cumulative returns over the next 20 bars and
    the probability of being 10 % up."""
    preds, first = hybrid_predictions(spark, sf_dir)
    common = cut_lineage(preds.where(F.col("fold") >= first))
    best = ev.leaderboard(ev.rmse(common, ["model", "series", "fold"]), 1).select("series", "model")
    of_best = join_null_safe(common, best, ["series", "model"]).where(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    w = Window.partitionBy("series").orderBy("ts")
    errors = of_best.select("series", (F.row_number().over(w) - 1).cast("long").alias("k"), (F.col("y") - F.col("yhat")).alias("r"))
    last = of_best.groupBy("series").agg(F.max_by("yhat", "ts").alias("forecast"), F.max_by("model", "ts").alias("model"))
    paths = join_null_safe(sc.scenario_paths(errors, paths=1000, horizon=20), last, ["series"])
    paths = paths.withColumn("cum_return", F.col("cum_return") + F.col("forecast"))
    fan = join_null_safe(sc.fan(paths), sc.threshold_probability(paths, 0.1).drop("paths"), ["series", "step"])
    return finish(join_null_safe(fan, last.select("series", "model"), ["series"]))
