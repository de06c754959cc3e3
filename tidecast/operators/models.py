"""Models (MO1-MO3, MO5-MO10).  Boosted trees are MLlib's: training is distributed,
the driver only loops over folds or grid points, and every loop result is a small
table.  Linear models come from moments (``linear``).

Boosted trees stand in for the two gradient-boosting libraries (two named
presets); a linear autoregression on lookback windows takes the place of the
recurrent networks (see README, "Not built").
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.functions.expr import md5_uniform, ntz_micros, safe_div
from tidecast.operators import evaluate as ev
from tidecast.operators.linear import known, known_sql, ridge
from tidecast.operators.ordered import IDX, PLAIN, Layout, ensure_index, join_null_safe, over_series
from tidecast.operators.quantiles import exact_quantiles
from tidecast.operators.validation import overlapped, walk_forward_run

# Named presets for the two boosters (MLlib GBT parameters).
GBT_PRESETS = {
    "lgbm": dict(maxDepth=6, stepSize=0.05, maxIter=60, subsamplingRate=0.8,
                 featureSubsetStrategy="sqrt", maxBins=64, minInstancesPerNode=20),
    "xgb": dict(maxDepth=5, stepSize=0.1, maxIter=40, subsamplingRate=1.0,
                featureSubsetStrategy="all", maxBins=32, minInstancesPerNode=5),
}


def _stages(features: Sequence[str], regressor, vector: str = "features") -> list:
    """Assembler, regressor, and a last stage that leaves ``yhat`` NULL where a feature
    is unknown: such rows are never trained on, but they are kept."""
    return [VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid="keep"),
            regressor.setFeaturesCol(vector).setPredictionCol("_yhat"),
            SQLTransformer(statement=f"SELECT *, CASE WHEN {known_sql(features)} THEN _yhat END AS yhat FROM __THIS__")]


REGRESSOR = 1  # position of the fitted regressor among the stages


def gbt_forecast(train: DataFrame, features: Sequence[str], label: str, *, preset: str = "xgb",
                 validation_col: str | None = None, seed: int = 7, **params) -> PipelineModel:
    """MO1: boosted-tree regressor.  With ``validation_col`` (MO2) training
    stops when the error on the flagged rows stops improving by
    ``validationTol``.  Rows with an unknown feature get a NULL ``yhat``."""
    p = dict(GBT_PRESETS[preset])
    p.update(params)
    gbt = GBTRegressor(labelCol=label, seed=seed, **p)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    return Pipeline(stages=_stages(features, gbt)).fit(train.where(known([*features, label])))


def linear_forecast(train: DataFrame, features: Sequence[str], label: str, *, reg: float = 0.0) -> PipelineModel:
    """Least squares (ridge with ``reg``) on the features, from one aggregate."""
    return ridge(train, features, label, reg=reg)


def early_stop(train: DataFrame, features: Sequence[str], label: str, *, val_fraction: float = 0.2,
               preset: str = "xgb", max_iter: int = 200, tol: float = 0.01, ts: str = "ts") -> PipelineModel:
    """MO2: GBT whose last ``val_fraction`` of training time is the validation
    set (chronological, never random).  Without a dated row there is nothing to
    fit: ``ValueError``."""
    us = ntz_micros(F.col(ts))
    at = exact_quantiles(train, us, [1 - val_fraction]).first()
    if at is None:
        raise ValueError("no training row with a time")
    cut = int(at["value"])
    flagged = train.withColumn("_is_val", us > F.lit(cut))
    return gbt_forecast(flagged, features, label, preset=preset, validation_col="_is_val",
                        maxIter=max_iter, validationTol=tol)


def lookback_names(n: int) -> list[str]:
    return [f"lookback{k}" for k in range(1, n)]


def window_frame(df: DataFrame, n: int, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """Lookback windows scaled by the current value (scale free): ``lookback{k}`` =
    x_{t-k} / x_t for k = 1 .. n-1.  Rows without n known values, or with a zero
    value, which scales nothing, are left out."""
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [F.lag(col, k).over(w).alias(name) for k, name in enumerate(lookback_names(n), 1)], layout=layout, back=n - 1)
    d = d.where(known([col, *lookback_names(n)]) & (F.col(col) != 0))
    return d.withColumns({name: safe_div(F.col(name), F.col(col)) for name in lookback_names(n)})


def window_regression(train: DataFrame, n: int, label: str, *, reg: float = 1e-3) -> PipelineModel:
    """MO3: linear autoregression (ridge) on lookback windows of n bars (``window_frame``)."""
    return ridge(train, lookback_names(n), label, reg=reg)


def ensemble_weighted(preds: DataFrame, *, keys=("series",), eps: float = 1e-12) -> DataFrame:
    """MO5: per fold, member weights ∝ 1/RMSE over **earlier** folds only (equal
    weights when there is no history).  Input: long predictions with ``fold``;
    output: rows of model 'ensemble_w'.  A member without a prediction has no
    weight in that row; ``members`` counts those that have one.

    The error history is a small (model, key, fold) table: its cumulative
    window runs over folds, not rows, and is joined back by key.
    """
    k = list(keys)
    per = preds.groupBy("model", *k, "fold").agg(
        F.sum(F.when(F.col("y").isNotNull() & F.col("yhat").isNotNull(),
                     (F.col("y") - F.col("yhat")) ** 2)).alias("_sse"),
        F.count(F.when(F.col("y").isNotNull() & F.col("yhat").isNotNull(), 1)).alias("_n"))
    past = Window.partitionBy("model", *k).orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    hist = per.select("model", *k, "fold",
                      F.sqrt(F.sum("_sse").over(past) / F.sum("_n").over(past)).alias("_rmse"))
    inv = F.when(F.col("_rmse").isNull(), F.lit(1.0)).otherwise(
        F.lit(1.0) / F.greatest(F.col("_rmse"), F.lit(eps)))
    # folds with any member lacking history fall back to equal weights
    hist = hist.withColumn("_inv", inv).withColumn(
        "_any_new", F.max(F.col("_rmse").isNull().cast("int")).over(Window.partitionBy(*k, "fold")))
    hist = hist.withColumn("_inv", F.when(F.col("_any_new") == 1, F.lit(1.0)).otherwise(F.col("_inv")))
    j = join_null_safe(preds, hist.select("model", *k, "fold", "_inv"), ["model", *k, "fold"])
    return (j.groupBy(*k, "fold", "ts", "horizon")
            .agg(safe_div(F.sum(F.col("_inv") * F.col("yhat")), F.sum(F.when(F.col("yhat").isNotNull(), F.col("_inv")))).alias("yhat"),
                 F.first("y", ignorenulls=True).alias("y"), F.count("yhat").alias("members"))
            .withColumn("model", F.lit("ensemble_w")))


def ensemble_stack(preds: DataFrame, models: Sequence[str], *, train_folds: Sequence[int],
                   keys=("series",), reg: float = 1e-6) -> DataFrame:
    """MO6: linear meta-model (ridge) over members' out-of-fold predictions.

    Members become columns in one aggregate (the model list is given, so it needs no extra
    pass); the meta-model is fit on ``train_folds`` and applied to the rest (pass only
    earlier folds to stay leak-free).  A row that lacks a member's prediction is not fitted
    on and gets a NULL ``yhat``."""
    k = list(keys)
    wide = preds.groupBy(*k, "fold", "ts", "horizon").agg(
        *[F.first(F.when(F.col("model") == m, F.col("yhat")), ignorenulls=True).alias(m) for m in models],
        F.first("y", ignorenulls=True).alias("y"))
    fit_rows = wide.where(F.col("fold").isin(list(train_folds)))
    rest = wide.where(~F.col("fold").isin(list(train_folds)))
    return (ridge(fit_rows, models, "y", reg=reg).transform(rest).select(*k, "fold", "ts", "horizon", "y", "yhat")
            .withColumn("model", F.lit("ensemble_stack")))


def feature_importance(model: PipelineModel, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """MO7: split importance of the fitted tree ensemble, one row per feature."""
    tree = model.stages[REGRESSOR]
    imp = tree.featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda r: -r[1])
    return spark.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def _series_rank(df: DataFrame, order: Sequence[str], bucket: Column, out: str, series: str) -> DataFrame:
    """0-based rank of each row in its series by (``bucket``, ``order``): ranked inside
    (series, bucket) and offset by the counts of the buckets before, so no series is
    sorted by one task.  ``bucket`` must not decrease along ``order``."""
    d = df.withColumn("_rb", bucket)
    local = d.withColumn("_rl", F.row_number().over(Window.partitionBy(series, "_rb").orderBy(*order)) - 1)
    counts = d.groupBy(series, "_rb").agg(F.count(F.lit(1)).alias("_rn"))
    before = Window.partitionBy(series).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(series, "_rb", F.coalesce(F.sum("_rn").over(before), F.lit(0)).alias("_ro"))
    return (join_null_safe(local, offsets, [series, "_rb"])
            .withColumn(out, (F.col("_rl") + F.col("_ro")).cast("long")).drop("_rb", "_rl", "_ro"))


def permuted(df: DataFrame, cols: Sequence[str], *, seed: int = 11, series: str = "series",
             task_rows: int = 65_536) -> DataFrame:
    """Add ``_perm``, the ``cols`` of another row of the same series: rows are ranked over
    the whole series by bar index and by an md5 draw of (seed, series, index), and equal
    ranks meet in an equi-join.  Each row is drawn exactly once.  ``task_rows`` sets how
    many buckets the ranking is dealt over and changes nothing else."""
    longest = df.groupBy(series).agg(F.count(F.lit(1)).alias("n"), F.max(IDX).alias("i")).agg(F.max("n"), F.max("i")).first()
    buckets = max(1, -(-(longest[0] or 0) // task_rows))
    width = max(1, -(-((longest[1] or 0) + 1) // buckets))
    drawn = df.withColumn("_u", md5_uniform(F.lit(seed), F.coalesce(F.col(series).cast("string"), F.lit("")), F.col(IDX)))
    src = _series_rank(drawn, ["_u", IDX], F.floor(F.col("_u") * buckets).cast("long"), "_pos", series)
    src = src.select(series, "_pos", F.struct(*cols).alias("_perm"))
    dst = _series_rank(df, [IDX], F.floor(F.col(IDX) / F.lit(width)).cast("long"), "_pos", series)
    return join_null_safe(dst, src, [series, "_pos"]).drop("_pos")


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str,
                           *, seed: int = 11) -> DataFrame:
    """MO8: RMSE increase when one feature is permuted over each whole series.  All
    features share one permutation, so rows are ranked and joined once, and all swaps
    are scored in one pass: each row comes once for every feature (and once as it is)."""
    pairs = permuted(df, features, seed=seed).withColumn("_swap", F.explode(F.array(*[F.lit(j) for j in range(len(features) + 1)])))
    keep = [c for c in df.columns if c not in features]
    swapped = pairs.select(*keep, "_swap", *[F.when(F.col("_swap") == j, F.col("_perm")[f]).otherwise(F.col(f)).alias(f) for j, f in enumerate(features, 1)])
    scored = model.transform(swapped).select("_swap", F.col(label).alias("y"), "yhat")
    by = {r["_swap"]: r["rmse"] for r in scored.groupBy("_swap").agg(ev.rmse_expr().alias("rmse")).collect()}  # one row per feature
    base = by.get(0)
    rows = [(f, by.get(j), base, None if base is None or by.get(j) is None else by[j] - base) for j, f in enumerate(features, 1)]
    return df.sparkSession.createDataFrame(
        rows, "feature string, permuted_rmse double, base_rmse double, importance double")


Estimator = Callable[[DataFrame], PipelineModel]  # training rows -> fitted model that adds ``yhat``


def learning_curve(train: DataFrame, test: DataFrame, estimator: Estimator, label: str, *,
                   fractions: Sequence[float] = (0.25, 0.5, 0.75, 1.0), ts: str = "ts",
                   threads: int = 4) -> DataFrame:
    """MO9: test RMSE of ``estimator`` fitted on growing time prefixes of ``train`` and,
    if the model fitted on the largest is boosted, its error after each round.  Without a
    dated training row nothing is fitted and the errors are NULL."""
    us = ntz_micros(F.col(ts))
    by_p = {r["p"]: int(r["value"]) for r in exact_quantiles(train, us, list(fractions)).collect()}
    scored = test.withColumn("y", F.col(label))
    if not by_p:
        return train.sparkSession.createDataFrame([("prefix", float(f), None) for f in fractions], "curve string, x double, rmse double")

    def one(frac: float) -> tuple[float, PipelineModel, float | None]:
        m = estimator(train.where(us <= F.lit(by_p[float(frac)])))
        return float(frac), m, m.transform(scored).agg(ev.rmse_expr()).first()[0]

    curve = overlapped(one, fractions, threads)
    rows = [("prefix", frac, rmse) for frac, _m, rmse in curve]
    full = max(curve, key=lambda c: c[0])[1]
    fitted = full.stages[REGRESSOR] if len(full.stages) > REGRESSOR else None
    if hasattr(fitted, "evaluateEachIteration"):
        rounds = full.transform(test).where(F.col("yhat").isNotNull() & known([label])).drop("_yhat", "yhat")
        errs = fitted.evaluateEachIteration(rounds, "squared")
        rows += [("round", float(i + 1), float(e) ** 0.5) for i, e in enumerate(errs)]
    return train.sparkSession.createDataFrame(rows, "curve string, x double, rmse double")


def walk_forward_search(df: DataFrame, spec, grid: Sequence[dict],
                        fit_predict: Callable[[DataFrame, DataFrame, dict], DataFrame], *,
                        label_ts: str | None = None, threads: int = 4) -> DataFrame:
    """MO10: every grid point scored on every walk-forward fold; mean and std of
    RMSE per point, ``best`` marks the lowest mean.  ``fit_predict(train, test,
    params)`` returns rows (y, yhat) of any estimator.  Fits of folds and grid
    points overlap; only (point, fold, rmse) rows come back."""
    spark = df.sparkSession

    def score(train, test, k):
        runs = [fit_predict(train, test, p).select(F.lit(g).alias("point"), "y", "yhat") for g, p in enumerate(grid)]
        return reduce(DataFrame.unionByName, runs).groupBy("point").agg(ev.rmse_expr().alias("rmse"))

    scores = walk_forward_run(df, spec, score, label_ts=label_ts, threads=threads)
    named = [str(sorted(p.items())) for p in grid]
    results = [(r["point"], named[r["point"]], r["fold"], r["rmse"]) for r in scores.collect()]  # points x folds
    res = spark.createDataFrame(results, "point int, params string, fold int, rmse double")
    summary = res.groupBy("point", "params").agg(F.avg("rmse").alias("mean_rmse"),
                                                 F.stddev_samp("rmse").alias("std_rmse"),
                                                 F.count("rmse").alias("folds"))
    best = summary.orderBy(F.col("mean_rmse").asc_nulls_last(), "point").first()  # one row
    return summary.withColumn("best", F.col("point") == F.lit(best["point"] if best else None))
