"""Evaluation (EV1-EV7): grouped error metrics on the long predictions table.

All metrics are one hash aggregate with partial aggregation over any key set,
so a hot (model, series) group is combined map-side, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.expr import safe_div

DEFAULT_KEYS = ("model", "series")


def _err() -> Column:
    return F.col("y") - F.col("yhat")


def _pair() -> Column:
    return F.col("y").isNotNull() & F.col("yhat").isNotNull()


def rmse_expr() -> Column:
    return F.sqrt(F.avg(F.when(_pair(), _err() * _err())))


def mae_expr() -> Column:
    return F.avg(F.when(_pair(), F.abs(_err())))


def mape_expr() -> Column:
    """Mean absolute percentage error in percent; rows with y = 0 are left out."""
    return F.avg(F.when(_pair() & (F.col("y") != 0), F.abs(safe_div(_err(), F.col("y"))))) * 100


def mape_excluded_expr() -> Column:
    return F.count(F.when(_pair() & (F.col("y") == 0), 1))


def r2_expr() -> Column:
    """1 - SSE/SST inside the group; NULL when SST = 0 (constant actuals)."""
    y = F.when(_pair(), F.col("y"))
    sse = F.sum(F.when(_pair(), _err() * _err()))
    sst = F.regr_syy(y, F.when(_pair(), F.col("yhat")))
    return F.lit(1.0) - safe_div(sse, F.when(sst != 0, sst))


def rmse(preds: DataFrame, keys=DEFAULT_KEYS) -> DataFrame:
    """EV1."""
    return preds.groupBy(*keys).agg(rmse_expr().alias("rmse"))


def mae(preds: DataFrame, keys=DEFAULT_KEYS) -> DataFrame:
    """EV2."""
    return preds.groupBy(*keys).agg(mae_expr().alias("mae"))


def mape(preds: DataFrame, keys=DEFAULT_KEYS) -> DataFrame:
    """EV3: with the count of excluded y = 0 rows."""
    return preds.groupBy(*keys).agg(mape_expr().alias("mape"),
                                    mape_excluded_expr().alias("mape_excluded"))


def r2(preds: DataFrame, keys=DEFAULT_KEYS) -> DataFrame:
    """EV4."""
    return preds.groupBy(*keys).agg(r2_expr().alias("r2"))


def metrics(preds: DataFrame, keys=DEFAULT_KEYS) -> DataFrame:
    """EV1-EV4 in one aggregate, plus the pair count."""
    return preds.groupBy(*keys).agg(
        F.count(F.when(_pair(), 1)).alias("n"), rmse_expr().alias("rmse"),
        mae_expr().alias("mae"), mape_expr().alias("mape"),
        mape_excluded_expr().alias("mape_excluded"), r2_expr().alias("r2"))


def directional_accuracy(preds: DataFrame, keys=DEFAULT_KEYS, base: str = "y_base") -> DataFrame:
    """EV5: share of rows where the predicted move from ``base`` (the last known
    actual at the forecast origin) has the sign of the actual move."""
    ok = _pair() & F.col(base).isNotNull()
    hit = F.signum(F.col("yhat") - F.col(base)) == F.signum(F.col("y") - F.col(base))
    return preds.groupBy(*keys).agg(
        F.avg(F.when(ok, hit.cast("double"))).alias("directional_accuracy"),
        F.count(F.when(ok, 1)).alias("n"))


def leaderboard(metric_rows: DataFrame, k: int = 3, *, metric: str = "rmse",
                by: str = "series") -> DataFrame:
    """EV6: top-k models per ``by`` by the mean of ``metric`` over folds, with its
    sample std.  ``row_number() <= k`` is planned as a window group limit."""
    agg = metric_rows.groupBy(by, "model").agg(
        F.avg(metric).alias(f"mean_{metric}"), F.stddev_samp(metric).alias(f"std_{metric}"),
        F.count(metric).alias("folds"))
    w = Window.partitionBy(by).orderBy(F.col(f"mean_{metric}").asc_nulls_last(), F.col("model"))
    return agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def interval_coverage(preds: DataFrame, keys=DEFAULT_KEYS, lo: str = "lo",
                      hi: str = "hi") -> DataFrame:
    """EV7: share of actuals inside [lo, hi] and mean band width."""
    ok = F.col("y").isNotNull() & F.col(lo).isNotNull() & F.col(hi).isNotNull()
    inside = F.col("y").between(F.col(lo), F.col(hi))
    return preds.groupBy(*keys).agg(
        F.avg(F.when(ok, inside.cast("double"))).alias("coverage"),
        F.avg(F.when(ok, F.col(hi) - F.col(lo))).alias("mean_width"),
        F.count(F.when(ok, 1)).alias("n"))
