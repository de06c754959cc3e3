"""Flagship: order ticks -> daily bars -> log return, SMA(20) -> benchmark
forecasts -> RMSE / MAE / MAPE / R² per (model, series).

Source, aggregate, window, prediction and metrics in one plan: the bars
aggregate shuffles on (series, day), every window shares one (series)
partitioning, and the metrics are a partial hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import bars as tb
from tidecast.operators import evaluate as ev
from tidecast.operators import indicators as ti
from tidecast.operators.features import frame
from tidecast.operators.ordered import over_series
from tidecast.plans.catalog import query
from tidecast.plans.common import finish, indexed_bars, rsql, with_bars

SMA_N = 20


def flagship_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-bar-ahead forecasts: last value, SMA(20), and last value grown by the
    mean log return of the last 20 bars."""
    d, lay = indexed_bars(spark, sf_dir, "orders", "day")
    d = tb.returns(d, "log", 1, out="lr", layout=lay)
    d = ti.sma(d, SMA_N, layout=lay)

    def build(w):
        f = frame(w, SMA_N)
        mlr = F.when(F.count("lr").over(f) >= SMA_N, F.avg("lr").over(f))
        return [F.lead("ts", 1).over(w).alias("_tts"), F.lead("close", 1).over(w).alias("y"),
                (F.col("close") * F.exp(mlr)).alias("_gr")]
    d = over_series(d, build, layout=lay, back=SMA_N, ahead=1)
    arr = F.array(F.struct(F.lit("last").alias("model"), F.col("close").alias("yhat")),
                  F.struct(F.lit("sma20").alias("model"), F.col(f"sma{SMA_N}").alias("yhat")),
                  F.struct(F.lit("logdrift20").alias("model"), F.col("_gr").alias("yhat")))
    return (d.where(F.col("_tts").isNotNull())
            .select("series", F.col("_tts").alias("ts"), "y", F.explode(arr).alias("f"))
            .select(F.col("f.model").alias("model"), "series", "ts", "y", F.col("f.yhat").alias("yhat")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(ev.metrics(flagship_preds(spark, sf_dir), ["model", "series"]))


def _flagship_sql() -> str:
    w = "(PARTITION BY series ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    return with_bars(extra=f"""lr AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER (PARTITION BY series ORDER BY i) > 0
    THEN ln(close / lag(close) OVER (PARTITION BY series ORDER BY i)) END AS lr FROM ib),
f AS (SELECT *, CASE WHEN count(close) OVER {w} >= 20 THEN avg(close) OVER {w} END AS sma20,
    CASE WHEN count(lr) OVER {w} >= 20 THEN close * exp(avg(lr) OVER {w}) END AS gr,
    lead(ts) OVER (PARTITION BY series ORDER BY i) AS tts, lead(close) OVER (PARTITION BY series ORDER BY i) AS y FROM lr),
p AS (SELECT 'last' AS model, series, y, close AS yhat FROM f WHERE tts IS NOT NULL
  UNION ALL SELECT 'sma20', series, y, sma20 FROM f WHERE tts IS NOT NULL
  UNION ALL SELECT 'logdrift20', series, y, gr FROM f WHERE tts IS NOT NULL)""") + METRICS_SELECT.format(src="p", keys="model, series")


# metrics SELECT shared by evaluation oracles: {src} table, {keys} group keys
METRICS_SELECT = ("SELECT {keys}, count(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN 1 END) AS n, "
                  + rsql("sqrt(avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN (y - yhat) * (y - yhat) END))") + " AS rmse, "
                  + rsql("avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN abs(y - yhat) END)") + " AS mae, "
                  + rsql("avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL AND y <> 0 THEN abs((y - yhat) / y) END) * 100") + " AS mape, "
                  + "count(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL AND y = 0 THEN 1 END) AS mape_excluded, "
                  + rsql("1 - sum(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN (y - yhat) * (y - yhat) END)"
                         " / NULLIF(regr_syy(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN y END,"
                         " CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN yhat END), 0)") + " AS r2 "
                  + "FROM {src} GROUP BY {keys}")


@query("flagship_metrics", _flagship_sql())
def q_flagship(spark, sf_dir):
    """Flagship at any scale factor."""
    return flagship(spark, sf_dir)
