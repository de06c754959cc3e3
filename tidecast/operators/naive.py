"""MO4: benchmark forecasts (last value, drift, seasonal naive, moving average).

One bounded window pass produces every benchmark for the target h bars ahead;
the result is the long predictions table
(model, fold, series, ts, horizon, y, yhat, y_base, origin_ts).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import warm
from tidecast.operators.features import frame
from tidecast.operators.ordered import PLAIN, Layout, ensure_index, over_series

KINDS = ("last", "drift", "seasonal", "ma")


def naive_forecast(bars: DataFrame, kinds: Sequence[str] = KINDS, *, h: int = 1, n: int = 20,
                   m: int = 7, col: str = "close", layout: Layout = PLAIN,
                   fold: int = 0) -> DataFrame:
    """Forecasts made at each bar t for bar t+h.

    last:      y_t
    drift:     y_t + h (y_t - y_{t-n}) / n
    seasonal:  the value one season (m bars) before the target, i.e. y_{t+h-m*ceil(h/m)}
    ma:        mean of the last n values
    Rows whose target or forecast does not exist are left out.
    """
    d = ensure_index(bars, layout)
    k_season = m * -(-h // m) - h

    def build(w):
        outs = [F.lead("ts", h).over(w).alias("_tts"), F.lead(col, h).over(w).alias("_y")]
        if "drift" in kinds:
            outs.append(F.lag(col, n).over(w).alias("_lagn"))
        if "seasonal" in kinds:
            outs.append((F.lag(col, k_season).over(w) if k_season else F.col(col)).alias("_seas"))
        if "ma" in kinds:
            f = frame(w, n)
            outs.append(warm(F.count(col).over(f), n, F.avg(col).over(f)).alias("_ma"))
        return outs
    d = over_series(d, build, layout=layout, back=max(n, m), ahead=h)
    c = F.col(col)
    fc = {
        "last": c,
        "drift": c + F.lit(float(h)) * (c - F.col("_lagn")) / F.lit(float(n)),
        "seasonal": F.col("_seas"),
        "ma": F.col("_ma"),
    }
    names = {"last": "naive_last", "drift": f"naive_drift{n}", "seasonal": f"naive_seasonal{m}",
             "ma": f"naive_ma{n}"}
    arr = F.array(*[F.struct(F.lit(names[k]).alias("model"), fc[k].cast("double").alias("yhat"))
                    for k in kinds])
    out = (d.where(F.col("_tts").isNotNull())
           .select("series", F.col("ts").alias("origin_ts"), F.col("_tts").alias("ts"),
                   F.col("_y").alias("y"), c.alias("y_base"), F.explode(arr).alias("_f")))
    return (out.where(F.col("_f.yhat").isNotNull())
            .select(F.col("_f.model").alias("model"), F.lit(fold).alias("fold"), "series", "ts",
                    F.lit(h).alias("horizon"), "y", F.col("_f.yhat").alias("yhat"), "y_base",
                    "origin_ts"))
