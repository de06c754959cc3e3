"""The panel feature table: every bounded, cumulative and recurrence feature
family over supplier daily bars (F4: one series per supplier), in one pass.

Plain layout: all windows share the (series) partitioning, one shuffle after the
bars aggregate.  Halo layout (chosen when a series may exceed the plain-window
threshold): rows are copied once into chunks, see ``one_pass``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.plans.catalog import TRUE_RANGE_SQL, W, lag_sum, query, rec_bars, warm_sql, wn
from tidecast.operators.ordered import one_pass
from tidecast.plans.common import bars_sql, finish, fixture_bars, r


STEPS = [
    lambda d, lay: ti.ema(d, 20, layout=lay),
    lambda d, lay: ti.macd(d, layout=lay),
    lambda d, lay: ti.rsi(d, 14, layout=lay),
    lambda d, lay: ti.atr(d, 14, layout=lay),
    lambda d, lay: ti.obv(d, layout=lay),
    lambda d, lay: tb.drawdown(d, layout=lay),
    lambda d, lay: tb.returns(d, "log", 1, out="lr", layout=lay),
    lambda d, lay: fe.lags(d, "lr", [1, 2, 5], layout=lay),
    lambda d, lay: fe.rolling(d, "close", 20, ["mean", "std", "min", "max"], layout=lay),
    lambda d, lay: fe.zscore(d, "close", 20, layout=lay),
    lambda d, lay: fe.rolling_trend(d, "close", 20, layout=lay),
    lambda d, lay: ti.wma(d, 10, layout=lay),
    lambda d, lay: ti.bollinger(d, 20, 2.0, layout=lay),
    lambda d, lay: ti.stochastic(d, 14, 3, layout=lay),
    lambda d, lay: ti.vwap(d, 20, layout=lay),
    lambda d, lay: ti.mfi(d, 14, layout=lay),
    lambda d, lay: fe.target(d, 1, "return", layout=lay),
    lambda d, lay: fe.calendar(d),
]


# Digits that rounding error cannot reach: prices go up to 1e5, their moments further.  A
# mean of 20 prices in cents is a multiple of 0.0005, so six digits leave no ties; a slope
# over 20 bars is one of 1 / 66500 and has none at four.
PRICE_DIGITS = {"close_mean20": 6, "bb_mid": 6, "close_slope20": 4} | {c: 2 for c in (
    "ema20", "macd", "macd_signal", "macd_hist", "atr14", "obv", "wma10", "close_std20", "bb_up", "bb_lo", "vwap20")}


def panel_features(spark: SparkSession, sf_dir: str, fixture: str = "lineitem") -> DataFrame:
    bars, lay = fixture_bars(spark, sf_dir, fixture, "day")
    return finish(one_pass(bars, STEPS, layout=lay), digits=4, by=PRICE_DIGITS)


def _panel_sql() -> str:
    a20, af, as_, ag, a14 = 2.0 / 21, 2.0 / 13, 2.0 / 27, 2.0 / 10, 1.0 / 14
    line = f"(({af!r} * ib.close + {1 - af!r} * rec.ef) - ({as_!r} * ib.close + {1 - as_!r} * rec.es))"
    mid, sd = f"avg(close) OVER {wn(20)}", f"stddev_pop(close) OVER {wn(20)}"
    up, lo = f"({mid} + 2.0 * {sd})", f"({mid} - 2.0 * {sd})"
    low14, high14 = f"min(low) OVER {wn(14)}", f"max(high) OVER {wn(14)}"
    wma = " + ".join(f"{10 - k}.0 * lag(close, {k}) OVER w" if k else "10.0 * close" for k in range(10))
    values = {
        "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume",
        "ema20": "CASE WHEN i >= 19 THEN e20 END", "macd": "CASE WHEN i >= 25 THEN ef - es END",
        "macd_signal": "CASE WHEN i >= 33 THEN sg END", "macd_hist": "CASE WHEN i >= 33 THEN (ef - es) - sg END",
        "rsi14": "CASE WHEN i < 14 OR (ag = 0 AND al = 0) THEN NULL WHEN al = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + ag / al) END",
        "atr14": "CASE WHEN i >= 13 THEN tr END",
        "obv": "sum(step) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "drawdown": "close / max(close) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1",
        "lr": "lr", **{f"lr_lag{k}": f"lag(lr, {k}) OVER w" for k in (1, 2, 5)},
        "close_mean20": warm_sql(20, mid), "close_std20": warm_sql(20, sd),
        "close_min20": warm_sql(20, f"min(close) OVER {wn(20)}"), "close_max20": warm_sql(20, f"max(close) OVER {wn(20)}"),
        "close_z20": warm_sql(20, f"(close - {mid}) / NULLIF({sd}, 0)"),
        "close_slope20": warm_sql(20, f"regr_slope(close, CAST(i AS DOUBLE)) OVER {wn(20)}"),
        "close_r2_20": warm_sql(20, f"regr_r2(close, CAST(i AS DOUBLE)) OVER {wn(20)}"),
        "wma10": warm_sql(10, f"({wma}) / 55.0"),
        "bb_mid": warm_sql(20, mid), "bb_up": warm_sql(20, up), "bb_lo": warm_sql(20, lo),
        "bb_width": warm_sql(20, f"({up} - {lo}) / NULLIF({mid}, 0)"), "bb_pctb": warm_sql(20, f"(close - {lo}) / NULLIF({up} - {lo}, 0)"),
        "stoch_k": "stoch_k", "stoch_d": f"CASE WHEN count(stoch_k) OVER {wn(3)} >= 3 THEN avg(stoch_k) OVER {wn(3)} END",
        "vwap20": warm_sql(20, f"{lag_sum('tp * volume', 20)} / NULLIF({lag_sum('volume', 20)}, 0)"),
        "mfi14": "CASE WHEN nflow < 14 OR (pf = 0 AND nf = 0) THEN NULL WHEN nf = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + pf / nf) END",
        "target_return_1": "CASE WHEN close > 0 AND lead(close) OVER w > 0 THEN lead(close) OVER w / close - 1 END",
    }
    rounded = ", ".join(r(v, name, PRICE_DIGITS.get(name, 4)) for name, v in values.items())
    return rec_bars(bars_sql("lineitem")) + f""",
rec AS (SELECT series, i, close AS e20, close AS ef, close AS es, CAST(NULL AS DOUBLE) AS sg, CAST(NULL AS DOUBLE) AS ag,
    CAST(NULL AS DOUBLE) AS al, high - low AS tr FROM ib WHERE i = 0
  UNION ALL
  SELECT ib.series, ib.i, {a20!r} * ib.close + {1 - a20!r} * rec.e20, {af!r} * ib.close + {1 - af!r} * rec.ef,
    {as_!r} * ib.close + {1 - as_!r} * rec.es,
    CASE WHEN ib.i = 25 THEN {line} WHEN ib.i > 25 THEN {ag!r} * {line} + {1 - ag!r} * rec.sg END,
    CASE WHEN ib.i = 1 THEN greatest(close - pc, 0) ELSE {a14!r} * greatest(close - pc, 0) + {1 - a14!r} * rec.ag END,
    CASE WHEN ib.i = 1 THEN greatest(pc - close, 0) ELSE {a14!r} * greatest(pc - close, 0) + {1 - a14!r} * rec.al END,
    {a14!r} * {TRUE_RANGE_SQL} + {1 - a14!r} * rec.tr
  FROM rec JOIN ib ON ib.series = rec.series AND ib.i = rec.i + 1),
p AS (SELECT ib.*, e20, ef, es, sg, ag, al, tr, (high + low + close) / 3 AS tp, coalesce(sign(close - pc) * volume, 0) AS step,
    CASE WHEN close > 0 AND pc > 0 THEN ln(close / pc) END AS lr
  FROM ib JOIN rec ON ib.series = rec.series AND ib.i = rec.i),
p2 AS (SELECT *, lag(tp) OVER w AS ptp, {warm_sql(14, f"100.0 * (close - {low14}) / NULLIF({high14} - {low14}, 0)")} AS stoch_k FROM p {W}),
p3 AS (SELECT *, sum(CASE WHEN tp > ptp THEN tp * volume ELSE 0 END) OVER {wn(14)} AS pf,
    sum(CASE WHEN tp < ptp THEN tp * volume ELSE 0 END) OVER {wn(14)} AS nf, count(ptp) OVER {wn(14)} AS nflow FROM p2 {W})
SELECT series, ts, i, {rounded},
  CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(dayofmonth(ts) AS INTEGER) AS dom, CAST(month(ts) AS INTEGER) AS month,
  CAST(quarter(ts) AS INTEGER) AS quarter, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(year(ts) AS INTEGER) AS year
FROM p3 {W}"""


@query("features_panel", _panel_sql())
def q_features_panel(spark, sf_dir):
    """All feature families at once on supplier daily bars, in one pass."""
    return panel_features(spark, sf_dir)
