"""Registered queries: evaluation, validation, models, prediction and model sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.expr import safe_div
from tidecast.operators.ordered import Layout, over_series
from tidecast.operators import bars as tb
from tidecast.operators import evaluate as ev
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators import models as mo
from tidecast.operators import validation as va
from tidecast.operators.linear import linear_search, walk_forward_linear
from tidecast.operators.naive import naive_forecast
from tidecast.plans.catalog import query
from tidecast.plans.common import finish, indexed_bars, r, with_bars
from tidecast.plans.flagship import METRICS_SELECT
from tidecast.session import checkpoint_dir, cut_lineage
from tidecast.sources import io

# ------------------------------------------------------------ naive forecasts
# F1 daily order bars; one-bar-ahead; fold = calendar year of the target.
NAIVE_N, NAIVE_M = 20, 7


def naive_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lay = indexed_bars(spark, sf_dir)
    p = naive_forecast(d, h=1, n=NAIVE_N, m=NAIVE_M, layout=lay)
    return p.withColumn("fold", F.year("ts"))


def _naive_sql_ctes() -> str:
    w20 = "(PARTITION BY series ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    k = NAIVE_M * 1 - 1
    return with_bars(extra=f"""nv AS (SELECT series, ts AS origin_ts, lead(ts) OVER w AS tts, lead(close) OVER w AS y,
    close AS y_base, close AS f_last,
    close + 1.0 * (close - lag(close, {NAIVE_N}) OVER w) / {float(NAIVE_N)} AS f_drift,
    lag(close, {k}) OVER w AS f_seas,
    CASE WHEN count(close) OVER {w20} >= {NAIVE_N} THEN avg(close) OVER {w20} END AS f_ma
  FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)),
preds AS (
  SELECT 'naive_last' AS model, series, tts AS ts, y, f_last AS yhat, y_base, origin_ts FROM nv WHERE tts IS NOT NULL AND f_last IS NOT NULL
  UNION ALL SELECT 'naive_drift{NAIVE_N}', series, tts, y, f_drift, y_base, origin_ts FROM nv WHERE tts IS NOT NULL AND f_drift IS NOT NULL
  UNION ALL SELECT 'naive_seasonal{NAIVE_M}', series, tts, y, f_seas, y_base, origin_ts FROM nv WHERE tts IS NOT NULL AND f_seas IS NOT NULL
  UNION ALL SELECT 'naive_ma{NAIVE_N}', series, tts, y, f_ma, y_base, origin_ts FROM nv WHERE tts IS NOT NULL AND f_ma IS NOT NULL),
p AS (SELECT *, CAST(year(ts) AS INTEGER) AS fold, 1 AS horizon FROM preds)""")


PRED_COLS = "model, fold, series, ts, CAST(horizon AS INTEGER) AS horizon"


@query("mo4_naive_forecast", _naive_sql_ctes() + f"""SELECT {PRED_COLS}, {r('y', 'y')}, {r('yhat', 'yhat')},
  {r('y_base', 'y_base')}, origin_ts FROM p""")
def q_mo4(spark, sf_dir):
    """MO4: last value, drift(20), seasonal naive(7), moving average(20)."""
    return finish(naive_preds(spark, sf_dir).select("model", "fold", "series", "ts", "horizon", "y", "yhat",
                                                    "y_base", "origin_ts"))


_IO3_SQL = _naive_sql_ctes() + f"""SELECT {PRED_COLS}, {r('y', 'y')}, {r('yhat', 'yhat')} FROM p"""


def _written_and_read(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/predictions-{uuid.uuid4().hex}"
    io.write_predictions(naive_preds(spark, sf_dir), path, fmt)
    return finish(io.read_predictions(spark, path, fmt))


@query("io3_write_predictions", _IO3_SQL)
def q_io3(spark, sf_dir):
    """IO3: predictions written as parquet partitioned by model, read back."""
    return _written_and_read(spark, sf_dir, "parquet")


@query("io3_write_predictions_csv", _IO3_SQL)
def q_io3_csv(spark, sf_dir):
    """IO3: predictions written as CSV partitioned by model, read back."""
    return _written_and_read(spark, sf_dir, "csv")


PAIR = "y IS NOT NULL AND yhat IS NOT NULL"


@query("ev1_rmse", _naive_sql_ctes() + f"SELECT model, series, {r(f'sqrt(avg(CASE WHEN {PAIR} THEN (y - yhat) * (y - yhat) END))', 'rmse')} FROM p GROUP BY model, series")
def q_ev1(spark, sf_dir):
    return finish(ev.rmse(naive_preds(spark, sf_dir)))


@query("ev2_mae", _naive_sql_ctes() + f"SELECT model, series, {r(f'avg(CASE WHEN {PAIR} THEN abs(y - yhat) END)', 'mae')} FROM p GROUP BY model, series")
def q_ev2(spark, sf_dir):
    return finish(ev.mae(naive_preds(spark, sf_dir)))


@query("ev3_mape", _naive_sql_ctes() + f"""SELECT model, series,
  {r(f'avg(CASE WHEN {PAIR} AND y <> 0 THEN abs((y - yhat) / y) END) * 100', 'mape')},
  count(CASE WHEN {PAIR} AND y = 0 THEN 1 END) AS mape_excluded FROM p GROUP BY model, series""")
def q_ev3(spark, sf_dir):
    return finish(ev.mape(naive_preds(spark, sf_dir)))


@query("ev4_r2", _naive_sql_ctes() + f"""SELECT model, series,
  {r(f'1 - sum(CASE WHEN {PAIR} THEN (y - yhat) * (y - yhat) END) / NULLIF(regr_syy(CASE WHEN {PAIR} THEN y END, CASE WHEN {PAIR} THEN yhat END), 0)', 'r2')}
FROM p GROUP BY model, series""")
def q_ev4(spark, sf_dir):
    return finish(ev.r2(naive_preds(spark, sf_dir)))


@query("ev5_directional_accuracy", _naive_sql_ctes() + f"""SELECT model, series,
  {r(f'avg(CASE WHEN {PAIR} AND y_base IS NOT NULL THEN CAST(sign(yhat - y_base) = sign(y - y_base) AS DOUBLE) END)', 'directional_accuracy')},
  count(CASE WHEN {PAIR} AND y_base IS NOT NULL THEN 1 END) AS n FROM p GROUP BY model, series""")
def q_ev5(spark, sf_dir):
    return finish(ev.directional_accuracy(naive_preds(spark, sf_dir)))


@query("ev_metrics_by_fold", _naive_sql_ctes() + METRICS_SELECT.format(src="p", keys="model, series, fold"))
def q_ev_all(spark, sf_dir):
    """EV1-EV4 in one aggregate per (model, series, fold)."""
    return finish(ev.metrics(naive_preds(spark, sf_dir), ["model", "series", "fold"]))


@query("ev6_leaderboard", _naive_sql_ctes() + f""",
m AS (SELECT model, series, fold, sqrt(avg(CASE WHEN {PAIR} THEN (y - yhat) * (y - yhat) END)) AS rmse FROM p GROUP BY model, series, fold),
a AS (SELECT series, model, avg(rmse) AS mean_rmse, stddev_samp(rmse) AS std_rmse, count(rmse) AS folds FROM m GROUP BY series, model),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY mean_rmse ASC NULLS LAST, model) AS INTEGER) AS rank FROM a)
SELECT series, model, {r('mean_rmse', 'mean_rmse')}, {r('std_rmse', 'std_rmse')}, folds, rank FROM k WHERE rank <= 2""")
def q_ev6(spark, sf_dir):
    """EV6: top-2 benchmark models per series by mean RMSE over yearly folds."""
    m = ev.rmse(naive_preds(spark, sf_dir), ["model", "series", "fold"])
    return finish(ev.leaderboard(m, 2))


BAND_Z = 1.96


@query("ev7_interval_coverage", with_bars(extra=f"""d AS (SELECT *, close - lag(close) OVER w AS dc FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)),
b AS (SELECT series, ts, lead(close) OVER w AS y,
    CASE WHEN count(dc) OVER w20 >= 20 THEN close - {BAND_Z} * stddev_pop(dc) OVER w20 END AS lo,
    CASE WHEN count(dc) OVER w20 >= 20 THEN close + {BAND_Z} * stddev_pop(dc) OVER w20 END AS hi
  FROM d WINDOW w AS (PARTITION BY series ORDER BY i), w20 AS (PARTITION BY series ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""") + f"""
SELECT 'band_last' AS model, series,
  {r('avg(CASE WHEN y IS NOT NULL AND lo IS NOT NULL AND hi IS NOT NULL THEN CAST(y BETWEEN lo AND hi AS DOUBLE) END)', 'coverage')},
  {r('avg(CASE WHEN y IS NOT NULL AND lo IS NOT NULL AND hi IS NOT NULL THEN hi - lo END)', 'mean_width')},
  count(CASE WHEN y IS NOT NULL AND lo IS NOT NULL AND hi IS NOT NULL THEN 1 END) AS n FROM b GROUP BY series""")
def q_ev7(spark, sf_dir):
    """EV7: coverage of last-value bands ± 1.96 σ of the last 20 one-bar changes."""
    d, lay = indexed_bars(spark, sf_dir)
    d = d.withColumn("_c", F.col("close"))
    d = fe.lags(d, "close", [1], layout=lay).withColumn("dc", F.col("close") - F.col("close_lag1"))
    d = fe.rolling(d, "dc", 20, ["std"], layout=lay)
    d = fe.target(d, 1, "price", layout=lay)
    sd = F.col("dc_std20")
    bands = d.select(F.lit("band_last").alias("model"), "series", "ts", F.col("target_price_1").alias("y"),
                     (F.col("close") - F.lit(BAND_Z) * sd).alias("lo"),
                     (F.col("close") + F.lit(BAND_Z) * sd).alias("hi"))
    return finish(ev.interval_coverage(bands))


@query("mo5_ensemble_weighted", _naive_sql_ctes() + f""",
per AS (SELECT model, series, fold, sum(CASE WHEN {PAIR} THEN (y - yhat) * (y - yhat) END) AS sse,
    count(CASE WHEN {PAIR} THEN 1 END) AS n FROM p GROUP BY model, series, fold),
hist AS (SELECT model, series, fold, sqrt(sum(sse) OVER past / sum(n) OVER past) AS rm FROM per
    WINDOW past AS (PARTITION BY model, series ORDER BY fold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h2 AS (SELECT *, max(CASE WHEN rm IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY series, fold) AS anynew FROM hist),
h3 AS (SELECT model, series, fold, CASE WHEN anynew = 1 THEN 1.0 ELSE 1.0 / greatest(rm, 1e-12) END AS inv FROM h2)
SELECT series, fold, ts, CAST(horizon AS INTEGER) AS horizon, {r('sum(inv * yhat) / sum(inv)', 'yhat')}, {r('first(y)', 'y')},
  count(*) AS members, 'ensemble_w' AS model
FROM p JOIN h3 USING (model, series, fold) GROUP BY series, fold, ts, horizon""")
def q_mo5(spark, sf_dir):
    """MO5: inverse-RMSE weighted ensemble of the benchmarks, weights from earlier years only."""
    return finish(mo.ensemble_weighted(naive_preds(spark, sf_dir)))


# ------------------------------------------------------------------ validation

@query("va1_chrono_split", with_bars(extra="""cal AS (SELECT DISTINCT epoch_us(ts) AS us FROM bars),
c AS (SELECT quantile_disc(us, 0.7) AS c1, quantile_disc(us, 0.85) AS c2 FROM cal)""") + """
SELECT series, ts, CASE WHEN epoch_us(ts) <= c1 THEN 'train' WHEN epoch_us(ts) <= c2 THEN 'val' ELSE 'test' END AS split
FROM bars, c""")
def q_va1(spark, sf_dir):
    d, _ = indexed_bars(spark, sf_dir)
    return va.chrono_split(d, 0.7, 0.15).select("series", "ts", "split")


WF = va.WalkForward(initial=1000, test=100, gap=1)


def _folds_sql(wf: va.WalkForward) -> str:
    """CTEs cal (ts, t) and folds (fold, train_hi, test_lo, test_hi) of an expanding walk-forward."""
    return f"""cal AS (SELECT ts, CAST(row_number() OVER (ORDER BY ts) - 1 AS BIGINT) AS t FROM (SELECT DISTINCT ts FROM bars)),
nf AS (SELECT greatest(0, (count(*) - {wf.initial} - {wf.gap} + {wf.test - 1}) // {wf.test}) AS n FROM cal),
folds AS (SELECT CAST(k AS INTEGER) AS fold, {wf.initial} + k * {wf.test} AS train_hi, {wf.initial + wf.gap} + k * {wf.test} AS test_lo,
    {wf.initial + wf.gap} + (k + 1) * {wf.test} AS test_hi FROM (SELECT unnest(range(0, n)) AS k FROM nf))"""


@query("va2_walk_forward", with_bars(extra=_folds_sql(WF) + """,
bt AS (SELECT b.series, b.ts, c.t FROM bars b JOIN cal c ON b.ts = c.ts)""") + """
SELECT series, ts, t, fold, 'train' AS role FROM bt JOIN folds ON t < train_hi
UNION ALL
SELECT series, ts, t, fold, 'test' AS role FROM bt JOIN folds ON t >= test_lo AND t < test_hi""")
def q_va2(spark, sf_dir):
    """VA2: expanding walk-forward folds on the shared step calendar (initial
    1000 steps, test blocks of 100, gap 1; the last block may be shorter)."""
    bars, _ = indexed_bars(spark, sf_dir)
    return va.walk_forward(bars.select("series", "ts"), WF).select("series", "ts", "t", "fold", "role")


@query("va2_fold_ranges", with_bars(extra=_folds_sql(WF) + """,
bt AS (SELECT b.series, b.ts, c.t FROM bars b JOIN cal c ON b.ts = c.ts)""") + """
SELECT series, ts, t, any_value(fold) FILTER (t >= test_lo AND t < test_hi) AS test_fold,
  min(fold) FILTER (t < train_hi) AS train_from, max(fold) FILTER (t < train_hi) AS train_to
FROM bt LEFT JOIN folds ON true GROUP BY series, ts, t""")
def q_va2_ranges(spark, sf_dir):
    """VA2 without the explosion: per row its test fold and the folds that train on it."""
    bars, _ = indexed_bars(spark, sf_dir)
    return va.fold_ranges(bars.select("series", "ts"), WF).select("series", "ts", "t", "test_fold", "train_from", "train_to")


# ---------------------------------------------------------------- model table
FEATURES = ["ret", "ret_lag1", "ret_lag2", "ret_lag3", "ret_lag5", "sma_ratio", "rsi14", "ret_std10",
            "dow", "month"]
LABEL = "target_return_1"


def model_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Daily order bars with lag / indicator / calendar features, the next bar's
    return as label and the time ``label_ts`` at which it is known; their layout."""
    d, lay = indexed_bars(spark, sf_dir)
    d = tb.returns(d, "simple", 1, out="ret", layout=lay)
    d = fe.lags(d, "ret", [1, 2, 3, 5], layout=lay)
    d = fe.rolling(d, "ret", 10, ["std"], layout=lay)
    d = ti.sma(d, 10, layout=lay)
    d = ti.rsi(d, 14, layout=lay)
    d = with_label(d, lay)
    d = fe.calendar(d).withColumn("sma_ratio", safe_div(F.col("close"), F.col("sma10")) - 1)
    return va.with_steps(d.select("series", "ts", "i", "close", "label_ts", *FEATURES, LABEL)), lay


def with_label(d: DataFrame, lay: Layout) -> DataFrame:
    d = fe.target(d, 1, "return", layout=lay)
    return over_series(d, lambda w: [F.lead("ts", 1).over(w).alias("label_ts")], layout=lay, ahead=1)


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_rows`` cut from their lineage (shared checkpoint folder), because model
    loops scan them many times."""
    return cut_lineage(model_rows(spark, sf_dir)[0])


def _split(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First 80 % of the calendar and the rest, purged of labels known only in the latter."""
    s = va.chrono_split(d, 0.8, 0.0)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    start = test.agg(F.min("ts")).first()[0]
    if start is not None:
        train = train.where(F.col("label_ts") < F.lit(start).cast("timestamp_ntz"))
    return train, test


RET_N = (1, 2, 3, 5, 10, 20)


def return_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean returns over the last n bars (``ret_mean{n}``) with the next bar's return as
    label: the input of the one-feature regressions, which SQL can reproduce."""
    d, lay = indexed_bars(spark, sf_dir)
    d = tb.returns(d, "simple", 1, out="ret", layout=lay)
    for n in RET_N:
        d = fe.rolling(d, "ret", n, ["mean"], layout=lay)
    d = with_label(d, lay)
    return cut_lineage(va.with_steps(d.select("series", "ts", "i", "label_ts", *[f"ret_mean{n}" for n in RET_N], LABEL)))


def _returns_sql(extra: str) -> str:
    """CTE m (series, ts, i, label_ts, x1.., y): ``return_table`` in SQL."""
    xs = ", ".join(f"CASE WHEN count(ret) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} "
                   f"THEN avg(ret) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS x{n}" for n in RET_N)
    return with_bars(extra=f"""rt AS (SELECT series, ts, i, lead(ts) OVER w AS label_ts, close / nullif(lag(close) OVER w, 0) - 1 AS ret,
    lead(close) OVER w / nullif(close, 0) - 1 AS y FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)),
m AS (SELECT series, ts, i, label_ts, y, {xs} FROM rt WINDOW w AS (PARTITION BY series ORDER BY i)),
{extra}""")


@query("mo1_gbt_forecast")
def q_mo1(spark, sf_dir):
    """MO1: boosted trees (both presets) on lag / indicator features; test-period predictions."""
    train, test = _split(model_table(spark, sf_dir))

    def one(preset: str) -> DataFrame:
        m = mo.gbt_forecast(train, FEATURES, LABEL, preset=preset)
        return m.transform(test).select(F.lit(f"gbt_{preset}").alias("model"), "series", "ts",
                                        F.col(LABEL).alias("y"), "yhat")
    return finish(reduce(DataFrame.unionByName, va.overlapped(one, ("xgb", "lgbm"), 2)))


@query("mo2_early_stop")
def q_mo2(spark, sf_dir):
    """MO2: GBT with chronological validation-based early stopping; reports trees kept."""
    train, test = _split(model_table(spark, sf_dir))
    m = mo.early_stop(train, FEATURES, LABEL)
    trees = m.stages[mo.REGRESSOR].getNumTrees
    return finish(m.transform(test).select("series", "ts", F.col(LABEL).alias("y"), "yhat",
                                           F.lit(trees).alias("trees")))


def ridge_sql(name: str, source: str, xs: list[str], y: str, reg: float, key: str | None = None) -> str:
    """CTEs that end in ``name`` (key, a, b0, b1, ..): ridge by Gaussian elimination over the
    covariances of ``source``'s rows with all columns known, for each value of ``key``."""
    p, k0 = len(xs), f"{key}, " if key else ""
    known = " AND ".join(f"{c} IS NOT NULL" for c in (*xs, y))
    first = [f"covar_pop({xs[i]}, {xs[j]}){f' * {1 + reg!r}' if i == j else ''} AS a{i}_{j}" for i in range(p) for j in range(i, p)]
    first += [f"covar_pop({xs[i]}, {y}) AS c{i}" for i in range(p)] + [f"avg({x}) AS m{i}" for i, x in enumerate(xs)] + [f"avg({y}) AS my"]
    steps = [f"{name}_0 AS MATERIALIZED (SELECT {k0}{', '.join(first)} FROM {source} WHERE {known}{f' GROUP BY {key}' if key else ''})"]

    def at(i: int, j: int) -> str:
        return f"a{min(i, j)}_{max(i, j)}"

    for k in range(p - 1):  # rows above k stay, those below lose their part along k
        cols = [f"a{i}_{j} - {at(i, k)} * {at(j, k)} / a{k}_{k} AS a{i}_{j}" if i > k else f"a{i}_{j}" for i in range(p) for j in range(i, p)]
        cols += [f"c{i} - {at(i, k)} * c{k} / a{k}_{k} AS c{i}" if i > k else f"c{i}" for i in range(p)] + [f"m{i}" for i in range(p)] + ["my"]
        steps.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT {k0}{', '.join(cols)} FROM {name}_{k})")
    last = f"{name}_{p - 1}"
    for i in range(p - 1, -1, -1):
        rest = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, p))
        steps.append(f"{name}_b{i} AS MATERIALIZED (SELECT *, (c{i}{rest}) / a{i}_{i} AS b{i} FROM {last})")
        last = f"{name}_b{i}"
    means = "".join(f" - b{i} * m{i}" for i in range(p))
    steps.append(f"{name} AS (SELECT {k0}my{means} AS a, {', '.join(f'b{i}' for i in range(p))} FROM {last})")
    return ",\n".join(steps)


def linear_sql(xs: list[str]) -> str:
    return "a" + "".join(f" + b{i} * {x}" for i, x in enumerate(xs))


LOOKBACK = 10
_LOOK = mo.lookback_names(LOOKBACK)


def _lookback_sql() -> str:
    """CTE wf (series, ts, label_ts, y, lookback1..): ``window_frame`` with labels in SQL."""
    lags = ", ".join(f"lag(close, {k}) OVER w / NULLIF(close, 0) AS {name}" for k, name in enumerate(_LOOK, 1))
    return with_bars(extra=f"""lb AS (SELECT series, ts, close, lead(ts) OVER w AS label_ts,
    CASE WHEN close > 0 AND lead(close) OVER w > 0 THEN lead(close) OVER w / close - 1 END AS y, {lags} FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)),
wf AS (SELECT * FROM lb WHERE close <> 0 AND {' AND '.join(f'{c} IS NOT NULL' for c in _LOOK)})""")


_SPLIT_SQL = """c AS (SELECT quantile_disc(us, 0.8) AS c1 FROM (SELECT DISTINCT epoch_us(ts) AS us FROM {0})),
te AS (SELECT {0}.* FROM {0}, c WHERE epoch_us(ts) > c1),
tr AS (SELECT {0}.* FROM {0}, c WHERE epoch_us(ts) <= c1 AND label_ts < (SELECT min(ts) FROM te))"""


@query("mo3_window_regression", _lookback_sql().rstrip() + f""",
{_SPLIT_SQL.format('wf')},
{ridge_sql('fit', 'tr', _LOOK, 'y', 1e-3)}
SELECT series, ts, {r('y', 'y')}, {r(linear_sql(_LOOK), 'yhat')} FROM te, fit""")
def q_mo3(spark, sf_dir):
    """MO3: linear autoregression on 10-bar lookback windows (scaled by the last close)."""
    d, lay = indexed_bars(spark, sf_dir)
    train, test = _split(cut_lineage(mo.window_frame(with_label(d, lay), LOOKBACK, layout=lay)))
    return finish(mo.window_regression(train, LOOKBACK, LABEL).transform(test)
                  .select("series", "ts", F.col(LABEL).alias("y"), "yhat"))


@query("io4_save_load_model")
def q_io4(spark, sf_dir):
    """IO4: a fitted pipeline saved to the shared folder, loaded back and applied."""
    train, test = _split(model_table(spark, sf_dir))
    m = mo.gbt_forecast(train, FEATURES, LABEL)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    io.save_model(m, path)
    back = io.load_model(path)
    return finish(back.transform(test).select("series", "ts", F.col(LABEL).alias("y"), "yhat"))


@query("io4_reloaded_same", with_bars(extra="""c AS (SELECT quantile_disc(us, 0.8) AS c1 FROM (SELECT DISTINCT epoch_us(ts) AS us FROM bars))""")
       + """SELECT series, ts, true AS same FROM bars, c WHERE epoch_us(ts) > c1""")
def q_io4_same(spark, sf_dir):
    """IO4: per row of the test range, whether the reloaded model predicts the same value
    (an invariant, not the value itself)."""
    train, test = _split(model_table(spark, sf_dir))
    m = mo.linear_forecast(train, FEATURES, LABEL)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    io.save_model(m, path)
    both = io.load_model(path).transform(m.transform(test).withColumnRenamed("yhat", "first").drop("features", "_yhat"))
    return both.select("series", "ts", F.col("yhat").eqNullSafe(F.col("first")).alias("same"))


_MEMBERS = ["naive_last", f"naive_drift{NAIVE_N}", f"naive_seasonal{NAIVE_M}", f"naive_ma{NAIVE_N}"]


@query("mo6_ensemble_stack", _naive_sql_ctes().rstrip() + f""",
wide AS (SELECT series, fold, ts, horizon, any_value(y) AS y, {', '.join(f"max(CASE WHEN model = '{m}' THEN yhat END) AS {m}" for m in _MEMBERS)}
  FROM p GROUP BY series, fold, ts, horizon),
late AS (SELECT DISTINCT fold FROM p ORDER BY fold DESC LIMIT 2),
early_rows AS (SELECT * FROM wide WHERE fold NOT IN (SELECT fold FROM late)),
{ridge_sql('fit', 'early_rows', _MEMBERS, 'y', 1e-6)}
SELECT series, fold, ts, CAST(horizon AS INTEGER) AS horizon, {r('y', 'y', 3)}, {r(linear_sql(_MEMBERS), 'yhat', 3)}, 'ensemble_stack' AS model
FROM wide, fit WHERE fold IN (SELECT fold FROM late)""")
def q_mo6(spark, sf_dir):
    """MO6: linear stack of the benchmarks, fit on years before the last two, applied after."""
    preds = naive_preds(spark, sf_dir)
    years = sorted(r_[0] for r_ in preds.select("fold").distinct().collect())  # a handful of years
    return finish(mo.ensemble_stack(preds, _MEMBERS, train_folds=years[:-2]), digits=3)


@query("mo7_feature_importance")
def q_mo7(spark, sf_dir):
    train, _ = _split(model_table(spark, sf_dir))
    m = mo.gbt_forecast(train, FEATURES, LABEL)
    return finish(mo.feature_importance(m, FEATURES, spark))


@query("mo8_permutation_importance")
def q_mo8(spark, sf_dir):
    train, test = _split(model_table(spark, sf_dir))
    m = mo.gbt_forecast(train, FEATURES, LABEL)
    return finish(mo.permutation_importance(m, test, FEATURES, LABEL))


PERM_SEED = 11


@query("mo8_permuted_column", with_bars(extra=f"""u AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', '{PERM_SEED}', series, CAST(i AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM ib),
k AS (SELECT series, ts, i, close, i AS pos, row_number() OVER (PARTITION BY series ORDER BY u, i) - 1 AS drawn FROM u)""")
       + f"""SELECT a.series, a.ts, a.i, {r('a.close', 'close')}, {r('b.close', 'permuted')} FROM k a JOIN k b ON a.series = b.series AND a.pos = b.drawn""")
def q_mo8_permuted(spark, sf_dir):
    """The permutation that MO8 scores with: each close and the one moved to its row."""
    d, _ = indexed_bars(spark, sf_dir)
    d = mo.permuted(d.select("series", "ts", "i", "close"), ["close"], seed=PERM_SEED, task_rows=512)
    return finish(d.select("series", "ts", "i", "close", F.col("_perm.close").alias("permuted")))


_SWAPPED = ["ret_mean5", "ret_mean20"]


def _importance_sql() -> str:
    def score(swap: str | None) -> str:
        xs = [f"b.x{n}" if f"ret_mean{n}" == swap else f"a.x{n}" for n in (5, 20)]
        known = " AND ".join(f"{x} IS NOT NULL" for x in ("a.y", *xs))
        return f"""(SELECT sqrt(avg((a.y - (fit.a + fit.b0 * {xs[0]} + fit.b1 * {xs[1]})) ** 2)) FROM k a JOIN k b ON a.series = b.series AND a.pos = b.drawn, fit WHERE {known})"""

    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, {score(f)} AS permuted, {score(None)} AS base" for f in _SWAPPED)
    draw = f"CAST(('0x' || substr(md5(concat_ws('|', '{PERM_SEED}', series, CAST(i AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0"
    return _returns_sql(f"""{_SPLIT_SQL.format('m')},
{ridge_sql('fit', 'tr', ['x5', 'x20'], 'y', 0.0)},
u AS (SELECT *, {draw} AS u FROM te),
k AS MATERIALIZED (SELECT series, y, x5, x20, row_number() OVER (PARTITION BY series ORDER BY i) AS pos, row_number() OVER (PARTITION BY series ORDER BY u, i) AS drawn FROM u),
s AS ({rows})""") + f"SELECT feature, {r('permuted', 'permuted_rmse')}, {r('base', 'base_rmse')}, {r('permuted - base', 'importance')} FROM s"


@query("mo8_permutation_importance_linear", _importance_sql())
def q_mo8_linear(spark, sf_dir):
    """MO8 with a least-squares fit on two features."""
    train, test = _split(return_table(spark, sf_dir))
    return finish(mo.permutation_importance(mo.linear_forecast(train, _SWAPPED, LABEL), test, _SWAPPED, LABEL, seed=PERM_SEED))


@query("mo9_learning_curve")
def q_mo9(spark, sf_dir):
    """MO9: boosted trees on growing prefixes of the training range, then per round."""
    train, test = _split(model_table(spark, sf_dir))
    return finish(mo.learning_curve(train, test, lambda d: mo.gbt_forecast(d, FEATURES, LABEL), LABEL))


@query("mo9_learning_curve_linear", _returns_sql("""c AS (SELECT quantile_disc(us, 0.8) AS c1 FROM (SELECT DISTINCT epoch_us(ts) AS us FROM bars)),
te AS (SELECT m.* FROM m, c WHERE epoch_us(ts) > c1),
tr AS (SELECT m.* FROM m, c WHERE epoch_us(ts) <= c1 AND label_ts < (SELECT min(ts) FROM te)),
cut AS (SELECT 0.25::DOUBLE AS x, quantile_disc(epoch_us(ts), 0.25) AS us FROM tr UNION ALL SELECT 0.5, quantile_disc(epoch_us(ts), 0.5) FROM tr
  UNION ALL SELECT 0.75, quantile_disc(epoch_us(ts), 0.75) FROM tr UNION ALL SELECT 1.0, max(epoch_us(ts)) FROM tr),
fit AS (SELECT cut.x, regr_slope(y, x5) AS b, regr_intercept(y, x5) AS a FROM tr JOIN cut ON epoch_us(ts) <= us WHERE y IS NOT NULL AND x5 IS NOT NULL GROUP BY cut.x)""")
       + f"""SELECT 'prefix' AS curve, x, {r('sqrt(avg((y - a - b * x5) * (y - a - b * x5)))', 'rmse')} FROM te, fit WHERE y IS NOT NULL AND x5 IS NOT NULL GROUP BY x""")
def q_mo9_linear(spark, sf_dir):
    """MO9 with a one-feature least-squares fit."""
    train, test = _split(return_table(spark, sf_dir))
    return finish(mo.learning_curve(train, test, lambda d: mo.linear_forecast(d, ["ret_mean5"], LABEL), LABEL))


WF_MODELS = va.WalkForward(initial=1200, test=120, gap=1)


@query("va3_walk_forward_run")
def q_va3(spark, sf_dir):
    """VA3: GBT refit on each expanding fold; union of out-of-fold predictions."""
    def fit_predict(train, test, k):
        m = mo.gbt_forecast(train, FEATURES, LABEL)
        return m.transform(test).select(F.lit("gbt_xgb").alias("model"), "series", "ts",
                                        F.col(LABEL).alias("y"), "yhat")
    return finish(va.walk_forward_run(model_table(spark, sf_dir), WF_MODELS, fit_predict, label_ts="label_ts"))


def _fold_fits_sql(points) -> str:
    """CTE fits (n, reg, fold, a, b): one ridge fit per window length, penalty and fold, purged by label time."""
    fits = " UNION ALL ".join(
        f"SELECT {n} AS n, {reg!r} AS reg, fold, avg(y) - avg(x{n}) * covar_pop(x{n}, y) / ({1 + reg!r} * var_pop(x{n})) AS a, "
        f"covar_pop(x{n}, y) / ({1 + reg!r} * var_pop(x{n})) AS b FROM mt JOIN st ON t < train_hi AND label_ts < start "
        f"WHERE y IS NOT NULL AND x{n} IS NOT NULL GROUP BY fold" for n, reg in points)
    return _folds_sql(WF_MODELS) + f""",
mt AS (SELECT m.*, t FROM m JOIN cal USING (ts)),
st AS (SELECT folds.*, ts AS start FROM folds JOIN cal ON t = test_lo),
fits AS ({fits})"""


_LINEAR_FOLDS_SQL = _returns_sql(_fold_fits_sql([(5, 0.0)])) + f"""
SELECT series, ts, fold, {r('y', 'y')}, {r('a + b * x5', 'yhat')} FROM mt JOIN st ON t >= test_lo AND t < test_hi JOIN fits USING (fold)"""


@query("va3_walk_forward_linear", _LINEAR_FOLDS_SQL)
def q_va3_linear(spark, sf_dir):
    """VA3 with a one-feature least-squares fit per fold, all folds from one aggregate."""
    preds = walk_forward_linear(return_table(spark, sf_dir), WF_MODELS, [(["ret_mean5"], 0.0)], LABEL, label_ts="label_ts")
    return finish(preds.select("series", "ts", "fold", F.col(LABEL).alias("y"), "yhat"))


@query("va3_walk_forward_linear_loop", _LINEAR_FOLDS_SQL)
def q_va3_linear_loop(spark, sf_dir):
    """VA3 fold by fold, as for any estimator, with the same least-squares fit."""
    def fit_predict(train, test, k):
        m = mo.linear_forecast(train, ["ret_mean5"], LABEL)
        return m.transform(test).select("series", "ts", F.col(LABEL).alias("y"), "yhat")
    return finish(va.walk_forward_run(return_table(spark, sf_dir), WF_MODELS, fit_predict, label_ts="label_ts"))


@query("va3_walk_forward_ridge", _lookback_sql().rstrip() + f""",
{_folds_sql(WF_MODELS).replace('FROM (SELECT DISTINCT ts FROM bars)', 'FROM (SELECT DISTINCT ts FROM wf)')},
mt AS (SELECT wf.*, t FROM wf JOIN cal USING (ts)),
st AS (SELECT folds.*, ts AS start FROM folds JOIN cal ON t = test_lo),
tr AS (SELECT fold, mt.* FROM mt JOIN st ON t < train_hi AND label_ts < start),
{ridge_sql('fit', 'tr', _LOOK, 'y', 1e-3, 'fold')}
SELECT series, ts, fold, {r('y', 'y')}, {r(linear_sql(_LOOK), 'yhat')} FROM mt JOIN st ON t >= test_lo AND t < test_hi JOIN fit USING (fold)""")
def q_va3_ridge(spark, sf_dir):
    """VA3 over MO3: the lookback ridge refit on every fold, from one aggregate."""
    d, lay = indexed_bars(spark, sf_dir)
    table = cut_lineage(va.with_steps(mo.window_frame(with_label(d, lay), LOOKBACK, layout=lay)))
    preds = walk_forward_linear(table, WF_MODELS, [(_LOOK, 1e-3)], LABEL, label_ts="label_ts")
    return finish(preds.select("series", "ts", "fold", F.col(LABEL).alias("y"), "yhat"))


@query("mo10_walk_forward_search")
def q_mo10(spark, sf_dir):
    """MO10: boosted trees of three depths and two step sizes, ten rounds each, scored on
    the walk-forward folds; best by mean RMSE."""
    grid = [dict(maxDepth=depth, stepSize=step, maxIter=10) for depth in (2, 3, 5) for step in (0.1, 0.3)]

    def fit_predict(train, test, params):
        m = mo.gbt_forecast(train, FEATURES, LABEL, **params)
        return m.transform(test).select(F.col(LABEL).alias("y"), "yhat")
    return finish(mo.walk_forward_search(model_table(spark, sf_dir), WF_MODELS, grid, fit_predict, label_ts="label_ts"))


GRID = [(n, reg) for n in RET_N for reg in (0.0, 0.5)]


@query("mo10_window_search", _returns_sql(_fold_fits_sql(GRID) + f""",
xs AS ({' UNION ALL '.join(f"SELECT {g} AS point, {n} AS n, {reg!r} AS reg, t, y, x{n} AS x FROM mt" for g, (n, reg) in enumerate(GRID))}),
e AS (SELECT point, xs.n, xs.reg, fold, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse FROM xs JOIN st ON t >= test_lo AND t < test_hi
  JOIN fits USING (n, reg, fold) WHERE y IS NOT NULL AND x IS NOT NULL GROUP BY point, xs.n, xs.reg, fold),
g AS (SELECT point, n, reg, avg(rmse) AS me, stddev_samp(rmse) AS sd, count(rmse) AS folds FROM e GROUP BY point, n, reg)""") + f"""
SELECT CAST(point AS INTEGER) AS point, 'ret_mean' || n || ' ' || CAST(reg AS VARCHAR) AS params,
  {r('me', 'mean_rmse')}, {r('sd', 'std_rmse')}, folds, point = (SELECT arg_min(point, (me, point)) FROM g) AS best FROM g""")
def q_mo10_window(spark, sf_dir):
    """MO10 over window length and penalty of a one-feature ridge: every fold and point from one aggregate."""
    points = [([f"ret_mean{n}"], reg) for n, reg in GRID]
    return finish(linear_search(return_table(spark, sf_dir), WF_MODELS, points, LABEL, label_ts="label_ts"))
