"""
oracle SQL where SQL can express it.  Every query reads the given tables."""

from __future__ import annotations

from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.plans.common import bars_sql, finish, fixture_bars, indexed_bars, r, rsql, with_bars
from tidecast.sources import io
from tidecast.sources.tables import FIXTURES

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _bars_cols(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in ("series", "ts", "open", "high", "low", "close", "volume"))


BARS_OUT = f"SELECT {_bars_cols()} FROM bars"

# ------------------------------------------------------------------ sources


@query("io1_read_bars", f"WITH bars AS ({bars_sql('orders')}) {BARS_OUT}")
def q_io1(spark, sf_dir):
    """IO1: bars landed as parquet in the shared checkpoint folder, read back
    with the fixed schema."""
    import uuid

    from tidecast.session import checkpoint_dir
    bars, _ = fixture_bars(spark, sf_dir, "orders")
    path = f"{checkpoint_dir(spark).rstrip('/')}/landed-bars-{uuid.uuid4().hex}"
    io.write_bars(bars, path)
    return finish(io.read_bars(spark, path))


@query("io2_clean_bars", f"WITH bars AS ({bars_sql('lineitem')}) {BARS_OUT} "
       "WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low")
def q_io2(spark, sf_dir):
    """IO2: clean supplier daily bars (F4)."""
    bars, _ = fixture_bars(spark, sf_dir, "lineitem")
    clean, _rejects = io.clean_bars(bars)
    return finish(clean)


REJECTS_SQL = f"""d AS (SELECT series, ts, open, high, low, close, volume, count(*) AS copies
      FROM bars GROUP BY series, ts, open, high, low, close, volume),
v AS (SELECT *, CASE WHEN series IS NULL OR ts IS NULL THEN 'null_key'
                     WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 'null_price'
                     WHEN isnan(open) OR isnan(high) OR isnan(low) OR isnan(close) THEN 'nan_price'
                     WHEN least(open, high, low, close) <= 0 THEN 'non_positive_price'
                     WHEN high < low THEN 'high_below_low' END AS invalid FROM d),
w AS (SELECT series, ts, arg_max(struct_pack(wo := open, wh := high, wl := low, wc := close, wv := volume),
        (coalesce(volume, CAST('-inf' AS DOUBLE)), -close, -open, -high, -low)) AS win
      FROM v WHERE invalid IS NULL GROUP BY series, ts),
t AS (SELECT v.*, (w.win IS NOT NULL AND v.open IS NOT DISTINCT FROM w.win.wo AND v.high IS NOT DISTINCT FROM w.win.wh
        AND v.low IS NOT DISTINCT FROM w.win.wl AND v.close IS NOT DISTINCT FROM w.win.wc
        AND v.volume IS NOT DISTINCT FROM w.win.wv) AS is_winner
      FROM v LEFT JOIN w ON v.series = w.series AND v.ts = w.ts)
SELECT series, ts, {r('open', 'open')}, {r('high', 'high')}, {r('low', 'low')}, {r('close', 'close')},
  {r('volume', 'volume')}, coalesce(invalid, 'duplicate') AS reason,
  CASE WHEN invalid IS NULL AND is_winner THEN copies - 1 ELSE copies END AS copies
FROM t WHERE (CASE WHEN invalid IS NULL AND is_winner THEN copies - 1 ELSE copies END) > 0"""


@query("io2_clean_bars_rejects", f"""WITH bars AS ({bars_sql('lineitem')}),
{REJECTS_SQL}""")
def q_io2r(spark, sf_dir):
    """IO2: the rejected rows (with reason and copy count) of supplier daily bars."""
    bars, _ = fixture_bars(spark, sf_dir, "lineitem")
    _clean, rejects = io.clean_bars(bars)
    return finish(rejects)


DIRTY_SQL = """SELECT CASE WHEN day(ts) = 13 THEN NULL ELSE series END AS series, CASE WHEN day(ts) = 11 THEN NULL ELSE ts END AS ts,
  CASE WHEN day(ts) = 7 THEN -open ELSE open END AS open, CASE WHEN day(ts) = 9 THEN low / 2 ELSE high END AS high, low,
  CASE WHEN day(ts) = 3 THEN NULL ELSE close END AS close, volume FROM raw
UNION ALL SELECT series, ts, open, high, low, close, volume + 1 FROM raw WHERE day(ts) = 15"""


@query("io2_dirty_bars_rejects", f"""WITH raw AS ({bars_sql('lineitem')}), bars AS ({DIRTY_SQL}),
{REJECTS_SQL}""")
def q_io2d(spark, sf_dir):
    """IO2: the rejected rows of supplier daily bars with NULLs, wrong prices and duplicates put in by day of the month."""
    raw, _ = fixture_bars(spark, sf_dir, "lineitem")
    day = F.dayofmonth("ts")
    dirty = raw.select(
        F.when(day != 13, F.col("series")).alias("series"), F.when(day != 11, F.col("ts")).alias("ts"),
        F.when(day == 7, -F.col("open")).otherwise(F.col("open")).alias("open"),
        F.when(day == 9, F.col("low") / 2).otherwise(F.col("high")).alias("high"), "low",
        F.when(day != 3, F.col("close")).alias("close"), "volume")
    again = raw.where(day == 15).withColumn("volume", F.col("volume") + 1).select(dirty.columns)
    return finish(io.clean_bars(dirty.unionByName(again))[1])


@query("io5_chart_table", with_bars("orders", extra="""x AS (SELECT *, epoch_us(ts) AS xu FROM bars),
rg AS (SELECT series, min(xu) AS lo, max(xu) AS hi FROM x GROUP BY series),
bk AS (SELECT x.*, CASE WHEN hi = lo THEN 1 ELSE least((xu - lo) * 50 // (hi - lo) + 1, 50) END AS bucket
       FROM x JOIN rg USING (series))""") + f"""
SELECT series, CAST(bucket AS INTEGER) AS bucket, min(ts) AS x_first, max(ts) AS x_last,
  {r('min(close)', 'close_min')}, {r('max(close)', 'close_max')}, {r('arg_max(close, xu)', 'close_last')},
  {r('min(volume)', 'volume_min')}, {r('max(volume)', 'volume_max')}, {r('arg_max(volume, xu)', 'volume_last')}
FROM bk GROUP BY series, bucket""")
def q_io5(spark, sf_dir):
    """IO5: plot-ready min / max / last of close and volume in 50 time buckets."""
    bars, _ = fixture_bars(spark, sf_dir, "orders")
    return finish(io.chart_table(bars, "ts", ["close", "volume"], 50))


# --------------------------------------------------------------------- bars

@query("ts1_ticks_to_bars", f"WITH bars AS ({bars_sql('lineitem')}) {BARS_OUT}")
def q_ts1(spark, sf_dir):
    """TS1: supplier daily bars from line items (F4)."""
    return finish(tb.ticks_to_bars(FIXTURES["lineitem"](spark, sf_dir), "day"))


@query("ts1_ticks_to_bars_hourly", f"WITH bars AS ({bars_sql('events', 'hour')}) {BARS_OUT}")
def q_ts1h(spark, sf_dir):
    """TS1: hourly event bars (F2)."""
    return finish(tb.ticks_to_bars(FIXTURES["events"](spark, sf_dir), "hour"))


@query("ts2_resample_bars", f"""WITH bars AS ({bars_sql('events', 'hour')})
SELECT series, date_trunc('day', ts) AS ts, {r('arg_min(open, ts)', 'open')}, {r('max(high)', 'high')},
  {r('min(low)', 'low')}, {r('arg_max(close, ts)', 'close')}, {r('sum(volume)', 'volume')}
FROM bars GROUP BY series, date_trunc('day', ts)""")
def q_ts2(spark, sf_dir):
    """TS2: hourly event bars resampled to days (F2 -> F3)."""
    hourly = tb.ticks_to_bars(FIXTURES["events"](spark, sf_dir), "hour")
    return finish(tb.resample_bars(hourly, "day"))


@query("ts3_fill_gaps", f"""WITH bars AS ({bars_sql('events', 'hour')}),
span AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY series),
cal AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span),
j AS (SELECT c.series, c.ts, b.open, b.high, b.low, b.close, b.volume, b.series IS NULL AS is_filled
      FROM cal c LEFT JOIN bars b ON b.series = c.series AND b.ts = c.ts),
f AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff,
        CAST(row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS BIGINT) AS i FROM j)
SELECT series, ts, i, {r('coalesce(open, ff)', 'open')}, {r('coalesce(high, ff)', 'high')},
  {r('coalesce(low, ff)', 'low')}, {r('coalesce(close, ff)', 'close')},
  {r('coalesce(volume, 0)', 'volume')}, is_filled FROM f""")
def q_ts3(spark, sf_dir):
    """TS3: gap-free hourly event bars, forward-filled."""
    bars, layout = fixture_bars(spark, sf_dir, "events", "hour")
    return finish(tb.fill_gaps(bars, "hour", layout=layout))


def _holed_sql(fixture: str, freq: str, number: str) -> str:
    """Bars without those whose ``number`` leaves 3 modulo 7, and without the closes of those that leave 5 modulo 11."""
    return f"""WITH full_bars AS ({bars_sql(fixture, freq)}),
bars AS (SELECT series, ts, open, high, low, CASE WHEN {number} % 11 <> 5 THEN close END AS close, volume FROM full_bars WHERE {number} % 7 <> 3),"""


def _holed(spark, sf_dir, fixture: str, freq: str, number):
    bars, layout = fixture_bars(spark, sf_dir, fixture, freq)
    return bars.where(number % 7 != 3).withColumn("close", F.when(number % 11 != 5, F.col("close"))), layout


def _fill_sql(fixture: str, freq: str, number: str, step: str, method: str) -> str:
    last, later = ("last_value(CASE WHEN close IS NOT NULL THEN {x} END IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                   "first_value(CASE WHEN close IS NOT NULL THEN {x} END IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    fill = {"ffill": "pc", "bfill": "nc", "linear": "CASE WHEN ni = pi THEN pc ELSE pc + (nc - pc) * (CAST(i - pi AS DOUBLE) / CAST(ni - pi AS DOUBLE)) END"}[method]
    return _holed_sql(fixture, freq, number) + f"""
span AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM bars GROUP BY series),
cal AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 {step})) AS ts FROM span),
j AS (SELECT c.series, c.ts, b.open, b.high, b.low, b.close, b.volume, CAST(row_number() OVER (PARTITION BY c.series ORDER BY c.ts) - 1 AS BIGINT) AS i
      FROM cal c LEFT JOIN bars b ON b.series = c.series AND b.ts = c.ts),
k AS (SELECT *, {last.format(x='close')} AS pc, {last.format(x='i')} AS pi, {later.format(x='close')} AS nc, {later.format(x='i')} AS ni FROM j),
f AS (SELECT *, {fill} AS fill FROM k)
SELECT series, ts, i, {r('coalesce(open, close, fill)', 'open')}, {r('coalesce(high, close, fill)', 'high')},
  {r('coalesce(low, close, fill)', 'low')}, {r('coalesce(close, fill)', 'close')}, {r('coalesce(volume, 0)', 'volume')}, close IS NULL AS is_filled FROM f"""


_HOURS = "(epoch_us(ts) // 3600000000)"


def _hours():
    return F.floor(ntz_micros(F.col("ts")) / F.lit(3_600_000_000))


@query("ts3_fill_gaps_bfill", _fill_sql("events", "hour", _HOURS, "HOUR", "bfill"))
def q_ts3_bfill(spark, sf_dir):
    """TS3: hourly event bars with holes, each filled from the next known close."""
    bars, layout = _holed(spark, sf_dir, "events", "hour", _hours())
    return finish(tb.fill_gaps(bars, "hour", "bfill", layout=layout))


@query("ts3_fill_gaps_linear", _fill_sql("events", "hour", _HOURS, "HOUR", "linear"))
def q_ts3_linear(spark, sf_dir):
    """TS3: hourly event bars with holes, filled along straight lines."""
    bars, layout = _holed(spark, sf_dir, "events", "hour", _hours())
    return finish(tb.fill_gaps(bars, "hour", "linear", layout=layout))


@query("ts3_fill_gaps_weekly", _fill_sql("lineitem", "week", "(epoch_us(ts) // 604800000000)", "WEEK", "ffill"))
def q_ts3_weekly(spark, sf_dir):
    """TS3: weekly supplier bars with holes, forward-filled."""
    bars, layout = _holed(spark, sf_dir, "lineitem", "week", F.floor(ntz_micros(F.col("ts")) / F.lit(604_800_000_000)))
    return finish(tb.fill_gaps(bars, "week", layout=layout))


@query("ts3_fill_gaps_monthly", _fill_sql("lineitem", "month", "(year(ts) * 12 + month(ts))", "MONTH", "linear"))
def q_ts3_monthly(spark, sf_dir):
    """TS3: monthly supplier bars with holes on the calendar's grid, filled along straight lines."""
    bars, layout = _holed(spark, sf_dir, "lineitem", "month", F.year("ts") * 12 + F.month("ts"))
    return finish(tb.fill_gaps(bars, "month", "linear", layout=layout))


@query("ts4_returns", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r("CASE WHEN close > 0 AND lag(close) OVER w > 0 THEN close / lag(close) OVER w - 1 END", 'ret_simple_1')},
  {r("CASE WHEN close > 0 AND lag(close, 5) OVER w > 0 THEN ln(close / lag(close, 5) OVER w) END", 'ret_log_5')}
FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)""")
def q_ts4(spark, sf_dir):
    """TS4: 1-bar simple and 5-bar log returns of daily order bars (F1)."""
    d, lay = indexed_bars(spark, sf_dir)
    d = tb.returns(d, "simple", 1, layout=lay)
    d = tb.returns(d, "log", 5, layout=lay)
    return finish(d.select("series", "ts", "i", "close", "ret_simple_1", "ret_log_5"))


@query("ts5_drawdown", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r("close / max(close) OVER (PARTITION BY series ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1", 'drawdown')}
FROM ib""")
def q_ts5(spark, sf_dir):
    """TS5: drawdown from the running peak."""
    d, lay = indexed_bars(spark, sf_dir)
    return finish(tb.drawdown(d, layout=lay).select("series", "ts", "i", "close", "drawdown"))


@query("ts5_max_drawdown", with_bars(extra="""dd AS (SELECT series, ts, close / max(close) OVER (PARTITION BY series ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS drawdown FROM ib)""") + f"""
SELECT series, {r('min(drawdown)', 'max_drawdown')}, arg_min(ts, (drawdown, ts)) AS trough_ts FROM dd GROUP BY series""")
def q_ts5b(spark, sf_dir):
    """TS5: worst drawdown per series and when it happened."""
    d, lay = indexed_bars(spark, sf_dir)
    return finish(tb.max_drawdown(d, layout=lay))


ACF_LAGS = (1, 2, 5, 10)


def _acf_sql() -> str:
    lagcols = ", ".join(f"lag(ret, {k}) OVER w AS l{k}" for k in ACF_LAGS)
    parts = []
    for k in ACF_LAGS:
        a = f"CASE WHEN ret IS NOT NULL AND l{k} IS NOT NULL THEN ret END"
        b = f"CASE WHEN ret IS NOT NULL AND l{k} IS NOT NULL THEN l{k} END"
        acf = f"covar_pop({a}, {b}) / NULLIF(stddev_pop({a}) * stddev_pop({b}), 0)"
        parts.append(f"SELECT series, CAST({k} AS INTEGER) AS lag, {r(acf, 'acf')}, "
                     f"count(CASE WHEN ret IS NOT NULL AND l{k} IS NOT NULL THEN 1 END) AS n_pairs "
                     f"FROM lg GROUP BY series")
    return with_bars(extra=f"""rt AS (SELECT series, i, CASE WHEN close > 0 AND lag(close) OVER w > 0
      THEN close / lag(close) OVER w - 1 END AS ret FROM ib WINDOW w AS (PARTITION BY series ORDER BY i)),
lg AS (SELECT series, ret, {lagcols} FROM rt WINDOW w AS (PARTITION BY series ORDER BY i))""") + \
        "\nUNION ALL\n".join(parts)


@query("ts6_autocorr", _acf_sql())
def q_ts6(spark, sf_dir):
    """TS6: autocorrelation of daily returns at lags 1, 2, 5, 10."""
    d, lay = indexed_bars(spark, sf_dir)
    d = tb.returns(d, "simple", 1, out="ret", layout=lay)
    return finish(tb.autocorr(d, "ret", list(ACF_LAGS), layout=lay))


@query("ts7_summary", with_bars(extra="""m AS (SELECT *, avg(close) OVER (PARTITION BY series) AS mu,
    lag(ts) OVER (PARTITION BY series ORDER BY i) AS pts FROM ib)""") + f"""
SELECT series, count(close) AS n, {r('avg(close)', 'mean')}, {r('stddev_samp(close)', 'std')},
  {r('avg(power(close - mu, 3)) / NULLIF(power(avg(power(close - mu, 2)), 1.5), 0)', 'skew')},
  {r('avg(power(close - mu, 4)) / NULLIF(power(avg(power(close - mu, 2)), 2), 0) - 3', 'kurt')},
  {r('min(close)', 'min')}, {r('max(close)', 'max')},
  {r('quantile_disc(close, 0.25)', 'q25')}, {r('quantile_disc(close, 0.5)', 'q50')},
  {r('quantile_disc(close, 0.75)', 'q75')},
  count(CASE WHEN ts - pts > INTERVAL 1 DAY THEN 1 END) AS gaps
FROM m GROUP BY series""")
def q_ts7(spark, sf_dir):
    """TS7: per-series summary of daily closes."""
    d, lay = indexed_bars(spark, sf_dir)
    return finish(tb.summary(d, "close", freq="day", layout=lay))


# ----------------------------------------------------------------- features

W = "WINDOW w AS (PARTITION BY series ORDER BY i)"


def wn(n: int) -> str:
    return f"(w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def warm_sql(n: int, expr: str, col: str = "close") -> str:
    return f"CASE WHEN count({col}) OVER {wn(n)} >= {n} THEN {expr} END"


@query("fe1_lags", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {', '.join(r(f'lag(close, {k}) OVER w', f'close_lag{k}') for k in (1, 2, 3, 5, 10))}
FROM ib {W}""")
def q_fe1(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.lags(d, "close", [1, 2, 3, 5, 10], layout=lay)
    return finish(d.select("series", "ts", "i", "close", *[f"close_lag{k}" for k in (1, 2, 3, 5, 10)]))


@query("fe2_rolling", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r(warm_sql(20, f'avg(close) OVER {wn(20)}'), 'close_mean20')},
  {r(warm_sql(20, f'stddev_pop(close) OVER {wn(20)}'), 'close_std20')},
  {r(warm_sql(20, f'min(close) OVER {wn(20)}'), 'close_min20')},
  {r(warm_sql(20, f'max(close) OVER {wn(20)}'), 'close_max20')},
  {r(warm_sql(20, f'sum(close) OVER {wn(20)}'), 'close_sum20')}
FROM ib {W}""")
def q_fe2(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.rolling(d, "close", 20, layout=lay)
    return finish(d.select("series", "ts", "i", "close", *[f"close_{s}20" for s in ("mean", "std", "min", "max", "sum")]))


@query("fe3_rolling_quantile", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r(warm_sql(20, f'quantile_cont(close, 0.1) OVER {wn(20)}'), 'close_q10_20')},
  {r(warm_sql(20, f'quantile_cont(close, 0.5) OVER {wn(20)}'), 'close_q50_20')},
  {r(warm_sql(20, f'quantile_cont(close, 0.9) OVER {wn(20)}'), 'close_q90_20')}
FROM ib {W}""")
def q_fe3(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.rolling_quantile(d, "close", 20, [0.1, 0.5, 0.9], layout=lay)
    return finish(d.select("series", "ts", "i", "close", "close_q10_20", "close_q50_20", "close_q90_20"))


@query("fe4_zscore", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r(warm_sql(20, f'(close - avg(close) OVER {wn(20)}) / NULLIF(stddev_pop(close) OVER {wn(20)}, 0)'), 'close_z20')}
FROM ib {W}""")
def q_fe4(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(fe.zscore(d, "close", 20, layout=lay).select("series", "ts", "i", "close", "close_z20"))


@query("fe5_rolling_trend", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r(warm_sql(20, f'regr_slope(close, CAST(i AS DOUBLE)) OVER {wn(20)}'), 'close_slope20')},
  {r(warm_sql(20, f'regr_r2(close, CAST(i AS DOUBLE)) OVER {wn(20)}'), 'close_r2_20')}
FROM ib {W}""")
def q_fe5(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(fe.rolling_trend(d, "close", 20, layout=lay)
                  .select("series", "ts", "i", "close", "close_slope20", "close_r2_20"))


@query("fe6_rolling_corr", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')}, {r('volume', 'volume')},
  {r(warm_sql(20, f'covar_pop(close, volume) OVER {wn(20)} / NULLIF(stddev_pop(close) OVER {wn(20)} * stddev_pop(volume) OVER {wn(20)}, 0)'), 'corr_close_volume_20')}
FROM ib {W}""")
def q_fe6(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(fe.rolling_corr(d, "close", "volume", 20, layout=lay)
                  .select("series", "ts", "i", "close", "volume", "corr_close_volume_20"))


@query("fe7_calendar", f"""WITH bars AS ({bars_sql('orders')})
SELECT series, ts, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(dayofmonth(ts) AS INTEGER) AS dom,
  CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(year(ts) AS INTEGER) AS year FROM bars""")
def q_fe7(spark, sf_dir):
    bars, _ = fixture_bars(spark, sf_dir)
    return fe.calendar(bars).select("series", "ts", "dow", "dom", "month", "quarter", "doy", "year")


@query("fe8_target", with_bars() + f"""SELECT series, ts, i, {r('close', 'close')},
  {r('lead(close, 1) OVER w', 'target_price_1')},
  {r('CASE WHEN close > 0 AND lead(close, 5) OVER w > 0 THEN lead(close, 5) OVER w / close - 1 END', 'target_return_5')},
  {r('CASE WHEN close > 0 AND lead(close, 1) OVER w > 0 THEN ln(lead(close, 1) OVER w / close) END', 'target_log_1')}
FROM ib {W}""")
def q_fe8(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.target(d, 1, "price", layout=lay)
    d = fe.target(d, 5, "return", layout=lay)
    d = fe.target(d, 1, "log", layout=lay)
    return finish(d.select("series", "ts", "i", "close", "target_price_1", "target_return_5", "target_log_1"))


SCALER_END = "2000-01-01 00:00:00"


@query("fe9_scaler", with_bars(extra=f"""st AS (SELECT series,
    avg(CASE WHEN ts < TIMESTAMP '{SCALER_END}' THEN close END) AS mu,
    stddev_pop(CASE WHEN ts < TIMESTAMP '{SCALER_END}' THEN close END) AS sd,
    min(CASE WHEN ts < TIMESTAMP '{SCALER_END}' THEN volume END) AS lo,
    max(CASE WHEN ts < TIMESTAMP '{SCALER_END}' THEN volume END) AS hi FROM bars GROUP BY series)""") + f"""
SELECT b.series, b.ts, {r('b.close', 'close')}, {r('b.volume', 'volume')},
  {r('(b.close - mu) / NULLIF(sd, 0)', 'close_scaled')},
  {r('(b.volume - lo) / NULLIF(hi - lo, 0)', 'volume_scaled')}
FROM bars b LEFT JOIN st ON b.series = st.series""")
def q_fe9(spark, sf_dir):
    """FE9: close standardised and volume min-max scaled, fitted on rows before 2000."""
    bars, _ = fixture_bars(spark, sf_dir)
    d = fe.scaler(bars, ["close"], SCALER_END, method="standard")
    d = fe.scaler(d, ["volume"], SCALER_END, method="minmax")
    return finish(d.select("series", "ts", "close", "volume", "close_scaled", "volume_scaled"))


@query("fe10_sequence_windows", with_bars(extra=f"""sq AS (SELECT series, ts, i,
    list(close) OVER {wn(5)} AS cs, list(volume) OVER {wn(5)} AS vs, count(*) OVER {wn(5)} AS n FROM ib {W})""") + """
SELECT series, ts, i, list_transform(cs, lambda x: round(x * 1000000.0) / 1000000.0) AS close_seq,
  list_transform(vs, lambda x: round(x * 1000000.0) / 1000000.0) AS volume_seq FROM sq WHERE n = 5""")
def q_fe10(spark, sf_dir):
    """FE10: last 5 closes and volumes as arrays (full windows only)."""
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.sequence_windows(d, ["close", "volume"], 5, layout=lay)
    return finish(d.select("series", "ts", "i", "close_seq", "volume_seq"))


_FE11 = ["close_lag1", "close_lag2", "close_lag3", "close_mean10", "close_std10"]


@query("fe11_assemble", with_bars(extra="""names AS (SELECT series, CAST(row_number() OVER (ORDER BY series) - 1 AS DOUBLE) AS k FROM (SELECT DISTINCT series FROM bars)),
f AS (SELECT series, ts, i, lag(close, 1) OVER w AS l1, lag(close, 2) OVER w AS l2, lag(close, 3) OVER w AS l3,
    CASE WHEN count(close) OVER w10 >= 10 THEN avg(close) OVER w10 END AS m,
    CASE WHEN count(close) OVER w10 >= 10 THEN stddev_pop(close) OVER w10 END AS s
  FROM ib WINDOW w AS (PARTITION BY series ORDER BY i), w10 AS (PARTITION BY series ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))""")
       + f"""SELECT series, ts, i, [{', '.join(rsql(c) for c in ('l1', 'l2', 'l3', 'm', 's', 'k'))}] AS features FROM f JOIN names USING (series)""")
def q_fe11(spark, sf_dir):
    """FE11: lag and rolling features and the series index assembled to a vector, read
    back as an array (NaN, an unknown feature, as NULL)."""
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.lags(d, "close", [1, 2, 3], layout=lay)
    d = fe.rolling(d, "close", 10, ["mean", "std"], layout=lay)
    pipe, _names = fe.assemble(d, _FE11)
    values = F.transform(vector_to_array("features"), lambda v: F.nanvl(v, F.lit(None).cast("double")))
    return finish(pipe.fit(d).transform(d).select("series", "ts", "i", values.alias("features")))


# --------------------------------------------------------------- indicators

def _ti_out(extra_cols: str) -> str:
    return f"SELECT series, ts, i, {r('close', 'close')}, {extra_cols} FROM ib {W}"


@query("ti1_sma", with_bars() + _ti_out(r(warm_sql(20, f"avg(close) OVER {wn(20)}"), "sma20")))
def q_ti1(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.sma(d, 20, layout=lay).select("series", "ts", "i", "close", "sma20"))


def _wma_sql(n: int) -> str:
    terms = " + ".join(f"{n - k}.0 * lag(close, {k}) OVER w" if k else f"{n}.0 * close" for k in range(n))
    return warm_sql(n, f"({terms}) / {n * (n + 1) / 2.0}")


@query("ti2_wma", with_bars() + _ti_out(r(_wma_sql(10), "wma10")))
def q_ti2(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.wma(d, 10, layout=lay).select("series", "ts", "i", "close", "wma10"))


@query("ti3_roc", with_bars() + _ti_out(r("close / NULLIF(lag(close, 10) OVER w, 0) - 1", "roc10")))
def q_ti3(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.roc(d, 10, layout=lay).select("series", "ts", "i", "close", "roc10"))


def _bb_sql(n=20, k=2.0) -> str:
    mid, sd = f"avg(close) OVER {wn(n)}", f"stddev_pop(close) OVER {wn(n)}"
    up, lo = f"({mid} + {k} * {sd})", f"({mid} - {k} * {sd})"
    return ", ".join([r(warm_sql(n, mid), "bb_mid"), r(warm_sql(n, up), "bb_up"), r(warm_sql(n, lo), "bb_lo"),
                      r(warm_sql(n, f"({up} - {lo}) / NULLIF({mid}, 0)"), "bb_width"),
                      r(warm_sql(n, f"(close - {lo}) / NULLIF({up} - {lo}, 0)"), "bb_pctb")])


@query("ti4_bollinger", with_bars() + _ti_out(_bb_sql()))
def q_ti4(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.bollinger(d, 20, 2.0, layout=lay)
                  .select("series", "ts", "i", "close", "bb_mid", "bb_up", "bb_lo", "bb_width", "bb_pctb"))


@query("ti5_donchian", with_bars() + _ti_out(", ".join([
    r(warm_sql(20, f"max(high) OVER {wn(20)}"), "dc_high"), r(warm_sql(20, f"min(low) OVER {wn(20)}"), "dc_low"),
    r(warm_sql(20, f"(max(high) OVER {wn(20)} + min(low) OVER {wn(20)}) / 2"), "dc_mid")])))
def q_ti5(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.donchian(d, 20, layout=lay).select("series", "ts", "i", "close", "dc_high", "dc_low", "dc_mid"))


@query("ti6_stochastic", with_bars(extra=f"""k AS (SELECT *, {warm_sql(14, f"100.0 * (close - min(low) OVER {wn(14)}) / NULLIF(max(high) OVER {wn(14)} - min(low) OVER {wn(14)}, 0)")} AS stoch_k
    FROM ib {W})""") + f"""SELECT series, ts, i, {r('close', 'close')}, {r('stoch_k', 'stoch_k')},
  {r(f"CASE WHEN count(stoch_k) OVER {wn(3)} >= 3 THEN avg(stoch_k) OVER {wn(3)} END", 'stoch_d')} FROM k {W}""")
def q_ti6(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.stochastic(d, 14, 3, layout=lay).select("series", "ts", "i", "close", "stoch_k", "stoch_d"))


@query("ti7_williams_r", with_bars() + _ti_out(r(warm_sql(14, f"-100.0 * (max(high) OVER {wn(14)} - close) / NULLIF(max(high) OVER {wn(14)} - min(low) OVER {wn(14)}, 0)"), "willr14")))
def q_ti7(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.williams_r(d, 14, layout=lay).select("series", "ts", "i", "close", "willr14"))


@query("ti8_cci", with_bars(extra=f"""tp AS (SELECT *, (high + low + close) / 3 AS tp FROM ib),
c AS (SELECT *, avg(tp) OVER {wn(20)} AS m, list(tp) OVER {wn(20)} AS tps FROM tp {W})""") + f"""
SELECT series, ts, i, {r('close', 'close')},
  {r("CASE WHEN len(tps) >= 20 THEN (tp - m) / NULLIF(0.015 * (list_sum(list_transform(tps, lambda x: abs(x - m))) / len(tps)), 0) END", 'cci20')}
FROM c""")
def q_ti8(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.cci(d, 20, layout=lay).select("series", "ts", "i", "close", "cci20"))


def lag_sum(expr: str, n: int) -> str:
    """Frame sum written oldest-first, the addition order of Spark's row frames."""
    return "(" + " + ".join(f"lag({expr}, {k}) OVER w" if k else expr for k in range(n - 1, -1, -1)) + ")"


@query("ti9_vwap", with_bars(extra="v AS (SELECT *, (high + low + close) / 3 * volume AS pv FROM ib)")
       + f"SELECT series, ts, i, {r('close', 'close')}, "
       + r(warm_sql(20, f"{lag_sum('pv', 20)} / NULLIF({lag_sum('volume', 20)}, 0)"), "vwap20")
       + f" FROM v {W}")
def q_ti9(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.vwap(d, 20, layout=lay).select("series", "ts", "i", "close", "vwap20"))


MFM_SQL = "coalesce(((close - low) - (high - close)) / NULLIF(high - low, 0), 0)"


@query("ti10_cmf", with_bars() + _ti_out(r(warm_sql(20, f"sum({MFM_SQL} * volume) OVER {wn(20)} / NULLIF(sum(volume) OVER {wn(20)}, 0)"), "cmf20")))
def q_ti10(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.cmf(d, 20, layout=lay).select("series", "ts", "i", "close", "cmf20"))


@query("ti11_mfi", with_bars(extra=f"""tp AS (SELECT *, (high + low + close) / 3 AS tp FROM ib),
p AS (SELECT *, lag(tp) OVER w AS ptp FROM tp {W}),
f AS (SELECT *, sum(CASE WHEN tp > ptp THEN tp * volume ELSE 0 END) OVER {wn(14)} AS pf,
   sum(CASE WHEN tp < ptp THEN tp * volume ELSE 0 END) OVER {wn(14)} AS nf,
   count(ptp) OVER {wn(14)} AS n FROM p {W})""") + f"""
SELECT series, ts, i, {r('close', 'close')},
  {r("CASE WHEN n >= 14 THEN (CASE WHEN pf = 0 AND nf = 0 THEN NULL WHEN nf = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + pf / nf) END) END", 'mfi14')}
FROM f""")
def q_ti11(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.mfi(d, 14, layout=lay).select("series", "ts", "i", "close", "mfi14"))


@query("ti12_obv", with_bars(extra=f"""st AS (SELECT *, coalesce(sign(close - lag(close) OVER w) * volume, 0) AS step FROM ib {W})""")
       + f"SELECT series, ts, i, {r('close', 'close')}, "
       + r("sum(step) OVER (PARTITION BY series ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "obv")
       + " FROM st")
def q_ti12(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.obv(d, layout=lay).select("series", "ts", "i", "close", "obv"))


@query("ti13_adl", with_bars() + _ti_out(r(f"sum({MFM_SQL} * volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "adl")))
def q_ti13(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.adl(d, layout=lay).select("series", "ts", "i", "close", "adl"))


# ------------------------------------------------------- recurrence indicators
# Hourly event bars (F2): values up to ~500 keep both engines' rounding error
# far below the 6th decimal.  Oracles are sequential recursive CTEs.

def rec_bars(bars: str = bars_sql("events", "hour")) -> str:
    return f"""WITH RECURSIVE bars AS ({bars}),
ib AS MATERIALIZED (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS BIGINT) AS i,
   lag(close) OVER (PARTITION BY series ORDER BY ts) AS pc, lag(high) OVER (PARTITION BY series ORDER BY ts) AS ph,
   lag(low) OVER (PARTITION BY series ORDER BY ts) AS pl FROM bars)"""


def _ema_sql(n: int) -> str:
    a = 2.0 / (n + 1)
    return rec_bars() + f""",
rec AS (SELECT series, i, close AS y FROM ib WHERE i = 0
  UNION ALL
  SELECT ib.series, ib.i, {a!r} * ib.close + {1 - a!r} * rec.y FROM rec JOIN ib ON ib.series = rec.series AND ib.i = rec.i + 1)
SELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')}, {r(f'CASE WHEN ib.i >= {n - 1} THEN rec.y END', f'ema{n}')}
FROM ib JOIN rec ON ib.series = rec.series AND ib.i = rec.i"""


@query("ti14_ema", _ema_sql(20))
def q_ti14(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    return finish(ti.ema(d, 20, layout=lay).select("series", "ts", "i", "close", "ema20"))


def _macd_sql(fast=12, slow=26, sig=9) -> str:
    af, as_, ag = 2.0 / (fast + 1), 2.0 / (slow + 1), 2.0 / (sig + 1)
    s0 = slow - 1
    line_new = f"(({af!r} * ib.close + {1 - af!r} * rec.ef) - ({as_!r} * ib.close + {1 - as_!r} * rec.es))"
    return rec_bars() + f""",
rec AS (SELECT series, i, close AS ef, close AS es,
    CAST(NULL AS DOUBLE) AS sg FROM ib WHERE i = 0
  UNION ALL
  SELECT ib.series, ib.i, {af!r} * ib.close + {1 - af!r} * rec.ef, {as_!r} * ib.close + {1 - as_!r} * rec.es,
    CASE WHEN ib.i = {s0} THEN {line_new} WHEN ib.i > {s0} THEN {ag!r} * {line_new} + {1 - ag!r} * rec.sg END
  FROM rec JOIN ib ON ib.series = rec.series AND ib.i = rec.i + 1)
SELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')},
  {r(f'CASE WHEN ib.i >= {s0} THEN ef - es END', 'macd')},
  {r(f'CASE WHEN ib.i >= {s0 + sig - 1} THEN sg END', 'macd_signal')},
  {r(f'CASE WHEN ib.i >= {s0 + sig - 1} THEN (ef - es) - sg END', 'macd_hist')}
FROM ib JOIN rec ON ib.series = rec.series AND ib.i = rec.i"""


@query("ti15_macd", _macd_sql())
def q_ti15(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    return finish(ti.macd(d, 12, 26, 9, layout=lay)
                  .select("series", "ts", "i", "close", "macd", "macd_signal", "macd_hist"))


def _rsi_sql(n=14) -> str:
    a = 1.0 / n
    return rec_bars() + f""",
g AS (SELECT series, i, greatest(close - pc, 0) AS gain, greatest(pc - close, 0) AS loss FROM ib WHERE i >= 1),
rec AS (SELECT series, i, gain AS ag, loss AS al FROM g WHERE i = 1
  UNION ALL
  SELECT g.series, g.i, {a!r} * g.gain + {1 - a!r} * rec.ag, {a!r} * g.loss + {1 - a!r} * rec.al
  FROM rec JOIN g ON g.series = rec.series AND g.i = rec.i + 1)
SELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')},
  {r(f"CASE WHEN ib.i < {n} THEN NULL WHEN ag = 0 AND al = 0 THEN NULL WHEN al = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + ag / al) END", f'rsi{n}')}
FROM ib LEFT JOIN rec ON ib.series = rec.series AND ib.i = rec.i"""


@query("ti16_rsi", _rsi_sql())
def q_ti16(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    return finish(ti.rsi(d, 14, layout=lay).select("series", "ts", "i", "close", "rsi14"))


TRUE_RANGE_SQL = "greatest(high - low, abs(high - pc), abs(low - pc))"


def _atr_sql(n=14) -> str:
    a = 1.0 / n
    return rec_bars() + f""",
t AS (SELECT series, i, CASE WHEN i = 0 THEN high - low ELSE {TRUE_RANGE_SQL} END AS tr FROM ib),
rec AS (SELECT series, i, tr AS y FROM t WHERE i = 0
  UNION ALL
  SELECT t.series, t.i, {a!r} * t.tr + {1 - a!r} * rec.y FROM rec JOIN t ON t.series = rec.series AND t.i = rec.i + 1)
SELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')}, {r(f'CASE WHEN ib.i >= {n - 1} THEN y END', f'atr{n}')}
FROM ib JOIN rec ON ib.series = rec.series AND ib.i = rec.i"""


@query("ti17_atr", _atr_sql())
def q_ti17(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    return finish(ti.atr(d, 14, layout=lay).select("series", "ts", "i", "close", "atr14"))


def _adx_sql(n=14) -> str:
    a = 1.0 / n
    return rec_bars() + f""",
dm AS (SELECT series, i,
    CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS pdm,
    CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END AS mdm,
    {TRUE_RANGE_SQL} AS tr FROM ib WHERE i >= 1),
rec AS (SELECT series, i, pdm AS sp, mdm AS sm, tr AS st FROM dm WHERE i = 1
  UNION ALL
  SELECT dm.series, dm.i, {a!r} * dm.pdm + {1 - a!r} * rec.sp, {a!r} * dm.mdm + {1 - a!r} * rec.sm,
    {a!r} * dm.tr + {1 - a!r} * rec.st FROM rec JOIN dm ON dm.series = rec.series AND dm.i = rec.i + 1),
di AS (SELECT series, i, CASE WHEN i >= {n} THEN 100.0 * sp / NULLIF(st, 0) END AS pdi,
    CASE WHEN i >= {n} THEN 100.0 * sm / NULLIF(st, 0) END AS mdi FROM rec),
dx AS (SELECT *, CASE WHEN pdi + mdi = 0 THEN 0.0 ELSE 100.0 * abs(pdi - mdi) / (pdi + mdi) END AS dx FROM di),
rec2 AS (SELECT series, i, dx AS y FROM dx WHERE i = {n}
  UNION ALL
  SELECT dx.series, dx.i, {a!r} * dx.dx + {1 - a!r} * rec2.y FROM rec2 JOIN dx ON dx.series = rec2.series AND dx.i = rec2.i + 1)
SELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')}, {r('dx.pdi', 'plus_di')}, {r('dx.mdi', 'minus_di')},
  {r(f'CASE WHEN ib.i >= {2 * n - 1} THEN rec2.y END', f'adx{n}')}
FROM ib LEFT JOIN dx ON ib.series = dx.series AND ib.i = dx.i
LEFT JOIN rec2 ON ib.series = rec2.series AND ib.i = rec2.i"""


@query("ti18_adx", _adx_sql())
def q_ti18(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    return finish(ti.adx(d, 14, layout=lay).select("series", "ts", "i", "close", "plus_di", "minus_di", "adx14"))
