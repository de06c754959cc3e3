"""Recurrence indicators over bars with NULL closes: a NULL input leaves the state as it
is.  Hourly event bars (F2) whose close is NULL where a hash of (series, i) says so; the
oracles number the known inputs and recurse over those."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout
from tidecast.plans.catalog import query
from tidecast.plans.common import bars_sql, finish, indexed_bars, r


def holed_bars(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    d, lay = indexed_bars(spark, sf_dir, "events", "hour")
    digit = F.substring(F.md5(F.concat_ws("|", "series", F.col("i").cast("string"))), 1, 1)
    return d.withColumn("close", F.when(~digit.isin("0", "1", "2"), F.col("close"))), lay


def _bars() -> str:
    return f"""WITH RECURSIVE bars AS ({bars_sql('events', 'hour')}),
n0 AS (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS BIGINT) AS i FROM bars),
n1 AS (SELECT series, ts, i, high, low, CASE WHEN substr(md5(concat_ws('|', series, CAST(i AS VARCHAR))), 1, 1) NOT IN ('0', '1', '2') THEN close END AS close FROM n0),
ib AS MATERIALIZED (SELECT *, lag(close) OVER w AS pc, lag(high) OVER w AS ph, lag(low) OVER w AS pl FROM n1 WINDOW w AS (PARTITION BY series ORDER BY i))"""


def _scan(name: str, source: str, inputs: dict[str, tuple[str, float]], where: str) -> str:
    """CTEs ``{name}_in`` (known inputs numbered j) and ``{name}`` (their smoothed values)."""
    known = " AND ".join(f"({x}) IS NOT NULL" for x, _ in inputs.values())
    columns = ", ".join(f"{x} AS x_{out}" for out, (x, _) in inputs.items())
    first = ", ".join(f"x_{out} AS {out}" for out in inputs)
    more = ", ".join(f"{a!r} * n.x_{out} + {1 - a!r} * p.{out}" for out, (_, a) in inputs.items())
    return f"""{name}_in AS MATERIALIZED (SELECT series, i, {columns}, CAST(row_number() OVER (PARTITION BY series ORDER BY i) - 1 AS BIGINT) AS j FROM {source} WHERE {where} AND {known}),
{name} AS (SELECT series, i, j, {first} FROM {name}_in WHERE j = 0
  UNION ALL SELECT n.series, n.i, n.j, {more} FROM {name} p JOIN {name}_in n ON n.series = p.series AND n.j = p.j + 1)"""


def _out(columns: str, *scans: str) -> str:
    joins = " ".join(f"LEFT JOIN {s} ON {s}.series = ib.series AND {s}.i = ib.i" for s in scans)
    return f"\nSELECT ib.series, ib.ts, ib.i, {r('ib.close', 'close')}, {columns} FROM ib {joins}"


@query("ti14_ema_nulls", f"{_bars()},\n{_scan('e', 'ib', {'y': ('close', 2.0 / 21)}, 'true')}"
       + _out(r("CASE WHEN e.j >= 19 THEN e.y END", "ema20"), "e"))
def q_ema(spark, sf_dir):
    d, lay = holed_bars(spark, sf_dir)
    return finish(ti.ema(d, 20, layout=lay).select("series", "ts", "i", "close", "ema20"))


@query("ti15_macd_nulls", f"{_bars()},\n{_scan('e', 'ib', {'ef': ('close', 2.0 / 13), 'es': ('close', 2.0 / 27)}, 'true')},\n"
       f"line AS MATERIALIZED (SELECT series, i, ef - es AS macd FROM e WHERE j >= 25),\n{_scan('g', 'line', {'sg': ('macd', 0.2)}, 'i >= 25')}"
       + _out(", ".join([r("line.macd", "macd"), r("CASE WHEN g.j >= 8 THEN g.sg END", "macd_signal"), r("CASE WHEN g.j >= 8 THEN line.macd - g.sg END", "macd_hist")]), "line", "g"))
def q_macd(spark, sf_dir):
    d, lay = holed_bars(spark, sf_dir)
    return finish(ti.macd(d, layout=lay).select("series", "ts", "i", "close", "macd", "macd_signal", "macd_hist"))


@query("ti16_rsi_nulls", f"{_bars()},\n{_scan('g', 'ib', {'ag': ('CASE WHEN close - pc IS NOT NULL THEN greatest(close - pc, 0) END', 1.0 / 14), 'al': ('CASE WHEN close - pc IS NOT NULL THEN greatest(pc - close, 0) END', 1.0 / 14)}, 'i >= 1')}"
       + _out(r("CASE WHEN g.j < 13 OR (ag = 0 AND al = 0) THEN NULL WHEN al = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + ag / al) END", "rsi14"), "g"))
def q_rsi(spark, sf_dir):
    d, lay = holed_bars(spark, sf_dir)
    return finish(ti.rsi(d, 14, layout=lay).select("series", "ts", "i", "close", "rsi14"))


@query("ti17_atr_nulls", f"{_bars()},\n{_scan('t', 'ib', {'y': ('greatest(high - low, abs(high - pc), abs(low - pc))', 1.0 / 14)}, 'true')}"
       + _out(r("CASE WHEN t.j >= 13 THEN t.y END", "atr14"), "t"))
def q_atr(spark, sf_dir):
    d, lay = holed_bars(spark, sf_dir)
    return finish(ti.atr(d, 14, layout=lay).select("series", "ts", "i", "close", "atr14"))


_DM = {
    "sp": ("CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END", 1.0 / 14),
    "sm": ("CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END", 1.0 / 14),
    "st": ("greatest(high - low, abs(high - pc), abs(low - pc))", 1.0 / 14),
}


@query("ti18_adx_nulls", f"{_bars()},\n{_scan('d', 'ib', _DM, 'i >= 1 AND pc IS NOT NULL AND ph IS NOT NULL AND pl IS NOT NULL')},\n"
       """di AS MATERIALIZED (SELECT series, i, 100.0 * sp / NULLIF(st, 0) AS pdi, 100.0 * sm / NULLIF(st, 0) AS mdi FROM d WHERE j >= 13),
dx AS MATERIALIZED (SELECT series, i, CASE WHEN pdi + mdi = 0 THEN 0.0 ELSE 100.0 * abs(pdi - mdi) / (pdi + mdi) END AS dx FROM di),
""" + _scan("x", "dx", {"y": ("dx", 1.0 / 14)}, "i >= 14")
       + _out(", ".join([r("di.pdi", "plus_di"), r("di.mdi", "minus_di"), r("CASE WHEN x.j >= 13 THEN x.y END", "adx14")]), "di", "x"))
def q_adx(spark, sf_dir):
    d, lay = holed_bars(spark, sf_dir)
    return finish(ti.adx(d, 14, layout=lay).select("series", "ts", "i", "close", "plus_di", "minus_di", "adx14"))
