"""Sliding statistics over windows wider than a chunk of the halo checks: FE2, FE4 and
TI5-TI7 at n = 500 on daily order bars (F1), FE2 at n = 2000 too, FE4 with NULL closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout
from tidecast.plans.catalog import W, query, warm_sql, wn
from tidecast.plans.common import finish, indexed_bars, r, with_bars

N, WIDE = 500, 2000
HOLE = 971  # one close in so many is NULL


def _holed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    d, lay = indexed_bars(spark, sf_dir)
    return d.withColumn("close", F.when(F.col("i") % HOLE != 13, F.col("close"))), lay


def _sql(columns: str) -> str:
    return with_bars(extra=f"h AS (SELECT series, ts, i, CASE WHEN i % {HOLE} <> 13 THEN close END AS close FROM ib)") + \
        f"SELECT series, ts, i, {r('close', 'close', 2)}, {columns} FROM h {W}"


@query("fe2_rolling_wide", with_bars() + f"SELECT series, ts, i, {r('close', 'close', 2)}, " + ", ".join(
    r(warm_sql(n, f"{f}(close) OVER {wn(n)}"), f"close_{s}{n}", d)
    for n in (N, WIDE) for s, f, d in (("mean", "avg", 6), ("std", "stddev_pop", 2), ("min", "min", 2), ("max", "max", 2), ("sum", "sum", 2))) + f" FROM ib {W}")
def q_fe2(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    d = fe.rolling(fe.rolling(d, "close", N, layout=lay), "close", WIDE, layout=lay)
    names = [f"close_{s}{n}" for n in (N, WIDE) for s in ("mean", "std", "min", "max", "sum")]
    return finish(d.select("series", "ts", "i", "close", *names), digits=2, by={f"close_mean{n}": 6 for n in (N, WIDE)})


@query("fe4_zscore_wide", _sql(r(f"CASE WHEN count(close) OVER {wn(N)} >= {N} THEN (close - avg(close) OVER {wn(N)}) / NULLIF(stddev_pop(close) OVER {wn(N)}, 0) END", "close_z500", 5)))
def q_fe4(spark, sf_dir):
    """A window over a NULL close holds fewer than 500 values, so its z-score is NULL."""
    d, lay = _holed(spark, sf_dir)
    return finish(fe.zscore(d, "close", N, layout=lay).select("series", "ts", "i", "close", "close_z500"), digits=5, by={"close": 2})


_HL = f"max(high) OVER {wn(N)}", f"min(low) OVER {wn(N)}"


@query("ti5_donchian_wide", with_bars() + f"SELECT series, ts, i, {r('close', 'close', 2)}, " + ", ".join([
    r(warm_sql(N, _HL[0]), "dc_high", 2), r(warm_sql(N, _HL[1]), "dc_low", 2), r(warm_sql(N, f"({_HL[0]} + {_HL[1]}) / 2"), "dc_mid", 3)]) + f" FROM ib {W}")
def q_ti5(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.donchian(d, N, layout=lay).select("series", "ts", "i", "close", "dc_high", "dc_low", "dc_mid"), digits=2, by={"dc_mid": 3})


@query("ti6_stochastic_wide", with_bars(extra=f"""k AS (SELECT *, {warm_sql(N, f"100.0 * (close - {_HL[1]}) / NULLIF({_HL[0]} - {_HL[1]}, 0)")} AS stoch_k FROM ib {W})""")
       + f"""SELECT series, ts, i, {r('close', 'close', 2)}, {r('stoch_k', 'stoch_k', 5)},
  {r(f"CASE WHEN count(stoch_k) OVER {wn(100)} >= 100 THEN avg(stoch_k) OVER {wn(100)} END", 'stoch_d', 5)} FROM k {W}""")
def q_ti6(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.stochastic(d, N, 100, layout=lay).select("series", "ts", "i", "close", "stoch_k", "stoch_d"), digits=5, by={"close": 2})


@query("ti7_williams_r_wide", with_bars() + f"SELECT series, ts, i, {r('close', 'close', 2)}, "
       + r(warm_sql(N, f"-100.0 * ({_HL[0]} - close) / NULLIF({_HL[0]} - {_HL[1]}, 0)"), "willr500", 5) + f" FROM ib {W}")
def q_ti7(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return finish(ti.williams_r(d, N, layout=lay).select("series", "ts", "i", "close", "willr500"), digits=5, by={"close": 2})
