"""Registered queries: scenario fans (SC1-SC3) and the streaming extension (X1)."""

from __future__ import annotations

import math
import uuid

from tidecast.operators import scenarios as sc
from tidecast.plans.catalog import query
from tidecast.plans.common import bars_sql, finish, indexed_bars, r, with_bars
from tidecast.session import checkpoint_dir
from tidecast.streaming.bars import events_tick_stream, run_available, stream_bars, stream_session

PATHS, HORIZON, SEED, BLOCK = 1000, 30, 42, 5
U_SQL = "CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) / 4503599627370496.0"


def _rets_sql() -> str:
    return with_bars(extra="""rt AS (SELECT series, i - 1 AS k, ln(close / lag(close) OVER (PARTITION BY series ORDER BY i)) AS r FROM ib),
rets AS (SELECT * FROM rt WHERE k >= 0),
ns AS (SELECT series, count(r) AS n FROM rets GROUP BY series HAVING count(r) > 0)""")


def _paths_sql(kind: str) -> str:
    if kind == "iid":
        key = f"concat_ws('|', '{SEED}', g.series, CAST(path AS VARCHAR), CAST(step AS VARCHAR))"
        k = f"CAST(floor(({U_SQL.format(key=key)}) * n) AS BIGINT)"
        where = ""
    else:
        b = f"CAST(floor((step - 1) / {BLOCK}) AS BIGINT)"
        key = f"concat_ws('|', '{SEED}', g.series, CAST(path AS VARCHAR), 'b' || CAST({b} AS VARCHAR))"
        k = f"CAST(floor(({U_SQL.format(key=key)}) * (n - {BLOCK - 1})) AS BIGINT) + (step - 1) % {BLOCK}"
        where = f"WHERE n >= {BLOCK}"
    return _rets_sql() + f""",
g AS (SELECT series, n, CAST(p AS INTEGER) AS path, CAST(s AS INTEGER) AS step FROM ns, range(0, {PATHS}) t1(p), range(1, {HORIZON + 1}) t2(s) {where}),
dr AS (SELECT g.series, path, step, {k} AS k FROM g),
pt AS (SELECT dr.series, path, step, sum(r) OVER (PARTITION BY dr.series, path ORDER BY step
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_return
       FROM dr JOIN rets ON dr.series = rets.series AND dr.k = rets.k)"""


def _fan_sql(kind: str) -> str:
    qs = ", ".join(r(f"quantile_cont(cum_return, {q})", f"p{int(round(q * 100)):02d}") for q in sc.FAN_QUANTILES)
    return _paths_sql(kind) + f"""
SELECT series, step, count(*) AS paths, {r('avg(cum_return)', 'mean')}, {qs} FROM pt GROUP BY series, step"""


def _rets(spark, sf_dir):
    d, lay = indexed_bars(spark, sf_dir)
    return sc.past_log_returns(d, layout=lay)


@query("sc1_scenario_fan", _fan_sql("iid"))
def q_sc1(spark, sf_dir):
    """SC1: i.i.d. bootstrap fan of 30-day cumulative log returns, 1000 paths per series."""
    return finish(sc.scenario_fan(_rets(spark, sf_dir), paths=PATHS, horizon=HORIZON, seed=SEED))


@query("sc2_block_scenario_fan", _fan_sql("block"))
def q_sc2(spark, sf_dir):
    """SC2: moving-block (5 days) bootstrap fan."""
    return finish(sc.block_scenario_fan(_rets(spark, sf_dir), paths=PATHS, horizon=HORIZON, seed=SEED,
                                        block=BLOCK))


LEVEL = 0.1


@query("sc3_threshold_probability", _paths_sql("iid") + f"""
SELECT series, step, {r(f'avg(CAST(cum_return >= {math.log1p(LEVEL)!r} AS DOUBLE))', 'probability')}, count(*) AS paths
FROM pt GROUP BY series, step""")
def q_sc3(spark, sf_dir):
    """SC3: probability of being 10 % or more up, by horizon."""
    paths = sc.scenario_paths(_rets(spark, sf_dir), paths=PATHS, horizon=HORIZON, seed=SEED)
    return finish(sc.threshold_probability(paths, LEVEL))


# --------------------------------------------------------------- streaming
DELAY_HOURS = 1


@query("x1_stream_bars", f"""WITH bars AS ({bars_sql('events', 'day')}),
wm AS (SELECT max(ts) - INTERVAL {DELAY_HOURS} HOUR AS w FROM events)
SELECT series, ts, {r('open', 'open')}, {r('high', 'high')}, {r('low', 'low')}, {r('close', 'close')}, {r('volume', 'volume')}
FROM bars, wm WHERE ts + INTERVAL 1 DAY <= w""")
def q_x1(spark, sf_dir):
    """X1: day bars from the events file read as a stream (watermark 1 hour,
    append mode): only windows closed by the watermark are emitted."""
    base = checkpoint_dir(spark).rstrip("/")
    run_id = uuid.uuid4().hex
    out, ckpt = f"{base}/stream-bars-{run_id}", f"{base}/stream-ckpt-{run_id}"
    run_available(stream_bars(events_tick_stream(stream_session(spark), sf_dir), "1 day", f"{DELAY_HOURS} hour"), out, ckpt)
    return finish(spark.read.parquet(out).select("series", "ts", "open", "high", "low", "close", "volume"))
