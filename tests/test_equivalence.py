"""Halo layout == plain layout; blocked scan == sequential loop; stream == batch."""

import math

import pytest

from conftest import SF001
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.naive import naive_forecast
from tidecast.operators.ordered import Layout, bar_index, linear_scan
from tidecast.sources.tables import FIXTURES

HALO = Layout(mode="halo", chunk_rows=64, bucket_bars=16)


def feature_table(bars, lay):
    d = bar_index(bars, lay)
    d = tb.returns(d, "log", 1, out="lr", layout=lay)
    d = fe.lags(d, "close", [1, 5], layout=lay)
    d = fe.rolling(d, "close", 20, layout=lay)
    d = fe.rolling_quantile(d, "close", 10, [0.5], layout=lay)
    d = fe.rolling_trend(d, "close", 10, layout=lay)
    d = fe.target(d, 3, "return", layout=lay)
    d = ti.wma(d, 5, layout=lay)
    d = ti.stochastic(d, 14, 3, layout=lay)
    d = ti.cci(d, 20, layout=lay)
    d = ti.mfi(d, 14, layout=lay)
    d = ti.obv(d, layout=lay)
    d = ti.adl(d, layout=lay)
    d = tb.drawdown(d, layout=lay)
    d = ti.macd(d, layout=lay)
    d = ti.rsi(d, 14, layout=lay)
    d = ti.adx(d, 14, layout=lay)
    return d


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("fixture,freq", [("orders", "day"), ("events", "hour")])
def test_halo_equals_plain(spark, fixture, freq):
    bars = tb.ticks_to_bars(FIXTURES[fixture](spark, SF001), freq).cache()
    plain = {(r["series"], r["ts"]): r for r in feature_table(bars, Layout()).collect()}
    halo = feature_table(bars, HALO.with_mode("halo", bar_seconds=tb.freq_seconds(freq))).collect()
    assert len(plain) == len(halo)
    bars.unpersist()
    for r in halo:
        p = plain[(r["series"], r["ts"])]
        for k in r.asDict():
            assert _close(r[k], p[k]), (k, r[k], p[k])


def test_halo_index_equals_row_number(spark):
    bars = tb.ticks_to_bars(FIXTURES["lineitem"](spark, SF001), "day")
    a = {(r["series"], r["ts"]): r["i"] for r in bar_index(bars, Layout()).collect()}
    b = {(r["series"], r["ts"]): r["i"] for r in bar_index(bars, HALO).collect()}
    assert a == b


def test_fill_gaps_halo_equals_plain(spark):
    bars = tb.ticks_to_bars(FIXTURES["events"](spark, SF001), "hour")
    a = sorted(tuple(r) for r in tb.fill_gaps(bars, "hour").collect())
    b = sorted(tuple(r) for r in tb.fill_gaps(bars, "hour", layout=HALO.with_mode("halo", bar_seconds=3600),
                                               bucket_bars=7).collect())
    assert a == b


@pytest.mark.parametrize("alpha", [0.001, 0.05, 2 / 27, 0.5, 0.9])
@pytest.mark.parametrize("lay", [Layout(), HALO], ids=["plain", "halo"])
def test_blocked_scan_equals_loop(spark, alpha, lay):
    bars = tb.ticks_to_bars(FIXTURES["events"](spark, SF001), "hour")
    d = linear_scan(bar_index(bars, lay.with_mode(lay.mode, bar_seconds=3600)), "close", alpha, "y", layout=lay)
    rows = sorted(d.select("series", "i", "close", "y").collect())
    state = {}
    for s, i, x, y in rows:
        prev = state.get(s)
        want = x if prev is None else alpha * x + (1 - alpha) * prev
        state[s] = want
        assert y == pytest.approx(want, rel=1e-12, abs=1e-12 * abs(want) + 1e-12)


def test_naive_halo_equals_plain(spark):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    a = sorted(tuple(r) for r in naive_forecast(bar_index(bars, Layout())).collect())
    b = sorted(tuple(r) for r in naive_forecast(bar_index(bars, HALO), layout=HALO).collect())
    assert a == b


def test_stream_bars_equal_batch_on_closed_windows(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidecast.streaming.bars import events_tick_stream, run_available, stream_bars
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    run_available(stream_bars(events_tick_stream(spark, SF001), "1 day", "1 hour"), out, ck)
    streamed = {(r["series"], r["ts"]): r for r in spark.read.parquet(out).collect()}
    batch = tb.ticks_to_bars(FIXTURES["events"](spark, SF001), "day")
    wm = FIXTURES["events"](spark, SF001).agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = [r for r in batch.collect() if r["ts"] + dt.timedelta(days=1) <= wm - dt.timedelta(hours=1)]
    assert len(closed) == len(streamed) > 0
    for r in closed:
        s = streamed[(r["series"], r["ts"])]
        for c in ("open", "high", "low", "close", "volume"):
            assert s[c] == pytest.approx(r[c])


def test_layout_rule():
    from tidecast.operators.ordered import choose_layout
    # small data: plain
    assert choose_layout(2_400, 12_000, 8)[0] == "plain"
    # one series beyond a task's limit: halo
    assert choose_layout(3_000_000, 3_000_000, 8)[0] == "halo"
    # five long series on a large cluster: halo, chunks sized for ~2 per core
    mode, chunk = choose_layout(20_000_000, 100_000_000, 4000)
    assert mode == "halo" and chunk == 1 << 16
    # many short series: plain even when the total is huge
    assert choose_layout(5_000, 10_000_000_000, 4000)[0] == "plain"
    assert choose_layout(300_000, 100_000_000, 8)[1] == 1 << 20


def test_hot_series_auto_layout(spark):
    """One series with about a third of all ticks: the auto rule picks the halo
    layout (thresholds lowered to the fixture's size) and results equal plain."""
    from pyspark.sql import functions as F
    ticks = FIXTURES["lineitem"](spark, SF001)
    hot = ticks.withColumn("series", F.when(F.col("series").cast("long") % 3 == 0, F.lit("hot"))
                           .otherwise(F.col("series")))
    bars = tb.ticks_to_bars(hot, "day").cache()
    lay = Layout.auto(hot, bar_seconds=86400, max_plain_rows=400, min_halo_rows=100)
    assert lay.mode == "halo"
    lay = lay.with_mode("halo", chunk_rows=128, bucket_bars=32)
    plain = {(r["series"], r["ts"]): r for r in feature_table(bars, Layout()).collect()}
    halo = feature_table(bars, lay).collect()
    bars.unpersist()
    assert len(halo) == len(plain)
    for r in halo:
        p = plain[(r["series"], r["ts"])]
        for k in r.asDict():
            assert _close(r[k], p[k]), (k, r[k], p[k])
