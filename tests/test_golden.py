"""Golden micro-series (FIXTURES.md §3), in the plain and the halo layout."""

import pytest

from conftest import bars_df
from tidecast.operators import bars as tb
from tidecast.operators import evaluate as ev
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout, bar_index

GOLD = [(0, 10, 11, 9, 10, 100), (1, 10, 12, 10, 11, 200), (2, 11, 13, 11, 12, 150),
        (3, 12, 12, 10, 11, 100), (4, 11, 14, 11, 13, 300)]
N = None
EXPECTED = {
    "ret_simple_1": [N, 0.1, 0.090909, -0.083333, 0.181818],
    "sma3": [N, N, 11, 11.333333, 12],
    "wma3": [N, N, 11.333333, 11.333333, 12.166667],
    "close_std3": [N, N, 0.816497, 0.471405, 0.816497],
    "stoch_k": [N, N, 75, 33.333333, 75],
    "cci3": [N, N, 100, -50, 87.5],
    "vwap3": [N, N, 11.111111, 11.333333, 12.181818],
    "close_slope3": [N, N, 1, 0, 0.5],
    "obv": [0, 200, 350, 250, 550],
    "drawdown": [0, 0, 0, -0.083333, 0],
    "ema": [10, 10.5, 11.25, 11.125, 12.0625],
    # masked by the warm-up rule (RSI(2) needs 2 changes, ATR(2) 2 ranges)
    "rsi2": [N, N, 100, 50, 83.333333],
    "atr2": [N, 2, 2, 2, 2.5],
}

LAYOUTS = [Layout(), Layout(mode="halo", chunk_rows=2, bucket_bars=2)]


@pytest.mark.parametrize("lay", LAYOUTS, ids=["plain", "halo"])
def test_golden(spark, lay):
    d = bar_index(bars_df(spark, GOLD), lay)
    d = tb.returns(d, layout=lay)
    d = ti.sma(d, 3, layout=lay)
    d = ti.wma(d, 3, layout=lay)
    d = fe.rolling(d, "close", 3, ["std"], layout=lay)
    d = ti.stochastic(d, 3, 1, layout=lay)
    d = ti.cci(d, 3, layout=lay)
    d = ti.vwap(d, 3, layout=lay)
    d = fe.rolling_trend(d, "close", 3, layout=lay)
    d = ti.obv(d, layout=lay)
    d = tb.drawdown(d, layout=lay)
    d = ti.ema(d, alpha=0.5, layout=lay)
    d = ti.rsi(d, 2, layout=lay)
    d = ti.atr(d, 2, layout=lay)
    rows = d.orderBy("i").collect()
    for col, want in EXPECTED.items():
        got = [r[col] for r in rows]
        for g, w in zip(got, want):
            if w is None:
                assert g is None, (col, got)
            else:
                assert g == pytest.approx(w, abs=1e-6), (col, got)


def test_metrics_golden(spark):
    p = spark.createDataFrame([("m", "A", 10.0, 11.0), ("m", "A", 12.0, 11.0), ("m", "A", 8.0, 8.0)],
                              "model string, series string, y double, yhat double")
    r = ev.metrics(p).first()
    assert r["rmse"] == pytest.approx(0.816497, abs=1e-6)
    assert r["mae"] == pytest.approx(0.666667, abs=1e-6)
    assert r["mape"] == pytest.approx(6.111111, abs=1e-6)
    assert r["r2"] == pytest.approx(0.75, abs=1e-9)


def test_mape_excludes_zero_actuals(spark):
    p = spark.createDataFrame([("m", "A", 0.0, 1.0), ("m", "A", 10.0, 11.0)],
                              "model string, series string, y double, yhat double")
    r = ev.mape(p).first()
    assert r["mape"] == pytest.approx(10.0)
    assert r["mape_excluded"] == 1


def test_walk_forward_golden(spark):
    from tidecast.operators.validation import WalkForward, walk_forward
    rows = [(d, 1, 1, 1, 1, 1) for d in range(10)]
    d = bars_df(spark, rows)
    out = walk_forward(d, WalkForward(initial=4, test=2, gap=1)).collect()
    by = {}
    for r in out:
        by.setdefault((r["fold"], r["role"]), []).append(r["t"] + 1)  # 1-based steps
    assert sorted(by[(0, "train")]) == [1, 2, 3, 4]
    assert sorted(by[(0, "test")]) == [6, 7]
    assert sorted(by[(1, "train")]) == [1, 2, 3, 4, 5, 6]
    assert sorted(by[(1, "test")]) == [8, 9]
    assert sorted(by[(2, "test")]) == [10]  # the last block is short: no step stays unscored
    assert {k[0] for k in by} == {0, 1, 2}
