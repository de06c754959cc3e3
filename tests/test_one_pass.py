"""One pass over many operators, sliding statistics and linear models against plain computation."""

import math
import random

import numpy as np
import pytest
from conftest import bars_df
from pyspark.sql import functions as F

from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators import linear as li
from tidecast.operators import models as mo
from tidecast.operators.ordered import Layout, bar_index, one_pass
from tidecast.operators.sliding import sliding

HALO = Layout(mode="halo", chunk_rows=16, bucket_bars=8)


def _rows(n=150, seed=3):
    rng = random.Random(seed)
    return [(k + 2 * (k > 40), 10.0, 12 + rng.random(), 8 + rng.random(), 10 + rng.random(), rng.randrange(9)) for k in range(n)]


def _same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for p, q in zip(x, y):
            assert p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9)), (x, y)


def test_one_pass_equals_the_operators_one_by_one(spark):
    """Recurrences of recurrences, windows of running values, NULL closes, a NULL series and a NULL time."""
    a = bars_df(spark, _rows())
    d = a.unionByName(bars_df(spark, _rows(70, 4), series=None)).withColumn("close", F.when(F.crc32(F.col("ts").cast("string")) % 7 != 0, F.col("close")))
    d = d.unionByName(bars_df(spark, _rows(1)).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    steps = [lambda d, lay: ti.adx(d, 5, layout=lay), lambda d, lay: ti.obv(d, layout=lay), lambda d, lay: fe.lags(d, "obv", [1, 9], layout=lay),
             lambda d, lay: tb.drawdown(d, layout=lay), lambda d, lay: ti.ema(d, 6, col="drawdown", out="dd", layout=lay),
             lambda d, lay: fe.target(d, 3, "return", layout=lay), lambda d, lay: fe.rolling(d, "close", 70, ["mean", "max"], layout=lay), lambda d, lay: fe.calendar(d)]
    plain, halo = one_pass(d, steps), one_pass(d, steps, layout=HALO)
    key = lambda r: (r[0] or "", r[7])
    assert plain.columns[7] == "i" and set(plain.columns) == set(halo.columns)
    _same(sorted(map(tuple, plain.collect()), key=key), sorted(map(tuple, halo.select(plain.columns).collect()), key=key))


@pytest.mark.parametrize("layout", [Layout(), HALO], ids=["plain", "halo"])
def test_sliding_equals_numpy(spark, layout):
    """Windows of one row, about a chunk and more than the series; NULLs; cost per row by blocks above 64."""
    d = bar_index(bars_df(spark, _rows()), layout).withColumn("x", F.when(F.col("i") % 11 != 4, F.col("close")))
    xs = [r.x for r in d.orderBy("i").collect()]
    stats = {"count": len, "sum": sum, "mean": np.mean, "std": np.std, "min": min, "max": max}
    for n in (1, 64, 65, 100, 400):
        out = sliding(d, n, [(s, "x", s) for s in stats], layout=layout).orderBy("i").collect()
        for k, r in enumerate(out):
            window = [v for v in xs[max(0, k - n + 1):k + 1] if v is not None]
            for s, f in stats.items():
                want = f(window) if window or s == "count" else None
                assert (r[s] is None and want is None) or math.isclose(r[s], want, rel_tol=1e-12, abs_tol=1e-12), (n, k, s)


def test_moments_merge_and_ridge(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(5, 2, (200, 3))
    x[:, 2] = x[:, 0] * 2  # dependent
    y = 1 + x[:, 0] - 3 * x[:, 1] + rng.normal(0, 0.1, 200)

    def of(a, b):
        z = np.c_[a, b]
        return li.Moments(len(z), z.mean(axis=0), np.cov(z.T, bias=True)) if len(z) else li.Moments.none(4)

    whole, merged = of(x, y), of(x[:0], y[:0]).merge(of(x[:50], y[:50])).merge(of(x[50:], y[50:]))
    assert np.allclose(whole.mean, merged.mean) and np.allclose(whole.cov, merged.cov)
    a, b = whole.solve()
    assert np.allclose(a + x @ b, np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[0] @ np.c_[np.ones(200), x].T)
    assert li.Moments.none(4).solve() is None
    rows = [(*map(float, r), float(v)) for r, v in zip(x[:, :2], y)] + [(None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "x1 double, `x 2` double, y double")
    model = li.ridge(df, ["x1", "x 2"], "y", reg=0.3)
    cov = np.cov(np.c_[x[:, :2], y].T, bias=True)
    beta = np.linalg.solve(cov[:2, :2] + 0.3 * np.diag(np.diag(cov[:2, :2])), cov[:2, 2])
    got = [r.yhat for r in model.transform(df).collect()]
    assert np.allclose(got[:200], y.mean() + (x[:, :2] - x[:, :2].mean(axis=0)) @ beta) and got[200:202] == [None, None] and got[202] is not None
    assert [r.yhat for r in li.ridge(df.limit(0), ["x1"], "y").transform(df).collect()] == [None] * 203


def test_empty_tables_have_defined_results(spark):
    from tidecast.operators import validation as va
    none = bars_df(spark, [(0, 1, 1, 1, 1, 1)]).limit(0).withColumn("y", F.col("close"))
    assert va.chrono_split(none).collect() == [] and "split" in va.chrono_split(none).columns
    with pytest.raises(ValueError):
        mo.early_stop(none, ["close"], "y")
    curve = mo.learning_curve(none, none, lambda d: mo.linear_forecast(d, ["close"], "y"), "y", fractions=(0.5, 1.0)).collect()
    assert sorted(tuple(r) for r in curve) == [("prefix", 0.5, None), ("prefix", 1.0, None)]
    assert tb.summary(none).collect() == [] and tb.fill_gaps(none.drop("y"), "month", "linear").collect() == []


def test_null_series_keeps_its_rows(spark):
    """NULL is one more series: MO5, MO6, TS7, FE9 and SC1-SC3 keep its rows, with the values of a named one."""
    from tidecast.operators import scenarios as sc
    from tidecast.operators.naive import naive_forecast
    d = bars_df(spark, _rows(60)).unionByName(bars_df(spark, _rows(60), series=None))

    def twins(df, *drop):
        rows = {None: [], "A": []}
        for r in df.collect():
            rows[r.series].append(tuple(sorted((k, str(v)) for k, v in r.asDict().items() if k not in ("series", *drop))))
        assert rows["A"] and sorted(rows["A"]) == sorted(rows[None])

    twins(tb.summary(d))
    twins(fe.scaler(d, ["close"], "2024-01-20 00:00:00"))
    preds = naive_forecast(bar_index(d), h=1, n=5, m=3).withColumn("fold", F.floor(F.dayofyear("ts") / 20).cast("int"))
    twins(mo.ensemble_weighted(preds))
    twins(mo.ensemble_stack(preds, ["naive_last", "naive_ma5"], train_folds=[0, 1]))
    rets = sc.past_log_returns(bar_index(d))
    for paths in (sc.scenario_paths(rets, paths=20, horizon=7), sc.block_scenario_paths(rets, paths=20, horizon=7)):
        found = {r.series: r.n for r in paths.groupBy("series").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert found == {None: 140, "A": 140}
        assert {r.series for r in sc.fan(paths).collect()} == {r.series for r in sc.threshold_probability(paths, 0.1).collect()} == {None, "A"}


def test_long_series_of_returns_are_read_from_their_chunks(spark, monkeypatch):
    from tidecast.operators import scenarios as sc
    rets = sc.past_log_returns(bar_index(bars_df(spark, _rows(90))))
    whole = sorted(map(tuple, sc.scenario_paths(rets, paths=15, horizon=9).collect()))
    monkeypatch.setattr(sc, "CHUNK", 7)
    assert sorted(map(tuple, sc.scenario_paths(rets, paths=15, horizon=9).collect())) == whole
