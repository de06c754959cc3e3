"""Boosted trees from histograms against a plain loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import boosting as bo


def plain(x, y, cuts, p):
    """(base, predictions) by trying every split of every node on the raw rows."""
    pred = np.full(len(y), y.mean())
    for _ in range(p.rounds):
        g = pred - y

        def best(rows):
            n, s, out = len(rows), g[rows].sum(), None
            for f in range(x.shape[1]):
                for c in cuts[f]:
                    left = x[rows, f] <= c
                    nl, gl = left.sum(), g[rows][left].sum()
                    if min(nl, n - nl) < max(1, p.min_rows):
                        continue
                    gain = gl ** 2 / (nl + p.reg) + (s - gl) ** 2 / (n - nl + p.reg) - s ** 2 / (n + p.reg)
                    if gain > p.min_gain and (out is None or gain > out[0] + 1e-12):
                        out = (gain, f, c)
            return out

        leaves, done, splits = [(np.arange(len(y)), 0)], [], 0
        while leaves:
            scored = [(best(rows) if depth < p.depth else None, rows, depth) for rows, depth in leaves]
            done += [rows for b, rows, _ in scored if b is None]
            open_ = sorted([s for s in scored if s[0] is not None], key=lambda s: -s[0][0])
            if p.leaves is not None and splits + 1 >= p.leaves:
                done += [rows for _, rows, _ in open_]
                break
            take = open_ if p.leaves is None else open_[:1]
            splits += len(take)
            leaves = [(r, d) for _, r, d in open_ if not any(r is t[1] for t in take)]
            for (_, f, c), rows, depth in take:
                left = x[rows, f] <= c
                leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
        for rows in done:
            pred[rows] += -g[rows].sum() / (len(rows) + p.reg) * p.rate
    return pred


@pytest.mark.parametrize("params", [bo.BoostParams(rounds=2, depth=3, rate=0.5, min_rows=4), bo.BoostParams(rounds=1, depth=4, rate=0.5, reg=0.0, min_rows=3, leaves=5)])
def test_equals_plain_trees(spark, tmp_path, params):
    from pyspark.ml import PipelineModel
    rng = np.random.default_rng(2)
    x = np.c_[rng.normal(size=160), rng.integers(0, 4, 160), rng.normal(size=160)]
    y = np.sin(x[:, 0]) + x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 0.1, 160)
    rows = [(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (900, None, 1.0, 1.0, 1.0), (901, float("nan"), 1.0, 1.0, 1.0), (902, 0.0, 1.0, 1.0, None)], "id int, a double, `b c` double, d double, y double")
    names = ["a", "b c", "d"]
    cuts = bo.bin_cuts(df.where("id < 900"), names, 8)
    state, fits = bo.boost(df, names, "y", cuts, [params], lambda m: F.lit(True))
    want = plain(x, y, cuts, params)
    got = {r.id: r._f[0] if r._f else None for r in state.collect()}
    assert np.allclose([got[k] for k in range(160)], want) and got[900] is None and got[901] is None and got[902] is not None
    path = str(tmp_path / "model")
    fits[0].pipeline().write().save(path)
    back = {r.id: r.yhat for r in PipelineModel.load(path).transform(df).collect()}
    assert all((back[k] is None) == (got[k] is None) and (back[k] is None or abs(back[k] - got[k]) < 1e-12) for k in got)
    assert abs(sum(g for _, g in fits[0].importances()) - 1) < 1e-12


def test_several_fits_at_once_equal_each_alone(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(a), float(b), float(a * b + a)) for k, (a, b) in enumerate(rng.normal(size=(120, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    cuts = bo.bin_cuts(df, ["a", "b"], 6)
    fits = [bo.BoostParams(rounds=1, depth=2), bo.BoostParams(rounds=2, depth=1, rate=0.5)]
    both, _ = bo.boost(df, ["a", "b"], "y", cuts, fits, lambda m: (m == 0) | (F.col("id") < 70))
    got = {r.id: list(r._f) for r in both.collect()}
    for m, (p, on) in enumerate(zip(fits, (F.lit(True), F.col("id") < 70))):
        alone = {r.id: r._f[0] for r in bo.boost(df, ["a", "b"], "y", cuts, [p], lambda _: on)[0].collect()}
        assert all(abs(got[k][m] - alone[k]) < 1e-12 for k in alone)


def test_early_stop_and_nothing_to_fit(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(a), float(b)) for k, (a, b) in enumerate(rng.normal(size=(90, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, y double")  # noise: more rounds do not help
    fit = bo.stopped_forecast(df, ["a"], "y", F.col("id") >= 60, bo.BoostParams(rounds=12, depth=1), patience=2, bins=6)
    assert len(fit.errors) < 12 and len(fit.trees) == fit.errors.index(min(fit.errors)) + 1
    none = bo.boosted_forecast(df.limit(0), ["a"], "y", bo.BoostParams(rounds=1, depth=1))
    assert {r.yhat for r in none.pipeline().transform(df).collect()} == {0.0}
