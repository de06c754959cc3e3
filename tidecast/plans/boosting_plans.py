"""Registered queries of the histogram-boosted trees, on the return features that SQL can
reproduce: stumps of one and two rounds, their importances and errors by round, and one
round on every walk-forward fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import boosting as bo
from tidecast.operators import evaluate as ev
from tidecast.plans.catalog import query
from tidecast.plans.common import finish, r
from tidecast.plans.modelling import _SPLIT_SQL, LABEL, WF_MODELS, _folds_sql, _returns_sql, _split, return_table

WINDOWS = (1, 5, 20)
NAMES = [f"ret_mean{n}" for n in WINDOWS]
BINS = 16
STUMP = bo.BoostParams(rounds=2, depth=1, rate=0.1, reg=1.0, min_rows=5)

_X = "CASE {f} " + " ".join(f"WHEN {k} THEN x{n}" for k, n in enumerate(WINDOWS)) + " END"
_KNOWN = " AND ".join(f"x{n} IS NOT NULL" for n in WINDOWS)


def _boost_sql(rounds: int, bin_rows: str, key: str = "") -> str:
    """CTEs s{r} (training rows with prediction p), best{r} (split of round r) and t{r} (test rows)."""
    by, on = (f"{key}, ", f"USING ({key})") if key else ("", "ON true")
    part = f"PARTITION BY {key} " if key else ""
    ps = ", ".join(f"{k / BINS!r}" for k in range(1, BINS))
    cuts = " UNION ALL ".join(f"SELECT {k} AS f, unnest(list_distinct(quantile_disc(x{n}, [{ps}]))) AS c, max(x{n}) AS top FROM {bin_rows}" for k, n in enumerate(WINDOWS))
    out = [f"cuts AS (SELECT f, c FROM ({cuts}) WHERE c < top)",
           f"s0 AS MATERIALIZED (SELECT *, avg(y) OVER ({part}) AS p FROM tr WHERE y IS NOT NULL AND {_KNOWN})",
           f"base AS (SELECT {by}avg(y) AS p FROM s0{f' GROUP BY {key}' if key else ''})",
           f"t0 AS (SELECT te.*, CASE WHEN {_KNOWN} THEN base.p END AS p FROM te LEFT JOIN base {on})"]
    for k in range(rounds):
        out += [f"cand{k} AS (SELECT {by}f, c, sum(CASE WHEN {_X.format(f='f')} <= c THEN 1 ELSE 0 END) AS nl, "
                f"sum(CASE WHEN {_X.format(f='f')} <= c THEN p - y ELSE 0 END) AS gl, count(*) AS n, sum(p - y) AS g FROM s{k}, cuts GROUP BY {by}f, c)",
                f"gain{k} AS (SELECT *, gl * gl / (nl + 1.0) + (g - gl) * (g - gl) / (n - nl + 1.0) - g * g / (n + 1.0) AS gain FROM cand{k} WHERE nl >= 5 AND n - nl >= 5)",
                f"best{k} AS MATERIALIZED (SELECT {by}f, c, gain, -gl / (nl + 1.0) * {STUMP.rate!r} AS vl, -(g - gl) / (n - nl + 1.0) * {STUMP.rate!r} AS vr FROM gain{k} "
                f"QUALIFY row_number() OVER ({part}ORDER BY gain DESC, f, c) = 1)"]
        for name in ("s", "t"):
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {name}{k}.* REPLACE (p + CASE WHEN {_X.format(f='f')} <= c THEN vl ELSE vr END AS p) FROM {name}{k} LEFT JOIN best{k} {on})")
    return ",\n".join(out)


def _single_sql(rounds: int) -> str:
    return _returns_sql(f"{_SPLIT_SQL.format('m')},\n{_boost_sql(rounds, 'tr')}\n")


def _fit(spark, sf_dir, rounds: int):
    train, test = _split(return_table(spark, sf_dir))
    params = bo.BoostParams(rounds=rounds, depth=1, rate=STUMP.rate, reg=1.0, min_rows=5)
    return bo.boosted_forecast(train, NAMES, LABEL, params, bins=BINS), test


def _predictions(rounds: int):
    def run(spark, sf_dir):
        fit, test = _fit(spark, sf_dir, rounds)
        return finish(fit.pipeline().transform(test).select("series", "ts", F.col(LABEL).alias("y"), "yhat"))
    run.__doc__ = f"MO1: {rounds} round(s) of boosted stumps from histograms; test-period predictions."
    return run


for _rounds, _name in ((1, "mo1_boosted_one_round"), (2, "mo1_boosted_two_rounds")):
    query(_name, _single_sql(_rounds) + f"SELECT series, ts, {r('y', 'y')}, {r('p', 'yhat')} FROM t{_rounds}")(_predictions(_rounds))


@query("mo7_boosted_importance", _single_sql(2) + f"""
SELECT 'ret_mean' || n AS feature, {r("coalesce(sum(gain), 0) / (SELECT sum(gain) FROM (SELECT gain FROM best0 UNION ALL SELECT gain FROM best1))", 'importance')}
FROM (VALUES {', '.join(f'({k}, {n})' for k, n in enumerate(WINDOWS))}) names(k, n) LEFT JOIN (SELECT f, gain FROM best0 UNION ALL SELECT f, gain FROM best1) b ON b.f = k GROUP BY n""")
def q_mo7(spark, sf_dir):
    """MO7: share of the summed gains by feature, two rounds of boosted stumps."""
    fit, _ = _fit(spark, sf_dir, 2)
    return finish(spark.createDataFrame(fit.importances(), "feature string, importance double"))


@query("mo9_boosted_rounds", _single_sql(2) + " UNION ALL ".join(
    f"SELECT CAST({k} AS DOUBLE) AS x, {r('sqrt(avg((y - p) * (y - p)))', 'rmse')} FROM t{k} WHERE y IS NOT NULL AND p IS NOT NULL" for k in (1, 2)))
def q_mo9(spark, sf_dir):
    """MO9: test error after each of two rounds of boosted stumps, noted while fitting."""
    train, test = _split(return_table(spark, sf_dir))
    both = train.withColumn("_test", F.lit(False)).unionByName(test.withColumn("_test", F.lit(True)))
    _, fits = bo.boost(both, NAMES, LABEL, bo.bin_cuts(train, NAMES, BINS), [STUMP], lambda m: ~F.col("_test"), watched=lambda m: F.col("_test"))
    return finish(spark.createDataFrame([(float(k + 1), e) for k, e in enumerate(fits[0].errors)], "x double, rmse double"))


@query("va3_walk_forward_boosted", _returns_sql(_folds_sql(WF_MODELS) + f""",
mt AS (SELECT m.*, t FROM m JOIN cal USING (ts)),
st AS (SELECT folds.*, ts AS start FROM folds JOIN cal ON t = test_lo),
tr AS (SELECT fold, mt.* FROM mt JOIN st ON t < train_hi AND label_ts < start),
te AS (SELECT fold, mt.* FROM mt JOIN st ON t >= test_lo AND t < test_hi),
head AS (SELECT * FROM mt WHERE t < {WF_MODELS.initial}),
{_boost_sql(1, 'head', 'fold')}
""") + f"SELECT series, ts, fold, CAST(0 AS INTEGER) AS point, {r('y', 'y')}, {r('p', 'yhat')} FROM t1")
def q_va3(spark, sf_dir):
    """VA3: one round of boosted stumps on every fold, all folds in one pass."""
    params = bo.BoostParams(rounds=1, depth=1, rate=STUMP.rate, reg=1.0, min_rows=5)
    preds = bo.walk_forward_boosted(return_table(spark, sf_dir), WF_MODELS, NAMES, [params], LABEL, label_ts="label_ts", bins=BINS)
    return finish(preds.select("series", "ts", "fold", "point", F.col(LABEL).alias("y"), "yhat"))


@query("mo10_boosted_search")
def q_mo10(spark, sf_dir):
    """MO10: boosted trees of two depths, three rounds, scored on all folds at once."""
    points = [bo.BoostParams(rounds=3, depth=depth, rate=0.3) for depth in (1, 2)]
    preds = bo.walk_forward_boosted(return_table(spark, sf_dir), WF_MODELS, NAMES, points, LABEL, label_ts="label_ts", bins=BINS)
    scores = preds.withColumn("y", F.col(LABEL)).groupBy("point", "fold").agg(ev.rmse_expr().alias("rmse"))
    return finish(scores.groupBy("point").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_samp("rmse").alias("std_rmse"), F.count("rmse").alias("folds")))
