"""Linear models from moments: least squares and ridge by normal equations.

A fit needs the rows' count, means and covariances, nothing else.  They are one hash
aggregate with partial aggregation, centred as it goes (no cancellation of raw sums), and
moments of disjoint row sets merge (Chan's formula).  So all walk-forward folds and all
grid points come from one scan: rows are aggregated by the range of folds that train on
them, and each fold's moments are merged from those few groups on the driver (folds x
features² numbers, a matter of parameters, not of rows).

A fitted model is a ``PipelineModel`` of one SQL stage, so it is saved and loaded like any
other.  Ridge penalises standardised coefficients: (1 / 2n) |y - a - Xb|² + (reg / 2) sum
var(x_j) b_j², that is, the diagonal of the covariance matrix times 1 + reg.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.operators.validation import WalkForward, fold_ranges


def known(cols: Sequence[str]) -> Column:
    """True where every column is neither NULL nor NaN."""
    return F.expr(known_sql(cols))


def known_sql(cols: Sequence[str]) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(CAST(`{c}` AS DOUBLE))" for c in cols)


@dataclass(frozen=True)
class Moments:
    """Count, means and population covariances of the features and, last, the label."""

    n: int
    mean: np.ndarray
    cov: np.ndarray

    @staticmethod
    def none(size: int) -> "Moments":
        return Moments(0, np.zeros(size), np.zeros((size, size)))

    def merge(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return other if other.n else self
        apart = other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        cov = (self.cov * self.n + other.cov * other.n + np.outer(apart, apart) * (self.n * other.n / n)) / n
        return Moments(n, mean, cov)

    def solve(self, reg: float = 0.0) -> tuple[float, list[float]] | None:
        """(intercept, coefficients); None without rows.  Where features are dependent, the
        shortest coefficients (in units of the features' deviations)."""
        if not self.n:
            return None
        scale = np.sqrt(np.diag(self.cov)[:-1])
        scale = np.where(scale > 0, scale, 1.0)
        a = self.cov[:-1, :-1] / np.outer(scale, scale)
        a = a + reg * np.diag(np.diag(a))
        c = self.cov[:-1, -1] / scale
        b = np.linalg.lstsq(a, c, rcond=1e-13)[0] if np.linalg.matrix_rank(a, tol=1e-12) < len(c) else np.linalg.solve(a, c)
        b = b / scale
        return float(self.mean[-1] - b @ self.mean[:-1]), [float(x) for x in b]


def moment_columns(features: Sequence[str], label: str, prefix: str = "") -> list[Column]:
    """Aggregates over the rows on which all features and the label are known."""
    ok = known([*features, label])
    x = [F.when(ok, F.col(c).cast("double")) for c in (*features, label)]
    out = [F.count(x[-1]).alias(f"{prefix}n")] + [F.avg(c).alias(f"{prefix}m{i}") for i, c in enumerate(x)]
    return out + [F.covar_pop(x[i], x[j]).alias(f"{prefix}c{i}_{j}") for i in range(len(x)) for j in range(i + 1)]


def moments_of(row: Row, size: int, prefix: str = "") -> Moments:
    if not row[f"{prefix}n"]:
        return Moments.none(size)
    cov = np.zeros((size, size))
    for i in range(size):
        for j in range(i + 1):
            cov[i, j] = cov[j, i] = row[f"{prefix}c{i}_{j}"]
    return Moments(row[f"{prefix}n"], np.array([row[f"{prefix}m{i}"] for i in range(size)]), cov)


def linear_model(features: Sequence[str], solution: tuple[float, list[float]] | None) -> PipelineModel:
    """Adds ``yhat``, NULL where a feature is unknown (or where nothing was fitted)."""
    if solution is None:
        formula = "CAST(NULL AS DOUBLE)"
    else:
        a, b = solution
        formula = " + ".join([f"CAST('{a!r}' AS DOUBLE)"] + [f"CAST('{x!r}' AS DOUBLE) * `{c}`" for c, x in zip(features, b)])
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CASE WHEN {known_sql(features)} THEN {formula} END AS yhat FROM __THIS__")])


def ridge(train: DataFrame, features: Sequence[str], label: str, *, reg: float = 0.0) -> PipelineModel:
    """Least squares (ridge with ``reg``) from one aggregate over ``train``."""
    row = train.agg(*moment_columns(features, label)).first()
    return linear_model(features, moments_of(row, len(features) + 1).solve(reg))


def walk_forward_linear(df: DataFrame, spec: WalkForward, points: Sequence[tuple[Sequence[str], float]], label: str, *,
                        label_ts: str | None = None) -> DataFrame:
    """VA3 and MO10 for linear models: every test row's prediction by the model fitted on its
    fold's training rows, for every point (features, reg), from one scan for the fits and one
    for the predictions.  ``df`` carries the step number ``t``; training rows and the purge by
    ``label_ts`` are those of ``walk_forward_run``.  Appends ``fold``, ``point`` and ``yhat``."""
    d = fold_ranges(df, spec)
    starts = {r["test_fold"]: r["s"] for r in  # one row per fold
              d.where("test_fold IS NOT NULL").groupBy("test_fold").agg(F.min(ntz_micros(F.col("ts"))).alias("s")).collect()}
    folds = sorted(starts)
    subsets = list(dict.fromkeys(tuple(features) for features, _ in points))
    enter = F.col("train_from")
    if label_ts:  # the first fold whose test block starts after the label is known
        ordered = F.array(*[F.lit(starts[k]).cast("long") for k in folds]) if folds else F.array().cast("array<bigint>")
        places = F.array(*[F.lit(k) for k in folds], F.lit(1 << 30))
        late = F.size(F.filter(ordered, lambda s: s <= ntz_micros(F.col(label_ts))))
        enter = F.greatest(enter, F.when(F.col(label_ts).isNotNull(), F.get(places, late)).otherwise(F.lit(1 << 30)))
    trained = d.select(enter.alias("_e"), F.col("train_to").alias("_l"), label, *dict.fromkeys(c for s in subsets for c in s)).where("_e <= _l")
    aggs = [c for k, s in enumerate(subsets) for c in moment_columns(s, label, f"s{k}_")]
    groups = trained.groupBy("_e", "_l").agg(*aggs).collect()  # ranges of folds, about as many as folds
    parts = [(g["_e"], g["_l"], [moments_of(g, len(s) + 1, f"s{k}_") for k, s in enumerate(subsets)]) for g in groups]
    fits = []
    for fold in folds:
        of = [Moments.none(len(s) + 1) for s in subsets]
        for e, last, moments in sorted(parts, key=lambda p: p[:2]):
            if e <= fold <= last:
                of = [m.merge(o) for m, o in zip(of, moments)]
        for point, (features, reg) in enumerate(points):
            solution = of[subsets.index(tuple(features))].solve(reg)
            if solution is not None:
                fits.append((fold, point, *solution))
    table = df.sparkSession.createDataFrame(fits, "_fold int, point int, _a double, _b array<double>")  # folds x points
    tested = d.where("test_fold IS NOT NULL").withColumnRenamed("test_fold", "fold").drop("train_from", "train_to")
    every = tested.withColumn("_p", F.explode(F.array(*[F.lit(k) for k in range(len(points))])))
    joined = every.join(F.broadcast(table), (F.col("fold") == F.col("_fold")) & (F.col("_p") == F.col("point")), "left")
    yhat = F.lit(None).cast("double")
    for point, (features, _) in enumerate(points):
        value = F.col("_a")
        for j, c in enumerate(features):
            value = value + F.get("_b", F.lit(j)) * F.col(c)
        yhat = F.when(F.col("_p") == point, F.when(known(features), value)).otherwise(yhat)
    return joined.withColumns({"yhat": yhat, "point": F.col("_p")}).drop("_p", "_fold", "_a", "_b")


def linear_search(df: DataFrame, spec: WalkForward, points: Sequence[tuple[Sequence[str], float]], label: str, *,
                  label_ts: str | None = None) -> DataFrame:
    """MO10 over linear models: mean and std over folds of each point's RMSE; ``params`` names
    its features and penalty, ``best`` marks the lowest mean (ties: the first point)."""
    from tidecast.operators import evaluate as ev

    preds = walk_forward_linear(df, spec, points, label, label_ts=label_ts).withColumn("y", F.col(label))
    named = F.array(*[F.lit(f"{' '.join(features)} {reg}") for features, reg in points])
    scores = preds.groupBy("point", "fold").agg(ev.rmse_expr().alias("rmse"))
    summary = scores.groupBy("point").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_samp("rmse").alias("std_rmse"), F.count("rmse").alias("folds"))
    best = summary.orderBy(F.col("mean_rmse").asc_nulls_last(), "point").first()  # one row
    return summary.select("point", F.get(named, F.col("point")).alias("params"), "mean_rmse", "std_rmse", "folds",
                          (F.col("point") == F.lit(best["point"] if best else None)).alias("best"))
