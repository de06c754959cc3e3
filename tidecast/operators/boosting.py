"""Boosted regression trees from histograms, many fits in one pass over the rows.

Features are binned once.  A level of a tree needs, for each open node, feature and bin,
the number of rows and the sum of residuals: one hash aggregate with partial aggregation
gives them for **all folds and all grid points** together.  Of two sibling nodes only the
smaller is counted; the other is its parent minus it.  The histograms (fits x nodes x
features x bins numbers, a matter of parameters, not of rows) come to the driver, which
picks the splits; the trees go back as literals of the next job.

Squared loss, regularised gain G_l²/(n_l + reg) + G_r²/(n_r + reg) - G²/(n + reg), leaf
values -G/(n + reg) times the learning rate, first prediction the mean label.  With
``leaves`` a tree grows best leaf first up to that many leaves, else level by level.

A row's state is one array, its prediction by every fit so far; it is cut from its lineage
every ``CUT`` rounds.  A fitted ensemble is a ``PipelineModel`` of one SQL stage that reads
the raw features, so it is saved and loaded like any other.
"""

from __future__ import annotations

import heapq
import random
from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.operators.linear import known, known_sql
from tidecast.operators.validation import WalkForward, fold_ranges
from tidecast.session import cut_lineage

CUT = 8  # rounds between two cuts of the rows' lineage
ACCURACY = 100_000  # of the sketch that gives the bins' borders


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 40
    depth: int = 5
    rate: float = 0.1
    reg: float = 1.0          # added to a node's rows
    min_gain: float = 1e-12
    min_rows: int = 5         # in each child
    leaves: int | None = None  # best leaf first, up to so many
    features: float = 1.0     # share of the features that a tree may use (seeded)
    seed: int = 7


# Named presets for the two boosters: level-wise with regularised gain, and leaf-wise.
PRESETS = {
    "xgb": BoostParams(rounds=40, depth=5, rate=0.1, reg=1.0, min_rows=5),
    "lgbm": BoostParams(rounds=60, depth=6, rate=0.05, reg=0.0, min_rows=20, leaves=31, features=0.5),
}


@dataclass
class Tree:
    """Nodes in heap order (children of k: 2k+1, 2k+2); feature -1 marks a leaf."""

    feature: list[int]
    bin: list[int]
    gain: list[float]
    value: list[float]


@dataclass
class Ensemble:
    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)  # RMSE on watched rows after each round

    def pipeline(self, rounds: int | None = None) -> PipelineModel:
        """Adds ``yhat`` by the first ``rounds`` trees, NULL where a feature is unknown."""
        trees = self.trees[:rounds]

        def numbers(xs, kind: str) -> str:
            return f"array({', '.join(str(x) if kind == 'INT' else f'DOUBLE({x!r})' if np.isfinite(x) else 'DOUBLE(0)' for x in xs)})"

        def one(t: Tree) -> str:
            cut = [self.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)]
            return f"struct({numbers(t.feature, 'INT')} AS f, {numbers(cut, 'DOUBLE')} AS c, {numbers(t.value, 'DOUBLE')} AS v)"

        x = f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in self.features)})"
        depth = max((_depth(t) for t in trees), default=0)
        node = f"aggregate(sequence(1, {max(1, depth)}), 0, (k, s) -> CASE WHEN get(t.f, k) < 0 THEN k WHEN get({x}, get(t.f, k)) <= get(t.c, k) THEN 2 * k + 1 ELSE 2 * k + 2 END)"
        total = f"aggregate(array({', '.join(map(one, trees))}), DOUBLE({self.base!r}), (total, t) -> total + get(t.v, {node}))" if trees else f"DOUBLE({self.base!r})"
        return PipelineModel([SQLTransformer(statement=f"SELECT *, CASE WHEN {known_sql(self.features)} THEN {total} END AS yhat FROM __THIS__")])

    def importances(self) -> list[tuple[str, float]]:
        """Share of the summed gains that each feature's splits bring (0 for all without a split)."""
        gains = [0.0] * len(self.features)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    gains[f] += g
        total = sum(gains)
        return [(name, g / total if total else 0.0) for name, g in zip(self.features, gains)]


def _depth(t: Tree) -> int:
    return max(((k + 1).bit_length() for k, f in enumerate(t.feature) if f >= 0), default=0)


def bin_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Per feature, increasing borders at the k/bins quantiles of its known values, without the greatest value."""
    ps = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.when(known([c]), F.col(c).cast("double")), ps, ACCURACY).alias(f"q{j}") for j, c in enumerate(features)],
                 *[F.max(F.when(known([c]), F.col(c).cast("double"))).alias(f"m{j}") for j, c in enumerate(features)]).first()
    return [sorted({q for q in row[f"q{j}"] or () if q < row[f"m{j}"]}) for j in range(len(features))]


def _bin(x: Column, cuts: list[float]) -> Column:
    """Number of borders below x: a border's own value is left of it."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c < x))


def _literal(rows: Sequence[Sequence], kind: str) -> Column:
    """array<array<kind>> of the plan."""
    body = ", ".join(f"array({', '.join(('CAST(NULL AS DOUBLE)' if x is None else f'DOUBLE({x!r})') if kind == 'DOUBLE' else str(x) for x in row)})" for row in rows)
    return F.expr(f"array({body})")


def _walk(trees: Sequence[Tree], m: Column, levels: int) -> Column:
    """Heap number of the node that a row reaches in the tree of fit ``m``."""
    feature, bin_ = _literal([t.feature for t in trees], "INT"), _literal([t.bin for t in trees], "INT")

    def down(k: Column, _: Column) -> Column:
        f = F.get(F.get(feature, m), k)
        left = F.get("_bin", f) <= F.get(F.get(bin_, m), k)
        return F.when(f < 0, k).when(left, 2 * k + 1).otherwise(2 * k + 2)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), down) if levels else F.lit(0)


class _Growing:
    """One fit's tree while it grows: histograms of its open nodes and their best splits."""

    def __init__(self, p: BoostParams, cuts: list[list[float]], usable: set[int]):
        self.p, self.cuts, self.usable = p, cuts, usable
        size = (1 << (p.depth + 1)) - 1
        self.hist: dict[int, np.ndarray] = {}  # node -> (features, bins, 2): rows, residuals
        self.total: dict[int, tuple[float, float]] = {}
        self.split: dict[int, tuple[float, int, int]] = {}
        self.tree = Tree([-1] * size, [0] * size, [0.0] * size, [0.0] * size)

    def take(self, node: int, hist: np.ndarray) -> None:
        """A node's histogram; its best split, if any, is opened."""
        p = self.p
        n, g = float(hist[0, :, 0].sum()), float(hist[0, :, 1].sum())
        self.hist[node], self.total[node] = hist, (n, g)
        if node >= (1 << p.depth) - 1 or not n:
            return
        left = hist.cumsum(axis=1)
        nl, gl = left[..., 0], left[..., 1]
        nr, gr = n - nl, g - gl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl * gl / (nl + p.reg) + gr * gr / (nr + p.reg) - g * g / (n + p.reg)
        bad = (nl < max(1, p.min_rows)) | (nr < max(1, p.min_rows)) | ~np.isfinite(gain)
        for f in range(len(self.cuts)):
            bad[f, len(self.cuts[f]):] = True
            if f not in self.usable:
                bad[f] = True
        gain = np.where(bad, -np.inf, gain)
        best = int(np.argmax(gain))
        f, b = divmod(best, gain.shape[1])
        if gain[f, b] > p.min_gain:
            self.split[node] = (float(gain[f, b]), f, b)
            self.tree.feature[node], self.tree.bin[node], self.tree.gain[node] = f, b, float(gain[f, b])

    def children(self, node: int) -> tuple[int, int]:
        """(smaller child, larger child) of a split node."""
        _, f, b = self.split[node]
        left = self.hist[node][f, :b + 1, 0].sum()
        return (2 * node + 1, 2 * node + 2) if 2 * left <= self.total[node][0] else (2 * node + 2, 2 * node + 1)

    def finish(self) -> Tree:
        """Leaf-wise: only the splits that best-first growth reaches; then the leaves' values."""
        kept = set(self.split)
        if self.p.leaves is not None:
            kept, open_ = set(), [(-self.split[0][0], 0)] if 0 in self.split else []
            while open_ and len(kept) + 1 < self.p.leaves:
                _, node = heapq.heappop(open_)
                kept.add(node)
                for child in (2 * node + 1, 2 * node + 2):
                    if child in self.split:
                        heapq.heappush(open_, (-self.split[child][0], child))
        t = self.tree
        for k in range(len(t.feature)):
            if k not in kept:
                t.feature[k], t.bin[k], t.gain[k] = -1, 0, 0.0
            n, g = self.total.get(k, (0.0, 0.0))
            t.value[k] = -g / (n + self.p.reg) * self.p.rate if n else 0.0
        return t


def boost(rows: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]], fits: Sequence[BoostParams],
          trains: Callable[[Column], Column], *, watched: Callable[[Column], Column] | None = None,
          stop: Callable[[list[list[float]]], bool] | None = None) -> tuple[DataFrame, list[Ensemble]]:
    """Fits all of ``fits`` (their places are the fit numbers m) on the rows for which
    ``trains(m)`` holds, and gives ``rows`` with ``_f``, the array of every fit's prediction.

    Rows with an unknown feature get a NULL ``_f``; rows with an unknown label train nothing.
    ``watched(m)``: rows whose RMSE is noted after each round; ``stop`` sees these errors
    (fit by fit) and ends the fitting when it returns true.
    """
    p, count = len(features), len(fits)
    fit_numbers = F.sequence(F.lit(0), F.lit(count - 1))
    width = max(len(c) for c in cuts) + 1
    bins = F.array(*[_bin(F.col(name).cast("double"), c) for name, c in zip(features, cuts)])
    y = F.col(label).cast("double")
    usable_row = known(features)
    d = rows.withColumns({"_bin": F.when(usable_row, bins), "_y": F.when(known([label]), y)})
    ones = F.transform(fit_numbers, lambda m: F.when(trains(m) & F.col("_y").isNotNull() & F.col("_bin").isNotNull(), F.col("_y")))
    d = cut_lineage(d.withColumn("_on", F.transform(ones, lambda v: v.isNotNull())))
    means = d.agg(*[F.avg(F.when(F.get("_on", F.lit(m)), F.col("_y"))).alias(f"m{m}") for m in range(count)]).first()
    bases = [means[f"m{m}"] or 0.0 for m in range(count)]
    ensembles = [Ensemble(list(features), cuts, b) for b in bases]
    d = d.withColumn("_f", F.when(F.col("_bin").isNotNull(), F.array(*[F.lit(float(b)) for b in bases])))
    rng = [random.Random(f.seed) for f in fits]
    none = Tree([-1], [0], [0.0], [0.0])

    def histograms(trees: Sequence[Tree], wanted: list[list[int]], level: int) -> dict[tuple[int, int], np.ndarray]:
        want = _literal([w or [-1] for w in wanted], "INT")
        active = F.filter(fit_numbers, lambda m: F.get("_on", m))
        at = F.transform(active, lambda m: F.struct(m.alias("m"), _walk(trees, m, level).alias("node"), (F.get("_f", m) - F.col("_y")).alias("g")))
        at = F.filter(at, lambda s: F.array_contains(F.get(want, s["m"]), s["node"]))
        each = d.where("_bin IS NOT NULL AND _y IS NOT NULL").select("_bin", F.explode(at).alias("_s"))
        each = each.select("_s.m", "_s.node", "_s.g", F.posexplode("_bin").alias("feature", "bin"))
        found = each.groupBy("m", "node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("g")).toPandas()
        out: dict[tuple[int, int], np.ndarray] = {}
        for (m, node), part in found.groupby(["m", "node"]):
            h = np.zeros((p, width, 2))
            h[part["feature"].to_numpy(), part["bin"].to_numpy()] = part[["n", "g"]].to_numpy()
            out[int(m), int(node)] = h
        return out

    for done in range(max((f.rounds for f in fits), default=0)):
        growing = {}
        for m, f in enumerate(fits):
            if done < f.rounds:
                k = max(1, round(f.features * p))
                growing[m] = _Growing(f, cuts, set(range(p)) if k == p else set(rng[m].sample(range(p), k)))
        wanted = [[0] if m in growing else [] for m in range(count)]
        level = 0
        while any(wanted):
            trees = [growing[m].tree if m in growing else none for m in range(count)]
            found = histograms(trees, wanted, level)
            following: list[list[int]] = [[] for _ in range(count)]
            for m, grow in growing.items():
                for node in wanted[m]:
                    hist = found.get((m, node), np.zeros((p, width, 2)))
                    grow.take(node, hist)
                    if node:
                        other = node + 1 if node % 2 else node - 1
                        grow.take(other, grow.hist[(node - 1) // 2] - hist)
                for node in [k for k in grow.split if (k + 1).bit_length() == level + 1]:
                    following[m].append(grow.children(node)[0])
            wanted, level = following, level + 1
        trees = []
        for m in range(count):
            trees.append(growing[m].finish() if m in growing else none)
            if m in growing:
                ensembles[m].trees.append(trees[-1])
        levels = max(map(_depth, trees))
        values = _literal([t.value for t in trees], "DOUBLE")
        d = d.withColumn("_f", F.when(F.col("_f").isNotNull(), F.transform(
            fit_numbers, lambda m: F.get("_f", m) + F.get(F.get(values, m), _walk(trees, m, levels)))))
        if (done + 1) % CUT == 0:
            d = cut_lineage(d)
        if watched is not None:
            error = d.agg(*[F.sqrt(F.avg(F.when(watched(F.lit(m)) & F.col("_y").isNotNull(), (F.col("_y") - F.get("_f", F.lit(m))) ** 2))).alias(f"e{m}") for m in range(count)]).first()
            for m in growing:
                ensembles[m].errors.append(error[f"e{m}"])
            if stop is not None and stop([e.errors for e in ensembles]):
                break
    return d.drop("_bin", "_y", "_on"), ensembles


def boosted_forecast(train: DataFrame, features: Sequence[str], label: str, params: BoostParams = PRESETS["xgb"], *, bins: int = 32) -> Ensemble:
    """MO1: one boosted ensemble on all rows of ``train`` with known features and label."""
    return boost(train, features, label, bin_cuts(train, features, bins), [params], lambda m: F.lit(True))[1][0]


def stopped_forecast(df: DataFrame, features: Sequence[str], label: str, is_validation: Column, params: BoostParams = PRESETS["xgb"], *,
                     tol: float = 0.01, patience: int = 3, bins: int = 32) -> Ensemble:
    """MO2: fits on the rows that are not for validation and stops when the error on those
    that are has not fallen by ``tol`` (a share of it) in ``patience`` rounds; keeps the trees up to the best round."""
    validation = F.coalesce(is_validation, F.lit(False))

    def stale(errors: list[list[float]]) -> bool:
        e = [x if x is not None else float("inf") for x in errors[0]]
        return len(e) > patience and min(e[-patience:]) > min(e[:-patience]) * (1 - tol)

    fit = boost(df.withColumn("_val", validation), features, label, bin_cuts(df.where(~validation), features, bins), [params],
                lambda m: ~F.col("_val"), watched=lambda m: F.col("_val"), stop=stale)[1][0]
    known_errors = [(e, k) for k, e in enumerate(fit.errors) if e is not None]
    if known_errors:
        fit.trees = fit.trees[:min(known_errors)[1] + 1]
    return fit


def walk_forward_boosted(df: DataFrame, spec: WalkForward, features: Sequence[str], points: Sequence[BoostParams], label: str, *,
                         label_ts: str | None = None, bins: int = 32) -> DataFrame:
    """VA3 and MO10 for boosted trees: every test row's prediction by its fold's fit, for
    every point, all fits in one pass a level.  ``df`` carries the step number ``t``;
    training rows and the purge by ``label_ts`` are those of ``walk_forward_run``.  Bins are
    those of the first training range, so no fold sees later rows.  Appends ``fold``,
    ``point`` and ``yhat``."""
    d = fold_ranges(df, spec)
    starts = {r["test_fold"]: r["s"] for r in  # one row per fold
              d.where("test_fold IS NOT NULL").groupBy("test_fold").agg(F.min(ntz_micros(F.col("ts"))).alias("s")).collect()}
    folds = sorted(starts)
    if not folds:
        return d.where("false").withColumnRenamed("test_fold", "fold").drop("train_from", "train_to").withColumns(
            {"point": F.lit(0), "yhat": F.lit(None).cast("double")})
    cuts = bin_cuts(df.where(F.col("t") < spec.initial), features, bins)
    fits = [p for _ in folds for p in points]  # fit m: fold m div points, point m mod points
    of_fold = F.array(*[F.lit(k) for k in folds])
    begin = F.array(*[F.lit(starts[k]).cast("long") for k in folds])

    def place(m: Column) -> Column:
        return F.floor(m / F.lit(len(points))).cast("int")

    def trains(m: Column) -> Column:
        fold = F.get(of_fold, place(m))
        inside = F.coalesce((F.col("train_from") <= fold) & (fold <= F.col("train_to")), F.lit(False))
        return inside & F.coalesce(ntz_micros(F.col(label_ts)) < F.get(begin, place(m)), F.lit(False)) if label_ts else inside

    state, _ = boost(d, features, label, cuts, fits, trains)
    tested = state.where("test_fold IS NOT NULL").withColumn("point", F.explode(F.array(*[F.lit(k) for k in range(len(points))])))
    number = (F.array_position(of_fold, F.col("test_fold")) - 1) * len(points) + F.col("point")
    return (tested.withColumn("yhat", F.get("_f", number.cast("int"))).withColumnRenamed("test_fold", "fold")
            .drop("train_from", "train_to", "_f"))
