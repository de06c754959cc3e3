"""Splits and validation (VA1-VA3).  Never random: every split is by time.

Folds are defined on a *step calendar* shared by all series (the distinct
timestamps, numbered in order), so one fold's train range ends at the same
instant for every series and a panel model never trains on another series'
future.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.operators.ordered import IDX, Layout, bar_index

STEP = "t"


def chrono_split(df: DataFrame, train: float = 0.7, val: float = 0.15, *, ts: str = "ts") -> DataFrame:
    """VA1: add ``split`` in {train, val, test} by time.

    Cut points are exact nearest-rank quantiles of the distinct timestamps
    (``exact_quantiles``): train: ts <= c1, val: c1 < ts <= c2, test: ts > c2.
    Only the two cut instants reach the driver.  A NULL ts is in "test"; in a
    table without any known ts, ``split`` is NULL.
    """
    from tidecast.operators.quantiles import exact_quantiles

    if not (0 < train < 1 and 0 <= val < 1 and train + val < 1):
        raise ValueError("need 0 < train, train + val < 1")
    cal = df.select(ntz_micros(F.col(ts)).alias("_us")).distinct()
    cuts = {r["p"]: int(r["value"]) for r in exact_quantiles(cal, "_us", [train, train + val]).collect()}
    if not cuts:
        return df.withColumn("split", F.lit(None).cast("string"))
    c1, c2 = cuts[float(train)], cuts[float(train + val)]
    us = ntz_micros(F.col(ts))
    split = (F.when(us <= F.lit(c1), F.lit("train"))
             .when(us <= F.lit(c2), F.lit("val")).otherwise(F.lit("test")))
    return df.withColumn("split", split)


def step_calendar(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Distinct timestamps numbered 0.. in time order (column ``t``); NULL is no step.

    Numbered with the engine's distributed bar index (one pseudo-series), whose
    buckets are as wide as the calendar's mean step asks for, so a long calendar
    is not sorted by one task."""
    cal = df.select(F.col(ts).alias("ts")).where(F.col("ts").isNotNull()).distinct().withColumn("_one", F.lit("all"))
    us = ntz_micros(F.col("ts"))
    n, span = cal.agg(F.count(F.lit(1)), F.max(us) - F.min(us)).first()
    step = max(1, round((span or 0) / max(1, n) / 1e6))
    return bar_index(cal, Layout(mode="halo", series="_one", bar_seconds=step)).select("ts", F.col(IDX).alias(STEP))


def with_steps(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Attach the step number ``t`` of each row's timestamp, NULL where that is NULL
    (equi-join on ts; AQE broadcasts the calendar when it is measured small)."""
    return df.join(step_calendar(df, ts=ts).withColumnRenamed("ts", ts), ts, "left")


@dataclass(frozen=True)
class WalkForward:
    initial: int          # steps in the first training range
    test: int             # steps per test block
    gap: int = 0          # steps dropped between train and test (>= target horizon)
    mode: str = "expanding"  # or "sliding" (train range keeps ``initial`` steps)

    def n_folds(self, n_steps: int) -> int:
        """Test blocks that start inside the calendar; the last may be shorter than ``test``."""
        return max(0, -(-(n_steps - self.initial - self.gap) // self.test))

    def train_hi(self, k):
        return self.initial + k * self.test            # exclusive

    def train_lo(self, k):
        return 0 if self.mode == "expanding" else k * self.test

    def test_lo(self, k):
        return self.train_hi(k) + self.gap

    def test_hi(self, k):
        return self.test_lo(k) + self.test              # exclusive


def _n_folds(d: DataFrame, spec: WalkForward) -> int:
    n_steps = d.agg(F.max(STEP)).first()[0]
    return spec.n_folds(0 if n_steps is None else n_steps + 1)


def fold_ranges(df: DataFrame, spec: WalkForward, *, ts: str = "ts") -> DataFrame:
    """VA2, one row per input row: (…, t, test_fold, train_from, train_to).

    ``test_fold`` is the fold whose test block holds the row, and folds
    ``train_from..train_to`` train on it; each is NULL where there is none.  Plain
    arithmetic on the step number, so the output is as large as the input.  Every
    step after the first training range and its gap is tested: the last block may
    be shorter than ``spec.test``.
    """
    if spec.mode not in ("expanding", "sliding"):
        raise ValueError(spec.mode)
    d = df if STEP in df.columns else with_steps(df, ts=ts)
    last = F.lit(_n_folds(d, spec) - 1)
    t = F.col(STEP)
    first_test = spec.initial + spec.gap
    test_fold = F.when(t >= F.lit(first_test), F.floor((t - F.lit(first_test)) / F.lit(spec.test)))
    lo = F.greatest(F.lit(0), F.floor((t - F.lit(spec.initial)) / F.lit(spec.test)) + 1)
    hi = last if spec.mode == "expanding" else F.least(last, F.floor(t / F.lit(spec.test)))
    trains = t.isNotNull() & (lo <= hi)
    return d.withColumns({"test_fold": test_fold.cast("int"),
                          "train_from": F.when(trains, lo).cast("int"),
                          "train_to": F.when(trains, hi).cast("int")})


def walk_forward(df: DataFrame, spec: WalkForward, *, ts: str = "ts") -> DataFrame:
    """VA2, one row per (row, fold): (…, t, fold, role in {train, test}).

    ``fold_ranges`` exploded, so the output is, by nature, as large as the sum of all
    folds' train and test sets; read ``fold_ranges`` where that is too much.
    """
    member = lambda k, role: F.struct(k.cast("int").alias("fold"), F.lit(role).alias("role"))
    none = F.array().cast("array<struct<fold:int,role:string>>")
    trained = F.when(F.col("train_from").isNotNull(),
                     F.transform(F.sequence("train_from", "train_to"), lambda k: member(k, "train"))).otherwise(none)
    tested = F.when(F.col("test_fold").isNotNull(), F.array(member(F.col("test_fold"), "test"))).otherwise(none)
    return (fold_ranges(df, spec, ts=ts)
            .withColumn("_m", F.explode(F.concat(trained, tested)))
            .drop("test_fold", "train_from", "train_to")
            .select("*", "_m.fold", "_m.role").drop("_m"))


def walk_forward_run(df: DataFrame, spec: WalkForward,
                     fit_predict: Callable[[DataFrame, DataFrame, int], DataFrame], *,
                     folds: list[int] | None = None, label_ts: str | None = None, threads: int = 4) -> DataFrame:
    """VA3: fit and predict fold by fold; union of the out-of-fold predictions.

    ``df`` carries the step number ``t`` (see ``with_steps``) and is cut from a
    checkpointed table by the caller.  Each fold is two filters on ``t`` (no
    exploded membership table) and one distributed fit.  ``fit_predict(train,
    test, fold)`` returns prediction rows.  With ``label_ts``, the time at which a
    row's label is known, training rows whose label is known only in the test block
    or later are left out (a series with gaps can reach over ``spec.gap`` steps).
    Up to ``threads`` folds are fitted at the same time; the result does not depend
    on it.
    """
    t = F.col(STEP)

    def one(k: int) -> DataFrame:
        train = df.where((t >= spec.train_lo(k)) & (t < spec.train_hi(k)))
        test = df.where((t >= spec.test_lo(k)) & (t < spec.test_hi(k)))
        start = test.agg(F.min("ts")).first()[0] if label_ts else None
        if start is not None:
            train = train.where(F.col(label_ts) < F.lit(start).cast("timestamp_ntz"))
        return fit_predict(train, test, k).withColumn("fold", F.lit(k).cast("int"))

    parts = overlapped(one, folds if folds is not None else range(_n_folds(df, spec)), threads)
    if not parts:
        raise ValueError("no test step: series too short for this walk-forward spec")
    return reduce(DataFrame.unionByName, parts)


def overlapped(work: Callable, items, threads: int) -> list:
    """``[work(x) for x in items]`` with up to ``threads`` of them submitting Spark jobs at once."""
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(work, items))
