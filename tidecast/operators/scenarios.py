"""Scenarios (SC1-SC3): bootstrap fans of future cumulative log returns.

A series' returns are kept as arrays of ``CHUNK`` consecutive ones.  A path is one
row: its draws are an array of (step, return index), split by the chunks they fall
into; each part meets its chunk in one equi-join on (series, chunk) and reads its
returns by position; the parts of a path meet again and are summed up inside one
array.  So rows shuffled go with paths (times the chunks a path touches), not with
paths x steps, and a long series is spread over its chunks.  Every draw is an md5
uniform of (seed, series, path, step), reproducible in SQL.
"""

from __future__ import annotations

import math

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import md5_uniform, safe_div
from tidecast.operators.ordered import IDX, PLAIN, Layout, join_null_safe, over_series, running

FAN_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
CHUNK = 4096  # returns of a series in one array


def past_log_returns(bars: DataFrame, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """(series, k, r): the k-th known one-bar log return of each series, from
    indexed bars.  A return is known if both prices are positive; others are
    left out and the rest numbered without gaps, so every draw hits one."""
    d = over_series(bars.select("series", IDX, col),
                    lambda w: [F.lag(col, 1).over(w).alias("_prev")], layout=layout, back=1)
    known = (F.col(col) > 0) & (F.col("_prev") > 0)
    d = d.withColumn("r", F.when(known, F.ln(safe_div(F.col(col), F.col("_prev")))))
    d = running(d, [("_n", F.col("r"), "count")], layout=layout)
    return d.where(F.col("r").isNotNull()).select("series", (F.col("_n") - 1).alias("k"), "r")


def _path_rows(rets: DataFrame, paths: int, parallelism: int | None) -> DataFrame:
    n = rets.groupBy("series").agg(F.count("r").alias("_n")).where(F.col("_n") > 0)
    p = n.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
    return p.repartition(parallelism or rets.sparkSession.sparkContext.defaultParallelism, "series", "path")


def _chunk_of(index: Column) -> Column:
    return F.floor(index / F.lit(CHUNK)).cast("long")


def _accumulate(rows: DataFrame, rets: DataFrame, draw: Callable[[Column], Column], horizon: int) -> DataFrame:
    """(series, path, step, cum_return) of path rows; ``draw`` gives the return index of a step."""
    ordered = F.array_sort(F.collect_list(F.struct("k", "r")))
    arrays = rets.withColumn("_c", _chunk_of(F.col("k"))).groupBy("series", "_c").agg(F.transform(ordered, lambda x: x["r"]).alias("_rs"))
    drawn = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda s: F.struct(s.alias("step"), draw(s).cast("long").alias("k")))
    d = rows.withColumn("_draws", drawn)
    d = d.withColumn("_c", F.explode(F.array_distinct(F.transform("_draws", lambda x: _chunk_of(x["k"])))))
    parts = d.select("series", "path", "_c", F.filter("_draws", lambda x: _chunk_of(x["k"]) == F.col("_c")).alias("_draws"))
    read = join_null_safe(parts, arrays, ["series", "_c"]).select(
        "series", "path", F.transform("_draws", lambda x: F.struct(x["step"].alias("step"), F.get("_rs", (x["k"] - F.col("_c") * CHUNK).cast("int")).alias("r"))).alias("_part"))
    steps = read.groupBy("series", "path").agg(F.array_sort(F.flatten(F.collect_list("_part"))).alias("_steps"))
    start = F.struct(F.lit(0.0).alias("total"), F.array().cast("array<struct<step:int,cum_return:double>>").alias("out"))

    def add(so_far: Column, x: Column) -> Column:
        total = so_far["total"] + x["r"]
        return F.struct(total.alias("total"), F.concat(so_far["out"], F.array(F.struct(x["step"].alias("step"), total.alias("cum_return")))).alias("out"))

    summed = steps.select("series", "path", F.aggregate("_steps", start, add)["out"].alias("_out"))
    return summed.select("series", "path", F.explode("_out").alias("_o")).select("series", "path", "_o.step", "_o.cum_return")


def scenario_paths(rets: DataFrame, *, paths: int = 1000, horizon: int = 30, seed: int = 42,
                   parallelism: int | None = None) -> DataFrame:
    """SC1 paths: i.i.d. bootstrap; step s of path p draws return index
    floor(u * n), u = md5_uniform(seed, series, p, s).  Output
    (series, path, step, cum_return)."""
    def draw(step: Column) -> Column:
        return F.floor(md5_uniform(F.lit(seed), F.col("series"), F.col("path"), step) * F.col("_n"))

    return _accumulate(_path_rows(rets, paths, parallelism), rets, draw, horizon)


def block_scenario_paths(rets: DataFrame, *, block: int = 5, paths: int = 1000, horizon: int = 30,
                         seed: int = 42, parallelism: int | None = None) -> DataFrame:
    """SC2 paths: moving-block bootstrap; block b of path p starts at
    floor(u * (n - block + 1)), u = md5_uniform(seed, series, p, 'b' || b), and
    step s takes the return at start + (s - 1) mod block."""
    def draw(step: Column) -> Column:
        b = F.floor((step - 1) / F.lit(block)).cast("long")
        u = md5_uniform(F.lit(seed), F.col("series"), F.col("path"), F.concat(F.lit("b"), b.cast("string")))
        return F.floor(u * (F.col("_n") - F.lit(block - 1))) + F.pmod(step - 1, F.lit(block))

    rows = _path_rows(rets, paths, parallelism).where(F.col("_n") >= block)
    return _accumulate(rows, rets, draw, horizon)


def fan(paths_df: DataFrame, quantiles=FAN_QUANTILES) -> DataFrame:
    """Quantiles of cumulative return across paths per (series, step).  Each
    group holds exactly ``paths`` rows, so the exact percentile is bounded."""
    names = [f"p{int(round(q * 100)):02d}" for q in quantiles]
    found = paths_df.groupBy("series", "step").agg(F.count(F.lit(1)).alias("paths"), F.avg("cum_return").alias("mean"),
                                                   F.percentile("cum_return", list(quantiles)).alias("_ps"))
    return found.select("series", "step", "paths", "mean", *[F.get("_ps", F.lit(j)).alias(name) for j, name in enumerate(names)])


def scenario_fan(rets: DataFrame, paths: int = 1000, horizon: int = 30, seed: int = 42) -> DataFrame:
    """SC1."""
    return fan(scenario_paths(rets, paths=paths, horizon=horizon, seed=seed))


def block_scenario_fan(rets: DataFrame, paths: int = 1000, horizon: int = 30, seed: int = 42,
                       block: int = 5) -> DataFrame:
    """SC2."""
    return fan(block_scenario_paths(rets, block=block, paths=paths, horizon=horizon, seed=seed))


def threshold_probability(paths_df: DataFrame, level: float) -> DataFrame:
    """SC3: share of paths whose cumulative simple return is at or beyond
    ``level`` (e.g. 0.1 = +10 %, -0.1 = -10 %) at each step."""
    thr = F.lit(math.log1p(level))
    hit = (F.col("cum_return") >= thr) if level >= 0 else (F.col("cum_return") <= thr)
    return paths_df.groupBy("series", "step").agg(
        F.avg(hit.cast("double")).alias("probability"), F.count(F.lit(1)).alias("paths"))
