"""Features (FE1-FE11).  Every feature is causal (reads rows <= t) except the
target, and NULL until its window holds n rows (warm-up rule)."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.expr import safe_div, warm
from tidecast.operators.ordered import IDX, PLAIN, Layout, derive, ensure_index, join_null_safe, over_series
from tidecast.operators.sliding import sliding


def frame(w: Window, n: int) -> Window:
    """Last n rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def lags(df: DataFrame, col: str, ks: Iterable[int], *, layout: Layout = PLAIN) -> DataFrame:
    """FE1: ``{col}_lag{k}``."""
    ks = list(ks)
    d = ensure_index(df, layout)
    return over_series(d, lambda w: [F.lag(col, k).over(w).alias(f"{col}_lag{k}") for k in ks],
                       layout=layout, back=max(ks))


def rolling(df: DataFrame, col: str, n: int, stats: Sequence[str] = ("mean", "std", "min", "max", "sum"),
            *, layout: Layout = PLAIN) -> DataFrame:
    """FE2: ``{col}_{stat}{n}`` over the last n rows; std is the population std.  Cost per
    row does not grow with n (``sliding``)."""
    d = sliding(ensure_index(df, layout), n, [("_n", col, "count")] + [(f"_r_{s}", col, s) for s in stats], layout=layout)
    return derive(d, {f"{col}_{s}{n}": warm(F.col("_n"), n, F.col(f"_r_{s}")) for s in stats}, layout=layout) \
        .drop("_n", *[f"_r_{s}" for s in stats])


def rolling_quantile(df: DataFrame, col: str, n: int, qs: Sequence[float] = (0.5,),
                     *, layout: Layout = PLAIN) -> DataFrame:
    """FE3: exact (interpolated) quantiles of the last n rows, ``{col}_q{pct}_{n}``.
    Memory is bounded by the frame (n rows)."""
    d = ensure_index(df, layout)

    def build(w):
        f = frame(w, n)
        cnt = F.count(col).over(f)
        return [warm(cnt, n, F.percentile(col, q).over(f)).alias(f"{col}_q{int(round(q * 100)):02d}_{n}")
                for q in qs]
    return over_series(d, build, layout=layout, back=n - 1)


def zscore(df: DataFrame, col: str, n: int, *, layout: Layout = PLAIN) -> DataFrame:
    """FE4: (x - rolling mean) / rolling population std; NULL when std = 0.
    Reuses ``{col}_mean{n}`` / ``{col}_std{n}`` from ``rolling`` when present."""
    d = ensure_index(df, layout)
    mean, std = f"{col}_mean{n}", f"{col}_std{n}"
    if mean in d.columns and std in d.columns:  # reuse ``rolling`` output (same warm-up mask)
        return d.withColumn(f"{col}_z{n}", safe_div(F.col(col) - F.col(mean), F.col(std)))

    d = sliding(d, n, [("_n", col, "count"), ("_m", col, "mean"), ("_sd", col, "std")], layout=layout)
    z = safe_div(F.col(col) - F.col("_m"), F.col("_sd"))
    return d.withColumn(f"{col}_z{n}", warm(F.col("_n"), n, z)).drop("_n", "_m", "_sd")


def rolling_trend(df: DataFrame, col: str, n: int, *, layout: Layout = PLAIN) -> DataFrame:
    """FE5: least-squares slope and R² of ``col`` on the bar index over n rows.

    A window with n values has the indexes of n rows in a row, so their squares are a
    constant and the products are a weighted sum of lags: one value a row and lag, where an
    aggregate over the frame would be worked out anew from n rows for every row.
    Reuses ``{col}_std{n}`` from ``rolling`` when present (same warm-up mask)."""
    d = ensure_index(df, layout)
    sxx = n * (n * n - 1) / 12.0
    std = f"{col}_std{n}"
    known = std in d.columns

    def build(w):
        f = frame(w, n)
        x = F.col(col).cast("double")
        at = [x, *(F.lag(x, k).over(w) for k in range(1, n))]
        sxy = F.lit(0.0)
        for k in range(n // 2):  # in pairs around the middle: nothing is left of a constant
            sxy = sxy + F.lit((n - 1) / 2.0 - k) * (at[k] - at[n - 1 - k])
        if known:
            return [sxy.alias("_sxy")]
        return [sxy.alias("_sxy"), F.count(col).over(f).alias("_n"), (F.var_pop(x).over(f) * F.lit(float(n))).alias("_syy")]
    d = over_series(d, build, layout=layout, back=n - 1)
    if known:
        d = d.withColumns({"_n": F.when(F.col(std).isNotNull(), F.lit(n)).otherwise(F.lit(0)), "_syy": F.col(std) * F.col(std) * F.lit(float(n))})
    sxy, syy = F.col("_sxy"), F.col("_syy")
    r2 = F.when(syy == 0, F.lit(1.0) if n > 1 else F.lit(None).cast("double")).otherwise(safe_div(sxy * sxy, F.lit(sxx) * syy))
    return (d.withColumn(f"{col}_slope{n}", warm(F.col("_n"), n, safe_div(sxy, F.lit(sxx))))
            .withColumn(f"{col}_r2_{n}", warm(F.col("_n"), n, r2)).drop("_n", "_sxy", "_syy"))


def rolling_corr(df: DataFrame, a: str, b: str, n: int, *, layout: Layout = PLAIN) -> DataFrame:
    """FE6: rolling correlation of two columns over n rows (pairs with both set)."""
    d = ensure_index(df, layout)

    def build(w):
        f = frame(w, n)
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        cnt = F.count(F.when(both, 1)).over(f)
        aa, bb = F.when(both, F.col(a)), F.when(both, F.col(b))
        c = safe_div(F.covar_pop(aa, bb).over(f), F.stddev_pop(aa).over(f) * F.stddev_pop(bb).over(f))
        return [warm(cnt, n, c).alias(f"corr_{a}_{b}_{n}")]
    return over_series(d, build, layout=layout, back=n - 1)


def calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """FE7: weekday (1 = Sunday .. 7), day of month, month, quarter, day of year, year."""
    t = F.col(ts)
    return df.select("*", F.dayofweek(t).alias("dow"), F.dayofmonth(t).alias("dom"),
                     F.month(t).alias("month"), F.quarter(t).alias("quarter"),
                     F.dayofyear(t).alias("doy"), F.year(t).alias("year"))


def target(df: DataFrame, h: int = 1, kind: str = "price", *, col: str = "close",
           layout: Layout = PLAIN) -> DataFrame:
    """FE8: the value h bars ahead (the only non-causal column): ``target_{kind}_{h}``.
    kind: price | return (simple) | log (log return)."""
    d = ensure_index(df, layout)

    def build(w):
        ahead = F.lead(col, h).over(w)
        cur = F.col(col)
        if kind == "price":
            v = ahead
        elif kind == "return":
            v = F.when((cur > 0) & (ahead > 0), safe_div(ahead, cur) - 1)
        elif kind == "log":
            v = F.when((cur > 0) & (ahead > 0), F.ln(safe_div(ahead, cur)))
        else:
            raise ValueError(kind)
        return [v.alias(f"target_{kind}_{h}")]
    return over_series(d, build, layout=layout, ahead=h)


def scaler(df: DataFrame, cols: Sequence[str], train_end, *, method: str = "standard",
           by: str = "series", ts: str = "ts") -> DataFrame:
    """FE9: scaling fitted on rows with ts < ``train_end`` only, applied to all rows.

    ``train_end`` is a literal timestamp or a column (e.g. a fold's test start
    after a join).  Stats are one row per series (small hash aggregate), joined
    back by key; AQE broadcasts them when measured small.
    method: standard ((x - mean) / population std) | minmax ((x - min) / (max - min)).
    """
    end = train_end if not isinstance(train_end, str) else F.lit(train_end).cast("timestamp_ntz")
    is_train = F.col(ts) < end
    aggs = []
    for c in cols:
        x = F.when(is_train, F.col(c))
        aggs += [F.avg(x).alias(f"_mu_{c}"), F.stddev_pop(x).alias(f"_sd_{c}"),
                 F.min(x).alias(f"_lo_{c}"), F.max(x).alias(f"_hi_{c}")]
    stats = df.groupBy(by).agg(*aggs)
    out = join_null_safe(df, stats, [by], "left")
    for c in cols:
        if method == "standard":
            v = safe_div(F.col(c) - F.col(f"_mu_{c}"), F.col(f"_sd_{c}"))
        elif method == "minmax":
            v = safe_div(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
        else:
            raise ValueError(method)
        out = out.withColumn(f"{c}_scaled", v)
    return out.drop(*[f"_{p}_{c}" for c in cols for p in ("mu", "sd", "lo", "hi")])


def sequence_windows(df: DataFrame, cols: Sequence[str], n: int, *, layout: Layout = PLAIN,
                     keep_partial: bool = False) -> DataFrame:
    """FE10: ``{col}_seq``: the last n values (oldest first) as array<double>.
    Only full windows are kept (unless ``keep_partial``).  Arrays are built from
    (index, value) structs and sorted, so order never depends on frame order."""
    d = ensure_index(df, layout)

    def build(w):
        f = frame(w, n)
        outs = [F.count(F.lit(1)).over(f).alias("_seq_n")]
        for c in cols:
            pairs = F.array_sort(F.collect_list(F.struct(F.col(IDX), F.col(c))).over(f))
            outs.append(F.transform(pairs, lambda p: p[c].cast("double")).alias(f"{c}_seq"))
        return outs
    out = over_series(d, build, layout=layout, back=n - 1)
    if not keep_partial:
        out = out.where(F.col("_seq_n") == n)
    return out.drop("_seq_n")


def assemble(df: DataFrame, cols: Sequence[str], *, out: str = "features",
             series_col: str | None = "series"):
    """FE11: feature columns (and optionally the indexed series key) into one
    vector; a NULL / NaN feature is NaN in it, so every row is kept.  Returns an
    unfitted Pipeline and the list of input names in vector order."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    stages, names = [], list(cols)
    if series_col:
        stages.append(StringIndexer(inputCol=series_col, outputCol="_series_idx",
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        names = names + ["_series_idx"]
    stages.append(VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages), names
