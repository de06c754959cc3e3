"""Bars and time-series preparation (TS1-TS7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_from_micros, ntz_micros, safe_div
from tidecast.operators.ordered import IDX, Layout, PLAIN, ensure_index, join_null_safe, over_series, running

# Fixed-width bar sizes in seconds, others in months; those and weeks truncate the date.
FREQ_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def freq_seconds(freq: str | int) -> int:
    if isinstance(freq, int):
        return freq
    if freq in FREQ_SECONDS:
        return FREQ_SECONDS[freq]
    if freq in MONTHS:
        return 31 * 86400 * MONTHS[freq]  # upper bound, only used to size index buckets
    raise ValueError(f"unknown freq {freq!r}")


def bar_start(ts: Column, freq: str | int) -> Column:
    """Start of the bar holding ``ts`` (TIMESTAMP_NTZ in, TIMESTAMP_NTZ out),
    computed on the wall clock: no session-time-zone cast anywhere."""
    if freq == "week" or freq in MONTHS:
        return F.trunc(ts.cast("date"), freq).cast("timestamp_ntz")
    width = freq_seconds(freq) * 1_000_000
    return ntz_from_micros(F.floor(ntz_micros(ts) / F.lit(width)) * F.lit(width))


def ticks_to_bars(ticks: DataFrame, freq: str | int = "day") -> DataFrame:
    """TS1: OHLCV per series and bar.

    Open / close are the first / last tick in the total order (ts, seq, price);
    putting the price last makes any remaining ties harmless.  One aggregate,
    hash-partitioned on (series, bar), with map-side partial aggregation: a hot
    series is spread over its many bars, never held by one task.  (The struct
    ordering key makes it a sort-based aggregate.)
    """
    key = F.struct(F.col("ts"), F.col("seq"), F.col("price"))
    t = ticks.where(F.col("price").isNotNull()).withColumn("_bar", bar_start(F.col("ts"), freq))
    return (t.groupBy("series", "_bar").agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum(F.coalesce(F.col("qty"), F.lit(0.0))).alias("volume"))
        .withColumnRenamed("_bar", "ts")
        .select("series", "ts", "open", "high", "low", "close", "volume"))


def resample_bars(bars: DataFrame, freq: str | int) -> DataFrame:
    """TS2: finer bars to coarser bars ((series, ts) unique, so ts orders a bar)."""
    b = bars.withColumn("_bar", bar_start(F.col("ts"), freq))
    return (b.groupBy("series", "_bar").agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"))
        .withColumnRenamed("_bar", "ts")
        .select("series", "ts", "open", "high", "low", "close", "volume"))


FILLS = ("ffill", "bfill", "linear")
_IN_MONTH = 1 << 42  # more microseconds than a month has


def _grid(ts: Column, freq: str | int) -> tuple[Column, Column]:
    """Number of the bar on the calendar grid and what is left over: equal for bars a whole number of widths apart."""
    us = ntz_micros(ts)
    if freq in MONTHS:
        month = (F.year(ts) * 12 + F.month(ts) - 1).cast("long")
        start = ntz_micros(F.trunc(ts.cast("date"), "month").cast("timestamp_ntz"))
        return F.floor(month / MONTHS[freq]).cast("long"), F.pmod(month, F.lit(MONTHS[freq])) * F.lit(_IN_MONTH) + us - start
    width = F.lit(freq_seconds(freq) * 1_000_000)
    return F.floor(us / width).cast("long"), F.pmod(us, width)


def _from_grid(number: Column, rest: Column, freq: str | int) -> Column:
    if freq in MONTHS:
        month = number * MONTHS[freq] + F.floor(rest / F.lit(_IN_MONTH)) - 1970 * 12
        start = F.add_months(F.lit("1970-01-01").cast("date"), month.cast("int")).cast("timestamp_ntz")
        return ntz_from_micros(ntz_micros(start) + F.pmod(rest, F.lit(_IN_MONTH)))
    return ntz_from_micros(number * F.lit(freq_seconds(freq) * 1_000_000) + rest)


def fill_gaps(bars: DataFrame, freq: str | int = "day", method: str = "ffill", *, layout: Layout = PLAIN,
              bucket_bars: int = 4096) -> DataFrame:
    """TS3: complete calendar per series from its first to its last bar.

    A missing bar has volume 0 and open = high = low = close by ``method``: the last known
    close (ffill), the next known one (bfill), or the straight line between the two by bar
    number (linear); NULL where there is none to go by.  A bar that is there but has a NULL
    close is filled alike, its other values stay.  ``is_filled`` marks both.

    ``freq``: seconds, a name of a fixed width, or month, quarter, year, whose grid is the
    calendar's.  The grid of a series starts at its first bar, so weekly bars and bars off
    the epoch grid keep their places; bars that are not a whole number of bar widths apart
    raise an error.  Rows with a NULL ts are no bars and are left out; NULL is one more series.

    The calendar is generated in buckets of ``bucket_bars`` bars (a per-series row only
    expands into bucket rows; each bucket row expands into at most ``bucket_bars`` bars), so
    a long series is generated by many tasks.  Because the result is gap-free, the bar
    index is arithmetic (no index shuffle).
    """
    if method not in FILLS:
        raise ValueError(f"unknown method {method!r}")
    number, rest = _grid(F.col("ts"), freq)
    span = bars.where(F.col("ts").isNotNull()).groupBy("series").agg(
        F.min(number).alias("_lo"), F.max(number).alias("_hi"), F.min(rest).alias("_o1"), F.max(rest).alias("_o2"))
    lo = F.when(F.col("_o1") == F.col("_o2"), F.col("_lo")).otherwise(
        F.raise_error(F.lit("fill_gaps: bars of a series are not a whole number of bar widths apart")))
    bk = F.lit(bucket_bars)
    buckets = (span.withColumns({"_lo": lo, "_last": F.col("_hi") - F.col("_lo")})
               .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / bk))))
               .repartition("series", "_k"))
    cal = (buckets.withColumn(IDX, F.explode(F.sequence(F.col("_k") * bk, F.least((F.col("_k") + 1) * bk - 1, F.col("_last")))))
           .select("series", _from_grid(F.col("_lo") + F.col(IDX), F.col("_o1"), freq).alias("ts"), IDX))
    j = join_null_safe(cal, bars, ["series", "ts"], "left")
    known = F.when(F.col("close").isNotNull(), F.struct(F.col(IDX).alias("at"), F.col("close").alias("close")))
    kinds = {"ffill": ["last"], "bfill": ["next"], "linear": ["last", "next"]}[method]
    j = running(j, [(f"_{kind}", known, kind) for kind in kinds], layout=layout)
    if method == "linear":
        a, b = F.col("_last"), F.col("_next")
        share = safe_div((F.col(IDX) - a["at"]).cast("double"), (b["at"] - a["at"]).cast("double"))
        fill = a["close"] + (b["close"] - a["close"]) * share
    else:
        fill = F.col(f"_{kinds[0]}")["close"]
    return j.select(
        "series", "ts", IDX,
        *[F.coalesce(F.col(c), F.col("close"), fill).alias(c) for c in ("open", "high", "low")], F.coalesce("close", fill).alias("close"),
        F.coalesce("volume", F.lit(0.0)).alias("volume"), F.col("close").isNull().alias("is_filled"))


def returns(bars: DataFrame, kind: str = "simple", k: int = 1, *, col: str = "close",
            out: str | None = None, layout: Layout = PLAIN) -> DataFrame:
    """TS4: k-bar simple or log return; NULL where either price is <= 0 or NULL."""
    out = out or f"ret_{kind}_{k}"
    df = ensure_index(bars, layout)

    def build(w):
        prev = F.lag(col, k).over(w)
        cur = F.col(col)
        ok = (cur > 0) & (prev > 0)
        if kind == "simple":
            v = safe_div(cur, prev) - 1
        elif kind == "log":
            v = F.ln(safe_div(cur, prev))
        else:
            raise ValueError(kind)
        return [F.when(ok, v).alias(out)]
    return over_series(df, build, layout=layout, back=k)


def drawdown(bars: DataFrame, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TS5: close / running maximum - 1 (0 at a new high)."""
    df = ensure_index(bars, layout)
    df = running(df, [("_peak", F.col(col), "max")], layout=layout)
    return df.withColumn("drawdown", safe_div(F.col(col), F.col("_peak")) - 1).drop("_peak")


def max_drawdown(bars: DataFrame, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TS5: worst drawdown per series (hash aggregate over the per-row drawdown)."""
    return (drawdown(bars, col=col, layout=layout).groupBy("series")
            .agg(F.min("drawdown").alias("max_drawdown"),
                 F.min_by("ts", F.struct("drawdown", "ts")).alias("trough_ts")))


def pair_corr(a: Column, b: Column) -> Column:
    """Population correlation over pairs where both are non-null.

    covar_pop / (stddev_pop * stddev_pop) with a safe division: plain ``corr``
    raises on a constant input under ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    aa, bb = F.when(both, a), F.when(both, b)
    return safe_div(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def autocorr(df: DataFrame, col: str, lags: list[int], *, layout: Layout = PLAIN) -> DataFrame:
    """TS6: lag-k autocorrelation per series for all ``lags`` in one pass.

    Lags come from one window (one shuffle), correlations from one hash
    aggregate with partial aggregation; output is long: (series, lag, acf, n_pairs).
    """
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [F.lag(col, k).over(w).alias(f"_lag{k}") for k in lags],
                    layout=layout, back=max(lags))
    aggs = []
    for k in lags:
        lk = F.col(f"_lag{k}")
        aggs += [pair_corr(F.col(col), lk).alias(f"_acf{k}"),
                 F.count(F.when(F.col(col).isNotNull() & lk.isNotNull(), 1)).alias(f"_n{k}")]
    wide = d.groupBy("series").agg(*aggs)
    stack = ", ".join(f"{k}, _acf{k}, _n{k}" for k in lags)
    return wide.selectExpr("series", f"stack({len(lags)}, {stack}) as (lag, acf, n_pairs)")


def summary(df: DataFrame, col: str = "close", *, freq: str | int = "day",
            layout: Layout = PLAIN, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """TS7: per-series count, mean, sample std, population skewness, excess
    kurtosis, min, max, exact nearest-rank quantiles and gap count (steps
    longer than one bar).

    Moments come from one partially-aggregated hash aggregate; quantiles from
    ``exact_quantiles`` (bounded memory per series, exact at any size).
    """
    from tidecast.operators.quantiles import exact_quantiles

    d = ensure_index(df, layout)
    step = freq_seconds(freq)
    d = over_series(d, lambda w: [F.lag("ts", 1).over(w).alias("_pts")], layout=layout, back=1)
    gap = (ntz_micros(F.col("ts")) - ntz_micros(F.col("_pts"))) > F.lit(step * 1_000_000)
    x = F.col(col)
    out = d.groupBy("series").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.skewness(x).alias("skew"), F.kurtosis(x).alias("kurt"),
        F.min(x).alias("min"), F.max(x).alias("max"),
        F.count(F.when(gap, 1)).alias("gaps"))
    names = {float(p): f"q{int(round(p * 100)):02d}" for p in quantiles}
    q = (exact_quantiles(d, col, list(quantiles), by=["series"])
         .groupBy("series").pivot("p", list(names)).agg(F.first("value")))
    for p, name in names.items():
        q = q.withColumnRenamed(str(p), name)
    return join_null_safe(out, q, ["series"], "left")
