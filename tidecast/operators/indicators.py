"""Technical indicators (TI1-TI18) from published formulas.

Classes: *bounded* (last n rows: one window frame), *cumulative* (prefix sums:
``running``), *recurrence* (exponential smoothing: ``linear_scan``).  Columns derived
on the way go through ``derive``, so that ``one_pass`` knows how far they look back.

Recurrences share one seed rule: the first non-null input seeds the state
(y_0 = x_0).  Other libraries seed with an n-bar mean; values converge after
a few multiples of n.  Every n-bar output is NULL until n inputs exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import safe_div, warm
from tidecast.operators.features import frame
from tidecast.operators.ordered import PLAIN, Layout, derive, ensure_index, linear_scan, linear_scans, over_series, running
from tidecast.operators.sliding import sliding

# Fixed values of the published formulas.
CCI_CONSTANT = 0.015

HIGH_LOW = [("_n", "close", "count"), ("_hh", "high", "max"), ("_ll", "low", "min")]  # of a window


def _tp() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def _mf_multiplier() -> Column:
    """((c - l) - (h - c)) / (h - l); 0 when h = l."""
    c, h, lo = F.col("close"), F.col("high"), F.col("low")
    return F.coalesce(safe_div((c - lo) - (h - c), h - lo), F.lit(0.0))


def sma(df: DataFrame, n: int, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TI1: ``sma{n}``."""
    d = ensure_index(df, layout)
    d = sliding(d, n, [("_n", col, "count"), ("_m", col, "mean")], layout=layout)
    return derive(d, {f"sma{n}": warm(F.col("_n"), n, F.col("_m"))}, layout=layout).drop("_n", "_m")


def wma(df: DataFrame, n: int, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TI2: ``wma{n}``, weights n (newest) .. 1 (oldest), sum of weighted lags
    (no large-index cancellation)."""
    d = ensure_index(df, layout)

    def build(w):
        num = None
        for k in range(n):
            t = F.lit(float(n - k)) * F.lag(col, k).over(w) if k else F.lit(float(n)) * F.col(col)
            num = t if num is None else num + t
        cnt = F.count(col).over(frame(w, n))
        return [warm(cnt, n, num / F.lit(n * (n + 1) / 2.0)).alias(f"wma{n}")]
    return over_series(d, build, layout=layout, back=n - 1)


def roc(df: DataFrame, n: int, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TI3: ``roc{n}`` = close / close n bars back - 1."""
    d = ensure_index(df, layout)
    return over_series(d, lambda w: [(safe_div(F.col(col), F.lag(col, n).over(w)) - 1).alias(f"roc{n}")],
                       layout=layout, back=n)


def bollinger(df: DataFrame, n: int = 20, k: float = 2.0, *, col: str = "close",
              layout: Layout = PLAIN) -> DataFrame:
    """TI4: middle (SMA), upper / lower = middle ± k·population std, width, %B.
    Reuses ``{col}_mean{n}`` / ``{col}_std{n}`` from ``rolling`` when present."""
    d = ensure_index(df, layout)

    mean, std = f"{col}_mean{n}", f"{col}_std{n}"
    if mean in d.columns and std in d.columns:  # reuse ``rolling`` output (same warm-up mask)
        d = d.withColumn("_n", F.when(F.col(mean).isNotNull(), F.lit(n)).otherwise(F.lit(0))) \
             .withColumn("_mid", F.col(mean)).withColumn("_sd", F.col(std))
    else:
        d = sliding(d, n, [("_n", col, "count"), ("_mid", col, "mean"), ("_sd", col, "std")], layout=layout)
    cnt, mid, sd = F.col("_n"), F.col("_mid"), F.col("_sd")
    up, lo = mid + F.lit(k) * sd, mid - F.lit(k) * sd
    return d.select("*", warm(cnt, n, mid).alias("bb_mid"), warm(cnt, n, up).alias("bb_up"),
                    warm(cnt, n, lo).alias("bb_lo"),
                    warm(cnt, n, safe_div(up - lo, mid)).alias("bb_width"),
                    warm(cnt, n, safe_div(F.col(col) - lo, up - lo)).alias("bb_pctb")).drop("_n", "_mid", "_sd")


def donchian(df: DataFrame, n: int = 20, *, layout: Layout = PLAIN) -> DataFrame:
    """TI5: highest high, lowest low, mid of the last n bars."""
    d = ensure_index(df, layout)
    d = sliding(d, n, HIGH_LOW, layout=layout)
    cnt, hh, ll = F.col("_n"), F.col("_hh"), F.col("_ll")
    return d.select("*", warm(cnt, n, hh).alias("dc_high"), warm(cnt, n, ll).alias("dc_low"),
                    warm(cnt, n, (hh + ll) / 2).alias("dc_mid")).drop("_n", "_hh", "_ll")


def stochastic(df: DataFrame, n: int = 14, m: int = 3, *, layout: Layout = PLAIN) -> DataFrame:
    """TI6: %K = 100 (close - LL) / (HH - LL) over n; %D = SMA_m(%K)."""
    d = ensure_index(df, layout)
    d = sliding(d, n, HIGH_LOW, layout=layout)
    hh, ll = F.col("_hh"), F.col("_ll")
    k = F.lit(100.0) * safe_div(F.col("close") - ll, hh - ll)
    d = derive(d, {"stoch_k": warm(F.col("_n"), n, k)}, layout=layout).drop("_n", "_hh", "_ll")

    def d_build(w):
        f = frame(w, m)
        return [warm(F.count("stoch_k").over(f), m, F.avg("stoch_k").over(f)).alias("stoch_d")]
    return over_series(d, d_build, layout=layout, back=m - 1)


def williams_r(df: DataFrame, n: int = 14, *, layout: Layout = PLAIN) -> DataFrame:
    """TI7: -100 (HH - close) / (HH - LL)."""
    d = ensure_index(df, layout)
    d = sliding(d, n, HIGH_LOW, layout=layout)
    hh, ll = F.col("_hh"), F.col("_ll")
    v = F.lit(-100.0) * safe_div(hh - F.col("close"), hh - ll)
    return d.withColumn(f"willr{n}", warm(F.col("_n"), n, v)).drop("_n", "_hh", "_ll")


def cci(df: DataFrame, n: int = 20, *, layout: Layout = PLAIN) -> DataFrame:
    """TI8: (TP - SMA(TP)) / (0.015 · mean absolute deviation of TP from that SMA)."""
    d = derive(ensure_index(df, layout), {"_tp": _tp()}, layout=layout)

    def build(w):
        f = frame(w, n)
        return [F.avg("_tp").over(f).alias("_m"), F.collect_list("_tp").over(f).alias("_tps")]
    d = over_series(d, build, layout=layout, back=n - 1)
    m, tps = F.col("_m"), F.col("_tps")
    mad = F.aggregate(tps, F.lit(0.0), lambda acc, x: acc + F.abs(x - m)) / F.size(tps)
    v = safe_div(F.col("_tp") - m, F.lit(CCI_CONSTANT) * mad)
    return d.withColumn(f"cci{n}", warm(F.size(tps), n, v)).drop("_tp", "_m", "_tps")


def vwap(df: DataFrame, n: int = 20, *, layout: Layout = PLAIN) -> DataFrame:
    """TI9: Σ TP·volume / Σ volume over n bars; NULL when volume sums to 0."""
    d = ensure_index(df, layout)

    def build(w):
        f = frame(w, n)
        v = safe_div(F.sum(_tp() * F.col("volume")).over(f), F.sum("volume").over(f))
        return [warm(F.count("close").over(f), n, v).alias(f"vwap{n}")]
    return over_series(d, build, layout=layout, back=n - 1)


def cmf(df: DataFrame, n: int = 20, *, layout: Layout = PLAIN) -> DataFrame:
    """TI10: Chaikin money flow: Σ multiplier·volume / Σ volume over n."""
    d = ensure_index(df, layout)

    def build(w):
        f = frame(w, n)
        v = safe_div(F.sum(_mf_multiplier() * F.col("volume")).over(f), F.sum("volume").over(f))
        return [warm(F.count("close").over(f), n, v).alias(f"cmf{n}")]
    return over_series(d, build, layout=layout, back=n - 1)


def mfi(df: DataFrame, n: int = 14, *, layout: Layout = PLAIN) -> DataFrame:
    """TI11: money flow index.  Flow = TP·volume, positive when TP rises, negative
    when it falls.  100 - 100/(1 + PF/NF); NF = 0 -> 100; PF = NF = 0 -> NULL."""
    d = derive(ensure_index(df, layout), {"_tp": _tp()}, layout=layout)
    d = over_series(d, lambda w: [F.lag("_tp", 1).over(w).alias("_ptp")], layout=layout, back=1)
    flow = F.col("_tp") * F.col("volume")

    def build(w):
        f = frame(w, n)
        return [F.sum(F.when(F.col("_tp") > F.col("_ptp"), flow).otherwise(0.0)).over(f).alias("_pf"),
                F.sum(F.when(F.col("_tp") < F.col("_ptp"), flow).otherwise(0.0)).over(f).alias("_nf"),
                F.count("_ptp").over(f).alias("_n")]
    d = over_series(d, build, layout=layout, back=n - 1)
    pf, nf = F.col("_pf"), F.col("_nf")
    v = (F.when((pf == 0) & (nf == 0), F.lit(None).cast("double"))
         .when(nf == 0, F.lit(100.0))
         .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + pf / nf)))
    return d.withColumn(f"mfi{n}", warm(F.col("_n"), n, v)).drop("_tp", "_ptp", "_pf", "_nf", "_n")


def obv(df: DataFrame, *, layout: Layout = PLAIN) -> DataFrame:
    """TI12: running Σ sign(Δclose)·volume; 0 at the first bar."""
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [F.lag("close", 1).over(w).alias("_pc")], layout=layout, back=1)
    step = F.coalesce(F.signum(F.col("close") - F.col("_pc")) * F.col("volume"), F.lit(0.0))
    return running(d, [("obv", step, "sum")], layout=layout).drop("_pc")


def adl(df: DataFrame, *, layout: Layout = PLAIN) -> DataFrame:
    """TI13: accumulation / distribution line, running Σ multiplier·volume."""
    d = ensure_index(df, layout)
    return running(d, [("adl", _mf_multiplier() * F.col("volume"), "sum")], layout=layout)


def ema(df: DataFrame, n: int | None = None, *, alpha: float | None = None, col: str = "close",
        out: str | None = None, layout: Layout = PLAIN) -> DataFrame:
    """TI14: EMA with alpha = 2/(n+1) (NULL for the first n-1 rows) or a given alpha."""
    if (n is None) == (alpha is None):
        raise ValueError("give n or alpha")
    a = alpha if alpha is not None else 2.0 / (n + 1)
    out = out or (f"ema{n}" if n is not None else "ema")
    d = ensure_index(df, layout)
    return linear_scan(d, col, a, out, layout=layout, min_rows=n or 1)


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, *, col: str = "close",
         layout: Layout = PLAIN) -> DataFrame:
    """TI15: line = EMA_fast - EMA_slow (from the slow warm-up on), signal = EMA of
    the line seeded at its first value, histogram = line - signal."""
    d = ensure_index(df, layout)
    d = linear_scans(d, [(col, 2.0 / (fast + 1), "_ef", 1), (col, 2.0 / (slow + 1), "_es", slow)],
                     layout=layout)
    d = derive(d, {"macd": F.col("_ef") - F.col("_es")}, layout=layout)
    d = linear_scan(d, "macd", 2.0 / (signal + 1), "macd_signal", layout=layout,
                    start=slow - 1, min_rows=signal)
    return d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop("_ef", "_es")


def rsi(df: DataFrame, n: int = 14, *, col: str = "close", layout: Layout = PLAIN) -> DataFrame:
    """TI16: Wilder RSI; gains and losses smoothed with alpha = 1/n.
    Average loss 0 -> 100; both 0 -> NULL; NULL until n price changes exist."""
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [(F.col(col) - F.lag(col, 1).over(w)).alias("_dc")],
                    layout=layout, back=1)
    known = F.col("_dc").isNotNull()  # greatest() would turn a NULL change into 0
    d = derive(d, {"_gain": F.when(known, F.greatest(F.col("_dc"), F.lit(0.0))),
                   "_loss": F.when(known, F.greatest(-F.col("_dc"), F.lit(0.0)))}, layout=layout)
    d = linear_scans(d, [("_gain", 1.0 / n, "_ag", n), ("_loss", 1.0 / n, "_al", n)], layout=layout, start=1)
    ag, al = F.col("_ag"), F.col("_al")
    v = (F.when(ag.isNull() | al.isNull(), F.lit(None).cast("double"))
         .when((ag == 0) & (al == 0), F.lit(None).cast("double"))
         .when(al == 0, F.lit(100.0))
         .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + ag / al)))
    return d.withColumn(f"rsi{n}", v).drop("_dc", "_gain", "_loss", "_ag", "_al")


def _true_range(prev_close: Column) -> Column:
    h, lo = F.col("high"), F.col("low")
    return F.when(h.isNotNull() & lo.isNotNull(), F.greatest(h - lo, F.abs(h - prev_close), F.abs(lo - prev_close)))


def atr(df: DataFrame, n: int = 14, *, layout: Layout = PLAIN) -> DataFrame:
    """TI17: true range smoothed with alpha = 1/n (first bar: high - low)."""
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [F.lag("close", 1).over(w).alias("_pc")], layout=layout, back=1)
    d = derive(d, {"_tr": _true_range(F.col("_pc"))}, layout=layout)
    return linear_scan(d, "_tr", 1.0 / n, f"atr{n}", layout=layout, min_rows=n).drop("_pc", "_tr")


def adx(df: DataFrame, n: int = 14, *, layout: Layout = PLAIN) -> DataFrame:
    """TI18: +DI, -DI and ADX (Wilder, alpha = 1/n), from the second bar on.

    +DM = up move if it beats the down move and is positive, else 0 (and vice
    versa).  DI = 100 · smoothed DM / smoothed TR; DX = 100 |+DI - -DI| / (+DI + -DI);
    ADX = smoothed DX (DX = 0 when +DI + -DI = 0), NULL until n DX values exist;
    the DM / TR scans start at bar 1, the DX scan at bar n."""
    d = ensure_index(df, layout)
    d = over_series(d, lambda w: [F.lag("high", 1).over(w).alias("_ph"),
                                  F.lag("low", 1).over(w).alias("_pl"),
                                  F.lag("close", 1).over(w).alias("_pc")],
                    layout=layout, back=1)
    up, down = F.col("high") - F.col("_ph"), F.col("_pl") - F.col("low")
    has_prev = F.lit(True)  # the three inputs are known together
    for c in ("_pc", "_ph", "_pl", "high", "low"):
        has_prev = has_prev & F.col(c).isNotNull()
    d = derive(d, {"_pdm": F.when(has_prev, F.when((up > down) & (up > 0), up).otherwise(0.0)),
                   "_mdm": F.when(has_prev, F.when((down > up) & (down > 0), down).otherwise(0.0)),
                   "_tr": F.when(has_prev, _true_range(F.col("_pc")))}, layout=layout)
    d = linear_scans(d, [("_pdm", 1.0 / n, "_spdm", n), ("_mdm", 1.0 / n, "_smdm", n),
                         ("_tr", 1.0 / n, "_str", n)], layout=layout, start=1)
    pdi = F.lit(100.0) * safe_div(F.col("_spdm"), F.col("_str"))
    mdi = F.lit(100.0) * safe_div(F.col("_smdm"), F.col("_str"))
    d = derive(d, {"plus_di": pdi, "minus_di": mdi}, layout=layout)
    # DX is 0 when there is no directional movement at all (+DI + -DI = 0).
    dsum = F.col("plus_di") + F.col("minus_di")
    dx = F.when(dsum == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) * F.abs(F.col("plus_di") - F.col("minus_di")) / dsum)
    d = derive(d, {"_dx": dx}, layout=layout)
    d = linear_scan(d, "_dx", 1.0 / n, f"adx{n}", layout=layout, start=n, min_rows=n)
    return d.drop("_ph", "_pl", "_pc", "_pdm", "_mdm", "_tr", "_spdm", "_smdm", "_str", "_dx")
