"""Order-dependent computation over series without putting a series in one task.

Three shapes cover every order-dependent operator of the engine:

* **bounded** (``over_series``): a value at row ``i`` reads rows ``i-back .. i+ahead``.
  Plain layout: ``Window.partitionBy(series)``.  Halo layout: rows are cut into
  chunks of ``chunk_rows`` consecutive bar indexes; each row is copied into every
  chunk whose owned rows need it, the window runs per (series, chunk), and only
  owned rows are kept.  Work per task is bounded by ``chunk_rows + back + ahead``.
* **cumulative** (``running``): running sum / count / max / min / last-non-null, and
  the next non-null value, which runs backward.
  Halo layout: local running value per chunk, plus an exclusive prefix over the
  small per-chunk table, joined back.
* **recurrence** (``linear_scan``): y -> w*y + u at each input, y -> y at a NULL.
  A chunk of inputs is one such affine map; the maps are composed along the small
  chunk table, which gives the state before each chunk.

``one_pass`` runs many operators over one copy of the rows: it notes how far each of
them looks back, copies each row once, and takes all chunk totals in one aggregate.

The bar index ``i`` (0-based position in the series) is computed without a
series-wide sort: rows are grouped into fixed time buckets (a bucket of
``bucket_bars`` bar widths holds at most that many bars), numbered inside the
bucket, and offset by an exclusive prefix sum of the small bucket-count table.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass, field, replace
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.session import cut_lineage

IDX = "i"  # bar index column name
KEY, CHUNK, BUCKET = "_sk", "_chunk", "_bucket"  # partition columns of the chunked layouts
#: Outside ``one_pass`` each running value or recurrence reads its rows twice (totals and rows), so a
#: long chain of them would double its plan at every step: a plan with so many scans is cut first.
LEAVES = 8


@dataclass(frozen=True)
class Layout:
    mode: str = "plain"          # "plain" | "halo" | "pass" (inside ``one_pass``)
    series: str = "series"
    ts: str = "ts"
    bar_seconds: int = 86400     # bar width; bounds rows per time bucket
    bucket_bars: int = 4096      # bars per time bucket when indexing
    chunk_rows: int = 1 << 20    # owned rows per halo chunk
    longest: int | None = None   # no series has more bars, if that is known
    distinct: bool = False       # (series, ts) is known to be unique: as many rows as bars
    run: "Pass | None" = field(default=None, compare=False, repr=False)  # set inside ``one_pass``

    @staticmethod
    def auto(df: DataFrame, *, bar_seconds: int = 86400, max_plain_rows: int = 2_000_000,
             min_halo_rows: int = 262_144, series: str = "series", ts: str = "ts", **kw) -> "Layout":
        """Choose the layout from per-series row bounds (one cheap aggregate job
        reading only the series and ts columns, partially aggregated).

        The bound per series is min(rows, span / bar width + 1), so many ticks
        per bar do not count.  See ``choose_layout`` for the rule.
        """
        span = (ntz_micros(F.max(ts)) - ntz_micros(F.min(ts))) / F.lit(bar_seconds * 1_000_000)
        per = df.groupBy(series).agg(F.least(F.count(F.lit(1)), F.floor(span).cast("long") + 1).alias("n"))
        row = per.agg(F.max("n"), F.sum("n")).first()
        parallelism = df.sparkSession.sparkContext.defaultParallelism
        mode, chunk = choose_layout(int(row[0] or 0), int(row[1] or 0), parallelism, max_plain_rows=max_plain_rows,
                                    min_halo_rows=min_halo_rows)
        kw.setdefault("chunk_rows", chunk)
        # a span may touch one more bar than it holds, and NULL has a bar of its own
        kw.setdefault("longest", _at_most(int(row[0] or 0), bar_seconds) + 2)
        return Layout(mode=mode, series=series, ts=ts, bar_seconds=bar_seconds, **kw)

    def most(self, keys: Sequence[str]) -> int | None:
        """The most rows that a series or bucket holds, if that is known."""
        if not self.distinct:
            return None
        return _at_most(self.bucket_bars, self.bar_seconds) if BUCKET in keys else self.longest

    def with_mode(self, mode: str, **kw) -> "Layout":
        return replace(self, mode=mode, **kw)


def _at_most(bars: int, bar_seconds: int) -> int:
    """Bars in the time of so many bar widths: months are shorter than the 31 days they count as."""
    return bars + bars // 9 + 1 if bar_seconds >= 28 * 86400 else bars


PLAIN = Layout()


def choose_layout(longest: int, total: int, parallelism: int, *, max_plain_rows: int = 2_000_000,
                  min_halo_rows: int = 262_144) -> tuple[str, int]:
    """(mode, chunk_rows) for series whose longest holds ``longest`` of ``total`` rows.

    Halo when the longest series is too long for one task (> ``max_plain_rows``),
    or when it is big enough to matter (> ``min_halo_rows``) and more than twice
    a fair task share (total / parallelism): with few long series the plain
    layout would leave most cores idle.  Chunks aim at about two per core,
    between 64k and 1M rows.
    """
    share = max(1, total // max(1, parallelism))
    halo = longest > max_plain_rows or (longest > min_halo_rows and longest > 2 * share)
    target = max(1, total // max(1, 2 * parallelism))
    chunk = 1 << max(16, min(20, (target - 1).bit_length()))
    return ("halo" if halo else "plain"), chunk


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL, so rows with NULL keys are not lost."""
    own = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(own[f"_k_{k}"])
        on = same if on is None else on & same
    return left.join(own, on, how).drop(*[f"_k_{k}" for k in keys])


def series_key(series: str) -> Column:
    """The series as a string that is never NULL: NULL is one more series, and joins on it are plain equi-joins."""
    return F.when(F.col(series).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(series).cast("string")))


def with_buckets(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows dealt out by series and time bucket; a NULL ts goes before all others."""
    width = layout.bar_seconds * layout.bucket_bars * 1_000_000
    b = F.coalesce(F.floor(ntz_micros(F.col(layout.ts)) / F.lit(width)).cast("long"), F.lit(-(1 << 62)))
    return df.select("*", series_key(layout.series).alias(KEY), b.alias(BUCKET)).repartition(KEY, BUCKET)


def _local_index(rows: DataFrame, layout: Layout) -> DataFrame:
    w = Window.partitionBy(KEY, BUCKET).orderBy(layout.ts)
    return rows.select("*", (F.row_number().over(w) - 1).cast("long").alias(IDX))


def _offsets(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")


def bar_index(df: DataFrame, layout: Layout = PLAIN) -> DataFrame:
    """Add ``i``: 0-based position of each row in its series, ordered by ts.

    (series, ts) must be unique (``clean_bars`` guarantees it).  Rows with a
    NULL series or ts are kept in both layouts: NULL is one more series, and a
    NULL ts comes first in its series.
    """
    if layout.mode == "plain":
        w = Window.partitionBy(layout.series).orderBy(layout.ts)
        return df.withColumn(IDX, (F.row_number().over(w) - 1).cast("long"))
    rows = with_buckets(df, layout)
    # offsets has one row per (series, bucket): AQE broadcasts it when its
    # measured size is small and keeps a sort-merge join otherwise.
    offsets = _offsets(rows.groupBy(KEY, BUCKET).agg(F.count(F.lit(1)).alias("_n")))
    return (_local_index(rows, layout).join(offsets, [KEY, BUCKET])
            .withColumn(IDX, F.col(IDX) + F.col("_off")).drop(KEY, BUCKET, "_off"))


def ensure_index(df: DataFrame, layout: Layout) -> DataFrame:
    return df if IDX in df.columns else bar_index(df, layout)


def _copied(df: DataFrame, layout: Layout, back: int, ahead: int) -> DataFrame:
    """Each row once for every chunk that reads it."""
    c, idx = layout.chunk_rows, F.col(IDX)
    lo = F.floor(F.greatest(idx - F.lit(ahead), F.lit(0)) / F.lit(c)).cast("long")
    hi = F.floor((idx + F.lit(back)) / F.lit(c)).cast("long")
    return df.withColumn(CHUNK, F.explode(F.sequence(lo, hi)))


def _own_chunk(layout: Layout) -> Column:
    return F.floor(F.col(IDX) / F.lit(layout.chunk_rows)).cast("long")


def over_series(df: DataFrame, build: Callable[[Window], Sequence[Column]], *,
                layout: Layout = PLAIN, back: int = 0, ahead: int = 0) -> DataFrame:
    """Append the columns ``build(w)`` returns, where ``w`` is ordered by the bar
    index inside each series.  Frames used by ``build`` must stay within ``back``
    preceding and ``ahead`` following rows (halo size)."""
    if layout.mode == "pass":
        return layout.run.bounded(df, build, back, ahead)
    if layout.mode == "plain":
        return df.select("*", *build(Window.partitionBy(layout.series).orderBy(IDX)))
    copied = _copied(df, layout, back, ahead)
    return (copied.select("*", *build(Window.partitionBy(layout.series, CHUNK).orderBy(IDX)))
            .where(F.col(CHUNK) == _own_chunk(layout)).drop(CHUNK))


def in_chunks(df: DataFrame, body: Callable[[DataFrame, list[str]], DataFrame], inputs: Sequence[Column], *,
              layout: Layout = PLAIN, back: int = 0) -> DataFrame:
    """``body(rows, keys)`` appends columns by windows of several steps, each within
    ``keys`` and reading ``inputs`` up to ``back`` rows back."""
    if layout.mode == "pass":
        out = body(df, layout.run.keys)
        names = [c for c in out.columns if c not in df.columns]
        layout.run.note(df, names, [F.struct(*inputs)] * len(names), back)
        return out
    if layout.mode == "plain":
        return body(df, [layout.series])
    out = body(_copied(df, layout, back, 0), [layout.series, CHUNK])
    return out.where(F.col(CHUNK) == _own_chunk(layout)).drop(CHUNK)


def derive(df: DataFrame, columns: dict[str, Column], *, layout: Layout = PLAIN) -> DataFrame:
    """``withColumns`` for columns of the same row; inside ``one_pass`` it notes what they read."""
    out = df.withColumns(columns)
    if layout.mode == "pass":
        layout.run.note(df, list(columns), list(columns.values()))
    return out


# ---- running values and recurrences: local values, chunk totals, states before a chunk ----

_NUMBERS = itertools.count()


def _upto(keys: Sequence[str], order: Column | str = IDX) -> Window:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


class Running:
    """Running aggregates ``(name, column, kind)``; kind "next" runs backward."""

    LOCAL = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min,
             "last": lambda c: F.last(c, ignorenulls=True), "next": lambda c: F.last(c, ignorenulls=True)}

    def __init__(self, specs: Iterable[tuple[str, Column, str]]):
        self.specs = list(specs)
        self.q = f"_q{next(_NUMBERS)}"
        self.outs = [n for n, *_ in self.specs]
        self.inputs = [c for _, c, _ in self.specs]

    def prepare(self, df: DataFrame, keys: Sequence[str], live: Column | None = None, most: int | None = None) -> DataFrame:
        """Local values within ``keys``, which hold at most ``most`` rows each, if that is
        known; rows that are not ``live`` count for nothing."""
        q = self.q
        masked = df.withColumns({f"{q}x{k}": (c if live is None else F.when(live, c)) for k, (_, c, _) in enumerate(self.specs)})
        forward, backward = _upto(keys), _upto(keys, F.col(IDX).desc())
        return masked.select("*", *[self.LOCAL[kind](F.col(f"{q}x{k}")).over(backward if kind == "next" else forward).alias(f"{q}l{k}")
                                    for k, (*_, kind) in enumerate(self.specs)])

    def totals(self, counted: Column) -> list[Column]:
        out = []
        for k, (*_, kind) in enumerate(self.specs):
            x = F.when(counted, F.col(f"{self.q}x{k}"))
            at = F.when(x.isNotNull(), F.col(IDX))
            agg = {"last": lambda: F.max_by(x, at), "next": lambda: F.min_by(x, at)}.get(kind, lambda: self.LOCAL[kind](x))()
            out.append(agg.alias(f"{self.q}t{k}"))
        return out

    def prefix(self, chunks: DataFrame, chunk: str) -> DataFrame:
        """The state before each chunk, from the totals of the chunks before it."""
        def others(order: Column) -> Window:
            return Window.partitionBy(KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

        before, behind = others(F.col(chunk).asc()), others(F.col(chunk).desc())
        agg = self.LOCAL | {"count": F.sum}
        return (chunks.withColumns({f"{self.q}p{k}": agg[kind](F.col(f"{self.q}t{k}")).over(behind if kind == "next" else before)
                                    for k, (*_, kind) in enumerate(self.specs)})
                .drop(*[f"{self.q}t{k}" for k in range(len(self.specs))]))

    def finish(self, df: DataFrame, whole: Sequence[str] = ()) -> DataFrame:
        """The outputs; ``whole``: keys within which nothing stands before the local values."""
        outs = {}
        for k, (name, _, kind) in enumerate(self.specs):
            here = F.col(f"{self.q}l{k}")
            if not whole:
                before = F.col(f"{self.q}p{k}")
                if kind in ("sum", "count"):
                    here = F.when(here.isNotNull() | before.isNotNull(), F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)))
                else:
                    here = {"max": F.greatest, "min": F.least}.get(kind, F.coalesce)(here, before)
            outs[name] = here
        return df.withColumns(outs).drop(*[f"{self.q}{p}{k}" for k in range(len(self.specs)) for p in "xlp"])


def block_size(w: float) -> int:
    """Inputs per block: w^-B stays far below the double range, and w^B is nothing beside 1."""
    return max(1, int(600.0 / -math.log(w))) if w > 0.0 else 1


class Scans:
    """Exponential smoothings ``(x, alpha, out, min_rows)`` that share their inputs.

    With c inputs up to a row, w = 1 - alpha and u = alpha * x, the value is
        y = sum_{k<=c} w^(c-k) u_k  +  w^c * y_before,
    an affine map of the state before the partition.  The sum is closed per block of B
    inputs (powers of w relative to the block); of earlier blocks only the last one is
    not negligible, as w^B is below e^-300.  The state before the first input is that
    input itself, so the first value is x.
    """

    def __init__(self, specs: Sequence[tuple], start: int):
        self.specs = [(F.col(x) if isinstance(x, str) else x, alpha, out, m) for x, alpha, out, m in specs]
        if not all(0.0 < alpha <= 1.0 for _, alpha, *_ in self.specs):
            raise ValueError("alpha must be in (0, 1]")
        self.start = start
        self.q = f"_q{next(_NUMBERS)}"
        self.outs = [out for *_, out, _ in self.specs]
        self.inputs = [x for x, *_ in self.specs] + ([F.col(IDX)] if start else [])
        self.alphas = sorted({alpha for _, alpha, *_ in self.specs})

    def _temps(self, *kinds: str) -> list[str]:
        return [f"{self.q}{kind}{k}" for kind in kinds for k in range(len(self.specs))]

    def prepare(self, df: DataFrame, keys: Sequence[str], live: Column | None = None, most: int | None = None) -> DataFrame:
        """Local values within ``keys``.  Where these hold no more than ``most`` rows and a
        block does too, there is one block and no second order of the rows."""
        q = self.q
        valid = F.col(IDX) >= F.lit(self.start) if self.start else F.lit(True)
        for x, *_ in self.specs:
            valid = valid & x.isNotNull()
        if live is not None:
            valid = valid & live
        d = df.withColumns({f"{q}v": valid} | {f"{q}x{k}": F.when(valid, x) for k, (x, *_) in enumerate(self.specs)})
        v = F.col(f"{q}v")
        d = d.select("*", F.count(F.when(v, F.lit(1))).over(_upto(keys)).alias(f"{q}c"))
        j = F.col(f"{q}c") - 1
        ends, sums, blocked = {}, {}, []
        for a, alpha in enumerate(self.alphas):
            w, size = 1.0 - alpha, block_size(1.0 - alpha)
            one = most is not None and most <= size
            mine = [k for k, spec in enumerate(self.specs) if spec[1] == alpha]
            # pow(w, +-j) is exact to ~1 ulp; exp(j * ln w) would lose |j ln w| ulps
            block = F.lit(0) if one else F.when(v, F.floor(j / F.lit(size))).otherwise(F.lit(-1))
            within = j if one else j - F.col(f"{q}_block") * F.lit(size)
            if not one:
                d = d.withColumn(f"{q}_block", block.cast("long"))
            d = d.withColumn(f"{q}j{a}", F.when(v, within).otherwise(F.lit(0)).cast("double"))
            power = F.pow(F.lit(w), F.col(f"{q}j{a}")) if w else F.lit(1.0)
            scaled = {k: F.lit(alpha) * F.col(f"{q}x{k}") * (F.pow(F.lit(w), -F.col(f"{q}j{a}")) if w else F.lit(1.0)) for k in mine}
            if one:
                sums |= {f"{q}s{k}": F.sum(scaled[k]).over(_upto(keys)) * power for k in mine}
                continue
            blocked += mine
            d = d.select("*", *[(F.sum(scaled[k]).over(_upto([*keys, f"{q}_block"])) * power).alias(f"{q}s{k}") for k in mine]).drop(f"{q}_block")
            for k in mine:
                ends[f"{q}e{k}"] = F.when(v & (F.col(f"{q}j{a}") == F.lit(size - 1)), F.col(f"{q}s{k}"))
        d = d.withColumns(ends) if ends else d
        before = _upto(keys).rowsBetween(Window.unboundedPreceding, -1)
        d = d.select("*", *[c.alias(name) for name, c in sums.items()], *[F.last(F.col(f"{q}e{k}"), ignorenulls=True).over(before).alias(f"{q}z{k}") for k in blocked])
        y = {}
        for k, (_, alpha, *_) in enumerate(self.specs):
            s = F.col(f"{q}s{k}")
            if k in blocked:
                s = s + F.coalesce(F.pow(F.lit(1.0 - alpha), F.col(f"{q}j{self.alphas.index(alpha)}") + 1) * F.col(f"{q}z{k}"), F.lit(0.0))
            y[f"{q}y{k}"] = F.when(v, s)
        return d.withColumns(y).drop(*self._temps("s", "e", "z"), *[f"{q}j{a}" for a in range(len(self.alphas))])

    def totals(self, counted: Column) -> list[Column]:
        live = F.when(F.col(f"{self.q}v"), F.col(IDX))
        at = F.when(counted, live)
        out = [F.count(at).alias(f"{self.q}n")]
        for k in range(len(self.specs)):  # the first input of all may be one that the next chunks count
            out += [F.max_by(F.col(f"{self.q}y{k}"), at).alias(f"{self.q}u{k}"), F.min_by(F.col(f"{self.q}x{k}"), live).alias(f"{self.q}f{k}")]
        return out

    def prefix(self, chunks: DataFrame, chunk: str) -> DataFrame:
        """Composition of the chunks' maps: closed per group of B inputs, as inside a chunk."""
        q = self.q
        order = Window.partitionBy(KEY).orderBy(chunk)
        upto, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
        d = chunks.withColumn(f"{q}_upto", F.sum(f"{q}n").over(upto))
        for alpha in self.alphas:
            w, size = 1.0 - alpha, block_size(1.0 - alpha)
            mine = [k for k, spec in enumerate(self.specs) if spec[1] == alpha]
            d = d.withColumn(f"{q}_group", F.floor(F.col(f"{q}_upto") / F.lit(size)).cast("long"))
            e = (F.col(f"{q}_upto") - F.col(f"{q}_group") * F.lit(size)).cast("double")
            power, inverse = (F.pow(F.lit(w), e), F.pow(F.lit(w), -e)) if w else (F.lit(1.0), F.lit(1.0))
            group = Window.partitionBy(KEY, f"{q}_group").orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            d = d.select("*", *[(F.sum(F.when(F.col(f"{q}n") > 0, F.col(f"{q}u{k}") * inverse)).over(group) * power).alias(f"{q}_sum{k}") for k in mine],
                         (F.coalesce(F.lead(f"{q}_group").over(order) != F.col(f"{q}_group"), F.lit(True))).alias(f"{q}_ends"))
            last = F.last(F.when(F.col(f"{q}_ends"), F.struct(F.col(f"{q}_upto").alias("upto"), *[F.col(f"{q}_sum{k}").alias(f"sum{k}") for k in mine])), ignorenulls=True)
            d = d.select("*", last.over(before).alias(f"{q}_last"))
            fade = F.pow(F.lit(w), (F.col(f"{q}_upto") - F.col(f"{q}_last")["upto"]).cast("double"))
            d = d.withColumns({f"{q}_state{k}": F.coalesce(F.col(f"{q}_sum{k}"), F.lit(0.0)) + F.coalesce(fade * F.col(f"{q}_last")[f"sum{k}"], F.lit(0.0)) for k in mine})
            d = d.drop(f"{q}_group", f"{q}_ends", f"{q}_last", *[f"{q}_sum{k}" for k in mine])
        d = d.withColumn(f"{q}_before", F.coalesce(F.lag(f"{q}_upto").over(order), F.lit(0)))
        states = {}
        for k, (_, alpha, *_) in enumerate(self.specs):
            first = F.first(f"{q}f{k}", ignorenulls=True).over(upto)
            states[f"{q}i{k}"] = F.coalesce(F.lag(f"{q}_state{k}").over(order), F.lit(0.0)) + F.pow(F.lit(1.0 - alpha), F.col(f"{q}_before").cast("double")) * first
        return d.withColumns(states).drop(f"{q}n", f"{q}_upto", *self._temps("u", "f", "_state"))

    def finish(self, df: DataFrame, whole: Sequence[str] = ()) -> DataFrame:
        q, c = self.q, F.col(f"{self.q}c")
        if whole:
            df = df.select("*", F.lit(0).alias(f"{q}_before"), *[F.first(f"{q}x{k}", ignorenulls=True).over(_upto(whole)).alias(f"{q}i{k}") for k in range(len(self.specs))])
        outs = {}
        for k, (_, alpha, out, min_rows) in enumerate(self.specs):
            y = F.col(f"{q}y{k}") + F.pow(F.lit(1.0 - alpha), c.cast("double")) * F.col(f"{q}i{k}")
            outs[out] = F.when(F.col(f"{q}v") & (F.col(f"{q}_before") + c >= F.lit(min_rows)), y)
        return df.withColumns(outs).drop(f"{q}v", f"{q}c", f"{q}_before", *self._temps("x", "y", "i"))


def _carried(df: DataFrame, request: Running | Scans, layout: Layout) -> DataFrame:
    if layout.mode == "pass":
        return layout.run.carried(df, request)
    if layout.mode == "plain":
        keys = [layout.series]
        return request.finish(request.prepare(df, keys, most=layout.most(keys)), whole=keys)
    if df._jdf.queryExecution().analyzed().collectLeaves().size() >= LEAVES:
        df = cut_lineage(df)
    rows = df.select("*", series_key(layout.series).alias(KEY), _own_chunk(layout).alias(CHUNK)).repartition(KEY, CHUNK)
    local = request.prepare(rows, [KEY, CHUNK], most=layout.chunk_rows)
    states = request.prefix(local.groupBy(KEY, CHUNK).agg(*request.totals(F.lit(True))), CHUNK)
    return request.finish(local.join(states, [KEY, CHUNK])).drop(KEY, CHUNK)


def running(df: DataFrame, specs: Iterable[tuple[str, Column, str]], *, layout: Layout = PLAIN) -> DataFrame:
    """Append running aggregates ``(name, column, kind)`` with kind in
    sum | count | max | min | last (last non-null value so far) | next (first non-null
    value from here on)."""
    return _carried(df, Running(specs), layout)


def linear_scan(df: DataFrame, x: Column | str, alpha: float, out: str, *,
                layout: Layout = PLAIN, start: int = 0, min_rows: int = 1) -> DataFrame:
    """Exponential smoothing y_t = alpha*x_t + (1-alpha)*y_{t-1} along the bar index.

    The first non-null input at or after bar index ``start`` seeds the state
    (y = x).  A NULL input gives a NULL output and leaves the state as it is.
    Output is NULL until ``min_rows`` non-null inputs have been seen.  See
    ``linear_scans``.
    """
    return linear_scans(df, [(x, alpha, out, min_rows)], layout=layout, start=start)


def linear_scans(df: DataFrame, specs: Sequence[tuple], *, layout: Layout = PLAIN,
                 start: int = 0) -> DataFrame:
    """Several exponential smoothings ``(x, alpha, out, min_rows)`` sharing one
    start bar.  Inputs of one call count together: a row is an input if all of them
    are non-null.  See ``Scans``."""
    return _carried(df, Scans(specs, start), layout)


# ---- many operators over one copy of the rows --------------------------------------------


@dataclass
class Need:
    """How far a column looks: rows back and ahead, and through how many chunk totals."""

    back: int = 0
    ahead: int = 0
    level: int = 0

    def with_(self, other: "Need") -> "Need":
        return Need(max(self.back, other.back), max(self.ahead, other.ahead), max(self.level, other.level))


class Pass:
    """State of one run of the operators inside ``one_pass``.

    Runs, in order: "measure" notes what every column needs; "buckets" takes the totals of
    requests that read nothing but their own row, per time bucket; "bucket values" computes
    their outputs; "chunks" at each level takes the totals of the requests of that level
    (and computes those below).  A run only builds a plan.
    """

    def __init__(self, layout: Layout, base: Sequence[str]):
        self.layout = layout
        self.need: dict[str, Need] = {c: Need() for c in base}
        self.requests: list[Need] = []   # by place in the run
        self.raw: list[bool] = []
        self.kept: list[str] = []
        self.made: dict[str, int] = {}   # column -> the step that appends it
        self.first: list[int] = []       # step -> place of its first request
        self.uses: list[set[int]] = []   # step -> the steps whose columns it names
        self.begin("measure")

    def begin(self, phase: str, level: int = 0, reach: int = 0, ahead: int = 0) -> Layout:
        self.phase, self.level, self.reach, self.ahead = phase, level, reach, ahead
        self.keys = [KEY, CHUNK] if phase == "chunks" else [KEY, BUCKET]
        self.place = 0
        self.pending: list[Running | Scans] = []
        return replace(self.layout, mode="pass", run=self)

    def reads(self, df: DataFrame, columns: Sequence[Column]) -> tuple[Need, set[str]]:
        """What the columns of ``df`` named in the expressions need; a name that only looks
        like one of them is counted too, and a column of unknown origin as needing most."""
        text = " ".join(str(c) for c in columns)
        named = {c for c in df.columns if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", text)}
        total, most = Need(), Need()
        for n in self.need.values():
            most = most.with_(n)
        for c in named:
            total = total.with_(self.need.get(c, most))
        if self.uses:
            self.uses[-1].update(self.made[c] for c in named if c in self.made)
        return total, named

    def note(self, df: DataFrame, names: Sequence[str], columns: Sequence[Column], back: int = 0, ahead: int = 0) -> None:
        if self.phase == "measure":
            for name, column in zip(names, columns):
                n, _ = self.reads(df, [column])
                self.need[name] = Need(n.back + back, n.ahead + ahead, n.level)

    def run(self, df: DataFrame, steps: Sequence["Step"], inside: Layout, wanted: Callable[[int], bool] | None = None) -> DataFrame:
        """The steps one after the other; with ``wanted``, only those that make a request of
        such a place, and those whose columns they name."""
        if self.phase == "measure":
            for k, step in enumerate(steps):
                self.first.append(self.place)
                self.uses.append(set())
                before = set(df.columns)
                df = step(df, inside)
                self.made.update({c: k for c in df.columns if c not in before})
            self.first.append(self.place)
            return df
        chosen = set(range(len(steps)))
        if wanted is not None:
            chosen = {k for k in chosen if any(wanted(place) for place in range(self.first[k], self.first[k + 1]))}
            todo = list(chosen)
            while todo:
                more = self.uses[todo.pop()] - chosen
                chosen |= more
                todo += more
        for k in sorted(chosen):
            self.place = self.first[k]
            df = steps[k](df, inside)
        return df

    def bounded(self, df: DataFrame, build, back: int, ahead: int) -> DataFrame:
        columns = build(Window.partitionBy(*self.keys).orderBy(IDX))
        out = df.select("*", *columns)
        self.note(df, out.columns[len(df.columns):], columns, back, ahead)
        return out

    def carried(self, df: DataFrame, request: Running | Scans) -> DataFrame:
        place, self.place = self.place, self.place + 1
        none = {out: F.lit(None).cast("double") for out in request.outs}
        if self.phase == "measure":
            need, named = self.reads(df, request.inputs)
            raw = need == Need() and IDX not in named
            self.requests.append(need)
            self.raw.append(raw)
            for out in request.outs:
                self.need[out] = Need() if raw else Need(need.back, need.ahead, need.level + 1)
            return df.withColumns(none)
        request.q = f"_q{place}"  # the same names in every run, so that states joined before are found
        if self.phase != "chunks":
            if not self.raw[place]:
                return df.withColumns(none)
            local = request.prepare(df, self.keys, most=self.layout.most(self.keys))
            if self.phase == "buckets":
                self.pending.append(request)
                return local.withColumns(none)
            done = request.finish(local)
            names = {f"_r{place}_{out}": F.col(out) for out in request.outs}
            self.kept += names
            return done.withColumns(names)
        if self.raw[place]:
            return df.withColumns({out: F.col(f"_r{place}_{out}") for out in request.outs})
        need = self.requests[place]
        if need.level > self.level:
            return df.withColumns(none)
        # a chunk's total ends where the rows that the next chunk can compute by itself begin
        border = F.col(CHUNK) * F.lit(self.layout.chunk_rows) - F.lit(self.reach - need.back)
        local = request.prepare(df, self.keys, F.col(IDX) >= border, self.layout.chunk_rows + self.reach + self.ahead)
        if need.level < self.level:
            return request.finish(local)
        request.counted = (F.col(IDX) >= border) & (F.col(IDX) < border + F.lit(self.layout.chunk_rows))
        self.pending.append(request)
        return local.withColumns(none)


Step = Callable[[DataFrame, Layout], DataFrame]


def one_pass(bars: DataFrame, steps: Sequence[Step], *, layout: Layout = PLAIN) -> DataFrame:
    """``bars`` with the bar index and everything that ``steps`` append, each a call of an
    operator ``(df, layout) -> df``.  A step that reads a column of another step in its own
    ``withColumn`` calls ``derive`` instead, so that the plan knows of it.

    Plain layout: the steps one after the other.  Halo layout: each row is copied once, by
    the farthest look of any step, and every step runs inside the chunks.  Totals of running
    values and recurrences whose inputs are the bars' own columns come with the bucket counts
    of the index; all others of one level (inputs that themselves come from totals are the
    next level) in one aggregate over the chunks.  Shuffles, whatever the number of steps:
    rows by bucket and by chunk, and two of a small table (one row per bucket or chunk) for
    the index and for each level.  Rows and their totals come from the same two shuffles,
    which Spark reuses as both read all columns: hence the checksum among the totals.
    """
    if layout.mode == "plain":
        df = bar_index(bars, layout)
        for step in steps:
            df = step(df, layout)
        return df

    def checksum(df: DataFrame) -> Column:
        return F.bit_xor(F.xxhash64(*df.columns)).alias("_sum")

    columns = bars.columns
    p = Pass(layout, [*columns, IDX, KEY, BUCKET, CHUNK])
    inside = p.begin("measure")
    nothing = bars.sparkSession.createDataFrame([], bars.schema)
    p.run(nothing.withColumns({IDX: F.lit(0).cast("long"), KEY: F.lit(""), BUCKET: F.lit(0).cast("long")}), steps, inside)
    back, ahead = max((n.back for n in p.need.values()), default=0), max((n.ahead for n in p.need.values()), default=0)

    rows = with_buckets(bars, layout)
    numbered = _local_index(rows, layout)
    inside = p.begin("buckets")
    local = p.run(numbered, steps, inside, lambda place: p.raw[place])
    totals = [t for r in p.pending for t in r.totals(F.lit(True))]
    counts = local.groupBy(KEY, BUCKET).agg(F.count(F.lit(1)).alias("_n"), checksum(rows), *totals)
    states = _offsets(counts.where("_sum IS NOT NULL").drop("_sum"))
    for r in p.pending:
        states = r.prefix(states, BUCKET)
    d = numbered.join(states, [KEY, BUCKET])
    inside = p.begin("bucket values")
    d = p.run(d, steps, inside, lambda place: p.raw[place])
    d = d.select(*columns, (F.col(IDX) + F.col("_off")).alias(IDX), KEY, *p.kept)

    copied = _copied(d, layout, back, ahead).repartition(KEY, CHUNK)
    d = copied
    levels = max((n.level + 1 for n, raw in zip(p.requests, p.raw) if not raw), default=0)
    for level in range(levels):
        inside = p.begin("chunks", level, back, ahead)
        local = p.run(d, steps, inside, lambda place: not p.raw[place] and p.requests[place].level == level)
        totals = [t for r in p.pending for t in r.totals(r.counted)]
        states = local.groupBy(KEY, CHUNK).agg(checksum(copied), *totals).where("_sum IS NOT NULL").drop("_sum")
        for r in p.pending:
            states = r.prefix(states, CHUNK)
        d = d.join(states, [KEY, CHUNK])
    inside = p.begin("chunks", levels, back, ahead)
    return p.run(d, steps, inside).where(F.col(CHUNK) == _own_chunk(layout)).drop(KEY, CHUNK, *p.kept)
