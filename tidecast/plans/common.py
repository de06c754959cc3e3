"""Shared building blocks for registered plans: fixture bars and oracle SQL pieces."""

from __future__ import annotations

import contextvars
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.bars import freq_seconds, ticks_to_bars
from tidecast.operators.ordered import Layout, bar_index
from tidecast.sources.tables import FIXTURES

DIGITS = 6


def half_away(x):
    """``round(x, 0)`` of a double, halves away from zero, without going through a decimal
    text: x less its nearest whole number is exact, so 0.5 is seen where it is one."""
    near = F.rint(x)
    return F.when(F.abs(x - near) == 0.5, x + F.signum(x) * F.lit(0.5)).otherwise(near)


def rnd_half(c, digits: int = DIGITS):
    """round(x * 10^d) / 10^d: the same IEEE steps in every engine, so exact
    decimal ties (e.g. sums divided by 8) round the same way everywhere."""
    scale = float(10 ** digits)
    v = half_away(c * F.lit(scale)) / F.lit(scale)
    return F.when(v == 0, F.lit(0.0)).otherwise(v)  # one zero: -0.0 and 0.0 hash differently


def _rounded(xs, digits: int):
    """``rnd_half`` of every element of an array."""
    scale = float(10 ** digits)
    whole = F.transform(xs, lambda x: x * F.lit(scale))
    return F.transform(whole, lambda x: half_away(x) / F.lit(scale) + F.lit(0.0))  # -0.0 + 0.0 is 0.0


FEW = 8  # columns to round one by one


def finish(df: DataFrame, digits: int = DIGITS, by: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (also inside arrays) so engines compare equal; ``by``:
    the digits of columns whose values are so large that the last of ``digits`` would be
    rounding error.

    Many columns are rounded as one array per number of digits: written out column by
    column they make one method, too long for the JVM to compile, that runs interpreted."""
    doubles: dict[int, list[str]] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            doubles.setdefault((by or {}).get(f.name, digits), []).append(f.name)
    many, fields = sum(map(len, doubles.values())) > FEW, df.schema.fields
    place = {name: (d, k) for d, names in doubles.items() for k, name in enumerate(names)}
    if many:
        own = [F.col(f.name) for f in fields if f.name not in place]
        df = df.select(*own, *[_rounded(F.array(*names), d).alias(f"_rounded{d}") for d, names in doubles.items()])
    cols = []
    for f in fields:
        if f.name in place:
            d, k = place[f.name]
            cols.append((F.get(f"_rounded{d}", F.lit(k)) if many else rnd_half(F.col(f.name), d)).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            cols.append(F.transform(F.col(f.name), lambda x: rnd_half(x, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# When set, plans use this layout instead of choosing one from the data (used to
# run the halo path of a query against the same oracle at a small scale).
FORCED_LAYOUT: contextvars.ContextVar[Layout | None] = contextvars.ContextVar("forced_layout", default=None)


def fixture_bars(spark: SparkSession, sf_dir: str, fixture: str = "orders",
                 freq: str | int = "day") -> tuple[DataFrame, Layout]:
    """Bars of a fixture plus the layout chosen for them (one cheap job)."""
    ticks = FIXTURES[fixture](spark, sf_dir)
    forced = FORCED_LAYOUT.get()
    if forced is not None:
        layout = replace(forced, bar_seconds=freq_seconds(freq))
    else:
        layout = Layout.auto(ticks, bar_seconds=freq_seconds(freq))
    return ticks_to_bars(ticks, freq), replace(layout, distinct=True)


def with_layout(fn, layout: Layout):
    """A query that builds its plan with ``layout`` forced."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        token = FORCED_LAYOUT.set(layout)
        try:
            return fn(spark, sf_dir)
        finally:
            FORCED_LAYOUT.reset(token)
    run.__doc__ = f"{fn.__doc__ or ''} [{layout.mode} layout, chunks of {layout.chunk_rows} rows]"
    return run


def indexed_bars(spark: SparkSession, sf_dir: str, fixture: str = "orders",
                 freq: str | int = "day") -> tuple[DataFrame, Layout]:
    bars, layout = fixture_bars(spark, sf_dir, fixture, freq)
    return bar_index(bars, layout), layout


# ---------------------------------------------------------------- oracle SQL
TICKS_SQL = {
    "orders": ("SELECT o_orderpriority AS series, o_orderdate AS t_ts, o_orderkey AS seq, "
               "o_totalprice AS price, CAST(1 AS DOUBLE) AS qty FROM orders"),
    "events": ("SELECT event_type AS series, ts AS t_ts, event_id AS seq, value AS price, "
               "CAST(1 AS DOUBLE) AS qty FROM events"),
    "lineitem": ("SELECT CAST(l_suppkey AS VARCHAR) AS series, l_shipdate AS t_ts, "
                 "l_orderkey * 8 + l_linenumber AS seq, l_extendedprice AS price, "
                 "l_quantity AS qty FROM lineitem"),
}


def bars_sql(fixture: str = "orders", freq: str = "day") -> str:
    return f"""SELECT series, date_trunc('{freq}', t_ts) AS ts,
  arg_min(price, (t_ts, seq, price)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, (t_ts, seq, price)) AS close, sum(coalesce(qty, 0)) AS volume
FROM ({TICKS_SQL[fixture]}) tk WHERE price IS NOT NULL GROUP BY series, date_trunc('{freq}', t_ts)"""


def with_bars(fixture: str = "orders", freq: str = "day", extra: str = "") -> str:
    """WITH clause defining ``bars`` and ``ib`` (bars with the 0-based index i)."""
    more = f",\n{extra}" if extra else ""
    return f"""WITH bars AS ({bars_sql(fixture, freq)}),
ib AS (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS BIGINT) AS i FROM bars){more}
"""


def r(expr: str, name: str, digits: int = DIGITS) -> str:
    return f"{rsql(expr, digits)} AS {name}"


def rsql(expr: str, digits: int = DIGITS) -> str:
    v = f"(round(({expr}) * {float(10 ** digits)!r}) / {float(10 ** digits)!r})"
    return f"(CASE WHEN {v} = 0 THEN CAST(0 AS DOUBLE) ELSE {v} END)"


def nan_null(expr: str) -> str:
    """DuckDB returns NaN / inf where Spark returns NULL for undefined statistics."""
    return f"(CASE WHEN isfinite({expr}) THEN {expr} END)"
