"""Sliding statistics of the last n rows at a cost per row that does not grow with n.

Spark evaluates a bounded row frame anew for each row, n steps a row.  Here rows are cut
into blocks of n by bar index; a window ending at row i is the end of one block and the
beginning of the next, so its statistic is that of two running values: one forward from
the block's first row to i, one backward from the block's last row to i - n + 1.

* min, max: the greater (smaller) of the two;
* sum, count: the sum of the two, without the cancellation of differences of prefix sums;
* mean, std: counts, means and squared deviations of the two, merged by Chan's formula.

Below ``FRAME`` rows a plain frame is as fast and needs no further sorts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.ordered import IDX, PLAIN, Layout, in_chunks, over_series

FRAME = 64
STATS = ("count", "sum", "mean", "std", "min", "max")
_PARTS = {"count": ("n",), "sum": ("n", "s"), "mean": ("n", "s"), "std": ("n", "m", "q"), "min": ("lo",), "max": ("hi",)}
_RUNNING = {"n": F.count, "s": F.sum, "m": F.avg, "q": F.var_pop, "lo": F.min, "hi": F.max}
_PLAIN = {"count": F.count, "sum": F.sum, "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}


def sliding(df: DataFrame, n: int, specs: Sequence[tuple[str, Column | str, str]], *, layout: Layout = PLAIN) -> DataFrame:
    """Append ``(name, column, stat)`` over the last n rows, the current one included; NULLs
    count for nothing.  ``df`` has the bar index.  Before n rows exist, all there are."""
    norm = [(name, F.col(c) if isinstance(c, str) else c, stat) for name, c, stat in specs]
    if n <= FRAME:
        return over_series(df, lambda w: [_PLAIN[stat](c).over(w.rowsBetween(-(n - 1), 0)).alias(name) for name, c, stat in norm],
                           layout=layout, back=n - 1)
    columns: list[tuple[Column, set[str]]] = []  # each input once, with the parts it needs
    place = []
    for _, c, stat in norm:
        k = next((k for k, (known, _) in enumerate(columns) if str(known) == str(c)), len(columns))
        if k == len(columns):
            columns.append((c, set()))
        columns[k][1].update(_PARTS[stat])
        place.append(k)

    def body(rows: DataFrame, keys: list[str]) -> DataFrame:
        idx = F.col(IDX)
        d = rows.withColumns({"_w_b": F.floor(idx / F.lit(n)).cast("long")} | {f"_w_x{k}": c for k, (c, _) in enumerate(columns)})
        for way, order in (("f", idx.asc()), ("r", idx.desc())):
            w = Window.partitionBy(*keys, "_w_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            d = d.select("*", *[_RUNNING[p](f"_w_x{k}").over(w).alias(f"_w_{way}{p}{k}") for k, (_, parts) in enumerate(columns) for p in sorted(parts)])
        temps = [f"_w_r{p}{k}" for k, (_, parts) in enumerate(columns) for p in sorted(parts)]
        w = Window.partitionBy(*keys).orderBy(IDX)
        whole = F.pmod(idx, F.lit(n)) == n - 1  # the window is one block
        d = d.select("*", *[F.when(~whole, F.lag(t, n - 1).over(w)).alias(f"{t}_") for t in temps])

        def parts(p: str, k: int) -> tuple[Column, Column]:
            return F.col(f"_w_f{p}{k}"), F.col(f"_w_r{p}{k}_")

        def value(k: int, stat: str) -> Column:
            if stat in ("min", "max"):
                return (F.least if stat == "min" else F.greatest)(*parts(_PARTS[stat][0], k))
            n1, n2 = parts("n", k)
            n2 = F.coalesce(n2, F.lit(0))
            count = n1 + n2
            if stat == "count":
                return count
            if stat in ("sum", "mean"):
                s1, s2 = parts("s", k)
                total = F.when(count > 0, F.coalesce(s1, F.lit(0.0)) + F.coalesce(s2, F.lit(0.0)))
                return total if stat == "sum" else F.try_divide(total, count)
            (m1, m2), (q1, q2) = parts("m", k), parts("q", k)
            apart = F.coalesce(m1 - m2, F.lit(0.0))
            squares = F.coalesce(q1 * n1, F.lit(0.0)) + F.coalesce(q2 * n2, F.lit(0.0)) + F.try_divide(apart * apart * n1 * n2, count)
            return F.when(count > 0, F.sqrt(F.try_divide(squares, count)))

        d = d.withColumns({name: value(k, stat) for (name, _, stat), k in zip(norm, place)})
        return d.drop("_w_b", *[f"_w_x{k}" for k in range(len(columns))], *temps, *[f"{t}_" for t in temps], *[t.replace("_w_r", "_w_f") for t in temps])

    return in_chunks(df, body, [c for _, c, _ in norm], layout=layout, back=n - 1)
