"""Exact nearest-rank quantiles per group without collecting a group.

The p-quantile is the value of rank r = max(1, ceil(p * n)) in ascending
order (the nearest-rank definition shared by ``percentile_approx`` in exact
mode and SQL ``quantile_disc``).

Each (group, p) has an open bracket of values with the rank inside.  While some
bracket holds more rows than one task should sort, all of them are narrowed:

1. a ``percentile_approx`` sketch of the rows inside gives ``CUTS`` cut points;
2. one hash aggregate counts the rows equal to each cut point and between each
   two, exactly; the running count over those few bins names the one that holds
   the rank.  If it is a cut point, the value is found, however often it occurs;
   else the bracket is the gap between two cut points, with about 1 / CUTS of the rows.

So a round divides the largest bracket by about CUTS whatever the distribution, and
the last step sorts at most ``most`` rows a bracket.  Memory per group is bounded by
the sketch, the bins and ``most``, never by n.  Values are cut from their lineage once;
brackets are a small table (groups x ps rows) that joins them by group: AQE
broadcasts it when measured small and splits skewed groups otherwise.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import cut_lineage

CUTS = 64
ACCURACY = 10_000
BRACKET = ("_j", "_r", "_below", "_rows", "_lo", "_hi")


def exact_quantiles(df: DataFrame, x: Column | str, ps: Sequence[float], *, by: Sequence[str] = (),
                    most: int = 50_000) -> DataFrame:
    """Rows (*by, p, value): exact nearest-rank p-quantiles of ``x`` per group
    (NULL inputs ignored; groups without values are absent; a NULL key is one
    more group; an empty table has none)."""
    by = list(by)
    ps = [float(p) for p in ps]
    xc = F.col(x) if isinstance(x, str) else x
    # the key as a struct: never NULL itself, so every group is joined by plain equality
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    d = cut_lineage(df.select(key.alias("_g"), xc.cast("double").alias("_x")).where(F.col("_x").isNotNull()))
    ranked = [F.struct(F.lit(j).alias("_j"), F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("_rows"))).cast("long").alias("_r")) for j, p in enumerate(ps)]
    none = F.lit(None).cast("double")
    brackets = cut_lineage(
        d.groupBy("_g").agg(F.count(F.lit(1)).alias("_rows")).select("_g", "_rows", F.explode(F.array(*ranked)).alias("_b"))
        .select("_g", "_b._j", "_b._r", F.lit(0).cast("long").alias("_below"), "_rows", none.alias("_lo"), none.alias("_hi"), none.alias("_value")))
    while (brackets.where("_value IS NULL").agg(F.max("_rows")).first()[0] or 0) > most:
        brackets = cut_lineage(_narrowed(d, brackets))
    found = brackets.where("_value IS NOT NULL").select("_g", "_j", F.col("_value").alias("value"))
    rest = brackets.where("_value IS NULL")
    pairs = _inside(d, rest, F.struct(*BRACKET)).groupBy("_g", "_b._j", "_x").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_b._below").alias("_below"), F.first("_b._r").alias("_r"))
    upto = Window.partitionBy("_g", "_j").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = pairs.withColumn("_upto", F.col("_below") + F.sum("_c").over(upto))
    hit = counted.where((F.col("_upto") >= F.col("_r")) & (F.col("_upto") - F.col("_c") < F.col("_r")))
    out = found.unionByName(hit.select("_g", "_j", F.col("_x").alias("value")))
    p = F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("_j") + 1)
    return out.select(*[F.col(f"_g.{c}").alias(c) for c in by], p.alias("p"), "value")


def _inside(d: DataFrame, brackets: DataFrame, bracket: Column) -> DataFrame:
    """(_g, _x, _b) for every open bracket ``_b`` that holds the row."""
    sets = brackets.groupBy("_g").agg(F.collect_list(bracket).alias("_bs"))  # at most one per p

    def holds(b: Column) -> Column:
        x = F.col("_x")
        return (b["_lo"].isNull() | (x > b["_lo"])) & (b["_hi"].isNull() | (x < b["_hi"]))

    return d.join(sets, "_g").select("_g", "_x", F.explode(F.filter("_bs", holds)).alias("_b"))


def _narrowed(d: DataFrame, brackets: DataFrame) -> DataFrame:
    """Brackets after one round; those with a value stay as they are."""
    rest, done = brackets.where("_value IS NULL"), brackets.where("_value IS NOT NULL")
    cuts = (_inside(d, rest, F.struct(*BRACKET)).groupBy("_g", "_b._j")
            .agg(F.array_sort(F.array_distinct(F.percentile_approx("_x", [k / CUTS for k in range(CUTS + 1)], ACCURACY))).alias("_q")))
    with_cuts = cut_lineage(rest.join(cuts, ["_g", "_j"]))
    rows = _inside(d, with_cuts, F.struct(*BRACKET, "_q"))
    smaller = F.size(F.filter("_b._q", lambda q: q < F.col("_x")))
    equal = F.array_contains("_b._q", F.col("_x"))
    bins = rows.groupBy("_g", "_b._j", (2 * smaller + equal.cast("int")).alias("_bin")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy("_g", "_j").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = bins.withColumn("_upto", F.sum("_c").over(upto)).join(with_cuts.drop("_value"), ["_g", "_j"])
    hit = counted.where((F.col("_below") + F.col("_upto") >= F.col("_r")) & (F.col("_below") + F.col("_upto") - F.col("_c") < F.col("_r")))
    at = F.floor(F.col("_bin") / 2).cast("int")
    value = F.when(F.col("_bin") % 2 == 1, F.get("_q", at))
    return done.unionByName(hit.select(
        "_g", "_j", "_r", (F.col("_below") + F.col("_upto") - F.col("_c")).alias("_below"), F.col("_c").alias("_rows"),
        F.coalesce(F.get("_q", at - 1), F.col("_lo")).alias("_lo"), F.coalesce(F.get("_q", at), F.col("_hi")).alias("_hi"), value.alias("_value")))
