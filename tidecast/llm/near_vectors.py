"""Embedding near-duplicates by a random-projection tree forest.

Every tree splits a group of vectors (equal label and dimension) again and again: project
on a random direction, cut in the widest gap between the middle quantiles, and let rows
within ``spill`` of the cut go down both sides. Vectors that share a leaf of any tree are
compared exactly; verified links are unioned.

Scale: equal vectors are one row with a count of copies. Groups of more than
``task_rows`` rows are split by Spark, one level of all trees a round, with cuts from
approximate quantiles of all rows; below that, a task grows the rest of the tree. A
larger node that no direction splits is dense; dense nodes of all trees that share vectors
are one group, compared once. It is cut into cells by the angle to the centre of a vector's
first dense node: pairs of cells that link for certain by the triangle inequality are
counted from the cells' totals, pairs that cannot link are left out, the others are
compared over many tasks. A pair is counted only in the smallest leaf its vectors share
(dense groups come first), which a leaf sees from its members' leaf lists, so no pair is
ever sent on: leaves give counts and a star per linked group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.components import connected_components, local_roots
from tidecast.session import cut_lineage

QUANTILES = [round(0.25 + 0.025 * k, 3) for k in range(21)]
DEPTH = 56  # tree and node share one long
STUCK = 0.9  # a split that leaves more than this share on one side ends the branch
SHELLS = 64  # of a dense leaf, by angle to its centre
SAMPLE = 1024  # vectors the centre is the mean of; any centre gives right results
MARGIN = 1e-7  # radians, far above the rounding of an angle


def direction(seed: int, tree: int, depth: int, dim: int) -> np.ndarray:
    """Random unit vector, shared by all nodes of one tree at one depth."""
    v = np.random.default_rng([seed, tree, depth, dim]).standard_normal(dim)
    return v / np.linalg.norm(v)


def widest_gap(quantiles: np.ndarray) -> float:
    """Middle of the widest step between neighbouring quantiles: few rows lie near it."""
    k = int(np.argmax(np.diff(quantiles)))
    return float((quantiles[k] + quantiles[k + 1]) / 2)


def unit_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length, in double precision, scaled to length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite and one of them not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


# ---- the forest -----------------------------------------------------------------------

def _grow(seed: int, leaf: int, spill: float):
    """Finishes one node: (nid, leaf) for the rows of every leaf below it."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, dim, tree, node = (k.as_py() for k in key)
        ids = table.column("nid").to_numpy()
        unit = unit_rows(table.column("vector"))
        out_ids, out_leaves = [], []
        todo = [(np.arange(ids.size), node)]
        while todo:
            rows, at = todo.pop()
            depth = at.bit_length() - 1
            if rows.size > leaf and depth < DEPTH:
                p = unit[rows] @ direction(seed, tree, depth, dim)
                cut = widest_gap(np.quantile(p, QUANTILES))
                low, high = rows[p <= cut + spill], rows[p >= cut - spill]
                if max(low.size, high.size) <= STUCK * rows.size:
                    todo += [(low, 2 * at), (high, 2 * at + 1)]
                    continue
            out_ids.append(ids[rows])
            out_leaves.append(np.full(rows.size, at * 64 + tree))
        return pa.table({"nid": np.concatenate(out_ids), "leaf": np.concatenate(out_leaves)})

    return run


def _split_large(frame: DataFrame, task_rows: int, seed: int, spill: float) -> DataFrame:
    """Splits every node of more than ``task_rows`` rows, a level a round, until none is left or splits."""
    key = ["label", "dim", "tree", "node"]
    for depth in range(DEPTH):
        sizes = frame.where("not done").groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > task_rows)
        large = cut_lineage(sizes)
        if large.isEmpty():
            return frame

        @F.pandas_udf("double")
        def project(vectors, trees, depth=depth):
            out = np.empty(len(vectors))
            for i, (v, t) in enumerate(zip(vectors, trees)):
                v = np.asarray(v, dtype=np.float64)
                v = v / np.abs(v).max()
                out[i] = v @ direction(seed, t, depth, v.size) / np.linalg.norm(v)
            return type(vectors)(out)

        tagged = frame.join(large, key, "left")
        rest = tagged.where("n is null").drop("n")
        placed = cut_lineage(tagged.where("n is not null").withColumn("p", project("vector", "tree")))
        steps = placed.groupBy(*key).agg(F.percentile_approx("p", QUANTILES, 1000).alias("q"))
        gaps = F.transform(F.sequence(F.lit(0), F.lit(len(QUANTILES) - 2)),
                           lambda i: F.struct((F.get("q", i + 1) - F.get("q", i)).alias("gap"), ((F.get("q", i + 1) + F.get("q", i)) / 2).alias("cut")))
        cuts = steps.select(*key, F.array_max(gaps)["cut"].alias("cut"))
        low, high = F.col("p") <= F.col("cut") + spill, F.col("p") >= F.col("cut") - spill
        sides = placed.join(cuts, key)
        counts = (sides.groupBy(*key).agg(F.max("n").alias("all"), F.count(F.when(low, 1)).alias("low"), F.count(F.when(high, 1)).alias("high"))
                  .select(*key, (F.greatest("low", "high") > STUCK * F.col("all")).alias("stuck")))
        node = F.col("node")
        children = F.when(F.col("stuck"), F.array(node)).otherwise(F.filter(
            F.array(F.when(low, node * 2), F.when(high, node * 2 + 1)), lambda x: x.isNotNull()))
        split = (sides.join(counts, key).withColumn("child", F.explode(children))
                 .select("nid", "vector", "label", "dim", "tree", F.col("child").alias("node"), F.col("stuck").alias("done")))
        frame = cut_lineage(rest.select(split.columns).unionByName(split))
    return frame


# ---- leaves ---------------------------------------------------------------------------

def _compare(threshold: float, step: int = 512):
    """Links of one leaf or one pair of its blocks: (nid, links counted here, root)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, _, leaf, lo, hi = (k.as_py() for k in key)
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        ids, copies, block = (table.column(c).to_numpy() for c in ("nid", "copies", "block"))
        unit = unit_rows(table.column("vector"))
        lists = table.column("leaves").combine_chunks()
        member, value = np.repeat(np.arange(ids.size), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
        earlier = value < leaf
        names, slot = np.unique(value[earlier], return_inverse=True)
        shared = np.zeros((ids.size, max(1, names.size)), dtype=np.float32)
        shared[member[earlier], slot] = 1
        left = np.flatnonzero(block == lo)
        right = np.flatnonzero(block == hi)
        count = np.zeros(ids.size, dtype=np.int64)
        linked = np.zeros(ids.size, dtype=bool)
        for k in range(0, left.size, step):
            rows = left[k:k + step]
            hit = unit[rows] @ unit[right].T >= threshold
            hit &= rows[:, None] != right[None, :]
            if not hit.any():
                continue
            linked[rows] |= hit.any(axis=1)
            linked[right] |= hit.any(axis=0)
            new = hit & ~((shared[rows] @ shared[right].T) > 0)
            count[rows] += new @ copies[right]
            if lo != hi:
                count[right] += copies[rows] @ new
        own = np.flatnonzero(linked)
        root = ids.copy()
        if own.size:
            near = unit[own]
            root[own] = ids[own[local_roots(own.size, lambda a, b: near[a] @ near[b].T >= threshold)]]
        return pa.table({"nid": ids[own], "links": count[own], "root": root[own]})

    return run


def _centre(table: pa.Table) -> pa.Table:
    """A home and the direction of the mean of its rows."""
    unit = unit_rows(table.column("vector"))
    mean = unit.mean(axis=0)
    size = np.linalg.norm(mean)
    mean = mean / size if size > 0 else unit[0]
    return table.select(["home"]).slice(0, 1).append_column("centre", pa.array([mean.tolist()], pa.list_(pa.float64())))


def _angle(vectors, centres):
    out = np.full(len(vectors), np.pi)
    for i, (v, c) in enumerate(zip(vectors, centres)):
        if c is not None:
            v = np.asarray(v, dtype=np.float64)
            v = v / np.abs(v).max()
            out[i] = 2 * np.arcsin(min(1.0, np.linalg.norm(v / np.linalg.norm(v) - c) / 2))
    return type(vectors)(out)


def _dense_groups(dense: DataFrame) -> DataFrame:
    """nid, home (its first dense node) and leaf (below 0: the group of all dense nodes that share vectors with it)."""
    nodes = dense.select("nid", F.xxhash64("label", "dim", "tree", "node").alias("at"))
    homes = cut_lineage(nodes.groupBy("nid").agg(F.sort_array(F.collect_set("at")).alias("all")))  # a few per tree
    edges = homes.select(F.get("all", F.lit(0)).alias("a"), F.explode("all").alias("b")).where("a != b").distinct()
    groups = connected_components(edges).select(F.col("node").alias("home"), "component")
    return (homes.select("nid", F.get("all", F.lit(0)).alias("home")).join(groups, "home", "left")
            .select("nid", "home", F.coalesce("component", "home").bitwiseOR(F.lit(-2**63)).alias("leaf")))


def _dense_links(rows: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links of the dense groups, as ``_compare`` gives them; two rows share one of them at most."""
    key = ["label", "dim", "leaf"]
    limit = float(np.arccos(threshold))
    angle = F.pandas_udf(_angle, "double")
    sizes = rows.groupBy("home").agg(F.count("*").alias("n"))
    sample = rows.join(sizes, "home").where(F.pmod(F.xxhash64("nid"), F.ceil(F.col("n") / SAMPLE).cast("long")) == 0)
    centres = cut_lineage(sample.select("home", "vector").groupBy("home").applyInArrow(_centre, "home long, centre array<double>"))
    rows = cut_lineage(rows.join(centres, "home", "left").withColumn("angle", angle("vector", "centre")).drop("centre"))

    cuts = rows.groupBy("home").agg(F.percentile_approx("angle", [k / SHELLS for k in range(1, SHELLS)], 1000).alias("cuts"),
                                    F.least(F.lit(SHELLS), F.ceil(F.count("*") / block)).cast("long").alias("shells"))
    beyond = F.size(F.filter("cuts", lambda c: c < F.col("angle")))
    rows = rows.join(cuts, "home").withColumn("shell", F.floor(beyond * F.col("shells") / SHELLS).cast("long")).drop("cuts", "shells")
    shell = [*key, "home", "shell"]
    parts = rows.groupBy(*shell).agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    rows = cut_lineage(rows.join(parts, shell).withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts"))).drop("parts"))
    cells = rows.groupBy(*shell, "part").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("total"), F.min("nid").alias("first"))
    cells = cut_lineage(cells.withColumn("block", F.row_number().over(Window.partitionBy(*key).orderBy("home", "shell", "part")).cast("long")))
    rows = rows.join(cells.select(*shell, "part", "block"), [*shell, "part"]).select(*key, "nid", "copies", "leaves", "vector", "block")

    def side(name: str, of: str) -> DataFrame:
        return cells.select(*key, F.col("block").alias(name), *(F.col(c).alias(c + of) for c in ("home", "low", "high", "total", "first")))

    a, b = side("lo", "_a"), side("hi", "_b")
    homes = cells.join(centres, "home", "left").select(*key, "home", "centre").distinct()
    between = (homes.select(*key, F.col("home").alias("home_a"), "centre")
               .join(homes.select(*key, F.col("home").alias("home_b"), F.col("centre").alias("other")), key)
               .withColumn("gap", F.when(F.col("home_a") == F.col("home_b"), 0.0).otherwise(angle("centre", "other"))).drop("centre", "other"))
    high = F.col("high_a") + F.col("high_b")
    apart = F.greatest(F.col("gap") - high, F.col("low_a") - F.col("gap") - F.col("high_b"), F.col("low_b") - F.col("gap") - F.col("high_a")) > limit + MARGIN
    pairs = cut_lineage(a.join(b, key).join(between, [*key, "home_a", "home_b"]).where(~apart)
                        .select(*key, "lo", "hi", "total_b", "first_a", "first_b", (F.col("gap") + high <= limit - MARGIN).alias("sure")))
    counted = (pairs.where("sure").groupBy(*key, F.col("lo").alias("block"))
               .agg(F.sum("total_b").alias("total"), F.max(F.col("lo") == F.col("hi")).alias("itself"), F.min("first_b").alias("root")))
    sure = rows.join(counted, [*key, "block"]).select("nid", (F.col("total") - F.when(F.col("itself"), F.col("copies")).otherwise(0)).alias("links"), "root")
    joined = pairs.where("sure and lo < hi").select(F.col("first_a").alias("nid"), F.lit(0).cast("long").alias("links"), F.col("first_b").alias("root"))

    left = pairs.where("lo <= hi and not sure").select(*key, "lo", "hi")
    sides = left.withColumn("block", F.explode(F.array_distinct(F.array("lo", "hi"))))
    dealt = rows.join(sides, [*key, "block"]).select(*key, "lo", "hi", "block", "nid", "copies", "leaves", "vector")
    compared = dealt.groupBy(*key, "lo", "hi").applyInArrow(_compare(threshold), "nid long, links long, root long")
    return sure.unionByName(joined).unionByName(compared)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, trees: int = 8, leaf: int = 256, spill: float = 0.025,
                 task_rows: int = 20_000, block: int = 2048, seed: int = 11) -> DataFrame:
    """One row per distinct (id, vector, label): id, ``n_links`` (other vectors at a cosine
    of ``threshold`` or more, in double precision), ``component_id`` (smallest id reachable
    by links, itself included) and ``kept`` (id = component_id).

    Vectors link only if their labels are equal and not null and their lengths equal. A
    vector that is null, empty or zero, or that holds null or non-finite components, links
    with nothing, nor does one without a label or an id: it has 0 links and its own id as
    component. Fully repeated rows are one vector; equal vectors with different ids link.
    A null id is kept (``kept`` true). Other columns are not read; an empty table gives an
    empty one. Every link returned is exact; a pair that no leaf of any tree holds is
    missed (recall is measured in the tests).
    """
    if not 1 <= trees <= 64:
        raise ValueError("1 to 64 trees")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).distinct()
    rows = rows.withColumn("fine", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    same = rows.where("fine").groupBy("label", "vector").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    distinct = cut_lineage(same.withColumn("nid", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))

    planted = (distinct.select("nid", "vector", "label", "dim", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
               .withColumn("node", F.lit(1).cast("long")).withColumn("done", F.lit(False)))
    nodes = _split_large(planted, task_rows, seed, spill)
    grown = nodes.where("not done").groupBy("label", "dim", "tree", "node").applyInArrow(_grow(seed, leaf, spill), "nid long, leaf long")
    leaves = cut_lineage(grown)
    stuck = nodes.where("done")
    dense = None if stuck.isEmpty() else cut_lineage(_dense_groups(stuck))
    if dense is not None:
        leaves = leaves.unionByName(dense.select("nid", "leaf"))

    lists = leaves.groupBy("nid").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))  # a few per tree
    placed = distinct.join(lists, "nid").withColumn("leaf", F.explode("leaves"))
    loose = placed.where("leaf >= 0")
    blocks = (loose.groupBy("label", "dim", "leaf").agg(F.count("*").alias("n"))
              .select("label", "dim", "leaf", F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long").alias("blocks")))
    dealt = (loose.join(blocks, ["label", "dim", "leaf"])
             .withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
             .select("label", "dim", "leaf", "lo", "hi", "block", "nid", "copies", "leaves", "vector"))
    found = dealt.groupBy("label", "dim", "leaf", "lo", "hi").applyInArrow(_compare(threshold), "nid long, links long, root long")
    if dense is not None:
        found = found.unionByName(_dense_links(placed.where("leaf < 0").join(dense.select("nid", "home"), "nid"), threshold, block))
    found = cut_lineage(found)

    roots = connected_components(found.where("nid != root").select(F.col("nid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("nid").agg(F.sum("links").alias("links"))
    named = (distinct.select("nid", "first_id", "copies", "label", "vector").join(counts, "nid", "left")
             .join(roots.select(F.col("node").alias("nid"), "component"), "nid", "left")
             .withColumn("component", F.coalesce("component", "nid")))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_vector = (named.join(names, "component")
                 .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    linked = rows.where("fine").join(of_vector, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (linked.unionByName(alone)
            .select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
