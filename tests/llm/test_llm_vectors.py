"""The projection forest against brute force."""

import numpy as np

from tidecast.llm import near_vectors


def planted(seed=3, groups=30, size=6, dense=300, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        c = rng.standard_normal(dim)
        rows += [(c + 0.05 * rng.standard_normal(dim), g % 3) for _ in range(size)]
    c = rng.standard_normal(dim)
    rows += [(c + 0.02 * rng.standard_normal(dim), 0) for _ in range(dense)]
    rows += [(rng.standard_normal(dim), int(rng.integers(0, 3))) for _ in range(500)]
    rows += rows[:10]  # equal vectors
    return [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]


def brute(rows, threshold=0.98):
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([x for *_, x in rows])
    links = (unit @ unit.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(links, False)
    root = np.arange(len(rows))
    while True:
        new = np.minimum(root, np.where(links, root[None, :], len(rows)).min(axis=1))
        if (new == root).all():
            return {i: (int(links[i].sum()), int(root[i]), bool(root[i] == i)) for i in range(len(rows))}
        root = new


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_links_equal_brute_force(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(near_vectors.near_vectors(df, leaf=64)) == brute(rows)


def test_splitting_by_spark_and_block_pairs(spark):
    rows = planted(seed=4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got, want = result(near_vectors.near_vectors(df, trees=4, leaf=32, task_rows=200, block=40)), brute(rows)
    found, true = sum(n for n, *_ in got.values()), sum(n for n, *_ in want.values())
    assert all(got[k][0] <= want[k][0] for k in want)  # no false link
    assert found >= 0.9 * true


def test_a_dense_third_of_a_label_is_no_single_task(spark, monkeypatch):
    rng = np.random.default_rng(8)
    dim, dense, task_rows = 64, 400, 250
    c = rng.standard_normal(dim)
    c *= 8 / np.linalg.norm(c)
    vectors = [c + rng.uniform(0.02, 0.11) * rng.standard_normal(dim) for _ in range(dense)] + [rng.standard_normal(dim) for _ in range(2 * dense)]
    vectors += vectors[:5]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    first = [float(v[0]) for v in vectors[:dense]]
    largest, compared = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    grow, compare = near_vectors._grow, near_vectors._compare

    def bounded(*args):
        run = grow(*args)

        def one(key, table):
            largest.add(int(table.num_rows > task_rows))
            return run(key, table)
        return one

    def counted(*args):
        run = compare(*args)

        def one(key, table):
            block, near = table.column("block").to_numpy(), np.array([v[0] for v in table.column("vector").to_pylist()])
            hot = np.isin(near, first)
            compared.add(int((hot & (block == key[3].as_py())).sum() * (hot & (block == key[4].as_py())).sum()))
            return run(key, table)
        return one

    monkeypatch.setattr(near_vectors, "_grow", bounded)
    monkeypatch.setattr(near_vectors, "_compare", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got, want = result(near_vectors.near_vectors(df, leaf=32, task_rows=task_rows, block=16)), brute(rows)
    assert {k: got[k] for k in range(dense)} == {k: want[k] for k in range(dense)}
    assert all(got[k][0] <= want[k][0] for k in want)  # no false link
    assert largest.value == 0
    assert compared.value < dense * dense  # at most once, and not those that link for certain


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [1.0, nan], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0], 1),
            (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [1e300, 1e290], 1)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, n_links string, nid int")
    got = result(near_vectors.near_vectors(df))
    linked = {1: (3, 1, True), 2: (3, 1, False), 12: (3, 1, False), 13: (3, 1, False)}
    assert got == linked | {k: (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11, None)}
    assert near_vectors.near_vectors(df.where("false")).count() == 0
