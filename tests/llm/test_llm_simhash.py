"""SimHash near-dedup against brute force, and its edge cases."""

import random
import re

import numpy as np
import pytest
import xxhash

from conftest import SF001
from tidecast.llm import components, simhash


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, bits=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def test_golay_code_is_perfect():
    assert len(set(simhash.ERRORS.tolist())) == 2048
    words = np.arange(0, 1 << 23, 977)
    code = words ^ simhash.ERRORS[simhash.UPPER[words >> 11] ^ (words & 0x7FF)]
    assert (np.bitwise_count((words ^ code).astype(np.uint32)) <= 3).all()
    assert (simhash.ERRORS[simhash.UPPER[code >> 11] ^ (code & 0x7FF)] == 0).all()


def test_fingerprints_within_three_bits_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b = a.copy()
    for i in range(b.size):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [set(zip(*(x.tolist() for x in simhash.golay_keys(p)))) for p in (a, b)]
    assert {r for r, _ in keys[0] & keys[1]} == set(range(a.size))


@pytest.mark.parametrize("text", ["", "one", "One two", "A b\tC\x0bd e", "Éa É x Y", "a " * 500, "x"])
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip((f"{p:016x}" for p in prints), slow_components([r.doc_id for r in rows], prints))))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_dense_groups_and_long_runs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(40)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = slow_components(signed, prints)
    for run in (4, 4096):
        roots = {r.node: r.component for r in components.connected_components(simhash.fingerprint_links(df, run=run)).collect()}
        got = [roots.get(p, p) for p in signed]
        first = {}
        assert [first.setdefault(x, i) for i, x in enumerate(got)] == [first.setdefault(("w", x), i) for i, x in enumerate(want)]


def test_edge_rows(spark):
    rows = [(1, None, "a", 9), (2, "", "b", 9), (3, "Same text here now", "c", 9), (3, "Same text here now", "c", 9),
            (7, "same TEXT here now", None, None), (None, "same text here now", "n", 1), (8, "other words are in this one", "d", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (7, 3), (None, 3), (8, 8)], key=str)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 8]
    empty = docs.where("false")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, max_bits=4)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + k) for k in range(1, 60)] + [(9, 9), (None, 3)] + [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in root and b in root and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_one_id_with_unlike_texts_stay_apart(spark):
    """A row whose id another group shares is not lost; columns named like the operator's own stay."""
    x, y = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    docs = spark.createDataFrame([(5, x, 1), (5, y, 2), (7, y, 3), (None, x + " z", 4), (None, "other words here", 5), (None, "other words here", 5)],
                                 "doc_id long, text string, _hash_of_text int")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r._hash_of_text for r in kept.collect()) in ([1, 2, 5], [1, 2, 4, 5])
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(5, x), (5, y)]
