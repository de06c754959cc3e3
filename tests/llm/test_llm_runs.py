"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from conftest import SF01
from tidecast.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(x):
    """All runs by comparing every word with that of every period before."""
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            stretch = x[i:j + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(x):
    return [tuple(r) for r in periodic_runs.runs(np.array(x, np.int64)).tolist()]


def test_random_sequences():
    rnd = random.Random(5)
    for _ in range(2500):
        n, letters = rnd.randint(0, 120), rnd.choice([1, 2, 2, 3, 5, 20])
        x = [rnd.randrange(letters) for _ in range(n)]
        for _ in range(rnd.randint(0, 4)):
            if n > 4:
                p, a = rnd.randint(1, n // 4), rnd.randrange(n)
                for i in range(a + p, min(n, a + p * rnd.randint(2, 8) + rnd.randint(0, p))):
                    x[i] = x[i - p]
        if n and rnd.random() < 0.3:
            x[rnd.randrange(n)] = rnd.randrange(letters)
        assert found(x) == brute(x)


def test_nested_runs_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for x in ([0] * 50, [0, 1] * 3, [0] * 5, [0] * 6, list(range(9)) * 4, list(range(9)) * 4 + [0], ([0, 1] * 6 + [2]) * 5, (b[:13] * 5 + [7]) * 5 + b[:300], b):
        assert found(x) == brute(x)


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, 3, (20, size)), rng.integers(0, 3, (20, 2 * size - 1))
        windows[::3, size // 2:size // 2 + size] = blocks[::3]
        for scale in (1, 10**6, 10**9):  # sums that need one, two and three primes
            expected = [[bool((w[k:k + size] == b).all()) for k in range(size)] for b, w in zip(blocks, windows)]
            assert periodic_runs.zero_mismatches(blocks * scale, windows * scale).tolist() == expected


def test_difference_of_a_multiple_of_a_prime_is_no_match():
    p = periodic_runs.PRIMES[0]
    assert not periodic_runs.zero_mismatches(np.array([[0]]), np.array([[p]])).any()


def test_cases_and_columns(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n ", 0), (4, "a b " * 20 + "c", 1), (4, "a b " * 20 + "c", 1), (5, "a a a a a", 0), (6, " a a" * 6, 1)]
    docs = spark.createDataFrame([(i, t, str(k)) for i, t, k in rows], "doc_id long, text string, runs string")
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    assert got == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 41, [(0, 40, 2)], "a b c"), (4, 41, [(0, 40, 2)], "a b c"),
                   (5, 5, [], "a a a a a"), (6, 6, [(0, 6, 1)], "a a")]
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    """A text longer than a slice, between short ones."""
    words = [f"w{i % 4001}" for i in range(150_000)]
    docs = spark.createDataFrame([(1, "x y"), (2, " ".join(words)), (3, "x " * 7)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], len(r.collapsed.split())) for r in periodic_runs.find_runs(docs).collect()}
    assert got == {1: (2, [], 2), 2: (150_000, [(0, 150_000, 4001)], 4001), 3: (7, [(0, 7, 1)], 1)}


def test_query_equals_brute_force(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF01).collect()}
    texts = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    total = 0
    for doc_id, text in texts:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs = brute(w)
        total += len(runs)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert got[doc_id] == (len(runs), *longest, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone))), doc_id
    assert total > 20
