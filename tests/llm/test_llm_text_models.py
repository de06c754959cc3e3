"""Masked LM, licence scans and the quality classifier."""

import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF01
from tidecast.llm import arrow_words, licenses, masked_lm, quality


# ---- masked LM ------------------------------------------------------------------------

def test_lm_prefers_real_order_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    train, test = docs.where("doc_id % 10 != 0"), docs.where("doc_id % 10 = 0 and n_chars > 500").select("text").collect()
    model = masked_lm.fit_masked_lm(train, rounds=2)
    rng = random.Random(1)
    real = [r.text for r in test]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in real]
    _, a = masked_lm.log_likelihoods(model, pa.array(real))
    n, b = masked_lm.log_likelihoods(model, pa.array(mixed))
    assert (a > b).mean() > 0.7 and a.sum() > b.sum()
    start = masked_lm.fit_masked_lm(train, rounds=0)  # the same counts, no training
    _, c = masked_lm.log_likelihoods(start, pa.array(real))
    assert a.sum() > c.sum()


def test_lm_probabilities_sum_to_one():
    model = masked_lm.start_model(["a", "b", "c"], np.array([5, 3, 1]), np.arange(masked_lm.OTHER))
    log_p = masked_lm._forward(model.views(model.flat), np.array([[0, 1, 2, model.size]]))[2][0]
    assert np.exp(log_p[model.class_of] + model.share).sum() == pytest.approx(1, abs=1e-4)


def test_lm_sum_is_over_every_token():
    model = masked_lm.start_model(["a", "b"], np.array([2, 1]), np.zeros(masked_lm.OTHER))
    counts, sums = masked_lm.log_likelihoods(model, pa.array(["a b a", None, "", "B"]))
    assert counts.tolist() == [3, 0, 0, 1] and sums[1] == sums[2] == 0
    out, views = model.size, model.views(model.flat)
    near = np.array([[out, out, 1, 0], [out, 0, 0, out], [0, 1, out, out]])
    log_p = masked_lm._forward(views, near)[2]
    want = sum(log_p[i, model.class_of[t]] + model.share[t] for i, t in enumerate([0, 1, 0]))
    assert sums[0] == pytest.approx(want, abs=1e-4)


def test_lm_junk_scores_low(spark):
    """Texts of never-seen strings score under the 5th percentile of the corpus."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    model = masked_lm.fit_masked_lm(docs)
    rng = random.Random(3)
    junk = [" ".join("".join(rng.choice("qxzjkvw0123456789") for _ in range(rng.randint(3, 12))) for _ in range(200)) for _ in range(20)]
    n, sums = masked_lm.log_likelihoods(model, pa.array(junk))
    real = [r.mean_log_likelihood for r in masked_lm.score_masked_lm(docs, model).collect() if r.mean_log_likelihood is not None]
    assert (sums / n).max() < np.percentile(real, 5)


def test_lm_edge_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "a b c " * 3000, 7), (4, "x y", 7), (4, "x y", 7), (None, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    model = masked_lm.fit_masked_lm(docs, vocabulary=2)
    got = {(r.doc_id, r.n_tokens): r for r in masked_lm.score_masked_lm(docs, model).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 9000), (4, 2), (None, 2)}
    assert got[(1, 0)].mean_log_likelihood is None and got[(1, 0)].log_likelihood == 0
    assert got[(4, 2)].log_likelihood == got[(None, 2)].log_likelihood
    none = docs.where("false")
    assert masked_lm.score_masked_lm(none, masked_lm.fit_masked_lm(none)).count() == 0


def test_vocabulary_is_the_most_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{i:03d}", 0, 1 + i // 10) for i in range(300)], "word string, other int, n long")
    want = sorted(((-(1 + i // 10), f"w{i:03d}") for i in range(300)))[:57]
    assert [(-r["n"], r["word"]) for r in masked_lm.top_words(counts, 57)] == want
    assert len(masked_lm.top_words(counts, 1000)) == 300 and masked_lm.top_words(counts.where("false"), 5) == []


def test_arrow_words():
    words, begins = arrow_words.lower_words(pa.array([" A,  b ", None, "", "...", "É x."]), ".,")
    assert words.to_pylist() == ["a", "b", "é", "x"] and begins.tolist() == [0, 2, 2, 2, 2, 4]
    part = pa.array(["q", "r s", "t"])[1:]
    assert arrow_words.lower_words(part)[0].to_pylist() == ["r", "s", "t"]
    assert list(arrow_words.slices(pa.array(["aa", "b", "cccc", "d"]), 3)) == [(0, 2), (2, 3), (3, 4)]
    assert [x.tolist() for x in arrow_words.outer_bytes(pa.array(["ab", "c", "x"])[1:])] == [[1, 1], [99, 120], [99, 120]]


# ---- licences -------------------------------------------------------------------------

def slow_dice(a, b):
    from collections import Counter

    ca, cb = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((ca & cb).values()) / max(1, sum(ca.values()) + sum(cb.values()))


def test_best_window_equals_brute_force():
    rng = random.Random(4)
    template = "the quick brown fox jumps over the lazy dog and the quick cat"
    scanner = licenses.Scanner((("T", template),), 0.6)
    words = template.split()
    for _ in range(60):
        copy = [w if rng.random() > 0.15 else "zz" for w in words if rng.random() > 0.1]
        text = ["q"] * rng.randint(0, 5) + copy + ["the", "quick"] * rng.randint(0, 2) + ["r"] * 4
        best = max(slow_dice(text[i:j], words) for i in range(len(text)) for j in range(i + 2, len(text) + 1))
        found = scanner.scan(" ".join(text))
        assert (max((d for _, d, *_ in found), default=0) == pytest.approx(best)) if best >= 0.6 else not found


def test_licences_in_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: [x["license"] for x in r.licenses] for r in licenses.scan_licenses(docs.select("doc_id", "text")).collect()}
    said = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
            "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for r in docs.select("doc_id", "text").collect():
        want = [name for _, name in sorted((r.text.find(s, i), name) for s, name in said.items() for i in range(len(r.text)) if r.text.startswith(s, i))]
        assert got[r.doc_id] == want


def test_licence_edge_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "x " * 20000 + "RELEASED under\nthe MIT license!", "k"), (3, "Released", None), (None, "Version 2.0 of the License", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = [(r.doc_id, [(x["license"], x["dice"]) for x in r.licenses]) for r in licenses.scan_licenses(docs).collect()]
    assert got == [(1, []), (2, []), (3, [("MIT", 1.0)]), (3, []), (None, [])]
    assert licenses.scan_licenses(docs.where("false")).count() == 0
    text = "İİ Released under the MIT License."
    (k, _, a, b), = licenses.Scanner(licenses.TEMPLATES).scan(text)
    assert text[a:b] == "Released under the MIT License"


# ---- quality --------------------------------------------------------------------------

def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels)
    rows = quality.score_quality(docs, model).withColumn("h", quality.held_out()).join(labels, "doc_id").where("h").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(rows) > 50 and np.mean([a > b for a in good for b in bad]) > 0.99
    assert np.mean([s >= 0.3 for s in good]) > 0.98 and np.mean([s < 0.3 for s in bad]) > 0.9


def test_held_out_labels_are_not_learned(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels, rows=150), quality.fit_quality(docs, turned, rows=150)
    assert (a.weight == b.weight).all() and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(6, 3, replace=False)) for _ in range(40)]
    values = [rng.standard_normal(3) for _ in rows]
    y = np.where(rng.random(40) < 0.5, 1.0, -1.0)
    w, b = quality.dual_coordinate_descent(rows, values, y, np.full(40, 0.5), epochs=4000, tolerance=1e-8)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + 0.5 * sum(max(0, 1 - t * (w[f] @ v + b)) for f, v, t in zip(rows, values, y))

    best = loss(w, b)
    for _ in range(200):
        step = np.zeros_like(w)
        step[:6] = 0.01 * rng.standard_normal(6)
        assert loss(w + step, b + 0.01 * rng.standard_normal()) >= best - 1e-6


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 3, "a"), (2, "", 3, "b"), (3, "w " * 50000, 3, "c"), (3, "w " * 50000, 3, "c"), (None, "Q q.", None, None)],
                                 "doc_id long, text string, score int, predicted string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 5), (None, 1), (9, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)  # nothing usable but a tie: one class
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    none = docs.where("false")
    assert quality.score_quality(none, quality.fit_quality(none, labels)).count() == 0
    assert quality.fit_rows([], np.array([], dtype=bool)).score(np.empty(0, np.int64)) == 0.5
    assert quality.keep_good(docs, quality.fit_rows([], np.array([], dtype=bool))).columns == docs.columns
