"""Quality classifier: naive Bayes support vectors (NB-SVM).

Features are indicators of n-grams: single words and word pairs, and runs of one to three
word shapes ("Aa," for "Hello,", a mark for a repeated word), hashed into ``DIMS`` places.
Each indicator is scaled by the log-count ratio of the two classes, the row to length
one, and a linear hinge-loss model is fitted by dual coordinate descent. A logistic curve
fitted on out-of-fold margins turns margins into scores.

The fit reads a bounded sample (``fit_rows`` labelled rows, in the order of a hash of the
id); scoring is one pass over all whole texts without a shuffle. The model is two arrays
of ``DIMS`` doubles, whatever the corpus size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.schemas import plus

DIMS = 1 << 18
SHIFT = np.uint64(64 - 18)
FIT_ROWS = 8_000
HELD_OUT_OF = 5
KEEP_FROM = 0.3
CACHE = 100_000
REPEATED = np.uint64(zlib.crc32(b"repeated word"))
# odd multipliers of the feature hashes
M1, M2, M3, M4, M5, M6 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


# ---- features -------------------------------------------------------------------------

_CLASSES = ((re.compile(r"\d+"), "0"), (re.compile(r"[^\W\d_A-Z]+"), "a"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"([^\w])\1+"), r"\1"))


def word_shape(word: str) -> str:
    """Runs of lower case (or caseless) letters as a, upper case as A, digits as 0; other signs once per run."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word.isupper():
            return "A"
        if word[1:].islower():
            return "Aa"
    elif word[:-1].isalpha() and not word[-1].isalnum():
        return word_shape(word[:-1]) + word[-1]
    out = "".join(c.lower() if c.isalpha() and not c.isupper() else "A" if c.isalpha() else c for c in word)
    for pattern, to in _CLASSES:
        out = pattern.sub(to, out)
    return out


class WordCodes(dict):
    """word -> hash of its lower case (upper 32 bits) and of its shape (lower 32 bits); emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        code = self[word] = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(word_shape(word).encode())
        return code


CODES = WordCodes()


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text (none for a null or empty one)."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))
    lex, shape = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    shape[1:][lex[1:] == lex[:-1]] = REPEATED
    with np.errstate(over="ignore"):
        parts = [lex * M1, lex[:-1] * M2 + lex[1:] * M3, shape * M4,
                 shape[:-1] * M5 + shape[1:] * M6, shape[:-2] * M3 + shape[1:-1] * M5 + shape[2:] * M2]
        spread = np.concatenate([(p + k) * M1 for p, k in zip(parts, map(np.uint64, (1, 2, 3, 4, 5)))])
    return np.unique(spread >> SHIFT).astype(np.int64)


# ---- fitting --------------------------------------------------------------------------

@dataclass(frozen=True)
class QualityModel:
    """``weight``: w_f r_f; ``square``: r_f^2; a score is logistic(slope * margin + offset)."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, feats: np.ndarray) -> float:
        norm = float(np.sqrt(self.square[feats].sum())) if feats.size else 0.0
        return (float(self.weight[feats].sum()) / norm if norm else 0.0) + self.bias

    def score(self, feats: np.ndarray) -> float:
        z = self.slope * self.margin(feats) + self.offset
        return float(1 / (1 + np.exp(-z))) if z >= 0 else float(np.exp(z) / (1 + np.exp(z)))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Naive Bayes ratios of indicator counts with add-alpha smoothing, DIMS values."""
    counts = [np.full(DIMS, alpha), np.full(DIMS, alpha)]
    for feats, y in zip(rows, good):
        counts[int(y)][feats] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
                            epochs: int = 30, tolerance: float = 1e-3, seed: int = 3) -> tuple[np.ndarray, float]:
    """Linear L1-loss support vector machine; y is -1 or 1, cost bounds each dual variable."""
    w, b = np.zeros(DIMS), 0.0
    dual = np.zeros(len(rows))
    q = np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            f, v, yi = rows[i], values[i], y[i]
            slope = yi * (float(w[f] @ v) + b) - 1
            step = min(max(dual[i] - slope / q[i], 0.0), cost[i]) - dual[i]
            if step:
                worst = max(worst, abs(step) * q[i])
                dual[i] += step
                w[f] += step * yi * v
                b += step * yi
        if worst < tolerance:
            break
    return w, b


def logistic_curve(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of P(good | margin) by Newton steps on smoothed targets."""
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margins ** 2).sum(), (s * margins).sum()], [(s * margins).sum(), s.sum()]]) + 1e-6 * np.eye(2)
        da, db = np.linalg.solve(h, g)
        scale = min(1.0, 5 / max(abs(da), abs(db), 1e-12))
        a, b = a - scale * da, b - scale * db
        if max(abs(da), abs(db)) < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def fit_rows(rows: list[np.ndarray], good: np.ndarray, c: float = 4.0) -> QualityModel:
    """NB-SVM of some feature rows. With one class only, every score is that class's
    smoothed share; with no rows, 0.5."""
    n1, n0 = int(good.sum()), int((~good).sum())
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2)
        return QualityModel(np.zeros(DIMS), np.zeros(DIMS), 0.0, 1.0, float(np.log(share / (1 - share))))

    def train(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        ratio = log_count_ratios([rows[i] for i in part], good[part])
        scaled = []
        for i in part:
            v = ratio[rows[i]]
            norm = np.linalg.norm(v)
            scaled.append(v / norm if norm else v)
        k1, k0 = int(good[part].sum()), int((~good[part]).sum())
        cost = c * part.size / 2 / np.where(good[part], max(k1, 1), max(k0, 1))
        w, b = dual_coordinate_descent([rows[i] for i in part], scaled, np.where(good[part], 1.0, -1.0), cost)
        return w * ratio, ratio ** 2, b

    fold = np.arange(len(rows)) % 3
    margins, known = np.zeros(len(rows)), np.zeros(len(rows), dtype=bool)
    for k in range(3):
        part, rest = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if good[part].all() or not good[part].any():
            continue
        model = QualityModel(*train(part), 1.0, 0.0)
        margins[rest] = [model.margin(rows[i]) for i in rest]
        known[rest] = True
    weight, square, bias = train(np.arange(len(rows)))
    slope, offset = logistic_curve(margins[known], good[known]) if known.any() else (1.0, 0.0)
    return QualityModel(weight, square, bias, slope, offset)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is never learned: crc32 of the id as text leaves no rest modulo 5 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [features(t.as_py()).astype("<i4").tobytes() for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc", "good", "feats"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                rows: int = FIT_ROWS) -> QualityModel:
    """Fits on at most ``rows`` labelled documents that are not held out.

    Labels other than 0 and 1 and null ids are ignored; of several labels for one id the
    majority counts (a tie is 0); of several texts with one id the least one is read.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("y"))
             .where("doc is not null and y in (0, 1)").where(~held_out("doc")).groupBy("doc").agg((F.avg("y") > 0.5).alias("good")))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    narrow = texts.select("doc").distinct().join(known, "doc")
    sample = narrow.orderBy(F.xxhash64("doc"), "doc").limit(rows)
    chosen = texts.join(F.broadcast(sample), "doc").groupBy("doc", "good").agg(F.min("body").alias("body"))
    got = chosen.mapInArrow(_feature_rows, "doc long, good boolean, feats binary").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r["doc"]).encode()), r["doc"]))
    good = np.array([r["good"] for r in got], dtype=bool)
    feats = [np.frombuffer(r["feats"], "<i4").astype(np.int64) for r in got]
    del got
    return fit_rows(feats, good)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: float = KEEP_FROM) -> DataFrame:
    """``docs`` without the text, then ``score`` and ``predicted`` (1 if score >= ``keep``).
    Every row is scored, on its whole text; a null or empty text has no features, so its
    score comes from the bias alone. Columns of ``docs`` named like the new ones are replaced."""
    carried = [c for c in docs.columns if c not in (text_col, "score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.array([model.score(features(t.as_py())) for t in batch.column(len(carried))], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(carried)], pa.array(scores), pa.array((scores >= keep).astype(np.int32))], [*carried, "score", "predicted"])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    return source.mapInArrow(run, plus(source.select(*carried).schema, "score double, predicted int"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            good = [model.score(features(t.as_py())) >= keep for t in batch.column(place)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
