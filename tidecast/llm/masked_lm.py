"""Masked pseudo-likelihood: a bidirectional window network, trained in numpy.

Tokens are lower-case words between white space: the ``vocabulary`` most frequent words
of the corpus, and ``OTHER`` groups for all other words by length and outer letters. For
every position the network reads ``WINDOW`` tokens on either side (embeddings, one tanh
layer, soft-max) and predicts the token's class; classes are bands of equal frequency
mass, and within a class a token has its share of the corpus counts. A group's share is
dealt evenly to its distinct words and one more, which stands for words never seen: so a
word outside the vocabulary is about as likely as a rare word, not as its whole group. A
document's score is the sum of log P(token | both sides) over all its tokens.

Scale: word counts are one aggregate over all texts. Each training round is one pass in
which every partition runs stochastic gradient steps on a masked share of all its
positions, from the same start; the parameters, weighted by positions, are summed by
blocks in two aggregates and averaged. So what is gathered grows with the partitions, and
the driver holds one model of fixed size. Scoring is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.arrow_words import lower_words, outer_bytes, slices
from tidecast.llm.schemas import plus
from tidecast.session import cut_lineage

WINDOW = 2
WIDTH = 16  # of an embedding
HIDDEN = 32
CLASSES = 64
OTHER = 64
VOCABULARY = 8192
MASKED = 0.15
BATCH = 512
RATE = 0.1
BLOCK = 4096  # parameters in one row of the aggregate
TILE = 16_384


def other_group(words: pa.Array) -> np.ndarray:
    """Group of each word by its length in bytes, first and last byte."""
    length, first, last = outer_bytes(words)
    return (length * 31 + first * 7 + last) % OTHER


class Vocabulary:
    """Tokens of words: their place in the list, or after it the group of other words."""

    def __init__(self, words: list[str]):
        self.words = pa.array(words, pa.large_string())

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts of a column, and where each text's begin."""
        words, begins = lower_words(texts)
        place = pc.index_in(words, self.words)
        tokens = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = np.flatnonzero(tokens < 0)
        tokens[rest] = len(self.words) + other_group(words.take(pa.array(rest)))
        return tokens, begins


# ---- counts ---------------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [lower_words(batch.column(0)[a:b])[0].value_counts() for a, b in slices(batch.column(0))]
        if counts:
            parts = pa.table({"word": pa.chunked_array([c.field("values") for c in counts]), "n": pa.chunked_array([c.field("counts") for c in counts])})
            found = parts.group_by("word").aggregate([("n", "sum")]).combine_chunks()
            words = found.column("word").combine_chunks()
            group = pa.array(other_group(words).astype(np.int32))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), group, found.column("n_sum").combine_chunks()], ["word", "other", "n"])


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, other, n) over all whole texts; ``other`` is the word's group if it is not in the vocabulary."""
    return (docs.select(F.col(text_col).cast("string")).mapInArrow(_count, "word string, other int, n long")
            .groupBy("word", "other").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    """Parameters are one flat float32 vector; the views share its memory."""

    vocabulary: Vocabulary
    class_of: np.ndarray
    share: np.ndarray  # log share of a token in its class
    flat: np.ndarray

    @property
    def size(self) -> int:
        return len(self.class_of)

    def views(self, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """Embeddings (one more for beyond the text), hidden weights, hidden bias, output weights, output bias."""
        shapes = ((self.size + 1, WIDTH), (2 * WINDOW * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, self.classes), (self.classes,))
        out, at = [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            out.append(flat[at:at + n].reshape(shape))
            at += n
        return tuple(out)

    @property
    def classes(self) -> int:
        return int(self.class_of.max()) + 1

    @property
    def parameters(self) -> int:
        return (self.size + 1) * WIDTH + 2 * WINDOW * WIDTH * HIDDEN + HIDDEN + (HIDDEN + 1) * self.classes


def start_model(words: list[str], counts: np.ndarray, other: np.ndarray, seed: int = 5, kinds: np.ndarray | None = None) -> Model:
    """Classes of equal mass over the words by falling count, and one class of all groups of
    other words; ``kinds``: how many distinct words each group has."""
    before = (np.cumsum(counts) - counts) / max(1, counts.sum())
    band = np.minimum((before * CLASSES).astype(np.int64), CLASSES - 1)
    names, band = np.unique(band, return_inverse=True)
    class_of = np.concatenate([band, np.full(OTHER, names.size)])
    mass = np.concatenate([counts, other]).astype(np.float64) + 1
    share = np.log(mass) - np.log(np.bincount(class_of, weights=mass))[class_of]
    if kinds is not None:
        share[len(words):] -= np.log(kinds + 1.0)
    model = Model(Vocabulary(words), class_of, share.astype(np.float32), np.empty(0, np.float32))
    rng = np.random.default_rng(seed)
    model.flat = np.zeros(model.parameters, dtype=np.float32)
    emb, w1, _, w2, _ = model.views(model.flat)
    emb[:] = rng.normal(0, 0.1, emb.shape)
    w1[:] = rng.normal(0, 1 / np.sqrt(w1.shape[0]), w1.shape)
    w2[:] = rng.normal(0, 1 / np.sqrt(HIDDEN), w2.shape)
    return model


# ---- network --------------------------------------------------------------------------

def _contexts(tokens: np.ndarray, begins: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """(len(at), 2 WINDOW) neighbours of the tokens at some places; ``outside`` beyond their text."""
    text = np.searchsorted(begins, at, side="right") - 1
    low, high = begins[text], begins[text + 1]
    near = np.empty((at.size, 2 * WINDOW), dtype=np.int64)
    for k, shift in enumerate([d for d in range(-WINDOW, WINDOW + 1) if d]):
        place = at + shift
        inside = (place >= low) & (place < high)
        near[:, k] = np.where(inside, tokens[np.where(inside, place, 0)], outside)
    return near


def _forward(views: tuple[np.ndarray, ...], near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    emb, w1, b1, w2, b2 = views
    x = emb[near].reshape(len(near), -1)
    hidden = np.tanh(x @ w1 + b1)
    logits = hidden @ w2 + b2
    logits -= logits.max(axis=1, keepdims=True)
    np.subtract(logits, np.log(np.exp(logits).sum(axis=1, keepdims=True)), out=logits)
    return x, hidden, logits


def _step(views: tuple[np.ndarray, ...], squares: tuple[np.ndarray, ...], near: np.ndarray, target: np.ndarray) -> None:
    """One Adagrad step on the mean negative log-probability of the targets' classes."""
    emb, w1, _, w2, _ = views
    x, hidden, log_p = _forward(views, near)
    g = np.exp(log_p)
    g[np.arange(len(g)), target] -= 1
    g /= len(g)
    back = (g @ w2.T) * (1 - hidden ** 2)
    rows, place = np.unique(near, return_inverse=True)
    g_emb = np.zeros((rows.size, WIDTH), dtype=np.float32)
    np.add.at(g_emb, place.reshape(-1), (back @ w1.T).reshape(-1, WIDTH))
    for view, square, grad in zip(views[1:], squares[1:], (x.T @ back, back.sum(axis=0), hidden.T @ g, g.sum(axis=0))):
        square += grad ** 2
        view -= RATE * grad / (np.sqrt(square) + 1e-6)
    squares[0][rows] += g_emb ** 2
    emb[rows] -= RATE * g_emb / (np.sqrt(squares[0][rows]) + 1e-6)


def _train(model: Model, columns: Iterator[pa.Array], seed: list[int]) -> tuple[np.ndarray, int]:
    """Parameters after one pass over the masked positions of some texts, and how many those were."""
    flat = model.flat.copy()
    views, squares = model.views(flat), model.views(np.full_like(flat, 1e-4))
    rng = np.random.default_rng(seed)
    seen = 0
    for column in columns:
        tokens, begins = model.vocabulary.tokens(column)
        masked = np.flatnonzero(rng.random(tokens.size) < MASKED)
        rng.shuffle(masked)
        seen += masked.size
        for k in range(0, masked.size, BATCH):
            at = masked[k:k + BATCH]
            _step(views, squares, _contexts(tokens, begins, at, model.size), model.class_of[tokens[at]])
    return flat, seen


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), "<f8") for v in table.column("total"))
    return pa.table({"block": table.column("block")[:1], "total": pa.array([total.tobytes()], pa.binary()), "weight": [sum(table.column("weight").to_pylist())]})


def _round(docs: DataFrame, model: Model, seed: int) -> np.ndarray:
    """The partitions' parameters after one pass, averaged by their positions."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, seen = _train(shared.value, (b.column(0)[i:j] for b in batches for i, j in slices(b.column(0))), [seed])
        if seen:
            cuts = range(0, flat.size, BLOCK)
            blobs = [(flat[k:k + BLOCK].astype("<f8") * seen).tobytes() for k in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blobs)), pa.int32()), pa.array(blobs, pa.binary()), pa.array([float(seen)] * len(blobs))],
                                             ["block", "total", "weight"])

    schema = "block int, total binary, weight double"
    parts = docs.mapInArrow(run, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    few = parts.groupBy("block", "salt").applyInArrow(_sum_blocks, schema)
    blocks = sorted(few.groupBy("block").applyInArrow(_sum_blocks, schema).collect(), key=lambda r: r["block"])
    if not blocks:
        return model.flat
    return np.concatenate([np.frombuffer(r["total"], "<f8") / r["weight"] for r in blocks]).astype(np.float32)


def top_words(counts: DataFrame, n: int) -> list:
    """The ``n`` most frequent words (ties by word). Only words of the highest bands of
    counts (powers of two) that hold ``n`` words are sorted, so few rows reach the driver."""
    band = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r["band"], r["words"]) for r in counts.groupBy(band.alias("band")).agg(F.count("*").alias("words")).collect()), reverse=True)
    lowest, held = 0, 0
    for lowest, words in sizes:  # at most 63 bands
        held += words
        if held >= n:
            break
    return counts.where(band >= lowest).orderBy(F.col("n").desc(), "word").limit(n).collect()


def fit_masked_lm(docs: DataFrame, text_col: str = "text", vocabulary: int = VOCABULARY, rounds: int = 2, seed: int = 5) -> Model:
    """Counts all words, then ``rounds`` passes of averaged local training over all texts."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = cut_lineage(word_counts(texts))
    top = top_words(counts, vocabulary)
    words = [r["word"] for r in top]
    mass, kinds = np.zeros(OTHER, np.int64), np.zeros(OTHER, np.int64)
    for r in counts.groupBy("other").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():  # OTHER rows
        mass[r["other"]], kinds[r["other"]] = r["n"], r["kinds"]
    for r in top:
        mass[r["other"]] -= r["n"]
        kinds[r["other"]] -= 1
    model = start_model(words, np.array([r["n"] for r in top], dtype=np.int64), mass, seed, kinds)
    for k in range(rounds):
        model.flat = _round(texts, model, seed * 1000 + k)
    return model


# ---- scores ---------------------------------------------------------------------------

def log_likelihoods(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, summed conditional log-probability) of each text."""
    views = model.views(model.flat)
    target, begins = model.vocabulary.tokens(texts)
    counts, sums = np.diff(begins), np.zeros(len(texts))
    if not target.size:
        return counts, sums
    log_p = np.empty(target.size)
    for k in range(0, target.size, TILE):
        t = target[k:k + TILE]
        near = _contexts(target, begins, np.arange(k, k + t.size), model.size)
        log_p[k:k + TILE] = _forward(views, near)[2][np.arange(t.size), model.class_of[t]] + model.share[t]
    full = counts > 0
    sums[full] = np.add.reduceat(log_p, begins[:-1][full])
    return counts, sums


def score_masked_lm(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, then ``n_tokens``, ``log_likelihood`` (summed) and
    ``mean_log_likelihood``. Null and empty texts have 0 tokens, a sum of 0 and a null
    mean. Every row is scored on its whole text; repeated rows get equal scores. Columns of
    ``docs`` named like the new ones are replaced."""
    new = ("n_tokens", "log_likelihood", "mean_log_likelihood")
    carried = [c for c in docs.columns if c not in (text_col, *new)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b in slices(batch.column(len(carried))):
                part = batch.slice(a, b - a)
                counts, sums = log_likelihoods(model, part.column(len(carried)))
                with np.errstate(invalid="ignore", divide="ignore"):
                    mean = pa.array(sums / counts, mask=counts == 0)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carried)], pa.array(counts), pa.array(sums), mean], [*carried, *new])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    return source.mapInArrow(run, plus(source.select(*carried).schema, "n_tokens long, log_likelihood double, mean_log_likelihood double"))
