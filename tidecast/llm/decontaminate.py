"""Benchmark decontamination: n-gram seeds, an exact bound on shared words, Smith-Waterman alignment.

Test items are indexed by their word n-grams. Passages are joined to items by every n-gram
they share, however many documents hold it, and the words around each seed are aligned
with the item; matches count 1, changed, missing and added words cost half. An item is
found if the best local alignment reaches ``threshold`` of the item's length.

An alignment that scores s has at least s equal words and spans at most the item's words
and those that may be added. Items of which the whole text, and then windows of that span
around the seeds, hold fewer words are passed over: that bound loses nothing, and it keeps
n-grams that are common to many items and texts from being aligned.

Scale: one map over whole texts. The index of the items is broadcast in blocks of a
bounded size, however many items there are; each block is one more pass.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.arrow_words import lower_words, slices
from tidecast.llm.schemas import plus

SEED = 4
THRESHOLD = 0.5
GAP = 0.5  # cost of a changed, missing or added word
BLOCK_CHARS = 8_000_000  # text of the items in one broadcast index
MARKS = string.punctuation + "«»„“”‘’…–—¿¡"
MIX = np.int64(0x5851F42D4C957F2D)


class Items:
    """N-gram index of one block of test items."""

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED):
        words, begins = lower_words(pa.array([text for _, text in items], pa.string()), MARKS)
        self.vocabulary = pc.unique(words)
        numbers = pc.index_in(words, self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        kept = np.flatnonzero(np.diff(begins) >= seed)
        self.seed = seed
        self.ids = [items[k][0] for k in kept]
        self.texts = [numbers[begins[k]:begins[k + 1]] for k in kept]
        grams = [self.grams(t) for t in self.texts]
        flat = np.concatenate(grams) if grams else np.empty(0, np.int64)
        item = np.repeat(np.arange(len(grams)), [g.size for g in grams])
        place = np.concatenate([np.arange(g.size) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], flat.size)
        self.item, self.place = item[order], place[order]
        self.sizes = np.array([t.size for t in self.texts], dtype=np.int64)
        bags = [np.unique(t, return_counts=True) for t in self.texts]
        self.words = np.concatenate([w for w, _ in bags]) if bags else np.empty(0, np.int64)
        self.times = np.concatenate([n for _, n in bags]) if bags else np.empty(0, np.int64)
        self.begins = np.concatenate([[0], np.cumsum([w.size for w, _ in bags])]).astype(np.int64)
        self.room = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)  # a value per word, zero between uses

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """Hash of every run of ``seed`` words; 0 if one of them is in no item."""
        n = numbers.size - self.seed + 1
        if n <= 0:
            return np.empty(0, np.int64)
        out, all_known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        with np.errstate(over="ignore"):
            for k in range(self.seed):
                part = numbers[k:k + n]
                out = (out + part) * MIX
                out ^= (out >> np.int64(29)) & np.int64(0x7FFFFFFFF)
                all_known &= part > 0
        return np.where(all_known, out | 1, 0)

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of a column of texts (0: in no item), and where each text begins."""
        words, begins = lower_words(texts, MARKS)
        return pc.index_in(words, self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1, begins

    def hits(self, numbers: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, number of the n-gram) of every n-gram of an item inside one text."""
        grams = self.grams(numbers)
        at = np.flatnonzero(grams)
        if not at.size or not self.keys.size:
            return (np.empty(0, np.int64),) * 3
        found = np.searchsorted(self.keys, grams[at])
        found[found == self.keys.size] = 0
        same = self.keys[found] == grams[at]
        at, found = at[same], found[same]
        text = np.searchsorted(begins, at, side="right") - 1
        inside = at + self.seed <= begins[text + 1]
        return text[inside], at[inside], found[inside]

    def shared(self, numbers: np.ndarray, items: np.ndarray) -> np.ndarray:
        """How many of each item's words ``numbers`` holds, a repeated word as often as both have it."""
        held, times = np.unique(numbers, return_counts=True)
        self.room[held] = times
        at, cuts = _ranges(self.begins[items], self.begins[items + 1])
        out = np.add.reduceat(np.minimum(self.room[self.words[at]], self.times[at]), cuts)
        self.room[held] = 0
        return out

    def matches(self, texts: pa.Array, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """(text, item id, score, first word, end) of the best alignment of each text with each item found."""
        numbers, begins = self.read(texts)
        text, at, gram = self.hits(numbers, begins)
        cuts = np.flatnonzero(np.diff(text, prepend=-1))
        out = []
        for part in np.split(np.arange(text.size), cuts[1:]) if text.size else []:
            k = int(text[part[0]])
            own = numbers[begins[k]:begins[k + 1]]
            out += [(k, *m) for m in self._matches(own, at[part] - begins[k], gram[part], threshold)]
        return out

    def _matches(self, numbers: np.ndarray, at: np.ndarray, gram: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
        grams = np.unique(gram)
        items = np.unique(self.item[_ranges(self.first[grams], self.last[grams])[0]])
        items = items[self.shared(numbers, items) >= threshold * self.sizes[items] - 1e-9]
        if not items.size:
            return []
        size = self.last[gram] - self.first[gram]
        row, at = _ranges(self.first[gram], self.last[gram])[0], np.repeat(at, size)
        fits = np.isin(self.item[row], items)
        row, at = row[fits], at[fits]
        order = np.argsort(self.item[row], kind="stable")
        cuts = np.flatnonzero(np.diff(self.item[row[order]], prepend=-1))
        out = []
        for mine in np.split(order, cuts[1:]):
            k = int(self.item[row[mine[0]]])
            item, m = self.texts[k], self.texts[k].size
            slack = int(m * (1 - threshold) / GAP) + 1  # an alignment that passes has no more added words
            begin = np.maximum(at[mine] - self.place[row[mine]] - slack, 0)
            end = np.minimum(at[mine] - self.place[row[mine]] + m + slack, numbers.size)
            best = None
            for a, b in _merge(begin, end):
                for c, d in self._windows(numbers[a:b], k, threshold * m - 1e-9, m + slack):
                    score, first, last = align(item, numbers[a + c:a + d])
                    if score >= threshold * m - 1e-9 and (best is None or score > best[0]):
                        best = (score, a + c + first, a + c + last)
            if best:
                out.append((self.ids[k], best[0] / m, best[1], best[2]))
        return out

    def _windows(self, region: np.ndarray, k: int, need: float, span: int) -> list[tuple[int, int]]:
        """Parts of a region that hold every alignment of ``span`` words or fewer with ``need`` words of item ``k``."""
        words = self.words[self.begins[k]:self.begins[k + 1]]
        self.room[words] = 1
        own = self.room[region]
        self.room[words] = 0
        until = np.concatenate([[0], np.cumsum(own)])
        if until[-1] < need:
            return []
        begin = np.flatnonzero(own)
        end = np.minimum(begin + span, region.size)
        enough = until[end] - until[begin] >= need
        return [(a, b) for a, b in _merge(begin[enough], end[enough]) if self.shared(region[a:b], np.array([k]))[0] >= need]


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges, one range after the other, and where each range begins among them."""
    size = end - begin
    cuts = np.cumsum(size) - size
    return np.repeat(begin - cuts, size) + np.arange(size.sum()), cuts


def _merge(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(begin.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _best(item: np.ndarray, region: np.ndarray) -> tuple[float, int]:
    """Best local score and the end of its alignment in the region."""
    n = region.size
    ramp = GAP * np.arange(n + 1)
    row = np.zeros(n + 1)
    top, end = 0.0, 0
    for word in item:
        new = np.empty(n + 1)
        new[0] = 0
        new[1:] = np.maximum(row[:-1] + np.where(region == word, 1.0, -GAP), row[1:] - GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + ramp) - ramp  # added words of the region
        k = int(np.argmax(row))
        if row[k] > top:
            top, end = float(row[k]), k
    return top, end


def align(item: np.ndarray, region: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman score of word numbers (0 is equal to nothing), and begin and end of the alignment in the region."""
    region = np.where(region == 0, -1, region)
    score, end = _best(item, region)
    if not score:
        return 0.0, 0, 0
    _, back = _best(item[::-1], region[:end][::-1])
    return score, end - back, end


def _blocks(items: DataFrame, id_col: str, text_col: str, chars: int) -> list[DataFrame]:
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // chars))
    return [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)] if total else []


def _indexes(items: DataFrame, item_col: str, item_text_col: str, seed: int, block_chars: int) -> Iterator[Broadcast]:
    """The index of each block of items."""
    for block in _blocks(items, item_col, item_text_col, block_chars):
        yield items.sparkSession.sparkContext.broadcast(Items(sorted((r["id"], r["text"]) for r in block.collect()), seed))


def find_leaks(docs: DataFrame, items: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", threshold: float = THRESHOLD, seed: int = SEED, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``id_cols``, ``item_id``, ``score`` (alignment score over item length, up to 1),
    ``first_word`` and ``end_word`` (places of the passage among the document's words): one
    row per row of ``docs`` and item found in it.

    Null texts, null item ids, items of fewer than ``seed`` words and empty tables match
    nothing. Items with equal words are found each; of several alignments with one item
    the first best one is returned. Repeated rows of ``docs`` each give their rows.
    """
    rows = docs.select(*(F.col(c) for c in id_cols), F.col(text_col).cast("string").alias("_text"))
    text_at = len(id_cols)
    schema = plus(rows.select(*id_cols).schema, "item_id long, score double, first_word long, end_word long")
    out = None
    for shared in _indexes(items, item_col, item_text_col, seed, block_chars):

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                texts = batch.column(text_at)
                found = [(m[0] + a, *m[1:]) for a, b in slices(texts) for m in index.matches(texts[a:b], threshold)]
                if found:
                    row, item, score, first, end = zip(*found)
                    at = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(at) for c in batch.columns[:text_at]), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                         pa.array(first, pa.int64()), pa.array(end, pa.int64())], [*id_cols, "item_id", "score", "first_word", "end_word"])

        found = rows.mapInArrow(match, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = THRESHOLD, seed: int = SEED, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found; a row is judged by its
    own text, so there is no join. What matches nothing is as in ``find_leaks``."""
    place = docs.columns.index(text_col)
    kept = docs
    for shared in _indexes(items, item_col, item_text_col, seed, block_chars):

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                texts = batch.column(place).cast(pa.string())
                for a, b in slices(texts):
                    mark = np.ones(b - a, dtype=bool)
                    mark[[m[0] for m in index.matches(texts[a:b], threshold)]] = False
                    yield batch.slice(a, b - a).filter(pa.array(mark))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
