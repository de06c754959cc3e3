"""Periodic runs of words by block convolution.

A run is a maximal stretch of consecutive words with smallest period q that is at least
``LEAST`` words and ``TIMES`` periods long. Periods from B to 2B - 1 are found at the
dyadic scale B: a run of such a period holds at least two neighbouring blocks of B words
(of the grid of multiples of B) that occur again q words later. For each block, the sum of
squared differences to each place of the window that follows it,

    sum (x_j - y_(k+j))^2 = sum x_j^2 + sum y_(k+j)^2 - 2 sum x_j y_(k+j),

is computed for all distances at once by a number-theoretic transform, exactly: modulo as
many primes as the largest possible sum needs. Distances with sum zero are seeds;
neighbouring blocks with the same distance are one chain, which is extended word by word
to both sides by less than one block each. A stretch inside a run of a smaller period
(found at a lower scale) repeats that run and is dropped, by the periodicity lemma.

Only blocks whose every word recurs within 2B words can be repeated within 2B words; the
others are left out before the transform. Work is O(n log n) a scale at most, and O(n) a
scale for prose.

Scale: a map over rows. All texts of a slice of about 1 MB are one sequence, in which
words of different texts are different, so short texts share the array work. A text longer
than a slice is a slice of its own; memory goes with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.arrow_words import slices
from tidecast.llm.schemas import plus

TIMES = 4
LEAST = 6
CELLS = 1 << 19  # entries of one batch of transforms

# Primes k * 2^m + 1 with primitive root 3, for transforms of up to 2^23 entries.
PRIMES = (998244353, 469762049, 167772161)
ROOT = 3


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    done, step = 1, np.uint64(base)
    while done < count:
        more = min(done, count - done)
        out[done:done + more] = out[:more] * step % np.uint64(prime)
        done += more
        step = step * step % np.uint64(prime)
    return out


def ntt(rows: np.ndarray, prime: int, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long)."""
    p = np.uint64(prime)
    out = rows.astype(np.uint64) % p
    count, n = out.shape
    root = pow(ROOT, (prime - 1) // n, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    # each step halves the columns' transforms and doubles their number; order comes out natural
    out = out.reshape(count, n, 1)
    while out.shape[1] > 1:
        half = out.shape[1] // 2
        factors = _powers(pow(root, n // (2 * half), prime), half, prime)[:, None]
        a, b = out[:, :half], out[:, half:]
        out = np.concatenate([(a + b) % p, (a + (p - b)) % p * factors % p], axis=2)
    out = out.reshape(count, n)
    if inverse:
        out = out * np.uint64(pow(n, prime - 2, prime)) % p
    return out


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each row of ``blocks`` (B entries, not negative) equals its row of ``windows``
    (2B - 1 entries) at each of the B places."""
    count, size = blocks.shape
    if not count:
        return np.zeros((0, size), bool)
    largest = int(max(blocks.max(), windows.max()))
    equal = np.ones((count, size), bool)
    modulus = 1
    for prime in PRIMES:
        p = np.uint64(prime)
        a = np.zeros((count, 2 * size), np.uint64)
        b = np.zeros((count, 2 * size), np.uint64)
        a[:, :size], b[:, :2 * size - 1] = blocks, windows
        a, b = a % p, b % p
        squares = np.cumsum(b * b % p, axis=1)  # of fewer than 2^24 entries under 2^30
        in_window = squares[:, size - 1:2 * size - 1].copy()
        in_window[:, 1:] -= squares[:, :size - 1]
        of_block = (a * a % p).sum(axis=1) % p
        back = np.roll(a[:, ::-1], 1, axis=1)  # entry -j: products then are at the difference of places
        cross = ntt(ntt(back, prime) * ntt(b, prime) % p, prime, inverse=True)[:, :size]
        equal &= (of_block[:, None] + in_window % p) % p == np.uint64(2) * cross % p
        modulus *= prime
        if size * largest * largest < modulus:
            return equal
    raise ValueError("sums of squares beyond the primes' product")


def runs(x: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers (0 or more), by start, then period."""
    n = len(x)
    empty = np.zeros((0, 3), np.int64)
    if n < TIMES:
        return empty
    order = np.argsort(x, kind="stable")
    gap = np.full(n, n, np.int64)  # to the next place of the same word
    same = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    never = int(x.max()) + 1
    found: list[np.ndarray] = []
    reach = np.zeros(n, np.int64)  # greatest end of the runs found so far that start here or before
    size = 1
    while TIMES * size <= n:
        count = n // size
        widest = gap[:count * size].reshape(count, size).max(axis=1)
        at = np.arange(count) * size
        able = (widest < 2 * size) & (reach[at] < at + 3 * size - 1)
        beside = np.zeros(count, bool)
        beside[1:] |= able[:-1]
        beside[:-1] |= able[1:]
        numbers = np.flatnonzero(able & beside)
        if numbers.size:
            new = _at_scale(x, numbers, size, reach, never)
            if new.size:
                found.append(new)
                np.maximum.at(reach, new[:, 0], new[:, 0] + new[:, 1])
                reach = np.maximum.accumulate(reach)
        size *= 2
    if not found:
        return empty
    out = np.concatenate(found)
    out = out[out[:, 1] >= LEAST]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _at_scale(x: np.ndarray, numbers: np.ndarray, size: int, reach: np.ndarray, never: int) -> np.ndarray:
    """Stretches of at least ``TIMES`` periods with a period from ``size`` to 2 ``size`` - 1
    that lie in no run found before; ``numbers``: the blocks that may be repeated."""
    n = len(x)
    seeds = []
    step = max(1, CELLS // (2 * size))
    for k in range(0, numbers.size, step):
        begin = numbers[k:k + step] * size
        places = begin[:, None] + size + np.arange(2 * size - 1)
        windows = np.where(places < n, x[np.minimum(places, n - 1)], never)
        row, shift = np.nonzero(zero_mismatches(x[begin[:, None] + np.arange(size)], windows))
        seeds.append(np.stack([numbers[k:k + step][row], shift + size], axis=1))
    number, period = np.concatenate(seeds).T
    order = np.lexsort((number, period))
    number, period = number[order], period[order]
    if not number.size:
        return np.zeros((0, 3), np.int64)
    first = np.concatenate([[True], (np.diff(number) != 1) | (np.diff(period) != 0)])
    chain = np.flatnonzero(first)
    blocks = np.diff(np.concatenate([chain, [number.size]]))
    begin, period = number[chain] * size, period[chain]
    end = begin + blocks * size  # words from begin to end recur a period later
    long_enough = end - begin + 2 * (size - 1) >= (TIMES - 1) * period
    inside = reach[begin] >= end + period
    keep = np.flatnonzero(long_enough & ~inside)
    out = []
    for b, e, q in zip(begin[keep].tolist(), end[keep].tolist(), period[keep].tolist()):
        low = max(0, b - size)
        differs = np.flatnonzero(x[low:b] != x[low + q:b + q])
        b = low + int(differs[-1]) + 1 if differs.size else low
        high = min(n - q, e + size)
        differs = np.flatnonzero(x[e:high] != x[e + q:high + q])
        e = e + int(differs[0]) if differs.size else high
        if e - b >= (TIMES - 1) * q and reach[b] < e + q:
            out.append((b, e + q - b, q))
    return np.array(out, np.int64).reshape(-1, 3)


def collapsed(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run keeps its first period only."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges)[:n] == 0


def _slice(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each text: its number of words, its runs, and its words without the repeats."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    words, begins = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    begins = begins - begins[0]
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at an end leaves an empty word
    kept = np.concatenate([[0], np.cumsum(full)])
    words, begins = words.filter(pa.array(full)), kept[begins]
    counts = np.diff(begins)
    text_of = np.repeat(np.arange(len(texts)), counts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, numbers = np.unique(text_of * max(1, len(words)) + codes, return_inverse=True)
    found = runs(numbers.astype(np.int64))
    stay = collapsed(len(words), found)
    of_run = text_of[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    ends = np.searchsorted(of_run, np.arange(len(texts) + 1))
    fields = [found[:, 0] - begins[of_run], found[:, 1], found[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"])
    left = np.concatenate([[0], np.cumsum(stay)])[begins]
    texts_left = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(stay)).cast(pa.string())), " ")
    return pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), structs), texts_left.cast(pa.string())


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, then ``n_words``, ``runs`` (start and length in words,
    period; by start, then period) and ``collapsed`` (the words outside the repeats, joined
    by one space: of each run, its first period stays).

    Words are what stands between ASCII white space, compared as they are. A null or empty
    text has no words, no runs and an empty ``collapsed``. One output row per input row,
    repeated rows included, none for an empty table; columns of ``docs`` named like the new
    ones are replaced."""
    new = ("n_words", "runs", "collapsed")
    carried = [c for c in docs.columns if c not in (text_col, *new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carried))
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[:len(carried)]), *_slice(texts[a:b])], [*carried, *new])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    return source.mapInArrow(run, plus(source.select(*carried).schema, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"))
