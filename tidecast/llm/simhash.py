"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 23, 23 and 18 bits. The binary Golay
code (23, 12) is perfect: every 23-bit word lies within 3 bits of exactly one codeword,
whose 12 message bits are the word's index. Decoding a word and all words one bit away
gives 1 or 6 indices; two words at most one bit apart share the plain index of one among
the nearby indices of the other.

With at most 3 differing bits, some two of the three segments differ by at most one bit
each (the splits 3+0+0, 2+1+0 and 1+1+1 and all smaller ones). So for each pair of
segments a fingerprint gets the keys (plain, nearby) and (nearby, plain), and linked
fingerprints share a key. Rows with equal keys are verified on the whole 64 bits.

Scale: documents are reduced to distinct fingerprints first, so exact copies cost one
row. Keys are spread by one hash shuffle and read as sorted runs; a run longer than
``RUN`` is dealt out as block pairs over many tasks. A run hands on a star per linked
group, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.components import connected_components, local_roots
from tidecast.llm.schemas import plus, unused
from tidecast.session import cut_lineage

SEED = 42
BITS = 3
RUN = 4096
CHUNK = 1 << 16
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, number of bits
PAIRS = ((0, 1), (0, 2), (1, 2))
GOLAY_POLYNOMIAL = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


# ---- fingerprints ---------------------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is 1 if set in over half of the shingles' XXH64."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and ASCII white space
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[k:k + CHUNK], ends[k:k + CHUNK])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """The columns of ``df`` without the text, and the fingerprint as a signed long."""
    carried = [c for c in df.columns if c not in (text_col, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carried)).cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], pa.array(prints.view(np.int64))], [*carried, out])

    source = df.select(*carried, F.col(text_col).cast("string"))
    schema = plus(source.select(*carried).schema, f"`{out}` long")
    return source.mapInArrow(run, schema)


def hex16(c: Column) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


# ---- Golay keys -----------------------------------------------------------------------

def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of the upper 12 bits, and the error of weight 3 or less for each syndrome."""
    rest = []
    for bit in range(11, 23):
        x = 1 << bit
        for b in range(22, 10, -1):
            if x >> b & 1:
                x ^= GOLAY_POLYNOMIAL << (b - 11)
        rest.append(x)
    upper = np.zeros(4096, dtype=np.int64)
    for bit in range(12):
        upper ^= np.where(np.arange(4096) >> bit & 1, rest[bit], 0)
    errors = np.zeros(2048, dtype=np.int64)
    one = [1 << i for i in range(23)]
    patterns = np.array([0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]),
                         *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])], dtype=np.int64)
    errors[upper[patterns >> 11] ^ (patterns & 0x7FF)] = patterns
    return upper, errors


UPPER, ERRORS = _tables()


def golay_index(words: np.ndarray) -> np.ndarray:
    """Message bits (12) of the codeword nearest to each 23-bit word."""
    return (words ^ ERRORS[UPPER[words >> 11] ^ (words & 0x7FF)]) >> 11


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every key of the uint64 fingerprints."""
    plain, nearby, fresh = [], [], []
    for first, bits in SEGMENTS:
        words = (prints >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)
        own = golay_index(words)
        ball = np.sort(golay_index(words[:, None] ^ (1 << np.arange(bits))[None, :]), axis=1)
        plain.append(own)
        nearby.append(ball)
        new = np.ones(ball.shape, dtype=bool)
        new[:, 1:] = ball[:, 1:] != ball[:, :-1]
        fresh.append(new & (ball != own[:, None]))
    rows, keys = [], []
    for p, (i, j) in enumerate(PAIRS):
        rows.append(np.arange(prints.size))
        keys.append(p << 24 | plain[i] << 12 | plain[j])
        r, c = np.nonzero(fresh[j])
        rows.append(r)
        keys.append(p << 24 | plain[i][r] << 12 | nearby[j][r, c])
        r, c = np.nonzero(fresh[i])
        rows.append(r)
        keys.append(p << 24 | nearby[i][r, c] << 12 | plain[j][r])
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        rows, keys = golay_keys(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints.view(np.int64)[rows])], ["key", "fp"])


# ---- links inside runs of equal keys --------------------------------------------------

def _link(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of every linked group among some fingerprints."""
    u = prints.view(np.uint64)
    root = local_roots(u.size, lambda a, b: np.bitwise_count(u[a][:, None] ^ u[b][None, :]) <= bits)
    own = np.flatnonzero(root != np.arange(u.size))
    return prints[own], prints[root[own]]


def _rows(kind: int, a, b, c) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())],
                                      ["kind", "a", "b", "c"])


def _link_runs(bits: int, run: int):
    """Reads (key, fp) sorted by key. kind 0: link a - b; 1: fingerprint c of block b of
    the long run a; 2: the long run a has b blocks."""

    def close(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1, append=keys[-1] + 1))
        sizes = np.diff(edges)
        two = edges[:-1][sizes == 2]
        x, y = prints[two], prints[two + 1]
        near = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= bits
        found = [(x[near], y[near])] + [_link(prints[s:s + n], bits) for s, n in zip(edges[:-1][sizes > 2], sizes[sizes > 2])]
        a, b = (np.concatenate(z) for z in zip(*found))
        if a.size:
            yield _rows(0, a, b, np.zeros(a.size, np.int64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_k, open_f, blocks = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for batch in batches:
            k = np.concatenate([open_k, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([open_f, batch.column(1).to_numpy(zero_copy_only=False)])
            if not k.size:
                continue
            first = int(np.searchsorted(k, k[0], side="right"))
            if blocks and first < k.size:  # the long run that was open ends here
                yield _rows(1, k[:first], np.full(first, blocks), f[:first])
                yield _rows(2, k[:1], [blocks + 1], [0])
                k, f, blocks = k[first:], f[first:], 0
            last = int(np.searchsorted(k, k[-1], side="left"))
            if last:
                whole_k, whole_f, k, f = k[:last], f[:last], k[last:], f[last:]
                # long runs that lie inside this batch
                starts = np.flatnonzero(np.diff(whole_k, prepend=whole_k[0] - 1))
                sizes = np.diff(np.append(starts, whole_k.size))
                rest = np.ones(whole_k.size, dtype=bool)
                for s, n in zip(starts[sizes > run], sizes[sizes > run]):
                    rest[s:s + n] = False
                    yield _rows(1, whole_k[s:s + n], np.arange(n) // run, whole_f[s:s + n])
                    yield _rows(2, [whole_k[s]], [(n - 1) // run + 1], [0])
                if rest.any():
                    yield from close(whole_k[rest], whole_f[rest])
            while k.size > run:
                yield _rows(1, k[:run], np.full(run, blocks), f[:run])
                k, f, blocks = k[run:], f[run:], blocks + 1
            open_k, open_f = k, f
        if open_k.size:
            if blocks:
                yield _rows(1, open_k, np.full(open_k.size, blocks), open_f)
                yield _rows(2, open_k[:1], [blocks + 1], [0])
            else:
                yield from close(open_k, open_f)

    return read


def fingerprint_links(prints: DataFrame, bits: int = BITS, run: int = RUN) -> DataFrame:
    """(a, b): links that join exactly the fingerprints (column ``fp``, distinct) with a
    chain of steps of ``bits`` or fewer; a star per group and key, not all pairs."""
    if not 0 <= bits <= 3:
        raise ValueError("the segment keys hold for 0 to 3 differing bits")
    keyed = prints.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    found = cut_lineage(keyed.repartition("key").sortWithinPartitions("key", "fp")
                        .mapInArrow(_link_runs(bits, run), "kind int, a long, b long, c long"))
    links = found.where("kind = 0").select("a", "b")
    long_runs = found.where("kind = 2").select(F.col("a").alias("key"), F.col("b").alias("blocks"))
    if long_runs.isEmpty():
        return links

    def pair(table: pa.Table) -> pa.Table:
        a, b = _link(table.column("fp").to_numpy(), bits)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = (found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("block"), F.col("c").alias("fp"))
            .join(long_runs, "key")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "fp"))
    return links.unionByName(rows.groupBy("key", "lo", "hi").applyInArrow(pair, "a long, b long"))


# ---- documents ------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = BITS, carry: tuple[str, ...] = (), root_col: str | None = None) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable by links of ``max_bits`` or fewer differing bits; then ``carry``
    and, as ``root_col``, the component's smallest fingerprint, which tells components
    apart where they share an id.

    Null and empty texts have fingerprint zero and link like any other; a text of fewer
    words than ``shingle`` is one shingle. Repeated rows keep their number; all rows with
    one id are nodes of their own. Null ids never name a component: a group of null ids
    only has component NULL. Other columns of ``docs`` are not read.
    """
    own = docs.select(F.col(id_col).alias("_id"), *carry, F.col(text_col).alias("_text"))
    prints = cut_lineage(with_fingerprint(own, "_text", shingle, "_fp"))
    distinct = prints.groupBy("_fp").agg(F.min("_id").alias("_first")).select(F.col("_fp").alias("fp"), "_first")
    roots = connected_components(fingerprint_links(distinct, max_bits))
    placed = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
              .select("fp", "_first", F.coalesce("component", "fp").alias("_root")))
    named = placed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    roots = () if root_col is None else (F.col("_root").alias(root_col),)
    of_print = placed.join(named, "_root").select(F.col("fp").alias("_fp"), "component_id", *roots)
    return (prints.join(of_print, "_fp")
            .select(F.col("_id").alias(id_col), hex16(F.col("_fp")).alias("fingerprint"), "component_id", *carry,
                    *(() if root_col is None else (root_col,))))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                max_bits: int = BITS) -> DataFrame:
    """``docs`` (all its columns) with one document of each near-duplicate group: the one
    with the group's smallest id; of several rows with that id, the one whose text has the
    smallest hash, and one of fully equal copies. Rows of one id with unlike texts are in
    groups of their own. A group of null ids keeps one row."""
    hash_col, = unused(docs.columns, "_hash_of_text")
    keys = F.xxhash64(F.col(text_col).cast("string"))
    narrow = docs.select(F.col(id_col).alias("_key"), keys.alias("_hash"), F.col(text_col).alias("_body"))
    groups = near_duplicates(narrow, "_key", "_body", shingle, max_bits, carry=("_hash",), root_col="_root")
    copies = groups.groupBy("_root", "_key", "_hash").agg(F.count("*").alias("n"))
    least = copies.groupBy("_root").agg(F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_hash", "n")).alias("f"))
    best = cut_lineage(least.select("f._key", "f._hash", "f.n"))
    marked = docs.withColumn(hash_col, keys)

    def rows_of(kept: DataFrame) -> DataFrame:  # the narrow side is hashed, the texts are not sorted
        same = marked[id_col].eqNullSafe(kept["_key"]) & (marked[hash_col] == kept["_hash"])
        return marked.join(kept.hint("shuffle_hash"), same, "left_semi")

    one, several = best.where("n = 1"), best.where("n > 1")
    if several.isEmpty():
        return rows_of(one).drop(hash_col)
    return rows_of(one).unionByName(rows_of(several).dropDuplicates([id_col, hash_col])).drop(hash_col)
