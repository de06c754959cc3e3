"""SentencePiece BPE encoding and decoding by exact backtracking.

A model of this kind merges, again and again, the two adjacent symbols whose concatenation
is the piece of highest score (the leftmost of equal ones). A token sequence is its result
if and only if each token and each two adjacent tokens are the result for their own text:
what happens inside one token, and at the border of two, depends on those two alone. So no
text has two such sequences, and neither has any prefix of it.

Encoding tries, at each position, the longest piece that an Aho-Corasick automaton found
there, then the shorter ones that begin it; a piece is taken if re-merging it with the token before gives
the two again. Where no piece fits, the position can be no token's border: a bitfield
marks it, and the token before gives way to a shorter one. Each position fails once.

Texts are cut beforehand where no piece can reach across (characters that stand side by
side in no piece), which changes nothing and makes words that a cache can hold.

Scale: a map over rows. The vocabulary (a fixed file) is broadcast; each Python worker
builds its automaton once and keeps bounded caches.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.arrow_words import slices
from tidecast.llm.schemas import plus

SPACE = "▁"
WORDS = 400_000  # cached words and token pairs of a worker
PAIRS = 300_000

# Fixed values of the model file's format: numbers of its fields and kinds of pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("tidecast-each-byte", _each_byte)


class PieceModel:
    """BPE model of a ``sentencepiece`` file with byte fallback, no normalisation but the
    space mark in front, and no user-defined or unused pieces. Pickled as its plain content."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(message(f.read()))
        pieces = [dict(message(v)) for k, v in parts if k == PIECES]
        trainer = dict(message(next(v for k, v in parts if k == TRAINER)))
        normalizer = dict(message(next((v for k, v in parts if k == NORMALIZER), b"")))
        self.pieces = [(p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)) for p in pieces]
        bytes_known = sum(kind == BYTE for *_, kind in self.pieces) == 256
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1) and not trainer.get(24, 0)
        if trainer.get(3, 1) != BPE_MODEL or not trainer.get(35, 0) or not bytes_known or not plain or any(kind not in (NORMAL, UNKNOWN, CONTROL, BYTE) for *_, kind in self.pieces):
            raise ValueError(f"{path}: not a BPE model with byte fallback and plain normalisation")
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()

    def __getstate__(self):
        return {"pieces": self.pieces, "unknown": self.unknown}

    @cached_property
    def vocabulary(self) -> dict[str, tuple[float, int]]:
        """Text -> (score, id) of the pieces that merging can make."""
        out: dict[str, tuple[float, int]] = {}
        for i, (text, score, kind) in enumerate(self.pieces):
            if kind == NORMAL:
                out.setdefault(text, (score, i))
        return out

    @cached_property
    def byte_ids(self) -> list[int]:
        known = {text: i for i, (text, _, kind) in enumerate(self.pieces) if kind == BYTE}
        return [known[f"<0x{b:02X}>"] for b in range(256)]

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for text in self.vocabulary:
            found.add_word(text)
        found.make_automaton()
        return found

    # -- words ---------------------------------------------------------------------

    @cached_property
    def word_pattern(self) -> re.Pattern:
        """Space marks and then characters of one class, or any one character. Characters
        are of one class if a chain of neighbours inside pieces connects them."""
        parent: dict[str, str] = {}

        def root(c: str) -> str:
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        mark_first = True
        for text in self.vocabulary:
            for a, b in zip(text, text[1:]):
                if a != SPACE and b == SPACE:
                    mark_first = False
                elif a != SPACE:
                    parent[root(a)] = root(b)
        if not mark_first:  # marks inside pieces: whole texts are single words
            return re.compile(".+", re.S)
        classes: dict[str, list[str]] = {}
        for c in sorted(parent):
            classes.setdefault(root(c), []).append(c)
        sets = ["[" + "".join(map(re.escape, c)) + "]+" for c in sorted(classes.values(), key=len, reverse=True)]
        return re.compile(f"{SPACE}*(?:{'|'.join([*sets, '.'])})", re.S)

    def merge(self, text: str) -> list[str]:
        """The model's own rule on a short text: highest score first, leftmost of equal ones."""
        parts, known = list(text), self.vocabulary
        while True:
            best = None
            for i in range(len(parts) - 1):
                piece = known.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or piece[0] > best[0]):
                    best = (piece[0], i)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    @cached_property
    def fits(self) -> dict[tuple[str, str], bool]:
        """Whether a token can follow another ("" before the first)."""
        merge = self.merge

        class Cache(dict):
            def __missing__(self, pair: tuple[str, str]) -> bool:
                known = merge(pair[0] + pair[1]) == [t for t in pair if t]
                if len(self) < PAIRS:
                    self[pair] = known
                return known

        return Cache()

    @cached_property
    def shorter(self) -> dict[str, int]:
        """Length of the next shorter piece that a piece begins with (0: none)."""
        known = self.vocabulary
        return {text: next((k for k in range(len(text) - 1, 0, -1) if text[:k] in known), 0) for text in known}

    def tokens(self, word: str) -> list[str]:
        """The texts of a word's tokens; characters outside the vocabulary are tokens of their own."""
        fits, shorter = self.fits, self.shorter
        longest = {last - length + 1: length for last, length in self.matcher.iter(word)}  # a later one is longer
        failed = bytearray(len(word) + 1)
        out: list[str] = []
        at, before = 0, ""
        while at < len(word):
            length = longest.get(at, 1)
            while True:
                while length:
                    token = word[at:at + length]
                    if not failed[at + length] and fits[before, token]:
                        break
                    length = shorter.get(token, 0)
                else:
                    failed[at] = 1
                    token = out.pop()
                    at -= len(token)
                    before = out[-1] if out else ""
                    length = shorter.get(token, 0)
                    continue
                break
            out.append(token)
            at += length
            before = token
        return out

    @cached_property
    def words(self) -> dict[str, bytes]:
        known, byte_ids, tokens = self.vocabulary, self.byte_ids, self.tokens

        def ids(word: str) -> bytes:
            out: list[int] = []
            for token in tokens(word):
                piece = known.get(token)
                out += [piece[1]] if piece else [byte_ids[b] for b in token.encode()]
            return np.array(out, "<i4").tobytes()

        class Cache(dict):
            """Takes words until full; starts anew after four times as many misses."""

            late = 0

            def __missing__(self, word: str) -> bytes:
                found = ids(word)
                if len(self) < WORDS:
                    if len(word) < 100:
                        self[word] = found
                else:
                    self.late += 1
                    if self.late > 4 * WORDS:
                        self.clear()
                        self.late = 0
                return found

        return Cache()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.words.__getitem__, self.word_pattern.findall(SPACE + text.replace(" ", SPACE))))

    # -- decoding ------------------------------------------------------------------

    @cached_property
    def labels(self) -> tuple[pa.Array, np.ndarray]:
        """What each id spells, and whether that begins with a space mark. The last entry stands for ids outside the vocabulary."""
        byte = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        spelled = {NORMAL: lambda i, text: text.replace(SPACE, " ").encode(), CONTROL: lambda i, text: b"",
                   UNKNOWN: lambda i, text: self.unknown.encode(), BYTE: lambda i, text: byte[i]}
        texts = [spelled[kind](i, text) for i, (text, _, kind) in enumerate(self.pieces)] + [b""]
        return pa.array(texts, pa.binary()), np.array([kind == NORMAL and text[:1] == SPACE for text, _, kind in self.pieces] + [False])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids (null: empty): bytes that are no UTF-8 become replacement
        characters, and the one space put in front of every text goes."""
        labels, marked = self.labels
        flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        flat = np.where((flat >= 0) & (flat < len(self.pieces)), flat, len(self.pieces))
        sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), labels.take(pa.array(flat))), b"")
        spells = pc.binary_length(labels).to_numpy()[flat] > 0
        silent = not spells.all()
        out = []
        for whole, begin, end in zip(joined.to_pylist(), ends[:-1], ends[1:]):
            first = begin + int(np.argmax(spells[begin:end])) if end > begin else begin
            if silent and not spells[begin:end].all():  # what spells nothing still parts the bytes beside it
                borders = [begin, *(begin + np.flatnonzero(~spells[begin:end])), end]
                spelled = [b"".join(labels.take(pa.array(flat[a:b])).to_pylist()) for a, b in zip(borders, borders[1:])]
            else:
                spelled = [whole]
            text = "".join([x.decode("utf-8", "tidecast-each-byte") for x in spelled])
            out.append(text[1:] if end > begin and marked[flat[first]] else text)
        return pa.array(out, pa.string())


def encode(docs: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, then ``ids`` (array of int) and ``n_tokens``. Nothing but
    the model's own space mark is added; nothing is cut or sampled. A null or empty text has
    no ids. One output row per input row, repeated rows included, none for an empty table;
    columns of ``docs`` named like the new ones are replaced."""
    carried = [c for c in docs.columns if c not in (text_col, "ids", "n_tokens")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value.encode
        for batch in batches:
            texts = batch.column(len(carried))
            for a, b in slices(texts):
                rows = [encode(t.as_py()) for t in texts[a:b]]
                counts = np.array([len(x) // 4 for x in rows], np.int64)
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[:len(carried)]), ids, pa.array(counts)], [*carried, "ids", "n_tokens"])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    return source.mapInArrow(run, plus(source.select(*carried).schema, "ids array<int>, n_tokens long"))


def decode(encoded: DataFrame, model: PieceModel, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the decoded text as ``out`` (replaced if there); null ids give an empty text."""
    carried = [c for c in encoded.columns if c not in (ids_col, out)]
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = shared.value.decode
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = part.column(len(carried))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carried)], ids, decode(ids)], [*carried, ids_col, out])

    source = encoded.select(*carried, ids_col)
    return source.mapInArrow(run, plus(source.schema, f"`{out}` string"))
