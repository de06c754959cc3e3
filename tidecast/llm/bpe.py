"""Byte-level BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts as one state with a loop for each byte; each merge
(a, b) in order is a gadget: the state that arc ``a`` enters is copied without its arc
``b``, ``a`` now enters the copy, and a new arc ``ab`` is added wherever ``a`` leaves,
entering the state that ``b`` entered. What remains are exactly the token sequences that
BPE produces, so a word has one path, and so has each of its prefixes.

A state is stored as what sets it apart from the state it was copied from: the cut arc
and the time of the cut. Whether an arc leaves a state follows from the cuts and is put
into a transition table on first use. Encoding follows the path by steps down a trie of the arc labels and
look-ups in that table; decoding emits the arc labels.

Scale: a map over rows. The vocabulary (a fixed file) is broadcast as its merges; each
Python worker compiles the automaton once and keeps bounded caches.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.arrow_words import slices
from tidecast.llm.schemas import plus

WORDS = 200_000  # cached words and table entries of a worker
ENTRIES = 300_000
LATE = 1 << 30


class TokenAutomaton:
    """Deterministic automaton over token numbers 0..n-1: 256 bytes, then one per merge."""

    def __init__(self, merges: list[tuple[int, int]]):
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.label: list[bytes] = [bytes([i]) for i in range(256)]
        #: the lineage of states entered by a token: (token, cut arc) -> time of the cut
        self.cut: dict[tuple[int, int], int] = {}
        self.states = 1
        for a, b in merges:
            token = len(self.parts)
            self.cut.setdefault((a, b), token)  # copy of the state entered by a, without arc b
            self.states += 1
            self.parts.append((a, b))  # arc ab enters what b entered at this time
            self.label.append(self.label[a] + self.label[b])
        self.longest = max(map(len, self.label))
        self.table: dict[int, bool] = {}

    def has_arc(self, last: int, token: int) -> bool:
        """Whether arc ``token`` leaves the state that arc ``last`` enters."""
        entry = last << 32 | token
        known = self.table.get(entry)
        if known is None:
            known = self._has_arc(last, token)
            if len(self.table) < ENTRIES:
                self.table[entry] = known
        return known

    def _has_arc(self, last: int, token: int) -> bool:
        # the arc was added when its left part left this state, and so down the left parts;
        # the state was copied from that of its right part, and so down the right parts
        state, copied = last, LATE
        while True:
            arc, until = token, copied
            while True:
                cut = self.cut.get((state, arc))
                if cut is not None and cut < copied and cut <= until:
                    return False
                if self.parts[arc] is None:
                    break
                until = min(copied, arc)
                arc = self.parts[arc][0]
            if self.parts[state] is None:
                return True
            copied = min(copied, state)
            state = self.parts[state][1]

    @cached_property
    def trie(self) -> tuple[dict[int, int], list[int]]:
        """(node << 8 | byte) -> node, and the token ending at each node (-1: none)."""
        step: dict[int, int] = {}
        ends = [-1]
        for token, label in enumerate(self.label):
            node = 0
            for byte in label:
                key = node << 8 | byte
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(ends)
                    ends.append(-1)
            ends[node] = token
        return step, ends

    def arcs(self, word: bytes, at: int) -> list[int]:
        """Tokens whose label starts at one position of a word, shortest first."""
        step, ends = self.trie
        node, found = 0, []
        for byte in word[at:at + self.longest]:
            node = step.get(node << 8 | byte, 0)
            if not node:
                break
            if ends[node] >= 0:
                found.append(ends[node])
        return found

    def path(self, word: bytes) -> list[int]:
        """Tokens of the one path that spells ``word``: longest arcs first, one step back
        from a dead end. As every prefix has one path, no position is reached twice."""
        out: list[int] = []
        opened: list[list[int]] = []
        at, n, label, has_arc = 0, len(word), self.label, self.has_arc
        while at < n:
            choices = self.arcs(word, at)
            while True:
                while choices:
                    token = choices.pop()
                    if not out or has_arc(out[-1], token):
                        break
                else:
                    at -= len(label[out.pop()])
                    choices = opened.pop()
                    continue
                break
            opened.append(choices)
            out.append(token)
            at += len(label[token])
        return out


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


# Letters and numbers that Unicode 16.0 added; the vocabulary's splitter knows them.
UNICODE_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA))
WORD = r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def unassigned_letters() -> str:
    """Pattern of the characters that ``regex`` takes for letters or numbers though Unicode 16.0 does not assign them."""
    known = {c for first, last in UNICODE_16 for c in range(first, last + 1)}
    letter, runs = regex.compile(r"[\p{L}\p{N}]"), []
    for c in range(0x370, 0x110000):
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and c not in known and letter.match(chr(c)):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "[" + "".join(rf"\U{first:08x}-\U{last:08x}" for first, last in runs) + "]"


class Tokenizer:
    """Byte-level BPE of one vocabulary file (``tokenizers`` JSON: byte-level splitting,
    no normaliser, prefix space or post-processing). Picklable as its plain content."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        added = spec.get("added_tokens", [])
        if not plain or odd or spec.get("normalizer") or spec.get("post_processor") or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        symbols = byte_symbols()
        number = {s: b for s, b in symbols.items()}
        ids = [model["vocab"][s] for s, _ in sorted(symbols.items(), key=lambda x: x[1])]
        merges = []
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merges.append((number[left], number[right]))
            number[left + right] = len(ids)
            ids.append(model["vocab"][left + right])
        self.spec = (merges, ids, [(t["content"], t["id"]) for t in added], unassigned_letters())

    def __getstate__(self):
        return {"spec": self.spec}

    @cached_property
    def automaton(self) -> TokenAutomaton:
        return TokenAutomaton(self.spec[0])

    @cached_property
    def words(self) -> dict[str, bytes]:
        automaton, ids = self.automaton, np.array(self.spec[1], dtype="<u4")

        class Cache(dict):
            """Takes words until full; starts anew after four times as many misses."""

            late = 0

            def __missing__(self, word: str) -> bytes:
                found = ids[automaton.path(word.encode())].tobytes()
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

    @cached_property
    def patterns(self) -> tuple[regex.Pattern, re.Pattern]:
        return regex.compile(WORD), re.compile(self.spec[3])

    def split(self, text: str) -> list[str]:
        """Words of a text, in order; together they are the text."""
        word, unassigned = self.patterns
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if unassigned.search(text):
                return [text[m.start():m.end()] for m in word.finditer(unassigned.sub("\ue000", text))]
        return word.findall(text)

    @cached_property
    def special(self) -> tuple[regex.Pattern | None, dict[str, bytes]]:
        strings = {s: np.array([i], dtype="<u4").tobytes() for s, i in self.spec[2] if s}
        longest = sorted(strings, key=lambda s: (-len(s), s))
        return (regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None), strings

    @cached_property
    def labels(self) -> dict[int, bytes]:
        """Arc label of each id; special tokens spell their string."""
        return dict(zip(self.spec[1], self.automaton.label)) | {i: s.encode() for s, i in self.spec[2]}

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        pattern, strings = self.special
        words = self.words
        if pattern is None or not text or not pattern.search(text):
            return b"".join(map(words.__getitem__, self.split(text or "")))
        return b"".join(strings[part] if part in strings else b"".join(map(words.__getitem__, self.split(part))) for part in pattern.split(text))

    def decode(self, ids: bytes | None) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters, ids outside the vocabulary nothing."""
        label = self.labels.get
        return b"".join([label(i, b"") for i in np.frombuffer(ids or b"", "<u4").tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, then ``ids`` (binary: little-endian unsigned 32-bit
    integers) and ``n_tokens``. Special token strings in a text become their ids; nothing
    is added, cut or padded. A null or empty text has no ids. One output row per input row;
    columns of ``docs`` named like the new ones are replaced."""
    carried = [c for c in docs.columns if c not in (text_col, "ids", "n_tokens")]
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value.encode
        for batch in batches:
            texts = batch.column(len(carried))
            for a, b in slices(texts):
                ids = [encode(t.as_py()) for t in texts[a:b]]
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[:len(carried)]), pa.array(ids, pa.binary()), counts],
                                                 [*carried, "ids", "n_tokens"])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    return source.mapInArrow(run, plus(source.select(*carried).schema, "ids binary, n_tokens long"))


def decode(encoded: DataFrame, tokenizer: Tokenizer, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the decoded text as ``out`` (replaced if there); null ids give an empty text."""
    carried = [c for c in encoded.columns if c not in (ids_col, out)]
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = shared.value.decode
        for batch in batches:
            ids = batch.column(len(carried))
            for a, b in slices(ids):
                texts = pa.array([decode(x.as_py()) for x in ids[a:b]], pa.string())
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[:len(carried)]), ids[a:b], texts], [*carried, ids_col, out])

    source = encoded.select(*carried, ids_col)
    return source.mapInArrow(run, plus(source.schema, f"`{out}` string"))
