"""Words of whole columns of texts with Arrow's string kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lower_words(texts: pa.Array, marks: str = "") -> tuple[pa.StringArray, np.ndarray]:
    """All words of a column in order, and the place where each text's words begin (one
    more at the end). Words are lower-case runs between white space, without the outer
    characters ``marks``; what is empty then is no word. Null texts have none."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())).fill_null(""))
    words = lists.flatten()
    if marks:
        words = pc.utf8_trim(words, marks)
    begins = lists.offsets.to_numpy().astype(np.int64)
    begins = begins - begins[0]
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full, min_count=0).as_py():
        kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        words, begins = words.filter(full), kept[begins]
    return words, begins


def outer_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length in bytes, first byte and last byte of each (not empty) word."""
    words = words.cast(pa.large_string())
    if not len(words):
        return (np.empty(0, np.int64),) * 3
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    content = np.frombuffer(data, np.uint8)
    return np.diff(ends), content[ends[:-1]].astype(np.int64), content[ends[1:] - 1].astype(np.int64)


def slices(column: pa.Array, to_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(begin, end) of row ranges of a column of strings or binaries, of about ``to_bytes``
    each, so that what a task makes of a batch stays small."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = 0
    while begin < len(column):
        total = np.cumsum(sizes[begin:])
        end = begin + min(int(np.searchsorted(total, to_bytes)) + 1, total.size)
        yield begin, end
        begin = end
    pa.default_memory_pool().release_unused()
