"""Vectorised word scanning over Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's identity is a
64-bit polynomial hash of its UTF-8 bytes, computed for a whole chunk of texts
with prefix sums, so no Python object is made per word. Chunks hold about
``limit`` bytes, which bounds memory whatever the batch: a longer text comes in
pieces cut between words. Only a single word longer than that is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANKS = b" \t\n\x0b\x0c\r"
SPACE = np.zeros(256, dtype=bool)
SPACE[list(_BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_BASE = 0x9E3779B97F4A7C15
_STATE: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    """Words of the texts first, first + 1, ... of a column, in reading order."""

    first: int
    texts: int
    doc: np.ndarray  # index of each word's text, from ``first``
    start: np.ndarray  # byte offsets into ``data``
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray  # A-Z in lower case
    raw: np.ndarray  # as in the text
    opens: bool = True  # the first text begins here
    ends: bool = True  # the last text ends here


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _STATE or len(_STATE["pow"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for key, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _STATE[key] = np.multiply.accumulate(steps)
    return _STATE["pow"][:n], _STATE["inv"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def scan(column: pa.Array, limit: int = 1 << 20, strip: bool = False, overlap: int = 0) -> Iterator[Words]:
    """strip: cut ASCII punctuation off both ends of words, and skip words that are nothing else.

    A text of more than ``limit`` bytes comes in pieces: ``opens`` and ``ends``
    tell them apart. Each piece repeats the last ``overlap`` bytes or fewer (far
    less than ``limit``) of the one before.
    """
    data, offsets = utf8(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n, first + (1 << 16))
        a, b = int(offsets[first]), int(offsets[last])
        if b - a <= limit:
            yield _words(data[a:b], offsets[first : last + 1] - a, first, strip)
        else:
            for c, d in _pieces(data, a, b, limit, overlap):
                yield _words(data[c:d], np.array([0, d - c]), first, strip)._replace(opens=c == a, ends=d == b)
        first = last


def _after_blank(data: np.ndarray, at: int, end: int) -> int:
    """The first place from ``at`` that follows a blank, or ``end``."""
    while at < end:
        blanks = np.flatnonzero(SPACE[data[at : min(at + 4096, end)]])
        if len(blanks):
            return at + int(blanks[0]) + 1
        at += 4096
    return end


def _pieces(data: np.ndarray, a: int, b: int, limit: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that end after a blank; a word is never cut."""
    while True:
        end = _after_blank(data, a + limit, b)
        yield a, end
        if end == b:
            return
        a = _after_blank(data, end - overlap, end) if overlap else end


def _words(raw: np.ndarray, offsets: np.ndarray, first: int, strip: bool) -> Words:
    size, texts = len(raw), len(offsets) - 1
    if not size:
        none = np.zeros(0, np.int64)
        return Words(first, texts, none, none, none, np.zeros(0, np.uint64), raw, raw)
    data = LOWER[raw]
    solid = ~SPACE[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before = np.ones(size, dtype=bool)
    before[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.ones(size, dtype=bool)
    after[:-1] = ~solid[1:]
    end = np.flatnonzero(solid & (after | edge[1:])) + 1
    if strip:
        while (edge_mark := PUNCTUATION[data[start]] & (start < end - 1)).any():
            start = start + edge_mark
        while (edge_mark := PUNCTUATION[data[end - 1]] & (start < end - 1)).any():
            end = end - edge_mark
        real = ~PUNCTUATION[data[start]]
        start, end = start[real], end[real]
    up, down = _powers(size)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * down[start])
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(first, texts, doc, start, end, hashes, data, raw)


def word_hash(word: bytes) -> int:
    """The hash that :func:`scan` gives to one word."""
    return int(next(iter(scan(pa.array([word.decode()])))).hash[0])


def bounds(words: Words) -> np.ndarray:
    """Offsets of each text's words: text i has words bounds[i] to bounds[i + 1]."""
    return np.searchsorted(words.doc, np.arange(words.texts + 1))


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``width`` words within one text."""
    return windows_of(words.hash, words.doc, width)


def windows_of(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(_BASE) + hashes[at + k])
    return at, out
