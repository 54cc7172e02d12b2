"""Benchmark decontamination by template canonicalisation.

Words lose the punctuation at their ends and A-Z is lower-cased. Numbers, units
after a number and capitalised words inside a sentence become typed
placeholders. A second template of the same words keeps the names, so that a
copy in other case or with other sentence marks is the same template. Where
more than half of a run is placeholders in both, and in items of under four
words, the words themselves count. Runs of
``width`` template words of the benchmark (the whole item if it is shorter) are
looked up by hash in every document. Hits of one document
and item on one alignment are merged, and count only if the slots agree: one
value in the item must always stand for one value in the document; two values of
the item may have got the same one. A re-parameterised question is thus found.
Runs that are the item's own words need no slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textscan import Words, mix, scan, windows_of, word_hash

# Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years dollar dollars euro euros cent cents percent degree degrees mph kmh joule joules watt watts volt volts"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (11, 12, 13))
LITERAL = np.uint8(0)
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:;\n|")] = True
_UNITS: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _UNITS:
        _UNITS.append(np.sort(np.array([word_hash(u.encode()) for u in UNITS], dtype=np.uint64)))
    return _UNITS[0]


def kinds(words: Words) -> np.ndarray:
    """Kind of every word (0: literal)."""
    kind = np.zeros(len(words.doc), dtype=np.uint8)
    if not len(kind):
        return kind
    digits = np.concatenate([[0], np.cumsum(_DIGIT[words.data])])
    number = digits[words.end] > digits[words.start]
    first, second = words.raw[words.start], words.raw[np.minimum(words.start + 1, len(words.raw) - 1)]
    capital = _UPPER[first] | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    stops = np.concatenate([[0], np.cumsum(_STOP[words.raw])])
    opens = np.ones(len(kind), dtype=bool)
    opens[1:] = (words.doc[1:] != words.doc[:-1]) | (stops[words.start[1:]] > stops[words.end[:-1]])
    table = _unit_hashes()
    at = np.minimum(np.searchsorted(table, words.hash), len(table) - 1)
    unit = table[at] == words.hash
    unit[1:] &= number[:-1] & (words.doc[1:] == words.doc[:-1])
    unit[0] = False
    kind[capital & ~opens] = NAME
    kind[unit] = UNIT
    kind[number] = NUMBER
    return kind


def templates(words: Words, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which words are placeholders and the hash that stands for each word: with
    names as placeholders, then with names as they are."""
    for literal in (kind == LITERAL, (kind == LITERAL) | (kind == NAME)):
        yield ~literal, np.where(literal, words.hash, mix(kind.astype(np.uint64)))


class Benchmark(NamedTuple):
    """A block of items: per width the sorted window hashes with item and place; per item its slots."""

    ids: np.ndarray
    length: np.ndarray  # template words of each item
    words: list[np.ndarray]  # hashes of each item's words
    slots: list[dict[int, int]]  # place -> hash of the value
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    overlap: int  # bytes that pieces of a long text share: more than any item takes


def prepare(ids: list[int | None], texts: list[str | None], width: int) -> Benchmark:
    length = np.zeros(len(texts), dtype=np.int64)
    slots: list[dict[int, int]] = [{} for _ in texts]
    own: list[list[np.ndarray]] = [[] for _ in texts]
    longest = max((len((t or "").encode("utf-8", "surrogatepass")) for t in texts), default=0)
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for words in scan(pa.array(texts, pa.string()), limit=max(1 << 20, longest), strip=True):
        kind = kinds(words)
        forms = list(templates(words, kind))
        cut = np.searchsorted(words.doc, np.arange(words.texts + 1))
        for i in range(words.texts):
            a, b = cut[i], cut[i + 1]
            item, n = words.first + i, b - a
            length[item] = n
            own[item].append(words.hash[a:b])
            slots[item] = {int(p): int(words.hash[a + p]) for p in np.flatnonzero(kind[a:b])}
            wide = min(int(n), width)
            if not wide:
                continue
            typed = np.zeros(n - wide + 1, dtype=bool)  # windows that a template takes
            for slot, hashes in forms if wide >= 4 else ():
                at, keys = windows_of(hashes[a:b], words.doc[a:b], wide)
                good = 2 * _inside(slot[a:b], at, wide) <= wide
                typed |= good
                found.setdefault(wide, []).append((keys[good], np.full(good.sum(), item), at[good]))
            at, keys = windows_of(words.hash[a:b], words.doc[a:b], wide)
            found.setdefault(wide, []).append((keys[~typed], np.full((~typed).sum(), item), at[~typed]))
    ready = {}
    for wide, parts in found.items():
        keys, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((at, item, keys))
        keys, item, at = keys[order], item[order], at[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1])
        ready[wide] = keys[new], item[new], at[new]
    none = np.zeros(0, np.uint64)
    return Benchmark(np.array(ids, dtype=object), length, [w[0] if w else none for w in own], slots, ready, 2 * longest + 1024)


def _inside(marked: np.ndarray, at: np.ndarray, wide: int) -> np.ndarray:
    """How many marked words lie in each window of ``wide`` words from ``at``."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[at + wide] - sums[at]


def _own_windows(words: Words, kind: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of the texts, in either template and word for word; once where they agree."""
    (_, typed), (_, named) = templates(words, kind)
    at, keys = windows_of(typed, words.doc, wide)
    names, values = _inside(kind == NAME, at, wide) > 0, _inside((kind == NUMBER) | (kind == UNIT), at, wide) > 0
    out = [(at, keys)]
    for hashes, there in ((named, names), (words.hash, values)):
        if there.any():
            out.append((at[there], windows_of(hashes, words.doc, wide)[1][there]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Match(NamedTuple):
    doc: int
    item: int
    matched: int
    changed: int


class Limits(NamedTuple):
    """What makes a leak: see :func:`leaks`."""

    width: int
    long_run: int
    share: float
    torn: bool


def matches(column: pa.Array, bench: Benchmark, limits: Limits) -> Iterator[Match]:
    """Leaks in a column of texts, in order of document and item."""
    begun: dict[int, tuple[int, int]] = {}  # best matches in the earlier pieces of a long text
    for words in scan(column, limit=max(1 << 20, 4 * bench.overlap), strip=True, overlap=bench.overlap):
        best = _best(words, bench, limits)
        if not words.opens:
            for i, found in begun.items():
                best[0, i] = max(best.get((0, i), found), found)
        begun = {} if words.ends else {i: found for (_, i), found in best.items()}
        for (d, i), (n, changed) in sorted(best.items()) if words.ends else ():
            yield Match(words.first + d, i, n, -changed)


def _best(words: Words, bench: Benchmark, limits: Limits) -> dict[tuple[int, int], tuple[int, int]]:
    """By text and item the most words that match, and minus the slots that differ."""
    kind = kinds(words)
    hits: list[tuple[np.ndarray, ...]] = []
    for wide, (keys, items, places) in bench.windows.items():
        at, own = _own_windows(words, kind, wide)
        lo = np.searchsorted(keys, own)
        there = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == own) if len(keys) else np.zeros(0, np.int64)
        if not len(there):
            continue
        lo = lo[there]
        n = np.searchsorted(keys, own[there], side="right") - lo
        each = np.repeat(np.arange(len(there)), n)
        pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = at[there][each]
        hits.append((words.doc[start], items[pick], start - places[pick], start, np.full(len(start), wide)))
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if not hits:
        return best
    doc, item, shift, start, wide = (np.concatenate(x) for x in zip(*hits, strict=True))
    order = np.lexsort((start, shift, item, doc))
    doc, item, shift, start, wide = (x[order] for x in (doc, item, shift, start, wide))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (shift[1:] != shift[:-1])
    heads = np.flatnonzero(new)
    runs = []  # text, item, first place, shift, covered places
    for a, b in zip(heads, [*heads[1:], len(doc)], strict=True):
        covered = np.unique((start[a:b, None] + np.arange(wide[a])).ravel())
        runs.append((int(doc[a]), int(item[a]), int(covered[0]), int(shift[a]), covered))
    for d, i, covered, place in _chains(runs) if limits.torn else ((d, i, c, c - s) for d, i, _, s, c in runs):
        need = int(min(limits.long_run, np.ceil(limits.share * bench.length[i])))
        if len(covered) < need:
            continue
        found = [_consistent(covered, place, bench.slots[i], words.hash)]
        if limits.torn and found[0] is None:
            found = _parts(covered, place, bench.slots[i], words.hash)
            literal = _literal(covered, place, bench.words[i], words.hash)
            found = [x for x in found if x[0] >= need] + ([(literal, 0)] if literal >= limits.long_run else [])
        for x in found:
            if x is not None:
                best[d, i] = max(best.get((d, i), x), x)
    return best


def _chains(runs: list[tuple], slip: int = 2) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Alignments joined where up to ``slip`` words were put in or left out: text, item, places in text and item."""
    chain: tuple | None = None
    for d, i, _, shift, covered in sorted(runs, key=lambda r: r[:3]):
        place = covered - shift
        if chain is not None and chain[:2] == (d, i) and abs(shift - chain[4]) <= slip:
            after = (covered > chain[2][-1]) & (place > chain[3][-1])
            if after.any() and covered[after][0] <= chain[2][-1] + slip + 1:
                chain = d, i, np.concatenate([chain[2], covered[after]]), np.concatenate([chain[3], place[after]]), shift
                continue
        if chain is not None:
            yield chain[:4]
        chain = d, i, covered, place, shift
    if chain is not None:
        yield chain[:4]


def _consistent(covered: np.ndarray, place: np.ndarray, slots: dict[int, int], hashes: np.ndarray) -> tuple[int, int] | None:
    """Words, and minus the slots whose value differs; None if a value of the item became two."""
    parts = _parts(covered, place, slots, hashes) if slots else [(len(covered), 0)]
    return parts[0] if len(parts) == 1 else None


def _parts(covered: np.ndarray, place: np.ndarray, slots: dict[int, int], hashes: np.ndarray) -> list[tuple[int, int]]:
    """The alignment cut before each slot that contradicts those since the last cut: words and minus changed slots."""
    there: dict[int, int] = {}
    out, size, changed = [], 0, 0
    for c, p in zip(covered.tolist(), place.tolist(), strict=True):
        value = slots.get(p)
        if value is not None:
            own = int(hashes[c])
            if there.setdefault(value, own) != own:
                out.append((size, -changed))
                there, size, changed = {value: own}, 0, 0
            changed += own != value
        size += 1
    return [*out, (size, -changed)]


def _literal(covered: np.ndarray, place: np.ndarray, item: np.ndarray, hashes: np.ndarray) -> int:
    """The longest run of words that are the item's own, without a gap."""
    same = hashes[covered] == item[place]
    joined = np.zeros(len(covered), dtype=bool)
    joined[1:] = same[1:] & same[:-1] & (np.diff(covered) == 1) & (np.diff(place) == 1)
    size = best = 0
    for s, j in zip(same.tolist(), joined.tolist(), strict=True):
        size = size + 1 if j else int(s)
        best = max(best, size)
    return best


def blocks(benchmark: DataFrame, block_rows: int, width: int, block_bytes: int = 32 << 20) -> Iterator[Benchmark]:
    """The benchmark in blocks of about ``block_rows`` items or ``block_bytes`` of text, each small enough to send to every task."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    n, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).collect()[0]
    parts = max(1, -(-n // block_rows), -(-(size or 0) // block_bytes))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        yield prepare([r["item_id"] for r in rows], [r["text"] for r in rows], width)


def leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = 8, long_run: int = 13, share: float = 0.5, block_rows: int = 50_000, torn: bool = False
) -> DataFrame:
    """doc_id, item_id, n_matched, n_item, n_changed of every leak: a row per document and item.

    A leak covers at least ``long_run`` template words of an item or ``share``
    of it, on one alignment, with consistent slots; n_changed slots have
    another value. With ``torn``, alignments are joined over one or two words
    put in or left out, an alignment on which one value of the item became two
    is cut there and each part counts by itself, and so does any run of
    ``long_run`` words that are the item's own; without, such an alignment is
    no leak. Each document is read once per block of the benchmark; a long text
    is read in pieces that overlap by more than any item.
    Null and empty texts leak nothing. Items of fewer than four words and
    windows that are mostly numbers and units are matched word for word; an item
    of one word is in every document that has the word. Repeated documents
    repeat their rows. Without a benchmark there are no rows.
    """
    limits = Limits(width, long_run, share, torn)

    def find(bench: Benchmark):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = list(matches(batch.column(1), bench, limits))
                rows = pa.array([m.doc for m in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        pa.array([bench.ids[m.item] for m in got], pa.int64()),
                        pa.array([m.matched for m in got], pa.int64()),
                        pa.array([int(bench.length[m.item]) for m in got], pa.int64()),
                        pa.array([m.changed for m in got], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "n_matched", "n_item", "n_changed"],
                )

        return run

    out = None
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for bench in blocks(benchmark, block_rows, width):
        part = own.mapInArrow(find(bench), "doc_id long, item_id long, n_matched long, n_item long, n_changed long")
        out = part if out is None else out.unionAll(part)
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, width: int = 8, long_run: int = 13, share: float = 0.5, block_rows: int = 50_000, torn: bool = False
) -> DataFrame:
    """``docs`` without the rows that :func:`leaks` reports; columns stay as they are.

    Null and empty texts stay, and so does everything without a benchmark;
    repeated rows stay or go together.
    """
    limits = Limits(width, long_run, share, torn)

    def keep(bench: Benchmark):
        @F.arrow_udf("boolean")
        def good(texts: pa.Array) -> pa.Array:
            out = np.ones(len(texts), dtype=bool)
            out[[m.doc for m in matches(texts, bench, limits)]] = False
            return pa.array(out)

        return good

    for bench in blocks(benchmark, block_rows, width):
        docs = docs.where(keep(bench)("text"))
    return docs
