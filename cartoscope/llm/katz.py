"""Katz backoff scoring of whole texts.

The model is a bigram Katz model over all training words, text end and text
start: Good-Turing discounted counts of words and bigrams, and backoff weights
that make every context's probabilities, one unseen word included, sum to one.

Three passes over the text count words, count bigrams and score. Counts are
packed tables in the shared folder, in parts by hash. The ``head``, the most
frequent words and bigrams, goes to every task; that names frequent words by
short ids and answers for frequent bigrams, and changes no score. A bigram of two
head words lies in the part of its own key; any other lies in the part of each
rare word in it, beside that word's count, so a part can finish the recursion
for what it is asked. Asks travel packed and come back as one sum per text and part.

``share`` makes a smaller model: words under one in ``share`` training tokens
(or found once) form one class, and are spelled out by their own discounted counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .langid import held_out
from .packed import SCHEMA, Entries, batched, dealt, entries, gathered, of_rows, pack, part_of, rounded, rows_of, summed, unpacked
from .storage import store
from .textscan import Words, mix, scan

START, END, OTHER, FIRST = 0, 1, 2, 3  # OTHER: the unseen word, or the class of rare words
TOP = 5  # counts above are not discounted
FLUSH = 1 << 20
NAMED = np.uint64(1 << 63)  # set in the names of words outside the head; ids are small
LOW = np.uint64((1 << 32) - 1)
STEPS = 8  # of a count's histogram, by factor of two
NONE = 1 << 30  # a step that no count is in

# Kinds of packed rows, in the order in which a part reads them.
WORD, HEAD, SECOND, LEFT, BELOW, SHARE, ASK_HEAD, ASK_SECOND, ASK_LEFT, OWN, SUMS = range(11)
_VALUES = {WORD: "q", HEAD: "q", SECOND: "q", LEFT: "q", BELOW: "d", SHARE: "d", ASK_HEAD: "qq", ASK_SECOND: "qq", ASK_LEFT: "qq", OWN: "qqq", SUMS: "qdd"}
_TEXT_BITS, _TEXT, _TASK_BITS = np.uint64(18), np.uint64((1 << 18) - 1), 22


class Head(NamedTuple):
    """What every task knows; ids are places in ``words`` plus ``FIRST``."""

    words: np.ndarray  # sorted names of the head
    seen: np.ndarray  # log10(count + 1) by id, for the base score
    unigram: np.ndarray  # log10 P(id)
    tail: np.ndarray  # log10 P of a word outside the head: by count to TOP, 0 being unseen
    scale: float  # log10 (P / count) of words counted more often than that
    classed: bool  # words outside the head are one class, and tail is P(word | class)
    discount: np.ndarray  # of bigram counts to TOP; 1 above
    context: np.ndarray  # log10 of (scale / count) of context id
    backoff: np.ndarray  # log10 of the backoff weight of context id
    bigrams: np.ndarray  # sorted keys of the most frequent bigrams
    bigram_log: np.ndarray  # log10 P of those


class Layout(NamedTuple):
    parts: int
    answers: int  # parts of the replies
    lanes: int


def _cut(discount: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return np.where(n <= TOP, discount[np.minimum(n, TOP)], 1.0) * n


def _discounts(times: dict[int, int]) -> np.ndarray:
    """Katz's Good-Turing discounts d_1 .. d_TOP from counts of counts; absolute
    discounting by a half where these are no proper fractions."""
    n = [0, *(times.get(r, 0) for r in range(1, TOP + 2))]
    d = np.ones(TOP + 1)
    cut = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    for r in range(1, TOP + 1):
        good = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 0.0
        d[r] = good if 0 < good < 1 else (r - 0.5) / r
    return d


def _step(n: Column) -> Column:
    return F.floor(F.log2(n) * STEPS)


def _least_step(histogram: list[tuple[int, int]], most: int) -> int:
    """Lowest step of counts such that it and those above hold ``most`` entries or fewer."""
    least, held = NONE, 0
    for step, n in sorted(histogram, reverse=True):
        held += n
        if held > most:
            break
        least = step
    return least


# Counting


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(held: list[Entries]) -> Iterator[pa.RecordBatch]:
        key, _, n = summed(held)
        for a in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(key[a : a + (1 << 16)].view(np.int64)), pa.array(n[a : a + (1 << 16)])], names=["key", "n"])

    held, size = [], 0
    for batch in batches:
        for words in scan(batch.column(0)):
            if len(words.hash):
                key, n = np.unique(words.hash | NAMED, return_counts=True)
                held.append((key, np.zeros(len(key), np.uint64), n))
                size += len(key)
            if size > 2 * FLUSH:
                held = [summed(held)]
                size = len(held[0][0])
                if size > FLUSH:
                    yield from rows(held)
                    held, size = [], 0
    if held:
        yield from rows(held)


def _names(words: Words, known: np.ndarray, classed: bool) -> np.ndarray:
    """Ids of head words; names of others, or their class."""
    name = words.hash | NAMED
    if not len(known):
        return np.full(len(name), OTHER, np.uint64) if classed else name
    at = np.minimum(np.searchsorted(known, name), len(known) - 1)
    return np.where(known[at] == name, (at + FIRST).astype(np.uint64), np.uint64(OTHER) if classed else name)


class _Sequence:
    """Bigrams of a column's texts, starts and ends included, across the pieces of a text."""

    def __init__(self):
        self.before = START

    def pairs(self, words: Words, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of every bigram, its text, and the place of the second among the words (-1: the end)."""
        n = np.bincount(words.doc, minlength=words.texts) + 1
        if not words.ends:
            n[-1] -= 1
        total = int(n.sum())
        last = np.cumsum(n)
        inside = np.ones(total, dtype=bool)
        inside[(last if words.ends else last[:-1]) - 1] = False
        second, place = np.full(total, END, np.uint64), np.full(total, -1)
        second[inside], place[inside] = names, np.arange(len(names))
        first = np.empty_like(second)
        first[1:] = second[:-1]
        begin = (last - n)[n > 0]
        first[begin] = START
        if not words.opens and total:
            first[0] = self.before
        if words.ends:
            self.before = START
        elif n[-1]:
            self.before = second[-1]
        elif words.texts > 1 or words.opens:
            self.before = START
        return first, second, np.repeat(np.arange(words.texts), n), place


def _split(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Kind, places, keys and others of the bigrams' entries."""
    a, b = first < NAMED, second < NAMED
    at = np.flatnonzero(a & b)
    yield HEAD, at, first[at] << np.uint64(32) | second[at], np.zeros(len(at), np.uint64)
    at = np.flatnonzero(~b)
    yield SECOND, at, second[at], first[at]
    at = np.flatnonzero(~a)
    yield LEFT, at, first[at], second[at]


def _count_bigrams(batches: Iterator[pa.RecordBatch], known: np.ndarray, classed: bool, layout: Layout) -> Iterator[dict]:
    held: dict[int, list[Entries]] = {HEAD: [], SECOND: [], LEFT: []}
    size, sequence = 0, _Sequence()
    for batch in batches:
        for words in scan(batch.column(0)):
            first, second, _, _ = sequence.pairs(words, _names(words, known, classed))
            for kind, at, key, other in _split(first, second):
                if len(at):
                    held[kind].append(summed([(key, other, np.ones(len(key), np.int64))]))
                    size += len(held[kind][-1][0])
            if size > 2 * FLUSH:
                held = {k: [summed(x)] if x else [] for k, x in held.items()}
                size = sum(len(y[0]) for x in held.values() for y in x)
                if size > 4 * FLUSH // 3:
                    yield from _packed(held, layout)
                    held, size = {k: [] for k in held}, 0
    yield from _packed(held, layout)


def _packed(held: dict[int, list[Entries]], layout: Layout) -> Iterator[dict]:
    for kind, found in held.items():
        if found:
            yield from pack(kind, summed(found), layout.parts, layout.lanes)


def _merge(batches: Iterator[pa.RecordBatch], head: Head, layout: Layout) -> Iterator[dict]:
    """Total counts of each part, and the shares of its words by the context that they follow."""

    def finish(part: int, kind: int, held: list[Entries], words: Entries | None) -> Iterator[dict]:
        total = summed(held)
        for r in pack(kind, total, 1, 1):
            yield r | {"part": part}
        if kind == SECOND and words is not None:
            key, other, _ = total
            below = np.power(10.0, _tail_log(words[2][np.searchsorted(words[0], key)], head))
            named = other >= NAMED
            for to, own in ((BELOW, named), (SHARE, ~named)):
                if own.any():
                    yield from pack(to, summed([(other[own], np.zeros(own.sum(), np.uint64), below[own])]), layout.parts, layout.lanes)

    held: list[Entries] = []
    size, last, words = 0, None, None
    for r in rows_of(batches):
        if held and (r["part"], r["kind"]) != last:
            yield from finish(*last, held, words)
            words = summed(held) if last[1] == WORD else words if r["part"] == last[0] else None
            held, size = [], 0
        last = r["part"], r["kind"]
        held.append(entries(r, _VALUES[r["kind"]]))
        size += r["size"]
        if size > 2 * FLUSH:
            held = [summed(held)]
            size = len(held[0][0])
    if held:
        yield from finish(*last, held, words)


def _tail_log(n: np.ndarray, head: Head) -> np.ndarray:
    """log10 P of words outside the head by their counts."""
    return np.where(n <= TOP, head.tail[np.minimum(n, TOP)], np.log10(np.maximum(n, 1)) + head.scale)


# Fitting


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many bigrams have each count to TOP + 1, and how many head bigrams are in each step of counts."""
    times, steps = np.zeros(TOP + 2, np.int64), np.zeros(64 * STEPS, np.int64)
    for r in rows_of(batches):
        _, other, n = entries(r, "q")
        if r["kind"] == HEAD:
            steps += np.bincount((np.log2(n) * STEPS).astype(np.int64), minlength=len(steps))
        if r["kind"] == LEFT:
            n = n[other < NAMED]  # the others are counted with their second word
        times += np.bincount(n[n <= TOP + 1], minlength=len(times))
    at, to = np.flatnonzero(times), np.flatnonzero(steps)
    yield pa.RecordBatch.from_arrays([pa.array([True] * len(at) + [False] * len(to)), pa.array(np.concatenate([at, to])), pa.array(np.concatenate([times[at], steps[to]]))], names=["times", "r", "n"])


def _contexts(batches: Iterator[pa.RecordBatch], head: Head) -> Iterator[pa.RecordBatch]:
    """Discounted counts, and shares of the words that were seen, by head context."""
    kept, below = np.zeros(len(head.unigram)), np.zeros(len(head.unigram))
    p1 = np.power(10.0, head.unigram)
    for r in rows_of(batches):
        key, other, n = entries(r, _VALUES[r["kind"]])
        if r["kind"] == HEAD:
            h = (key >> np.uint64(32)).astype(np.int64)
            below += np.bincount(h, weights=p1[(key & LOW).astype(np.int64)], minlength=len(below))
            kept += np.bincount(h, weights=_cut(head.discount, n), minlength=len(kept))
        elif r["kind"] == SECOND:
            own = other < NAMED
            kept += np.bincount(other[own].astype(np.int64), weights=_cut(head.discount, n[own]), minlength=len(kept))
        else:
            below += np.bincount(key.astype(np.int64), weights=n, minlength=len(below))
    at = np.flatnonzero(kept + below)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(kept[at]), pa.array(below[at])], names=["h", "kept", "below"])


def _weights(n: np.ndarray, kept: np.ndarray, below: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 of (scale / n) and of the backoff weight of contexts seen n times.

    kept: sum of the discounted counts; at least one in n + 1 of the mass goes
    to unseen words. A context that all words followed (below is one, to half
    a ``unit``) backs off to nothing and is not discounted.
    """
    full = below > 1 - unit / 2
    used = kept / n
    mass = np.where(full, 1.0, np.minimum(used, n / (n + 1.0)))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log10(mass / used / n), np.where(full, 0.0, np.log10((1 - mass) / (1 - below)))


class Model(NamedTuple):
    head: Head
    table: DataFrame  # packed counts by part
    layout: Layout
    tokens: int
    kinds: int


def fit(train: DataFrame, share: int | None = None, part_entries: int = 2_000_000, head_words: int = 500_000, head_bigrams: int = 500_000, lanes: int = 1024) -> Model:
    """Model of the texts in ``train``. The driver gets the head, and counts of counts."""
    texts = train.select("text")
    spark = train.sparkSession
    words = store(texts.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "katz-words")
    docs = texts.count()
    row = words.agg(F.sum("n"), F.count("*")).collect()[0]
    tokens, kinds = (row[0] or 0) + docs, row[1] + (docs > 0)
    layout = Layout(rounded(tokens // part_entries, lanes), rounded(tokens // (4 * part_entries), lanes), lanes)
    if share:
        frequent = F.col("n") >= max(2, -(-tokens // share))
    else:
        frequent = _step(F.col("n")) >= _least_step([tuple(r) for r in words.groupBy(_step(F.col("n"))).count().collect()], head_words)
    top = words.where(frequent).toArrow()
    names = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(names)
    names, counts = names[order], top.column("n").to_numpy()[order]
    head = _unigrams(names, counts, tokens, docs, _times(words), words.where(~frequent) if share else None)
    shared = spark.sparkContext.broadcast(tuple(head))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Head(*shared.value)
        yield from batched(_count_bigrams(batches, own.words, own.classed, layout))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_merge(batches, Head(*shared.value), layout))

    counted = texts.mapInArrow(count, SCHEMA).unionAll(of_rows(words.where(~frequent), WORD, layout.parts, lanes))
    merged = gathered(dealt(counted, layout.parts, lanes, _VALUES)).mapInArrow(merge, SCHEMA)
    table = store(merged, "katz-table")
    found = table.where(F.col("kind").isin(HEAD, SECOND, LEFT)).mapInArrow(_statistics, "times boolean, r long, n long")
    found = found.groupBy("times", "r").agg(F.sum("n").alias("n")).collect()
    head = head._replace(discount=_discounts({r["r"]: r["n"] for r in found if r["times"]}))
    shared = spark.sparkContext.broadcast(tuple(head))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _contexts(batches, Head(*shared.value))

    sums = table.where(F.col("kind").isin(HEAD, SECOND, SHARE)).mapInArrow(contexts, "h long, kept double, below double")
    sums = sums.groupBy("h").agg(F.sum("kept").alias("kept"), F.sum("below").alias("below")).toArrow()
    h, kept, below = (sums.column(c).to_numpy() for c in ("h", "kept", "below"))
    n = np.concatenate([[docs, 1, tokens - docs - counts.sum()], counts]).astype(np.float64)[h]
    context, backoff = np.full(len(head.unigram), -np.inf), np.zeros(len(head.unigram))
    context[h], backoff[h] = _weights(n, kept, below, 10.0 ** np.min(head.unigram[END:], initial=0.0))
    least = _least_step([(r["r"], r["n"]) for r in found if not r["times"]], head_bigrams)
    most = math.ceil(2 ** (least / STEPS) - 1e-9) if least < NONE else 1 << 62
    often = unpacked(table.where(F.col("kind") == HEAD), "q", most).toArrow()
    keys, n = often.column("key").to_numpy().view(np.uint64), often.column("a").to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    log = np.log10(_cut(head.discount, n)) + context[(keys >> np.uint64(32)).astype(np.int64)]
    return Model(head._replace(context=context, backoff=backoff, bigrams=keys, bigram_log=log), table, layout, tokens, kinds)


def _times(counts: DataFrame) -> dict[int, int]:
    rows = counts.where(F.col("n") <= TOP + 1).groupBy("n").agg(F.count("*").alias("k")).collect()
    return {r["n"]: r["k"] for r in rows}


def _unigrams(names: np.ndarray, counts: np.ndarray, tokens: int, docs: int, times: dict[int, int], rare: DataFrame | None) -> Head:
    """A head without bigrams. rare: table of the words of the class, if there is one."""
    nothing = np.zeros(0)
    few = np.arange(TOP + 1)
    seen = np.log10(np.concatenate([[0, docs, 0], counts]) + 1.0)
    if rare is not None:
        mass = tokens - docs - int(counts.sum())
        every = np.concatenate([[0, docs + 1, mass + 1], counts]).astype(np.float64)
        own = _discounts(times)
        lost = 1 + sum((1 - own[r]) * r * n for r, n in _times(rare).items() if r <= TOP)
        tail, scale, unigram = np.concatenate([[lost], _cut(own, few)[1:]]) / (mass + 1), -np.log10(mass + 1.0), every / every.sum()
    else:
        own = _discounts(times | {docs: times.get(docs, 0) + 1} if docs else times)
        ends = docs * (own[docs] if docs <= TOP else 1.0)
        used = (tokens - docs + ends - sum((1 - own[r]) * r * n for r, n in times.items() if r <= TOP)) / max(tokens, 1)
        kept = min(used, tokens / (tokens + 1))
        unit = kept / used / tokens if used else 0.0
        tail, scale = np.concatenate([[1 - kept], _cut(own, few)[1:] * unit]), np.log10(unit) if unit else 0.0
        unigram = np.concatenate([[0.0, ends * unit if docs else 1.0, 1 - kept], _cut(own, counts) * unit])
    with np.errstate(divide="ignore"):
        return Head(names, seen, np.log10(unigram), np.log10(tail), float(scale), rare is not None, np.ones(TOP + 1), nothing, nothing, nothing.astype(np.uint64), nothing)


# Scoring


def _look_up(batches: Iterator[pa.RecordBatch], head: Head, layout: Layout) -> Iterator[dict]:
    """What is known of each text, and what is asked of each part, by batches of about ``FLUSH`` open bigrams."""
    task, batch = TaskContext.get().partitionId() << _TASK_BITS, 0
    asks: dict[int, list[Entries]] = {HEAD: [], SECOND: [], LEFT: []}
    own: list[tuple[np.ndarray, ...]] = []
    count = size = 0
    sequence = _Sequence()

    def asked() -> Iterator[dict]:
        for kind, found in asks.items():
            if found:
                key, other, text, times = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((text, other, key)) if kind != HEAD else np.argsort(key, kind="stable")
                who = (np.uint64(task | batch) << _TEXT_BITS | text[order].astype(np.uint64)).view(np.int64)
                yield from pack(kind + ASK_HEAD - HEAD, (key[order], other[order], who, times[order]), layout.parts, layout.lanes)

    def told() -> Iterator[dict]:
        ids, there, texts, known, tokens, base, score = (np.concatenate(x) for x in zip(*own, strict=True))
        key, text = np.full(len(texts), task | batch, np.uint64), texts.astype(np.uint64)
        part = int(part_of(key[:1], layout.parts)[0]) % min(layout.parts, layout.lanes)
        for kind, values in ((SUMS, (known, base, score)), (OWN, (tokens, ids, there))):
            for r in pack(kind, summed([(key, text, *values)]), 1, 1):
                yield r | {"part": part}

    for rows in batches:
        doc_ids = rows.column(0)
        ids = doc_ids.fill_null(0).to_numpy()
        there = doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        for words in scan(rows.column(1)):
            names = _names(words, head.words, head.classed)
            first, second, doc, place = sequence.pairs(words, names)
            pair = np.where((first < NAMED) & (second < NAMED), first << np.uint64(32) | second, np.uint64(0))
            at = np.minimum(np.searchsorted(head.bigrams, pair), max(len(head.bigrams) - 1, 0))
            sure = head.bigrams[at] == pair if len(head.bigrams) else np.zeros(len(pair), bool)
            shift = count - (not words.opens)  # a further piece adds to the text before
            common = (second < NAMED) & (second != OTHER)
            total = lambda w, d, n=words.texts: np.bincount(d, weights=w, minlength=n)
            seen = head.seen[second[common].astype(np.int64)]
            a, b = words.first, words.first + words.texts
            fresh = np.ones(words.texts, np.int64)
            fresh[0] = int(words.opens)
            own.append((ids[a:b] * fresh, there[a:b] * fresh, np.arange(words.texts) + shift, total(seen > 0, doc[common]).astype(np.int64), np.bincount(doc, minlength=words.texts), total(seen, doc[common]), total(head.bigram_log[at[sure]], doc[sure])))
            open_ = np.flatnonzero(~sure)
            for kind, pick, key, other in _split(first[open_], second[open_]):
                if len(pick):
                    asks[kind].append(_per_text(key, other, doc[open_[pick]] + shift))
                    size += len(asks[kind][-1][0])
            rare = np.flatnonzero(second == OTHER) if head.classed else ()
            if len(rare):  # the word within its class
                asks[SECOND].append(_per_text(words.hash[place[rare]] | NAMED, second[rare], doc[rare] + shift))
                size += len(asks[SECOND][-1][0])
            count += words.texts - (not words.opens)
            full = size > FLUSH or count > 1 << 16
            if full:
                yield from asked()
                asks, size = {k: [] for k in asks}, 0
            if full and words.ends:
                yield from told()
                own, count, batch = [], 0, batch + 1
    yield from asked()
    if own:
        yield from told()


def _per_text(key: np.ndarray, other: np.ndarray, text: np.ndarray) -> Entries:
    """Distinct (key, other, text) with how often."""
    order = np.lexsort((key, text)) if not other.any() else np.lexsort((other, key, text))
    key, other, text = key[order], other[order], text[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return key[at], other[at], text[at], np.diff(at, append=len(key))


class _Part:
    """The counts of one part, and what follows from them for what is asked of it."""

    def __init__(self, head: Head):
        self.head, self.held = head, {k: [] for k in (WORD, HEAD, SECOND, LEFT, BELOW)}
        self.ready = False

    def add(self, kind: int, found: Entries) -> None:
        self.held[kind].append(found)

    def close(self) -> None:
        nothing = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        total = {k: summed(x) if x else nothing for k, x in self.held.items()}
        self.held, self.ready = {}, True
        self.words, self.word_n = total[WORD][0], total[WORD][2]
        self.keys, self.counts = {HEAD: total[HEAD][0]}, {HEAD: total[HEAD][2]}
        for kind in (SECOND, LEFT):
            both = _both(*total[kind][:2])
            order = np.argsort(both)
            self.keys[kind], self.counts[kind] = both[order], total[kind][2][order]
        key, other, n = total[LEFT]
        at = np.flatnonzero(np.diff(key, prepend=np.uint64(0)) != 0)
        self.contexts = key[at]
        if len(at):
            head = self.head
            times = self.word_n[np.searchsorted(self.words, self.contexts)].astype(np.float64)
            kept = np.add.reduceat(_cut(head.discount, n), at)
            own = other < NAMED
            p1 = np.where(own, np.power(10.0, head.unigram[np.where(own, other, np.uint64(END)).astype(np.int64)]), 0.0)
            below = np.add.reduceat(p1, at)
            rare, _, sums = total[BELOW]
            to = np.minimum(np.searchsorted(rare, self.contexts), max(len(rare) - 1, 0))
            below = below + (np.where(rare[to] == self.contexts, sums[to], 0.0) if len(rare) else 0.0)
            self.scale, self.backoff = _weights(times, kept, below, 0.0)

    def _count(self, kind: int, key: np.ndarray) -> np.ndarray:
        return _found(self.keys[kind], self.counts[kind], key)

    def answer(self, kind: int, key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the word is known, its base score and what it adds to the score, once each."""
        head, none = self.head, np.zeros(len(key))
        n = self._count(HEAD, key) if kind == HEAD else self._count(kind, _both(key, other))
        log = np.log10(_cut(head.discount, np.maximum(n, 1)))
        named = other >= NAMED
        id_ = np.where(named, np.uint64(END), other).astype(np.int64)
        if kind == HEAD:
            h, w = (key >> np.uint64(32)).astype(np.int64), (key & LOW).astype(np.int64)
            return none, none, np.where(n > 0, log + head.context[h], head.backoff[h] + head.unigram[w])
        if kind == SECOND:
            c = _found(self.words, self.word_n, key)
            own = _tail_log(c, head)
            if not head.classed:
                own = np.where(n > 0, np.where(named, 0.0, log + head.context[id_]), own + np.where(named, 0.0, head.backoff[id_]))
            return (c > 0).astype(np.float64), np.log10(c + 1.0), own
        if not len(self.contexts):
            return none, none, np.where(named, 0.0, head.unigram[id_])
        at = np.minimum(np.searchsorted(self.contexts, key), len(self.contexts) - 1)
        there = self.contexts[at] == key
        less = np.where(there, self.backoff[at], 0.0) + np.where(named, 0.0, head.unigram[id_])
        return none, none, np.where(n > 0, log + self.scale[at], less)


def _both(key: np.ndarray, other: np.ndarray) -> np.ndarray:
    return mix(mix(key) + other)


def _found(keys: np.ndarray, values: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(key), np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at], 0)


def _answers(batches: Iterator[pa.RecordBatch], head: Head, layout: Layout) -> Iterator[dict]:
    """Sums by text of what each part knows; what is known already passes on. A part's counts are read before its asks."""
    part, held, replies, size = None, None, [], 0

    def replied() -> Iterator[dict]:
        if replies:
            yield from pack(SUMS, summed(replies), layout.answers, layout.lanes)

    for r in rows_of(batches):
        if r["part"] != part:
            yield from replied()
            part, held, replies, size = r["part"], _Part(head), [], 0
        kind, found = r["kind"], entries(r, _VALUES[r["kind"]])
        if kind >= OWN:
            yield from pack(kind, found, layout.answers, layout.lanes)
        elif kind <= BELOW:
            held.add(kind, found)
        else:
            if not held.ready:
                held.close()
            key, other, who, times = found
            known, base, score = held.answer(kind - ASK_HEAD + HEAD, key, other)
            who = who.view(np.uint64)
            replies.append(summed([(who >> _TEXT_BITS, who & _TEXT, (known * times).astype(np.int64), base * times, score * times)]))
            size += len(replies[-1][0])
            if size > FLUSH:
                yield from replied()
                replies, size = [], 0
    yield from replied()


_SCORED = "doc_id long, n_tokens long, n_known long, base double, score double"


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a part of the replies with all their sums."""

    def rows(held: dict[int, list[Entries]]) -> pa.RecordBatch:
        (_, _, tokens, ids, there), (_, _, known, base, score) = summed(held[OWN]), summed(held[SUMS])
        return pa.RecordBatch.from_arrays([pa.array(ids, mask=there == 0), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "base", "score"])

    part, held = None, {}
    for r in rows_of(batches):
        if r["part"] != part:
            if held:
                yield rows(held)
            part, held = r["part"], {OWN: [], SUMS: []}
        held[r["kind"]].append(entries(r, _VALUES[r["kind"]]))
        if len(held[SUMS]) > 64:
            held[SUMS] = [summed(held[SUMS])]
    if held:
        yield rows(held)


def score(docs: DataFrame, train: DataFrame, share: int | None = None, part_entries: int = 2_000_000, **sizes: int) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    Null and empty texts are one end token. A null or repeated doc_id is kept;
    every row is scored by itself. Without training rows every word is unseen.
    ``part_entries`` bounds the training tokens, hence the counts, of a part;
    ``sizes`` (head_words, head_bigrams, lanes: see :func:`fit`) change no score.
    """
    model = fit(train, share, part_entries, **sizes)
    layout = model.layout
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model.head))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_look_up(batches, Head(*shared.value), layout))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_answers(batches, Head(*shared.value), layout))

    asks = dealt(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look_up, SCHEMA), layout.parts, layout.lanes, _VALUES)
    own = model.table.where(F.col("kind") <= LEFT)
    below = dealt(model.table.where(F.col("kind") == BELOW), layout.parts, layout.lanes, _VALUES)
    replies = gathered(asks.unionAll(own).unionAll(below)).mapInArrow(answer, SCHEMA)
    scored = gathered(dealt(replies, layout.answers, layout.lanes, _VALUES)).mapInArrow(_totals, _SCORED)
    size = float(np.log10(model.tokens + model.kinds + 1.0))
    return scored.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * size).alias("base_score"),
        "score",
    )


def score_held_out(docs: DataFrame, folds: int = 7) -> DataFrame:
    """All ``docs`` scored by a model of those that are not held out; with held_out.

    Null doc_ids are not held out. Nulls, ties, repeated rows and an empty table are as in :func:`score`.
    """
    own = docs.select("doc_id", "text")
    out = held_out(F.col("doc_id"), folds)
    return score(own, own.where(~out)).withColumn("held_out", out)
