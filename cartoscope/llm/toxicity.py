"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

A bounded sample of labelled texts is the example set. Its vocabulary is every
word of the examples, without the punctuation at its ends; document frequencies
of that vocabulary are counted over the whole corpus. A word whose log odds
differ between the labels by z standard errors weighs 1 + z^2 times its TF-IDF;
no word is left out. The examples form a
block-max inverted index: a word's postings lie in blocks of examples, and each
word knows its largest weight in each block that has it. A query visits blocks
by falling upper bound and stops when no block can reach its k-th neighbour, so
the neighbours are exact. Words that no example has are in no product and do
not count in a text's length. Votes are weighted by similarity and by how common
the label is outside the sample, and shrink to the base rate; a logistic map,
fitted to the votes that each example gets from the others, makes them
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .langid import held_out
from .textscan import scan

BLOCK = 64
FIRST = 4  # blocks visited before bounds are compared


class Index(NamedTuple):
    words: np.ndarray  # sorted hashes of the vocabulary
    idf: np.ndarray  # times one plus z squared
    ids: np.ndarray  # doc_id of each example
    label: np.ndarray
    cells: np.ndarray  # cells (word, block) of word: cells[word] to cells[word + 1]
    block: np.ndarray
    most: np.ndarray  # largest weight in each cell
    start: np.ndarray  # postings of cell: start[cell] to start[cell + 1]
    example: np.ndarray
    weight: np.ndarray
    rate: float  # share of label 1 among all labelled rows to learn from
    odds: float  # weight of a label-1 vote against a label-0 vote
    slope: float = 1.0  # of the map from log odds of a vote to log odds of label 1
    shift: float = 0.0


def bags(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place, distinct word hashes and counts of each text."""
    begun = None  # of a text that comes in pieces
    for words in scan(column, strip=True):
        cut = np.searchsorted(words.doc, np.arange(words.texts + 1))
        for i in range(words.texts):
            found = np.unique(words.hash[cut[i] : cut[i + 1]], return_counts=True)
            if not (words.opens and words.ends):
                begun = _joined(begun, found) if begun else found
                if not words.ends:
                    continue
                found, begun = begun, None
            yield words.first + i, *found


def _joined(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of two lists of counts."""
    words, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return words, np.bincount(at, weights=np.concatenate([a[1], b[1]])).astype(np.int64)


def _vector(hashes: np.ndarray, counts: np.ndarray, words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the vocabulary and their weights, of length one."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    own = words[at] == hashes
    at, w = at[own], (1 + np.log(counts[own])) * idf[at[own]]
    norm = np.sqrt((w * w).sum())
    return (at, w / norm) if norm > 0 else (at[:0], w[:0])


def _sample_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(bags(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([h.view(np.int64) for _, h, _ in found], pa.list_(pa.int64())), pa.array([n for _, _, n in found], pa.list_(pa.int64()))],
            names=["doc_id", "toxic", "words", "counts"],
        )


def vocabulary(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Every word of the examples, and by how many standard errors its log odds differ between the labels."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    words, at = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
    label = np.repeat([r[1] for r in rows], [len(r[0]) for r in rows])
    ones, every = np.bincount(at, weights=label, minlength=len(words)), np.bincount(at, minlength=len(words))
    total = np.array([len(rows), sum(r[1] for r in rows)], dtype=np.float64)
    a, b = ones + 0.5, every - ones + 0.5
    z = (np.log(a / (total[1] + 1)) - np.log(b / (total[0] - total[1] + 1))) / np.sqrt(1 / a + 1 / b)
    return words, np.abs(z)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of ``size``, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def build(rows: list[tuple], words: np.ndarray, idf: np.ndarray, rate: float, odds: float) -> Index:
    """rows: doc_id, label, hashes, counts of the examples."""
    vectors = [_vector(r[2], r[3], words, idf) for r in rows]
    lead = [(r[1], int(p[np.argmax(w)]) if len(p) else -1, r[0]) for r, (p, w) in zip(rows, vectors, strict=True)]
    order = sorted(range(len(rows)), key=lead.__getitem__)
    blocks = max(1, -(-len(rows) // BLOCK))
    sizes = [len(vectors[i][0]) for i in order]
    example = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    word = np.concatenate([vectors[i][0] for i in order]) if order else np.zeros(0, np.int64)
    weight = np.concatenate([vectors[i][1] for i in order]) if order else np.zeros(0)
    by = np.lexsort((example, word))
    example, word, weight = example[by], word[by], weight[by]
    slots, start = np.unique(word * blocks + example // BLOCK, return_index=True)
    most = np.maximum.reduceat(weight, start) if len(start) else np.zeros(0)
    cells = np.searchsorted(slots, np.arange(len(words) + 1) * blocks)
    return Index(
        words, idf, np.array([rows[i][0] for i in order], dtype=np.int64), np.array([rows[i][1] for i in order], dtype=np.int64),
        cells, slots % blocks, most, np.append(start, len(word)), example, weight, rate, odds,
    )


def _cosines(index: Index, start: np.ndarray, end: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over runs of postings, by example."""
    pick = _ranges(start, end - start)
    return np.bincount(index.example[pick], weights=index.weight[pick] * np.repeat(w, end - start))


def nearest(index: Index, at: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Examples with the k largest positive cosines, largest first (ties by place), and those.

    The blocks of largest bound come first; where the bounds leave many others,
    whole words are read, which is cheaper than their cells.
    """
    n = index.cells[at + 1] - index.cells[at]
    cell, by = _ranges(index.cells[at], n), np.repeat(w, n)
    block = index.block[cell]
    bound = np.bincount(block, weights=index.most[cell] * by)
    todo = np.zeros(len(bound), dtype=bool)
    todo[np.argsort(-bound, kind="stable")[:FIRST]] = True
    found, scores, left = np.zeros(0, np.int64), np.zeros(0), bound > 0
    while (todo & left).any():
        if 4 * np.count_nonzero(todo & left) > len(bound) > FIRST:
            cosine, found, scores = _cosines(index, index.start[index.cells[at]], index.start[index.cells[at + 1]], w), found[:0], scores[:0]
            left[:] = False
        else:
            own = cell[mine := np.flatnonzero((todo & left)[block])]
            cosine = _cosines(index, index.start[own], index.start[own + 1], by[mine])
            left &= ~todo
        there = np.flatnonzero(cosine > 0)
        found, scores = np.concatenate([found, there]), np.concatenate([scores, cosine[there]])
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= least], scores[scores >= least]
        todo = bound >= (scores.min() - 1e-12 if len(scores) >= k else 0)
    best = np.lexsort((found, -scores))[:k]
    return found[best], scores[best]


def vote(index: Index, found: np.ndarray, scores: np.ndarray, prior: float) -> float:
    for_it = index.odds * scores[index.label[found] == 1].sum()
    against = scores[index.label[found] == 0].sum()
    return float((for_it + prior * index.rate) / (for_it + against + prior))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibrated(index: Index, votes: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(index.slope * _log_odds(votes) + index.shift)))


def calibrate(index: Index, rows: list[tuple], k: int, prior: float, steps: int = 50) -> Index:
    """``index`` with the logistic map that fits the labels best, given each example's
    vote without itself; with few examples it stays near the identity."""
    votes = np.zeros(len(rows))
    for i, (d, _, hashes, counts) in enumerate(rows):
        found, cosine = nearest(index, *_vector(hashes, counts, index.words, index.idf), k + 1)
        others = index.ids[found] != d
        votes[i] = vote(index, found[others][:k], cosine[others][:k], prior)
    x, y = _log_odds(votes), np.array([r[1] for r in rows], dtype=np.float64)
    weight = np.where(y == 1, index.odds, 1.0)
    a, b = 1.0, 0.0
    for _ in range(steps if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-(a * x + b)))
        s = weight * p * (1 - p)
        slope = np.array([(weight * (y - p) * x).sum() - (a - 1), (weight * (y - p)).sum() - b])
        bend = np.array([[(s * x * x).sum() + 1, (s * x).sum()], [(s * x).sum(), s.sum() + 1]])
        step = np.linalg.solve(bend, slope)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return index._replace(slope=max(float(a), 0.0), shift=float(b))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000, folds: int = 4, k: int = 25, prior: float = 0.25) -> Index:
    """Index over a sample of the labelled rows that are not held out.

    ``fit_rows`` bounds the sample: about a quarter label 1 and three quarters
    label 0, by a hash of doc_id; if a label has fewer rows, all of them. Of
    contradicting labels the larger counts; null labels count for nothing.
    Frequencies of the sample's words are counted over all of ``docs``. ``k`` and
    ``prior`` are those that :func:`score` is to use.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    own = own.where(~held_out(F.col("doc_id"), folds))
    sizes = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total, ones = sum(sizes.values()), sizes.get(1, 0)
    share = F.when(F.col("toxic") == 1, min(1.0, fit_rows / 4 / max(ones, 1))).otherwise(min(1.0, fit_rows * 3 / 4 / max(total - ones, 1)))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    chosen = own.where(draw < share).select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic"))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("doc_id", "text", "toxic")
    got = sample.mapInArrow(_sample_bags, "doc_id long, toxic int, words array<long>, counts array<long>").toArrow()
    rows = [
        (d, y, np.asarray(h, np.int64).view(np.uint64), np.asarray(n, np.int64))
        for d, y, h, n in zip(*(got.column(c).to_pylist() for c in ("doc_id", "toxic", "words", "counts")), strict=True)
    ]
    rows.sort(key=lambda r: (r[0], len(r[2])))
    words, z = vocabulary([(r[2], r[1]) for r in rows])
    shared = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, every = shared.value, 0
        seen = np.zeros(len(known) + 1, dtype=np.int64)
        for batch in batches:
            every += batch.num_rows
            begun = None  # words so far of a text that comes in pieces
            for w in scan(batch.column(0), strip=True) if len(known) else ():
                at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
                mine = known[at] == w.hash
                pairs = np.unique(w.doc[mine] * len(known) + at[mine])
                if not (w.opens and w.ends):
                    pairs = pairs if begun is None else np.union1d(begun, pairs)
                    begun = None if w.ends else pairs
                    if not w.ends:
                        continue
                hit, n = np.unique(pairs % len(known), return_counts=True)
                seen[hit] += n
        seen[-1] = every
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(seen[there])], names=["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(words) + 1)
    df[counts.column("word").to_numpy()] = counts.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) * (1 + z * z)
    rate = ones / total if total else 0.0
    in_sample = sum(r[1] == 1 for r in rows)
    odds = (rate / (1 - rate)) * (len(rows) - in_sample) / in_sample if 0 < in_sample < len(rows) and 0 < rate < 1 else 1.0
    return calibrate(build(rows, words, idf, rate, odds), rows, k, prior)


def score(docs: DataFrame, index: Index, k: int = 25, prior: float = 0.25, evidence: int = 5) -> DataFrame:
    """doc_id, score and evidence (doc_ids of the nearest examples) of each row.

    Null and empty texts, and texts that share no word with an example, have no
    neighbour: their vote is the base rate. Without labelled rows it is 0. Null
    and repeated doc_ids are kept; ties between neighbours go by their place.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*shared.value)
        for batch in batches:
            scores, near = np.zeros(batch.num_rows), [None] * batch.num_rows
            for i, hashes, counts in bags(batch.column(1)):
                found, cosine = nearest(own, *_vector(hashes, counts, own.words, own.idf), k)
                scores[i], near[i] = vote(own, found, cosine, prior), own.ids[found[:evidence]]
            scores = calibrated(own, scores)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(near, pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, evidence array<long>")
