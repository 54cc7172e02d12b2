"""Language identification by rank-order n-gram profiles (out-of-place distance).

A profile is the list of a language's most frequent character n-grams in order
of frequency. A document gets a profile of its own, and its distance to a
language is the sum over its n-grams of how far each is out of place; an n-gram
that the language's profile lacks costs the full profile length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
BLANK = 1  # not 0: a blank in front must make another key
_TABLE: list[np.ndarray] = []


def _letter_codes() -> np.ndarray:
    """Code of each code point: itself for letters (16 bits), ``BLANK`` otherwise."""
    if not _TABLE:
        every = np.arange(0x110000, dtype=np.uint32)
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        codes = np.where(letters, (every & 0xFFFF) ^ (every >> 16), BLANK).astype(np.uint64)
        codes[letters & (codes <= BLANK)] = BLANK + 1
        _TABLE.append(codes)
    return _TABLE[0]


def pieces(text: str, size: int = 1 << 18) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at blanks: no n-gram crosses one."""
    a = 0
    while a < len(text):
        b = a + size
        while b < len(text) and not text[b].isspace():
            b += 1
        yield text[a:b]
        a = b


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a text's n-grams and their counts; a long text is counted piece by piece."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for piece in pieces(text):
        own, n = np.unique(gram_keys(piece), return_counts=True)
        if len(grams):
            own, at = np.unique(np.concatenate([grams, own]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([counts, n])).astype(np.int64)
        grams, counts = own, n
    return grams, counts


def gram_keys(text: str) -> np.ndarray:
    """Keys of all n-grams of a lower-cased text. Words are runs of letters with
    one blank on either side; a blank may only be an n-gram's first or last."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _letter_codes()[points]
    solid = codes != BLANK
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    keep[0] = True
    codes, solid = codes[keep], solid[keep]
    out, key = [codes[solid]], codes
    inner = np.ones(len(codes), dtype=bool)
    for n in ORDERS[1:]:
        if len(codes) < n:
            break
        key = (key[:-1] << np.uint64(16)) | codes[n - 1 :]
        if n > 2:
            inner = inner[:-1] & solid[n - 2 : len(codes) - 1]
        else:
            inner = solid[:-1] | solid[1:]
        out.append(key[inner])
    return np.concatenate(out)


def ranked(keys: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` most frequent keys, most frequent first, ties by key."""
    return most_frequent(*np.unique(keys, return_counts=True), length)


def most_frequent(grams: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    if len(grams) > length:
        least = -np.partition(-counts, length - 1)[length - 1]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")][:length]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            found = [gram_counts(t.as_py()) for t, x in zip(texts, langs, strict=True) if x == lang]
            grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"]
            )


def fit_profiles(docs: DataFrame, length: int = 400, fit_rows: int = 4000) -> dict[str, list[int]]:
    """Profiles of the languages in ``docs`` (columns doc_id, text, lang; no nulls).

    ``fit_rows`` bounds the rows fitted on: about that many per language, taken
    by a hash of doc_id; a language with fewer rows is used whole. That bound also
    bounds the n-grams ranked per language. The driver gets one count per
    language and ``length`` n-grams per language.
    """
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, fit_rows / n)))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id")), F.lit(1 << 30)) / (1 << 30)
    sample = docs.where(draw < F.element_at(share, F.col("lang"))).select("text", "lang")
    counts = sample.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= length).orderBy("lang", "place")
    best: dict[str, list[int]] = {}
    for r in top.collect():
        best.setdefault(r["lang"], []).append(r["gram"])
    return best


class Ranker:
    """Out-of-place distances of texts to every profile."""

    def __init__(self, profiles: dict[str, list[int]], length: int):
        self.length, self.langs = length, list(profiles)
        every = np.unique(np.concatenate([np.asarray(p, np.int64).view(np.uint64) for p in profiles.values()]))
        self.keys = every
        self.ranks = np.full((len(every) + 1, len(self.langs)), -1, dtype=np.int32)
        for j, p in enumerate(profiles.values()):
            self.ranks[np.searchsorted(every, np.asarray(p, np.int64).view(np.uint64)), j] = np.arange(len(p))

    def distances(self, text: str) -> tuple[np.ndarray, int]:
        own = most_frequent(*gram_counts(text), self.length)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at = np.where(self.keys[at] == own, at, len(self.keys))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.length, np.abs(ranks - np.arange(len(own))[:, None]))
        return apart.sum(axis=0), len(own) * self.length

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language, and how much of the greatest distance is left."""
        if not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        apart, most = self.distances(text)
        if not most:
            return UNKNOWN, 0.0
        best = int(np.argmin(apart))
        return self.langs[best], float(1 - apart[best] / most)


def identify(docs: DataFrame, profiles: dict[str, list[int]], length: int = 400) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; every other column stays as it is.

    Text that is null or has no letter: ``und`` and 0. Without profiles every
    text is ``und``. Ties go to the alphabetically first language. Columns of
    the input named lang_pred or score are replaced. An empty table gives an
    empty result; repeated rows are told alike.
    """
    docs = docs.drop("lang_pred", "score")
    if not profiles:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranker = Ranker(profiles, length)
        for batch in texts:
            found = [ranker.predict(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["lang_pred", "score"])

    told = docs.select(F.struct("*").alias("own"), predict("text").alias("told"))
    return told.select("own.*", "told.*")


def held_out(doc_id, folds: int, fold: int = 2):
    """Whether crc32 of the id as text falls in ``fold``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def learnable(docs: DataFrame, folds: int = 4) -> DataFrame:
    """Rows to learn languages from: text, lang and doc_id not null, not held out."""
    own = docs.select("doc_id", "text", "lang").dropna()
    return own.where(~held_out(F.col("doc_id"), folds))
