"""SimHash near-duplicates found with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a
23-bit vector of the perfect (23, 12) Golay code. The fuzzy indices of a
segment are the codewords nearest to the vector and to its 23 neighbours: one
or six of them. Two vectors at distance 2 or less have a vector within one bit
of both, hence share an index. If two fingerprints differ in at most two bits,
some segment is equal (pigeonhole: two errors, three segments) and any other
segment has at most two errors, so (equal segment, index of the next segment)
is a key that both fingerprints have. Keys are joined and pairs verified.

Buckets with more than ``dense`` fingerprints are not paired: their members
take the exact star form, where fingerprints meet at the vectors within one bit
of both; everything that meets at one vector is linked to the least of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .storage import forget, store

SEED = 42
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
GOLAY_POLYNOMIAL = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_GOLAY: list[np.ndarray] = []


def _pieces(data: bytes, size: int = 1 << 18) -> Iterator[list[bytes]]:
    """Lower-cased words of about ``size`` bytes at a time."""
    a = 0
    while a < len(data):
        cut = _BLANK.search(data, a + size)
        b = cut.end() if cut else len(data)
        yield data[a:b].lower().split()
        a = b


def fingerprint(text: str | None) -> int:
    """Bitwise majority of XXH64 over the 3-word shingles; 0 without words. A long text is read in pieces."""
    digest = xxhash.xxh64_digest
    ones, n, words = np.zeros(64, dtype=np.int64), 0, []
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass")):
        words = words[-2:] + piece
        hashed = b"".join([digest(s, SEED) for s in map(b" ".join, zip(words, words[1:], words[2:], strict=False))])
        ones += np.unpackbits(np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashed) // 8
    if not n and words:
        ones, n = np.unpackbits(np.frombuffer(digest(b" ".join(words), SEED), dtype=np.uint8)).astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big") if n else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *others, texts = batch.columns
        found = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*others, pa.array(found.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])


def golay_table() -> np.ndarray:
    """Index (12 bits) of the codeword nearest to every 23-bit vector."""
    if not _GOLAY:
        data = np.arange(1 << 12, dtype=np.uint32)
        word = data << np.uint32(11)
        rest = word.copy()
        for bit in range(22, 10, -1):
            rest = np.where(rest >> np.uint32(bit) & np.uint32(1), rest ^ np.uint32(GOLAY_POLYNOMIAL << (bit - 11)), rest)
        word |= rest
        table = np.empty(1 << 23, dtype=np.uint16)
        one = np.uint32(1) << np.arange(23, dtype=np.uint32)
        errors = [np.zeros(1, np.uint32), one]
        errors.append(np.array([one[i] | one[j] for i in range(23) for j in range(i)], np.uint32))
        errors.append(np.array([one[i] | one[j] | one[k] for i in range(23) for j in range(i) for k in range(j)], np.uint32))
        for error in np.concatenate(errors):
            table[word ^ error] = data
        _GOLAY.append(table)
    return _GOLAY[0]


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each distinct key of every fingerprint (uint64)."""
    table = golay_table()
    balls = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint64)
    parts = [(fps >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    rows, keys = [], []
    for z, (_, _) in enumerate(SEGMENTS):
        near = (z + 1) % len(SEGMENTS)
        index = np.sort(table[(parts[near][:, None] ^ balls).astype(np.int64)], axis=1)
        first = np.ones(index.shape, dtype=bool)
        first[:, 1:] = index[:, 1:] != index[:, :-1]
        row, at = np.nonzero(first)
        rows.append(row)
        keys.append(np.uint64(z) << np.uint64(40) | parts[z][row] << np.uint64(12) | index[row, at].astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        row, key = fuzzy_keys(fps)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fps[row].view(np.int64))], names=["key", "fp"])


def links(fps: DataFrame, dense: int = 64) -> DataFrame:
    """Edges (a < b) between distinct fingerprints (column fp) that suffice to
    connect all pairs at two or fewer differing bits; each edge is such a pair."""
    keyed = fps.mapInArrow(_keys, "key long, fp long")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = store(keyed.join(sizes, "key"), "simhash-keys")
    sparse = shared.where(F.col("n") <= dense).select("key", "fp")
    left, right = sparse.withColumnRenamed("fp", "a"), sparse.withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    pairs = left.join(right, "key").where(near).select("a", "b")
    crowded = shared.where(F.col("n") > dense).select("fp").distinct()
    around = F.transform(F.sequence(F.lit(0), F.lit(64)), lambda i: F.when(i == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(_bit(i))))
    met = crowded.select("fp", F.explode(around).alias("middle"))
    heads = met.groupBy("middle").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("middle", "a")
    stars = met.join(heads, "middle").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(stars).distinct()


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): least node of the component, for every other node with an edge.

    Alternates large-star and small-star steps until the edges are stars, which
    takes a number of rounds logarithmic in the longest chain; each round is
    written to the shared folder. Skewed hubs meet joins only, never one group.
    """
    stars = store(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "components")
    state = None
    for _ in range(rounds):
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = store(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(joined.select("u", F.col("m").alias("v")))
        fresh = store(small.where("u <> v").distinct(), "components")
        forget(large)
        forget(stars)
        stars = fresh
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == state:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _least(marked: DataFrame, key: Column, dense: int) -> DataFrame:
    """The least ``key`` in the component of each fingerprint: columns of, least."""
    groups = store(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-groups")
    roots = components(links(groups.select("fp"), dense))
    rooted = groups.join(roots, groups.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.drop("least").join(ids, "root").select(F.col("fp").alias("of"), "least")


def one_each(docs: DataFrame, dense: int = 64) -> DataFrame:
    """One row of each component of near duplicates, with the columns of ``docs``.

    It is the row with the least doc_id, then text hash; a null doc_id comes
    last. Rows are told apart by a number that is written down with them, so
    repeated and null doc_ids take no other row along. Null and empty texts are
    one group. An empty table gives an empty result; all columns stay, whatever
    their names.
    """
    rows = store(docs.select(F.struct("*").alias("own"), F.monotonically_increasing_id().alias("row")), "simhash-rows")
    own = rows.select("row", F.col("own.doc_id").cast("long").alias("doc_id"), F.xxhash64("own.text").alias("hash"), F.col("own.text").alias("text"))
    marked = store(own.mapInArrow(_fingerprints, "row long, doc_id long, hash long, fp long"), "simhash")
    known = _least(marked, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row"), dense)
    gone = marked.join(known, marked.fp == known.of).where(F.col("row") != F.col("least.row")).select("row")
    return rows.join(gone, "row", "left_anti").select("own.*")


def near_duplicates(docs: DataFrame, dense: int = 64) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs``.

    component_id is the least doc_id reachable over fingerprints that differ in
    at most two bits, the document's own included. Null, empty and blank texts
    have fingerprint zero and are linked like any other. Rows with a null
    doc_id are kept; they count in their component only when it has no other
    id, whose component_id is then null. Repeated rows stay repeated.
    """
    marked = store(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints, "doc_id long, fp long"), "simhash")
    known = _least(marked, F.col("doc_id"), dense).withColumnRenamed("least", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(known, marked.fp == known.of).select("doc_id", hexed, "component_id")
