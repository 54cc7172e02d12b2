"""Sharding by histogram sort: splitters found by counting, then one exchange.

Rows are ordered by (hash of text, hash of doc_id and row), so equal texts lie
side by side and any group of them can be cut, equal rows too. Each round counts the exact bytes of every cell between candidate
boundaries; a splitter whose nearest boundary is within tolerance of its target
is settled, otherwise its cell is cut into ``fan`` finer ones. Boundaries on
the text hash come first: a group of equal texts is cut only when its bytes
exceed the tolerance on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import store

BITS = 12


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _order(name: str, start: int) -> Column:
    """Digit of ``BITS`` bits of an unsigned 60-bit key, ``start`` bits from its top."""
    return F.shiftright(name, 60 - start - BITS).bitwiseAND(F.lit((1 << BITS) - 1))


def keyed(text: Column, doc_id: Column) -> tuple[Column, Column]:
    """The two 60-bit keys of a row: of its text; of its doc_id (40 bits), then of
    its place in the table, which tells equal rows apart and must be written down."""
    cut = F.lit((1 << 60) - 1).cast("long")
    own, row = F.xxhash64(F.lit("row"), doc_id), F.xxhash64(F.monotonically_increasing_id())
    return F.xxhash64(text).bitwiseAND(cut), F.shiftleft(own.bitwiseAND(F.lit((1 << 40) - 1)), 20).bitwiseOR(row.bitwiseAND(F.lit((1 << 20) - 1)))


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.01) -> list[tuple[int, int]]:
    """The least (k1, k2) of shards 1, 2, ...; keys has k1, k2 (60 bits) and size.

    The driver sees at most 2 ** ``BITS`` counts per unsettled splitter and
    round. Rows with equal k1 and k2, one in a million of a run of equal rows,
    are never cut.
    """
    total = keys.agg(F.sum("size")).collect()[0][0] or 0
    slack = tolerance * total / shards
    wanted = {j: total * j / shards for j in range(1, shards)}
    found: dict[int, tuple[int, int]] = {}
    cells = {(): 0}  # prefix of digits -> bytes before it
    depth = 0
    while wanted and total:
        name, start = ("k1", depth * BITS) if depth < 5 else ("k2", (depth - 5) * BITS)
        prefixes = list(cells)
        here = keys
        if depth:
            place = F.lit(False)
            for p in prefixes:
                place = place | _within(p)
            here = keys.where(place)
        known = [_digit(d).alias(f"d{d}") for d in range(depth)]
        counts: dict[tuple, list[tuple[int, int]]] = {p: [] for p in prefixes}
        for r in here.groupBy(*known, _order(name, start).alias("digit")).agg(F.sum("size").alias("size")).collect():
            counts[tuple(r[f"d{d}"] for d in range(depth))].append((r["digit"], r["size"]))
        finer: dict[tuple, int] = {}
        for p in prefixes:
            below = cells[p]
            for digit, size in sorted(counts[p]):
                above = below + size
                for j, target in list(wanted.items()):
                    if below <= target < above:
                        near, gap = (p + (digit,), target - below) if target - below <= above - target else (p + (digit + 1,), above - target)
                        if gap <= slack or depth == 9:
                            found[j] = _start(near)
                            del wanted[j]
                        else:
                            finer[p + (digit,)] = below
                below = above
        cells, depth = finer, depth + 1
    end = (1 << 60, 0)
    return [found.get(j, end) for j in range(1, shards)]


def _digit(d: int) -> Column:
    return _order("k1", d * BITS) if d < 5 else _order("k2", (d - 5) * BITS)


def _start(prefix: tuple[int, ...]) -> tuple[int, int]:
    """Least (k1, k2) with these digits; a last digit one too high carries."""
    value = 0
    for d in range(10):
        value = (value << BITS) + (prefix[d] if d < len(prefix) else 0)
    return value >> 60, value & ((1 << 60) - 1)


def _within(prefix: tuple[int, ...]) -> Column:
    out = F.lit(True)
    for d, digit in enumerate(prefix):
        out = out & (_digit(d) == digit)
    return out


def shard_of(k1: Column, k2: Column, cuts: list[tuple[int, int]]) -> Column:
    out = F.lit(0)
    for a, b in cuts:
        out = out + ((k1 > a) | ((k1 == a) & (k2 >= b))).cast("int")
    return out.cast("int")


def assign(rows: DataFrame, cuts: list[tuple[int, int]], lots: int) -> DataFrame:
    """``rows`` (own, k1, k2, size), a table in storage, with shard and slot.

    Slots number a shard's rows from 0 without gaps. Rows go once through an
    exchange by (shard, lot), ``lots`` being equal hash ranges of a shard whatever
    the texts are, and are numbered within their lot; lot counts give the offsets.
    """
    keys = rows.select("k1", "k2")
    shard = shard_of(F.col("k1"), F.col("k2"), cuts)
    piece = F.pmod(F.xxhash64("k2", "k1"), F.lit(lots)).cast("int")
    ahead = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    counts = keys.groupBy(shard.alias("shard"), piece.alias("lot")).agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "lot", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "lot").orderBy("k1", "k2")
    numbered = rows.withColumns({"shard": shard, "lot": piece}).withColumn("place", F.row_number().over(inside) - 1)
    slot = (F.col("offset") + F.col("place")).cast("long")
    return numbered.join(offsets, ["shard", "lot"]).select("own", "size", "shard", slot.alias("slot"))


def _placed(docs: DataFrame, own: Column, shards: int, tolerance: float, lot: Column) -> DataFrame:
    """``lot``: how many lots the rows, of which it is an aggregate, are worth."""
    k1, k2 = keyed(F.col("text"), F.col("doc_id"))
    rows = store(docs.select(own.alias("own"), k1.alias("k1"), k2.alias("k2"), size_of(F.col("text")).alias("size")), "shard-rows")
    lots = rows.agg(F.ceil(lot / shards).cast("long")).collect()[0][0] or 1
    return assign(rows, splitters(rows.select("k1", "k2", "size"), shards, tolerance), max(1, lots))


def shard(docs: DataFrame, shards: int = 16, tolerance: float = 0.01, lot_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with size, shard and slot; shards hold near equal bytes.

    Size is the text's UTF-8 bytes plus one, a null text counting no bytes. Each
    of a shard's two ends is within ``tolerance`` of a shard, or a row, of its
    place. Rows are told apart by a number that is written down with them, so
    equal rows and null ids are dealt out like any others. An empty table gives
    an empty result. Input columns named size, shard or slot are replaced; all
    others stay, whatever their names. A task numbers about ``lot_bytes`` of text.
    """
    docs = docs.drop("size", "shard", "slot")
    return _placed(docs, F.struct("*"), shards, tolerance, F.sum("size") / lot_bytes).select("own.*", "size", "shard", "slot")


def shard_table(docs: DataFrame, shards: int = 16, tolerance: float = 0.01, lot_rows: int = 20_000) -> DataFrame:
    """The assignment alone: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    No text moves: the exchange carries keys, sizes and checksums. The law is
    ``bytes``, under which no other shard count is promised: grown_shard is null.
    A null text has the checksum of no bytes.
    """
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    placed = _placed(docs, F.struct("doc_id", crc), shards, tolerance, F.count("*") / lot_rows)
    return placed.select("own.doc_id", "size", "own.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
