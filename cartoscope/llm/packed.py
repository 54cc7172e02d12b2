"""Sorted arrays as rows of compressed blobs, dealt to parts by key.

A row holds entries (key, other, up to three values) of one kind, sorted, keys
as differences, every array byte plane by byte plane. Entries meet in the part
that the hash of their key names. Where there are more than ``lanes`` parts they
are dealt in two exchanges, lane first, and regrouped in between, so that a row
keeps thousands of entries however many parts there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textscan import mix

SCHEMA = "part int, kind int, size int, key binary, other binary, a binary, b binary, c binary"
_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("size", pa.int32()), *((n, pa.binary()) for n in ("key", "other", "a", "b", "c"))])
_ROW = 1 << 18
Entries = tuple[np.ndarray, ...]  # key, other, values


def squeeze(values: np.ndarray) -> bytes:
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(blob: bytes, size: int, dtype: str) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, size * 8, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, size).T).view(dtype).ravel()


def row(part: int, kind: int, entries: Entries) -> dict:
    key, other, *values = entries
    made = {"part": part, "kind": kind, "size": len(key), "key": squeeze(np.diff(key, prepend=np.uint64(0)))}
    made["other"] = squeeze(other) if other.any() else None
    return made | {n: squeeze(np.ascontiguousarray(v)) for n, v in zip("abc", values, strict=False)}


def entries(made: dict, dtypes: str) -> Entries:
    """dtypes: a letter (q or d) for each value."""
    size = made["size"]
    key = np.cumsum(_unsqueeze(made["key"], size, "u8"), dtype=np.uint64)
    other = np.zeros(size, np.uint64) if made["other"] is None else _unsqueeze(made["other"], size, "u8")
    return key, other, *(_unsqueeze(made[n], size, {"q": "i8", "d": "f8"}[t]) for n, t in zip("abc", dtypes, strict=False))


def ordered(parts: list[Entries]) -> Entries:
    """All entries, sorted by key and other."""
    key, other, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((other, key)) if other.any() else np.argsort(key, kind="stable")
    return key[order], other[order], *(v[order] for v in values)


def summed(parts: list[Entries]) -> Entries:
    """Distinct (key, other), sorted, with the sums of their values."""
    key, other, *values = ordered(parts)
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1])
    at = np.flatnonzero(new)
    return key[at], other[at], *(np.add.reduceat(v, at) if len(at) else v for v in values)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (mix(key) % np.uint64(parts)).astype(np.int64)


def rounded(parts: int, lanes: int) -> int:
    """A number of parts that lanes divide evenly."""
    return max(1, parts) if parts <= lanes else -(-parts // lanes) * lanes


def pack(kind: int, sorted_entries: Entries, parts: int, lanes: int) -> Iterator[dict]:
    """Rows of sorted entries for each part, or each lane if there are more parts than those."""
    part = part_of(sorted_entries[0], parts) % min(parts, lanes)
    order = np.argsort(part.astype(np.uint16) if lanes <= 1 << 16 else part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(min(parts, lanes) + 1))
    for p in np.flatnonzero(cuts[1:] > cuts[:-1]):
        for a in range(cuts[p], cuts[p + 1], _ROW):
            pick = order[a : min(a + _ROW, cuts[p + 1])]
            yield row(int(p), kind, tuple(x[pick] for x in sorted_entries))


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def batched(rows: Iterator[dict], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` bytes."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += 200 + sum(len(r.get(c) or b"") for c in ("key", "other", "a", "b", "c"))
        if n > size:
            yield batch_of(held)
            held, n = [], 0
    if held:
        yield batch_of(held)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def gathered(rows: DataFrame) -> DataFrame:
    """Rows of a part in one task, kind by kind; a task holds several parts, one after the other."""
    return rows.repartition("part").sortWithinPartitions("part", "kind")


def dealt(rows: DataFrame, parts: int, lanes: int, kinds: dict[int, str], flush: int = 1 << 20) -> DataFrame:
    """Rows dealt to lanes, dealt on to parts. Entries of several rows share the new ones."""
    if parts <= lanes:
        return rows

    def onward(kind: int, held: list[Entries]) -> Iterator[dict]:
        every = ordered(held)
        part = part_of(every[0], parts)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            for c in range(a, b, _ROW):
                pick = order[c : min(c + _ROW, b)]
                yield row(int(part[order[a]]), kind, tuple(x[pick] for x in every))

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run() -> Iterator[dict]:
            held, size, last = [], 0, None
            for r in rows_of(batches):
                if held and (size > flush or (r["part"], r["kind"]) != last):
                    yield from onward(last[1], held)
                    held, size = [], 0
                last = r["part"], r["kind"]
                held.append(entries(r, kinds[r["kind"]]))
                size += r["size"]
            if held:
                yield from onward(last[1], held)

        yield from batched(run())

    return gathered(rows).mapInArrow(regroup, SCHEMA)


def unpacked(rows: DataFrame, dtypes: str, least: int = 0) -> DataFrame:
    """Rows (key, a) of single-valued entries whose value is ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            key, _, a = entries(r, dtypes)
            yield pa.RecordBatch.from_arrays([pa.array(key[a >= least].view(np.int64)), pa.array(a[a >= least])], names=["key", "a"])

    return rows.mapInArrow(run, f"key long, a {'long' if dtypes == 'q' else 'double'}")


def of_rows(rows: DataFrame, kind: int, parts: int, lanes: int) -> DataFrame:
    """Packed rows of plain ones (key, n), which need no order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            held.append((key, np.zeros(len(key), np.uint64), batch.column(1).to_numpy()))
            size += len(key)
            if size > 1 << 20:
                yield from batched(pack(kind, ordered(held), parts, lanes))
                held, size = [], 0
        if size:
            yield from batched(pack(kind, ordered(held), parts, lanes))

    return rows.select("key", F.col("n").cast("long")).mapInArrow(run, SCHEMA)
