"""Repeated keys without a shuffle of unique ones (A8): a mergeable seen-once / seen-twice filter.

1. Every key is hashed to a place among 2^``PLACE_BITS``.  A task packs the places it has seen once, and those
   it has seen twice, as sorted gaps of a few bytes each, cut into ranges of places.
2. The packs of a range meet in one task, which merges them: places seen twice by one task or once by
   two are the suspects.  Only these packs are shuffled, two or three bytes a key instead of the key.
3. Rows whose place is a suspect, the repeated keys and a few chance neighbours, are counted exactly.

The result does not depend on the filter: a place shared by different keys only adds suspects.  A hot key is one
place in each task's pack.  A task of step 1 holds the places of ``HELD`` keys at a time, a task of step 2
those of its range; the number of ranges follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE_BITS = 40
HELD = 1 << 21


def place(keys: Sequence[str]) -> Column:
    """Place of a key: its hash, with nulls told apart from absent neighbours; -0.0 is 0.0, as in grouping."""
    named = [F.col(f"`{k}`") for k in keys]
    h = F.xxhash64(*[x for c in named for x in (c.isNull(), c)])
    return F.shiftrightunsigned(h, 64 - PLACE_BITS)


def packed(places: np.ndarray) -> bytes:
    """Sorted distinct places as gaps: the bytes of each gap but its high zeros, after the gaps' sizes."""
    gaps = np.diff(places, prepend=0).astype("<u8")
    raw = gaps.view(np.uint8).reshape(-1, 8)
    size = np.maximum(1, 8 - np.argmax(raw[:, ::-1] != 0, axis=1)).astype(np.uint8)
    size[gaps == 0] = 1
    body = raw[np.arange(8) < size[:, None]]
    pairs = np.append(size, np.zeros(len(size) % 2, np.uint8)).reshape(-1, 2)          # two sizes a byte
    return len(places).to_bytes(8, "little") + (pairs[:, 0] | pairs[:, 1] << 4).astype(np.uint8).tobytes() + body.tobytes()


def unpacked(pack: bytes) -> np.ndarray:
    n = int.from_bytes(pack[:8], "little")
    head = 8 + (n + 1) // 2
    pairs = np.frombuffer(pack, np.uint8, head - 8, 8)
    size = np.column_stack([pairs & 15, pairs >> 4]).ravel()[:n]
    raw = np.zeros((n, 8), np.uint8)
    raw[np.arange(8) < size[:, None]] = np.frombuffer(pack, np.uint8, -1, head)
    return np.cumsum(raw.view("<u8").ravel().astype(np.int64))


def _once_and_twice(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(places, return_counts=True)
    return found[n == 1], found[n > 1]


def _packs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs(held: list[np.ndarray]) -> pa.RecordBatch:
            once, twice = _once_and_twice(np.concatenate(held))
            rows = []
            for r in range(ranges):
                lo, hi = (-(-x << PLACE_BITS) // ranges if x else 0 for x in (r, r + 1))
                a, b = (p[np.searchsorted(p, lo):np.searchsorted(p, hi)] for p in (once, twice))
                if len(a) or len(b):
                    rows.append((r, packed(a), packed(b)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                                              ["range", "once", "twice"])

        held, n = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy())
            n += b.num_rows
            if n >= HELD:
                yield packs(held)
                held, n = [], 0
        if n:
            yield packs(held)
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suspect places of the ranges of one task; packs of a range follow each other."""
    now, once, twice = None, [], []

    def suspects() -> pa.RecordBatch:
        _, again = _once_and_twice(np.concatenate(once))
        return pa.RecordBatch.from_arrays([pa.array(np.union1d(again, np.concatenate(twice)))], ["place"])

    for b in batches:
        for r, x, y in zip(*(b.column(c).to_pylist() for c in ("range", "once", "twice"))):
            if r != now and now is not None:
                yield suspects()
                once, twice = [], []
            now = r
            once.append(unpacked(x))
            twice.append(unpacked(y))
    if now is not None:
        yield suspects()


def suspect_places(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(place)``: distinct places that more than one row fell on."""
    ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packs = df.select(place(keys).alias("place")).mapInArrow(_packs(ranges), "range int, once binary, twice binary")
    return packs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(_merged, "place long")


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """``(*keys, count)`` of every key that occurs more than once; null keys equal each other."""
    from nestgate.operators.lookup import probe_size
    from nestgate.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    suspects = suspect_places(df, keys).checkpoint(eager=True)
    n, _ = probe_size(suspects, 1_000_000)
    p = "_place"
    while p in keys:
        p = "_" + p
    right = suspects.withColumnRenamed("place", p)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], place(keys).alias(p))
    rows = rows.join(F.broadcast(right) if n <= 1_000_000 else right, p, "left_semi")       # 8 bytes a suspect
    return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(count)).where(F.col(f"`{count}`") > 1)
