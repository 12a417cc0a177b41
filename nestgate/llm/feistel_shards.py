"""Reproducible shuffle and sharding: a Feistel permutation of global row numbers.

Rows are numbered from 0 in key order, the number goes through a keyed Feistel
network on 2h bits, and cycle walking (apply again while the value is outside
0..n-1) makes it a permutation of exactly 0..n-1.  Place ``p`` is shard
``p mod shards``, slot ``p div shards``: counts differ by one at most, slots
have no gaps, and both directions are computable without a table
(:func:`locate`, :func:`row_at`).

Defined results: null texts count as empty, equal rows are interchangeable, an
empty table gives no rows, other columns pass through unless a new one has
their name (then the new one replaces them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import free_name, row_numbers

ROUNDS = 6
M31 = (1 << 31) - 1
# Multipliers of the round function (all products stay under 2^62).
MULTIPLIERS = (1103515245, 1812433253)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{r}".encode()).digest()[:8], "big") & M31 for r in range(rounds)]


def half_bits(n: int) -> int:
    h = 1
    while (1 << (2 * h)) < n:
        h += 1
    return h


def _mix(x: np.ndarray, key: int, mask: int) -> np.ndarray:
    y = (x + key) & M31
    y = (y * MULTIPLIERS[0] + 12345) & M31
    y ^= y >> 15
    y = (y * MULTIPLIERS[1] + 54321) & M31
    return (y ^ (y >> 13)) & mask


def _network(x: np.ndarray, keys: list[int], h: int, inverse: bool) -> np.ndarray:
    mask = (1 << h) - 1
    left, right = x >> h, x & mask
    for k in (reversed(keys) if inverse else keys):
        if inverse:
            left, right = right ^ _mix(left, k, mask), left
        else:
            left, right = right, left ^ _mix(right, k, mask)
    return (left << h) | right


def permute(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (its inverse), with cycle walking; n up to 2^62."""
    keys, h = round_keys(seed), half_bits(n)
    out = _network(np.asarray(x, dtype=np.int64), keys, h, inverse)
    while (outside := out >= n).any():
        out[outside] = _network(out[outside], keys, h, inverse)
    return out


def locate(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    place = int(permute(np.array([row]), n, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Row number at a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def shard_rows(df: DataFrame, keys: list[Column], shards: int = 24, seed: int = 20) -> DataFrame:
    """``df`` with ``row_no``, ``shard`` and ``slot``; numbering by ``keys``."""
    df = df.drop("row_no", "shard", "slot")
    numbered, n = row_numbers(df, keys, "row_no")
    place = free_name(df, "_place")

    @F.pandas_udf("long")
    def placed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(permute(s.to_numpy(np.int64), n, seed) if len(s) else s)

    return (numbered.withColumn(place, placed("row_no"))
            .withColumn("shard", (F.col(place) % shards).cast("int"))
            .withColumn("slot", F.expr(f"`{place}` div {int(shards)}"))
            .drop(place))


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 20) -> DataFrame:
    """Query form: size, checksum and place of every document under the law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    placed = shard_rows(slim, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_no")

