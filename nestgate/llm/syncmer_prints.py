"""Document fingerprints from closed syncmers.

A ``K``-byte gram of the UTF-8 text is an anchor when the least of its inner
``S``-byte grams (the leftmost of equals) stands at its first or last place.
That depends on the gram alone, so an edit changes anchors only where it
touches them.  Of all anchors a text keeps the ``SIZE`` least hashes, each with
the byte place of its first occurrence: the fingerprint, in hash order.

The likeness of two fingerprints looks at the ``SIZE`` least hashes of their
union, as far as both sides can tell, and counts those that both texts have at
places that agree with the most common shift (neighbouring shifts within
``SLACK`` bytes count as one); the share is between 0 and 1.

Defined results: null texts are empty; texts shorter than ``K`` bytes have the
hash of the whole text as their only anchor, empty texts none (two empty
fingerprints are alike: 1, an empty and another: 0); documents without id come
last in descending order; equal ids are ordered by text; an empty table gives
no rows.  Ids are numbers (their range is cut into parts); long texts are taken
whole; only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import saved

K, S = 24, 8
SIZE = 64
SLACK = 64
ENTRY = np.dtype([("h", ">u4"), ("at", ">u4")])

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[1]
    return x ^ (x >> np.uint64(29))


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (64 bits) and places of the closed syncmers of ``raw``."""
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if n < K:
        h = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        return np.array([h], np.uint64), np.zeros(1, np.int64)
    inner = np.empty(n - S + 1, np.uint64)
    for o in range(8):
        inner[o::8] = np.frombuffer(raw, "<u8", (n - o) // 8, o)[:len(inner[o::8])]
    s = _mix(inner * _M[0])
    span, size = K - S + 1, 1
    least = s
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    m = n - K + 1
    least = np.minimum(least[:m], least[span - size:span - size + m])
    first = s[:m] == least
    # at the last place only where no equal stands before: the leftmost is the least
    last = np.flatnonzero(~first & (s[K - S:K - S + m] == least))
    if len(last):
        before = np.lib.stride_tricks.sliding_window_view(s, span - 1)[last]
        last = last[(before > least[last][:, None]).all(axis=1)]
    at = np.sort(np.concatenate((np.flatnonzero(first), last)))
    h = _mix(s[at] * _M[0] + s[at + S] * _M[1] + s[at + 2 * S] * _M[2])
    return h, at


def fingerprint(text: str | None) -> np.ndarray:
    """The ``SIZE`` least anchor hashes (32 bits) with the place of their first occurrence."""
    h, at = anchors((text or "").encode("utf-8"))
    if not len(h):
        return np.empty(0, ENTRY)
    order = np.lexsort((at, h))
    h, at = h[order], at[order]
    keep = np.concatenate(([True], h[1:] != h[:-1]))
    h, at = h[keep][:4 * SIZE], at[keep][:4 * SIZE]
    top = (h >> np.uint64(32)).astype(np.uint32)
    keep = np.concatenate(([True], top[1:] != top[:-1]))
    out = np.empty(min(SIZE, int(keep.sum())), ENTRY)
    out["h"], out["at"] = top[keep][:SIZE], at[keep][:SIZE]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the least hashes of both that stand at agreeing places."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    ha, hb = a["h"].astype(np.int64), b["h"].astype(np.int64)
    union = np.union1d(ha, hb)
    # beyond a full fingerprint's largest hash its text is unknown
    ends = [x[-1] for x in (ha, hb) if len(x) == SIZE]
    union = union[union <= min(ends)] if ends else union
    common, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    known = common <= union[-1] if len(union) else np.zeros(len(common), bool)
    if not known.any():
        return 0.0
    shift = np.sort(a["at"][i][known].astype(np.int64) - b["at"][j][known].astype(np.int64))
    agree = np.searchsorted(shift, shift + SLACK, side="right") - np.arange(len(shift))
    return float(agree.max() / len(union))


def as_text(print_: np.ndarray) -> str:
    return print_.tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and descending id; each is finished when the next of its part is seen.
    ``own`` is false for the first row of the next part, which only closes this one."""
    held = None
    for b in batches:
        out = []
        for part, own, i, t in zip(*(b.column(k).to_pylist() for k in range(4))):
            t = t or ""
            print_ = fingerprint(t)
            if held is not None and held[0] == part:
                _, k, u, p = held
                e = edited(u, t)
                q = fingerprint(e)
                out.append((k, len(u), hashlib.sha256(e.encode("utf-8")).hexdigest(), as_text(p), as_text(q),
                            likeness(p, q), likeness(p, print_)))
            held = (part, i, t, print_) if own else None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), b.schema.field(2).type if n == 0 else None)
                                              for n, c in enumerate(zip(*out))], NAMES)


def document_prints(df: DataFrame, id_col: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text; the next document is the one with the next smaller id."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    n = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = df.select(F.col(id_col).alias("id"))
    # cuts of the id range: a few numbers, from quantiles; they place rows, results do not depend on them
    cuts = sorted({c for c in ids.select(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []})
    edges = np.array(cuts)

    @F.pandas_udf("int")
    def place(s: pd.Series) -> pd.Series:
        return pd.Series((len(edges) - np.searchsorted(edges, s.to_numpy(), side="left")).astype(np.int32))

    # part 0 holds the largest ids; rows without id are in a part of their own at the end
    where = F.lit(0) if not len(edges) else place(F.coalesce(F.col("id"), F.lit(cuts[0])))
    rows = (df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
            .withColumn("part", F.when(F.col("id").isNull(), F.lit(len(edges) + 1)).otherwise(where)))
    # the first row of each part closes the part before it; of the last part, the very first row does
    heads = (saved(rows.groupBy("part").agg(F.max("id").alias("id")))).collect()               # a row for each part
    order = sorted(r.part for r in heads)
    closes = {p: order[i - 1] for i, p in enumerate(order)}
    first_rows = spark.createDataFrame(
        [(r.part, r.id, closes[r.part]) for r in heads] or [(0, None, 0)], f"part int, id {kind}, closes int")
    candidates = rows.join(F.broadcast(first_rows), (rows["part"] == first_rows["part"]) & rows["id"].eqNullSafe(
        first_rows["id"])).select(rows["id"], "text", "closes")
    # of equal ids the one whose text sorts first
    head = candidates.groupBy("closes", "id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    both = rows.select("part", F.lit(True).alias("own"), "id", "text").unionByName(
        head.select(F.col("closes").alias("part"), F.lit(False).alias("own"), "id", "text"))
    dealt = both.repartition(n, "part").sortWithinPartitions(
        F.col("part"), F.col("own").desc(), F.col("id").desc_nulls_last(), F.coalesce("text", F.lit("")))
    out = dealt.select("part", "own", "id", "text").mapInArrow(
        _rows, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
