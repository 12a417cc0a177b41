"""Near-duplicate classes: universal hash minima, banding, signature checks, full-set checks, components.

1. Every document becomes its set of 5-word shingle hashes; equal sets are one
   *class* (named by a 128-bit digest of the set), so copies are never expanded.
2. A class has 192 minima under universal hashes ``a x + b mod 2^32``; 32 bands
   of 6 minima name its buckets.  Two classes at Jaccard 0.85 share no bucket
   with probability (1 - 0.85^6)^32 < 3e-7.
3. Inside a bucket signatures are compared (agreement of at least 0.70, five
   standard deviations below 0.85); a spanning forest of the agreeing pairs is
   kept, never all pairs.  Its components are the *clusters*.
4. The shingle sets of clustered classes (only those) are made again and meet in
   their cluster, where ``100 |A and B| >= 85 |A or B|`` is checked on full sets,
   skipping pairs that are already connected.  A spanning forest of confirmed
   links is kept, so no link between different sets is lost.
5. Components of the confirmed links, by large-star and small-star.

Buckets and clusters above ``BLOCK`` members are dealt out as pairs of blocks,
so a task holds at most two blocks of one group, however large the group is.

Defined results: documents without words have an empty set, stay alone and are
kept; fewer than five words are one shingle; equal rows share a class; a class
is labelled with its smallest ``doc_id`` (nulls are ignored, a component with
null ids only has a null label and keeps none).  The pipeline form goes by rows,
not by ids: exactly one row of each component stays, also of repeated rows and of
null ids.  Long texts are taken whole; an empty table gives no rows; only id and
text are read, and the pipeline form passes all columns through, so none can clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import each_group, free_name, saved
from nestgate.llm.components import components
from nestgate.session import scratch_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 32, 6
MINIMA = BANDS * ROWS
AGREE = 0.70                 # least signature agreement of a pair that is checked on full sets
BLOCK = 1024                 # members of a group that meet in one task at most (two blocks)
CACHED_WORDS = 200_000       # word hashes remembered by a task

_rng = np.random.default_rng(20)
_A = (_rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Word to 64-bit hash; forgets everything when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingle_set(text: str | None, words: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    found = WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    k = min(SHINGLE, n)
    g = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        g = _spread(g * _MULT + h[i:n - k + 1 + i])
    return np.unique(g)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The universal hash minima of a set: the low 16 bits, which differ for different minima but once in 65536."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        h = _A[:, None] * x[None, i:i + 512]
        h += _B[:, None]
        np.minimum(out, h.min(axis=1), out=out)
    return out.astype(np.uint16)


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The contract's test on two sorted sets."""
    if min(len(a), len(b)) * 100 < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _forest_links(sig: np.ndarray, side: np.ndarray, sets: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """A spanning forest of the agreeing (with ``sets``: linked) pairs.

    ``side``: block number of each member; where two blocks meet only pairs across them are
    looked at (each block also meets itself in another task).
    """
    n, out = len(sig), []
    tree = np.arange(n)
    two = side.min() != side.max()
    least = AGREE * MINIMA
    for i in range(n - 1):
        wanted = tree[i + 1:] != tree[i]
        if two:
            wanted &= side[i + 1:] != side[i]
        left = np.flatnonzero(wanted) + i + 1
        if not len(left):
            continue
        agree = (sig[left] == sig[i]).sum(axis=1)
        near = agree >= least
        for j in left[near][np.argsort(-agree[near], kind="stable")]:
            if tree[i] != tree[j] and (sets is None or linked(sets[i], sets[j])):
                tree[tree == tree[j]] = tree[i]
                out.append((i, int(j)))
    return out


def _dealt(groups: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Members with the task ``(key, p, q)`` they meet in; large groups as pairs of blocks.

    ``counts``: rows ``(key, n)`` of the groups with two members or more.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int")
    dealt = groups.join(counts.withColumn("blocks", blocks), key).withColumn("side", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (dealt.withColumn("other", other)
            .withColumn("p", F.least("side", "other")).withColumn("q", F.greatest("side", "other"))
            .drop("n", "blocks", "other"))


def _links(with_sets: bool):
    def of(group: dict) -> dict:
        order = sorted(range(len(group["node"])), key=group["node"].__getitem__)
        node = [group["node"][i] for i in order]
        sig = np.frombuffer(b"".join(group["sig"][i] for i in order), np.uint16).reshape(len(order), MINIMA)
        sets = [np.frombuffer(group["shingles"][i], np.uint64) for i in order] if with_sets else None
        pairs = _forest_links(sig, np.array([group["side"][i] for i in order]), sets)
        return {"u": [node[i] for i, _ in pairs], "v": [node[j] for _, j in pairs]}
    return of


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordHashes()
    for b in batches:
        n, node, sig = [], [], []
        for t in b.column(1).to_pylist():
            s = shingle_set(t, words)
            n.append(len(s))
            node.append(set_name(s) if len(s) else None)
            sig.append(minima(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())],
            ["id", "n_shingles", "node", "sig"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordHashes()
    for b in batches:
        s = [shingle_set(t, words) for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_name(x) if len(x) else None for x in s], pa.binary()),
             pa.array([x.tobytes() for x in s], pa.binary())], ["node", "shingles"])


def _band_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        h = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sig), 1))
        for r in range(ROWS):
            h = _spread(h * _MULT + sig[:, :, r])
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS))),
             pa.array(h.view(np.int64).ravel())], ["node", "bucket"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(id, n_shingles, node, component_id, kept)`` for every row of ``df``."""
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = saved(docs.mapInArrow(_sketch, f"id {kind}, n_shingles long, node binary, sig binary"))
    classes = rows.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("first_id"), F.min("sig").alias("sig"))       # sig is the same in all rows of a class
    classes = saved(classes)
    # buckets with two classes or more
    buckets = classes.select("node", "sig").mapInArrow(_band_names, "node binary, bucket long")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = _dealt(buckets, "bucket", shared)
    agreeing = each_group(met.join(classes.select("node", "sig"), "node").select("bucket", "p", "q", "node", "side", "sig"),
                          ["bucket", "p", "q"], _links(False), "u binary, v binary")
    clusters = components(agreeing)
    # the full sets of clustered classes, made again from one document (or its equals) of each class
    chosen = classes.join(clusters, "node").select("first_id").distinct()
    sets = (docs.join(chosen, F.col("id").eqNullSafe(F.col("first_id")), "left_semi").select("text")
            .mapInArrow(_full_sets, "node binary, shingles binary")
            .groupBy("node").agg(F.min("shingles").alias("shingles")))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    meeting = _dealt(clusters, "root", sizes).join(classes.select("node", "sig"), "node").join(sets, "node")
    confirmed = each_group(meeting.select("root", "p", "q", "node", "side", "sig", "shingles"), ["root", "p", "q"],
                           _links(True), "u binary, v binary")
    member = components(confirmed)
    labels = (member.join(classes.select("node", "first_id"), "node"))
    least = labels.groupBy("root").agg(F.min("first_id").alias("least"))
    labels = labels.join(least, "root").select("node", "least")
    named = classes.select("node", "first_id").join(labels, "node", "left").select(
        "node", F.coalesce("least", "first_id").alias("least"))
    return (rows.drop("sig").join(named, "node", "left")
            .withColumn("component_id", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least")))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
            .select("id", "n_shingles", "node", "component_id", "kept"))


def document_components(docs: DataFrame) -> DataFrame:
    """Query form: one row for each document."""
    return near_duplicates(docs).withColumnRenamed("id", "doc_id").drop("node")


def first_of_each_class(docs: DataFrame) -> DataFrame:
    """Pipeline form: one row of each component stays (the smallest ``doc_id``, nulls last, then the
    smallest row number), and every row with an empty set."""
    row = free_name(docs, "_row")
    folder = scratch_path(docs.sparkSession, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(folder)
    numbered = docs.sparkSession.read.parquet(folder)                 # the numbers are the same in every scan
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    found = near_duplicates(numbered.select(key.alias("key"), "text"), "key")
    kept = found.filter("kept").select(F.col("id.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
