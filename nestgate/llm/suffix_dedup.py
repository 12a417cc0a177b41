"""Removal of repeated byte strings by sharded suffix arrays.

A byte goes when some ``width``-byte string over it starts anywhere else too.

1. Every window of ``width`` bytes has an *anchor*, its 64-byte gram of least
   hash.  Neighbouring windows with one anchor form a *segment*; equal windows
   have equal anchors, so only segments with equal anchors can share a window.
2. Anchors are counted over the corpus; segments whose anchor occurs once hold
   no repeat.  A bit table of fixed size carries the repeated anchors to the
   next scans (its false hits cost work, not results).
3. Equal segments are collapsed to one row with a count.  Where all segments of
   an anchor are equal the count decides.  All others go to shards by anchor.
4. A shard's string gets its suffix array by induced sorting, and the permuted
   common prefixes tell which windows occur twice (:mod:`.induced_sort`).
5. The marked windows go back to their texts, and covered bytes are cut out.

Segments meet by anchor hash in shards of about ``SHARD_BYTES``; an anchor with
more than ``HOT_SEGMENTS`` different segments is not collected in one shard:
its windows are compared as whole strings in a shuffle (by 128-bit digests).

Defined results: null texts are empty; texts shorter than ``width`` stay whole;
equal rows repeat each other like any other texts; an empty table gives no
rows.  Cutting works on bytes; the pipeline form decodes what is left and drops
the fragments of a character cut in two.  Long texts are hashed in overlapping
pieces and cut whole.  The general form puts its result columns in place of input
columns of their names; the pipeline form keeps every input column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import behind_names, each_group, free_name, saved, sliced
from nestgate.llm.induced_sort import permuted_prefixes, shard_string, suffix_array

WIDTH = 200
GRAM = 64
BLOCK_BYTES = 1 << 19          # text bytes hashed together; longer texts are hashed in overlapping pieces
PLACE_BITS = 24                # of a gram's place in its block, beside the high bits of its hash
SHARD_BYTES = 1_500_000
HOT_SEGMENTS = 20_000
MOST_BITS = 27                 # the bit table has 2^27 bits (16 MB) at most

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M[0]
    x += b * _M[1]
    x ^= x >> np.uint64(29)
    x *= _M[2]
    x ^= x >> np.uint64(32)
    return x


def _segments(texts: list[bytes]) -> tuple[np.ndarray, ...] | None:
    """Segments of texts of ``WIDTH`` bytes or more, hashed as one buffer: (anchor hash, segment
    hash, text number, first window, windows), places inside the text."""
    buf = b"".join(texts)
    n = len(buf)
    if n > 1 << PLACE_BITS:
        raise ValueError(f"a block of {n} bytes has places beyond {PLACE_BITS} bits")
    eight = np.empty(n - 7, np.uint64)
    for o in range(8):
        eight[o::8] = np.frombuffer(buf, "<u8", (n - o) // 8, o)[:len(eight[o::8])]
    h = _fold(eight[:-8], eight[8:])
    h = _fold(h[:-16], h[16:])
    h = _fold(h[:-32], h[32:])                                   # hash of the gram at each place
    low = np.uint64((1 << PLACE_BITS) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)          # the leftmost of equal hashes wins
    size, span = 1, WIDTH - GRAM + 1
    while 2 * size <= span:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    m = np.minimum(m[:n - WIDTH + 1], m[span - size:span - size + n - WIDTH + 1])
    anchor = (m & low).astype(np.int64)
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate(([0], ends[:-1]))
    for e in ends[:-1].tolist():
        anchor[e - WIDTH + 1:e] = -1                             # windows over a text's end
    cut = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
    count = np.diff(np.concatenate((cut, [len(anchor)])))
    real = anchor[cut] >= 0
    first, count = cut[real], count[real]
    end = first + count - 1 + WIDTH
    g = _fold(h[first], h[first + GRAM])
    for at in (first + 2 * GRAM, end - 3 * GRAM, end - 2 * GRAM, end - GRAM):
        g = _fold(g, h[at])
    g = _fold(g, count.astype(np.uint64))
    text = np.searchsorted(ends, first, side="right")
    return h[anchor[first]].view(np.int64), g.view(np.int64), text, first - starts[text], count


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """The texts that are long enough, in blocks of about ``BLOCK_BYTES``: (text numbers, offsets, pieces).

    A longer text comes in pieces of at most ``BLOCK_BYTES`` windows; neighbours overlap by ``WIDTH - 1``
    bytes, so each window lies in one piece.  A segment cut at a piece's end only means more work.
    """
    block, size = [], 0
    for i, t in enumerate(texts):
        for a in range(0, len(t) - WIDTH + 1, BLOCK_BYTES):
            piece = t[a:a + BLOCK_BYTES + WIDTH - 1]
            block.append((i, a, piece))
            size += len(piece)
            if size >= BLOCK_BYTES:
                yield np.array([x[0] for x in block]), np.array([x[1] for x in block]), [x[2] for x in block]
                block, size = [], 0
    if block:
        yield np.array([x[0] for x in block]), np.array([x[1] for x in block]), [x[2] for x in block]


def _texts(column) -> list[bytes]:
    return [(t or "").encode("utf-8") for t in column.to_pylist()]


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        texts = _texts(b.column(0))
        for _, _, pieces in _blocks(texts):
            h, n = np.unique(_segments(pieces)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])


def _with_bits(bits, step):
    """``step(texts, (h, g, text, first, count))`` over the segments whose anchor is in the bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        mask = np.int64(64 * len(table) - 1)
        for b in sliced(batches):
            texts = _texts(b.column(0))
            for number, offset, pieces in _blocks(texts):
                h, g, piece, first, count = _segments(pieces)
                at = h & mask
                hit = (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
                if hit.any():
                    s = h, g, number[piece], first + offset[piece], count
                    yield step(texts, tuple(x[hit] for x in s))
    return run


def _segment_counts(texts, s) -> pa.RecordBatch:
    both = np.stack((s[0], s[1]), axis=1)
    rows, n = np.unique(both, axis=0, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(n)], ["h", "g", "n"])


def _segment_texts(texts, s) -> pa.RecordBatch:
    _, one = np.unique(s[0] ^ (s[1] * np.int64(3)), return_index=True)
    h, g, text, first, count = (x[one] for x in s)
    parts = [texts[i][a:a + c + WIDTH - 1] for i, a, c in zip(text.tolist(), first.tolist(), count.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(parts, pa.binary())], ["h", "g", "part"])


def _segment_places(texts, s) -> pa.RecordBatch:
    names = {i: hashlib.md5(texts[i], usedforsecurity=False).digest() for i in set(s[2].tolist())}
    return pa.RecordBatch.from_arrays(
        [pa.array(s[0]), pa.array(s[1]), pa.array([names[i] for i in s[2].tolist()], pa.binary()),
         pa.array(s[3]), pa.array(s[4].astype(np.int32))], ["h", "g", "name", "first", "count"])


def _bit_table(rows: DataFrame) -> np.ndarray:
    """Bits of the anchors ``h``; the size follows their number up to 2^MOST_BITS bits."""
    n = rows.count()
    size = min(MOST_BITS, max(12, (16 * n + 1).bit_length()))
    at = F.col("h").bitwiseAND(F.lit((1 << size) - 1))
    words = rows.groupBy(F.shiftright(at, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(h & 63 as int))")).alias("b")).toPandas()   # 2^(MOST_BITS - 6) rows at most
    out = np.zeros(1 << (size - 6), np.uint64)
    if len(words):
        out[words["w"].to_numpy()] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def _shard_marks(group: dict) -> dict:
    """Windows of a shard's segments that occur elsewhere in the shard, as packed bits."""
    order = sorted(range(len(group["h"])), key=lambda i: (group["h"][i], group["g"][i]))
    parts = [group["part"][i] for i in order]
    t, starts = shard_string(parts)
    sa = suffix_array(t, 258)
    prefix = permuted_prefixes(t, sa, WIDTH)
    twice = np.zeros(len(t), bool)
    k = np.flatnonzero(prefix[sa[1:]] >= WIDTH)
    twice[sa[k]] = twice[sa[k + 1]] = True
    out = {"h": [], "g": [], "marks": []}
    for i, a, p in zip(order, starts.tolist(), parts):
        bits = twice[a:a + len(p) - WIDTH + 1]
        if bits.any():
            out["h"].append(group["h"][i])
            out["g"].append(group["g"][i])
            out["marks"].append(np.packbits(bits).tobytes())
    return out


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h, g, at, digest = [], [], [], []
        for x, y, p in zip(*(b.column(i).to_pylist() for i in range(3))):
            for i in range(len(p) - WIDTH + 1):
                h.append(x)
                g.append(y)
                at.append(i)
                digest.append(hashlib.blake2b(p[i:i + WIDTH], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array(at, pa.int32()),
             pa.array(digest, pa.binary())], ["h", "g", "at", "digest"])


def _hot_marks(parts: DataFrame) -> DataFrame:
    """Marks of anchors with very many segments: windows compared by digest."""
    windows = parts.select("h", "g", "part").mapInArrow(_window_digests, "h long, g long, at int, digest binary")
    twice = windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    found = windows.join(twice, "digest").select("h", "g", "at")

    def bits(group: dict) -> dict:
        marks = np.zeros(max(group["at"]) + 1, bool)
        marks[group["at"]] = True
        return {"h": group["h"][:1], "g": group["g"][:1], "marks": [np.packbits(marks).tobytes()]}

    return each_group(found, ["h", "g"], bits, "h long, g long, marks binary")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """Rows ``(name, first, count, marks)``: windows of the text ``name`` (md5) that occur elsewhere.

    ``texts``: one string column.  ``marks``: packed bits over ``count`` windows from ``first``;
    null means all of them.
    """
    sc = texts.sparkSession.sparkContext
    repeated = saved(texts.mapInArrow(_anchor_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
                     .filter("n > 1").select("h"))
    table = sc.broadcast(_bit_table(repeated))
    segments = saved(texts.mapInArrow(_with_bits(table, _segment_counts), "h long, g long, n long")
                     .groupBy("h", "g").agg(F.sum("n").alias("n")))
    mixed = saved(segments.groupBy("h").agg(F.min("g").alias("a"), F.max("g").alias("b"),
                                            F.count("*").alias("different"))
                  .filter("a <> b").select("h", "different"))
    mixed_table = sc.broadcast(_bit_table(mixed))
    parts = (texts.mapInArrow(_with_bits(mixed_table, _segment_texts), "h long, g long, part binary")
             .groupBy("h", "g").agg(F.first("part").alias("part")).join(mixed, "h"))
    parts = saved(parts)
    total = parts.agg(F.sum(F.length("part"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    usual = parts.filter(F.col("different") <= HOT_SEGMENTS).select(
        F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "h", "g", "part")
    found = each_group(usual, ["shard"], _shard_marks, "h long, g long, marks binary").unionByName(
        _hot_marks(parts.filter(F.col("different") > HOT_SEGMENTS)))
    whole = segments.filter("n > 1").select("h", "g", F.lit(None).cast("binary").alias("marks"))
    single = segments.filter("n = 1").select("h", "g")
    marks = whole.unionByName(found.join(single, ["h", "g"]).select("h", "g", "marks"))
    places = texts.mapInArrow(_with_bits(table, _segment_places),
                              "h long, g long, name binary, first long, count int")
    return places.join(marks, ["h", "g"]).select("name", "first", "count", "marks")


def _starts(found: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked windows as (row number, first window, windows), from lists of (first, count, marks)."""
    offsets = found.offsets.to_numpy()
    owner = np.repeat(np.arange(len(found)), np.diff(offsets))
    first, count, marks = found.values.slice(offsets[0], offsets[-1] - offsets[0]).flatten()
    first, count, whole = first.to_numpy(), count.to_numpy().astype(np.int64), marks.is_null().to_numpy(False)
    some = np.flatnonzero(~whole)
    out = [(owner[whole], first[whole], count[whole])]
    if len(some):
        parts = marks.take(pa.array(some)).to_pylist()
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        bits = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(parts), np.uint8)))
        begin = 8 * (np.cumsum(size) - size)
        row = np.searchsorted(begin, bits, side="right") - 1
        out.append((owner[some][row], first[some][row] + bits - begin[row], np.ones(len(bits), np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _cut(texts: list[bytes], found: pa.ListArray) -> tuple[list, ...]:
    removed, spans, digest, kept = [], [], [], []
    owner, first, count = _starts(found)
    order = np.argsort(owner, kind="stable")
    owner, first, count = owner[order], first[order], count[order]
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK_BYTES):
            size += len(texts[j])
            j += 1
        lengths = np.fromiter(map(len, texts[i:j]), np.int64, j - i)
        base = np.cumsum(lengths) - lengths
        a, b = np.searchsorted(owner, [i, j])
        begin = base[owner[a:b] - i] + first[a:b]
        edge = np.bincount(begin, minlength=size + 1)
        edge -= np.bincount(begin + count[a:b] - 1 + WIDTH, minlength=size + 1)
        gone = np.cumsum(edge[:size]) > 0
        for k, at in enumerate(base.tolist()):
            t = texts[i + k]
            g = gone[at:at + len(t)]
            n = int(np.count_nonzero(g))
            removed.append(n)
            spans.append(int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if n else 0)
            kept.append(t if not n else b"" if n == len(t) else np.frombuffer(t, np.uint8)[~g].tobytes())
            digest.append(hashlib.sha256(kept[-1]).hexdigest())
        i = j
    return removed, spans, digest, kept


def cut_repeats(df: DataFrame, text: str = "text", with_bytes: bool = True) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, where asked for (else
    null), the bytes ``kept_bytes``."""
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
    df = df.drop(*new)
    name, rows = free_name(df, "_name"), free_name(df, "_rows")
    marks = (repeated_windows(df.select(F.col(text)))
             .groupBy(F.col("name").alias(name))
             .agg(F.collect_set(F.struct("first", "count", "marks")).alias(rows)))     # of one text
    named = df.withColumn(name, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    joined = named.join(marks, name, "left").drop(name)
    names = df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = _texts(b.column(at))
            removed, spans, digest, kept = _cut(texts, b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(list(map(len, texts)), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept if with_bytes else [None] * len(kept), pa.binary())],
                [*names, *new])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return joined.select(*df.columns, rows).mapInArrow(
        run, kinds + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def document_repeats(docs: DataFrame) -> DataFrame:
    """Query form: one row for each document."""
    return cut_repeats(docs.select("doc_id", "text"), with_bytes=False).drop("text", "kept_bytes")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Pipeline form: documents with their repeated bytes cut out, in the columns of ``docs``; columns
    that share a name with one of this operator's keep their values."""
    return behind_names(docs, ["text", "n_chars"], _without_repeats)


def _without_repeats(docs: DataFrame) -> DataFrame:
    cut = cut_repeats(docs)
    names = [*docs.columns, "n_removed", "decoded"]
    text: Column = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("decoded"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            done = [bytes(x).decode("utf-8", "ignore") for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(done, pa.string())],
                                             names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = cut.select(*docs.columns, "n_removed", "kept_bytes").mapInArrow(
        decode, f"{kinds}, n_removed long, decoded string").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
