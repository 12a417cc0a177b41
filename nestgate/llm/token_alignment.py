"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often corpus-wide.

1. A text is encoded by both tokenizers chunk by chunk (a chunk begins at a blank or line end after
   a visible character, where neither tokenizer can join); each Python worker remembers the chunks'
   ids as list arrays, so a text's tokens are one ``take`` and one flatten.
2. Arrow kernels align a unit of documents at once: token byte lengths, cumulative sums restarted at
   every document, and a full outer Acero join of both tokenizers' (document, end) keys.  A row
   of the join is one stretch of bytes between two neighbouring ends, so it is one link: the ids are
   filled backwards from the ends.  Rows with both sides are common ends, which cut the groups.
3. ``Table.group_by`` counts the links of each id pair in a document.  The documents' results are
   written once; partial counts of pairs come from them, again by ``group_by``, and Spark adds them up.
4. The corpus counts go back to the documents.  Pairs in many documents (at most ``HEAVY`` of them)
   travel with the tasks; the others, each in few documents, are joined by a shuffle in which no
   key is hot.  Both routes run at every size.

Memory: a unit holds about ``UNIT`` characters; longer texts are cut at chunk borders into several
units, whose results are added (the hash of the groups is continued).  Only a single word of
many megabytes is encoded whole.

Defined results: null and empty texts, and texts whose tokens of either side do not give back blank
plus text byte by byte (for example texts holding U+2581), have no tokens: zeros and an empty
``groups_sha256``.  Rows are documents: repeated rows and null ids are counted and returned like any
others.  Ties for an A id's highest count are all best.  An empty table gives no rows.  Only the id and
text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import saved
from nestgate.session import scratch_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
UNIT = 1 << 19                # characters of texts aligned at once
CACHED = 150_000              # chunks whose ids a Python worker remembers
PAIRS_HELD = 1 << 20          # pair counts a task holds before it sends them on
HEAVY = 1 << 20               # pairs whose counts travel with the tasks
BLANK_PIECE = "▁"
CHUNK = re.compile(r"[ \n]*[^ \n]+(?:(?<=\s)[ \n]+[^ \n]*)*|[ \n]+")
BORDER = re.compile(r"(?<=\S)(?=[ \n])")
# letters, then marks: the byte-level splitting parts them there and nowhere else
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(moved)}


class _Buffer:
    """Growing array."""

    def __init__(self, kind: str):
        self.data, self.n = np.empty(1 << 16, kind), 0

    def extend(self, values) -> None:
        k = len(values)
        if self.n + k > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(k, len(self.data)), self.data.dtype)])
        self.data[self.n:self.n + k] = values
        self.n += k


class Encoders:
    """Both tokenizers, and the ids of remembered chunks as list arrays."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.paths = (a_path, b_path)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet, size = _byte_alphabet(), self.a.get_vocab_size()
        self.alphabet = {b: c for c, b in alphabet.items()}
        self.a_bytes = [bytes(alphabet[c] for c in w) if all(c in alphabet for c in w) else w.encode()
                        for w in (self.a.id_to_token(i) or "" for i in range(size))]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(BLANK_PIECE, " ").encode())
        self.a_size, self.b_size = (pa.array([len(x) for x in t], pa.int64()) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (pa.array([str(i) for i in range(len(t))]) for t in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id(BLANK_PIECE)
        _separable(self.a, [self.b.id_to_piece(i) for i in range(len(self.b_bytes)) if not self.b.is_byte(i)])
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = (_Buffer("i4"), _Buffer("i4"))
        self.ends = (_Buffer("i4"), _Buffer("i4"))
        self.good = _Buffer("?")
        self.mark_ids: dict[str, list[int]] = {}
        for e in self.ends:
            e.extend([0])

    def _a_ids(self, chunks: list[str]) -> list[list[int]]:
        """Plain words go straight to the model, which saves the tracking of offsets."""
        out, rest = [], []
        for i, c in enumerate(chunks):
            plain = PLAIN.fullmatch(c)
            if plain is None:
                rest.append(i)
                out.append(None)
                continue
            word, marks = plain.groups()
            ids = [t.id for t in self.a.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))]
            if marks:
                if marks not in self.mark_ids:
                    self.mark_ids[marks] = [t.id for t in self.a.model.tokenize(marks)]
                ids += self.mark_ids[marks]
            out.append(ids)
        found = self.a.encode_batch([chunks[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found):
            out[i] = e.ids
        return out

    def _b_ids(self, chunks: list[str]) -> list[list[int]]:
        """The model sets a blank before what it is given: a chunk's own first blank, or one that is taken off."""
        out = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [(ids or [self.blank]) if c[0] == " " else ids[1:] for c, ids in zip(chunks, out)]

    def learn(self, chunks: list[str]) -> None:
        for found in (chunks[i:i + 4096] for i in range(0, len(chunks), 4096)):
            self.index.update(zip(found, range(len(self.index), len(self.index) + len(found))))
            raw = [c.encode() for c in found]
            sizes, good = np.array([len(r) for r in raw]), np.ones(len(found), bool)
            sides = (self._a_ids(found), self._b_ids(found))
            for side, (lists, words) in enumerate(zip(sides, (self.a_bytes, self.b_bytes))):
                flat, n = list(chain.from_iterable(lists)), np.array([len(x) for x in lists])
                self.ends[side].extend(self.ids[side].n + np.cumsum(n))
                self.ids[side].extend(flat)
                spelt = list(map(words.__getitem__, flat))
                ends = np.cumsum([0, *map(len, spelt)])[np.cumsum(n)]
                if not (np.array_equal(ends, np.cumsum(sizes)) and b"".join(spelt) == b"".join(raw)):
                    good &= [b"".join(map(words.__getitem__, x)) == r for x, r in zip(lists, raw)]
            self.good.extend(good)

    def places(self, chunks: list[str]) -> np.ndarray:
        """Row of each chunk in the remembered list arrays."""
        if len(self.index) > CACHED:
            self.forget()
        new = [c for c in dict.fromkeys(chunks) if c not in self.index]
        if new:
            self.learn(new)
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def lists(self, side: int) -> pa.ListArray:
        ids, ends = self.ids[side], self.ends[side]
        return pa.ListArray.from_arrays(pa.array(ends.data[:ends.n]), pa.array(ids.data[:ids.n]))


def _separable(a, pieces: list[str]) -> None:
    """Raises if a token could reach over a chunk border (a blank or line end after a visible character)."""
    state = json.loads(a.to_str())
    plain = not state["normalizer"] and (state["pre_tokenizer"] or {}).get("type") == "ByteLevel" and (
        not state["pre_tokenizer"].get("add_prefix_space"))
    if not plain or any("\n" in p or BLANK_PIECE in p.lstrip(BLANK_PIECE) for p in pieces):
        raise ValueError("these tokenizers join text over blanks; chunks cannot be encoded on their own")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)


_WORKER: list[Encoders] = []


def _encoders(paths: tuple[str, str]) -> Encoders:
    """One for each Python worker; Spark reuses workers for many tasks."""
    if not _WORKER or _WORKER[0].paths != paths:
        _WORKER[:] = [Encoders(*paths)]
    return _WORKER[0]


def _parts(text: str) -> Iterator[str]:
    """Blank plus text in parts of about ``UNIT`` characters that end at chunk borders."""
    text, at = " " + text, 0
    while at < len(text):
        cut = BORDER.search(text, at + UNIT) if len(text) - at > UNIT else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _strings(ids: pa.Array, names: pa.Array, common: np.ndarray) -> pa.Array:
    """Decimal ids of each group, joined by commas; ``common``: whether a group ends with the token."""
    offsets = np.concatenate([[0], np.flatnonzero(common) + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(ids)), ",")


def align(places: np.ndarray, owner: np.ndarray, n_docs: int, known: Encoders) -> dict:
    """Counts, groups and pair counts of ``n_docs`` pieces of text.

    ``places``: remembered chunks in text order; ``owner``: the piece of each chunk (ascending).
    """
    sides = []
    for side, sizes in ((0, known.a_size), (1, known.b_size)):
        lists = known.lists(side).take(pa.array(places))
        ids = lists.flatten()
        piece = owner[pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)]
        ends = pc.cumulative_sum(sizes.take(ids)).to_numpy()
        tokens = np.bincount(piece, minlength=n_docs)
        last = np.cumsum(tokens) - 1
        before = np.where(np.cumsum(tokens) > tokens, ends[last - tokens], 0)     # bytes of the pieces before
        key = (piece.astype(np.int64) << 40) | (ends - before[piece])
        sides.append((pa.table({"key": pa.array(key), f"id{side}": ids}), tokens))
    (a, n_a), (b, n_b) = sides
    links = a.join(b, "key", join_type="full outer", use_threads=False).combine_chunks()
    links = links.take(pc.sort_indices(links["key"]))
    piece = links["key"].to_numpy() >> 40
    at_a, at_b = (pc.is_valid(links[c]).to_numpy() for c in ("id0", "id1"))
    common = at_a & at_b
    n_groups = np.bincount(piece[common], minlength=n_docs)
    groups = pc.binary_join_element_wise(
        _strings(links["id0"].drop_null().combine_chunks(), known.a_text, common[at_a]),
        _strings(links["id1"].drop_null().combine_chunks(), known.b_text, common[at_b]), "|")
    offsets = np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)
    ids = [pc.fill_null_backward(links[c]).to_numpy().astype(np.int64) for c in ("id0", "id1")]
    width = _width(known)
    pairs = pa.table({"key": (piece << 2 * width) | (ids[0] << width) | ids[1]}).group_by(
        "key", use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(pairs["key"].to_numpy())
    key, times = pairs["key"].to_numpy()[order], pairs["count_all"].to_numpy()[order]
    n_pairs = np.bincount(key >> 2 * width, minlength=n_docs)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.bincount(piece, minlength=n_docs),
            "groups": pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";").to_pylist(),
            "pairs": key & ((1 << 2 * width) - 1), "times": times, "at": np.concatenate([[0], np.cumsum(n_pairs)])}


def _width(known: Encoders) -> int:
    """Bits of an id in a pair."""
    return max(len(known.a_bytes), len(known.b_bytes) - 1).bit_length()


class _Open:
    """A document whose pieces are being added up."""

    def __init__(self):
        self.counts = np.zeros(4, np.int64)
        self.hash, self.pieces = hashlib.sha256(), 0
        self.pairs, self.times = [], []

    def add(self, found: dict, i: int) -> None:
        self.counts += [found[c][i] for c in ("n_a", "n_b", "n_groups", "n_links")]
        self.hash.update((";" if self.pieces else "").encode() + found["groups"][i].encode())
        self.pieces += 1
        part = slice(found["at"][i], found["at"][i + 1])
        self.pairs.append(found["pairs"][part])
        self.times.append(found["times"][part])

    def row(self, good: bool) -> tuple:
        if not good or not self.pieces:
            return 0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        pairs, times = np.concatenate(self.pairs), np.concatenate(self.times)
        if self.pieces > 1:
            pairs, where = np.unique(pairs, return_inverse=True)
            times = np.bincount(where, times).astype(np.int64)
        return *self.counts.tolist(), self.hash.hexdigest(), pairs, times


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned_documents(df: DataFrame, id_col: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """A row for each document: counts, hash, its distinct id pairs and how often each is linked in it."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _encoders(paths)
        for b in batches:
            rows: list[tuple] = []
            now: dict[int, _Open] = {}
            spoiled: set[int] = set()
            waiting, held = [], 0

            def work():
                chunks = [CHUNK.findall(part) for _, part in waiting]
                places = known.places([c for x in chunks for c in x])
                owner = np.repeat(np.arange(len(chunks)), [len(x) for x in chunks])
                bad = np.unique(owner[~known.good.data[places]]).tolist()
                spoiled.update(waiting[i][0] for i in bad)
                if bad:                                  # their documents have no tokens
                    left = ~np.isin(owner, bad)
                    places, owner = places[left], owner[left]
                if len(places):
                    found = align(places, owner, len(chunks), known)
                    for i, (row, _) in enumerate(waiting):
                        if i not in bad:
                            now[row].add(found, i)
                waiting.clear()

            def close():
                for row in sorted(now):
                    rows.append(now[row].row(row not in spoiled))
                now.clear()

            def batch(first: int):
                cols = list(zip(*rows))
                lists = []
                for c in cols[5:]:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in c])]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(c))))
                out = pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(rows)), *(pa.array(c, pa.int64()) for c in cols[:4]),
                     pa.array(cols[4]), *lists],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                rows.clear()
                return out

            done = 0
            for row in range(b.num_rows):
                value = b.column(1)[row].as_py()
                now[row] = _Open()
                for part in _parts(value) if value else ():
                    waiting.append((row, part))
                    held += len(part)
                    if held >= UNIT:
                        work()
                        held = 0
                if not waiting and (not held):           # everything up to here is aligned
                    close()
                    if len(rows) >= 256:
                        n = len(rows)
                        yield batch(done)
                        done += n
            if waiting:
                work()
            close()
            if rows:
                yield batch(done)

    return df.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(run, f"id {kind}, {ALIGNED}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows ``(pair, docs)``: how many documents hold each id pair linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            t = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("docs", "sum")])
            return t.rename_columns(["pair", "docs"])

        for b in batches:
            pairs = b.column(0).flatten()
            held.append(pa.table({"pair": pairs, "docs": pa.array(np.ones(len(pairs), np.int64))}))
            if sum(t.num_rows for t in held) > PAIRS_HELD:
                held = [merged()]
                if held[0].num_rows > PAIRS_HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
        if held:
            yield from merged().to_batches(max_chunksize=1 << 16)

    partial = aligned.select("pairs").mapInArrow(run, "pair long, docs long")
    return partial.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _heavy(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The pairs (ascending), counts and best marks of at most ``HEAVY`` pairs, and the count they start at."""
    size = F.floor(F.log2("docs")).cast("int")
    n_by = {r[0]: r[1] for r in counts.groupBy(size.alias("s")).count().collect()}      # 64 rows at most
    least, total = 64, 0
    for s in sorted(n_by, reverse=True):
        total += n_by[s]
        if total > HEAVY:
            break
        least = s
    chosen = counts.filter(F.col("docs") >= F.lit(float(2.0 ** least)))
    t = chosen.select("pair", "docs", "best").toArrow().sort_by("pair")                 # HEAVY rows at most
    return (t["pair"].to_numpy(), t["docs"].to_numpy(), t["best"].to_numpy().astype(np.int64), least)


def token_alignment(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                    paths: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' alignment (one row each) and the corpus counts ``(a_id, b_id, docs, best)``."""
    spark = df.sparkSession
    paths = tuple(paths or default_paths())
    known = Encoders(*paths)
    width = _width(known)
    folder = scratch_path(spark, "aligned")
    aligned_documents(df, id_col, text, paths).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    aligned = spark.read.parquet(folder)
    counts = saved(pair_counts(aligned))
    top = counts.groupBy(F.shiftright("pair", width).alias("a_id")).agg(F.max("docs").alias("top"))
    counts = saved(counts.withColumn("a_id", F.shiftright("pair", width)).join(top, "a_id")
                   .withColumn("best", F.col("docs") == F.col("top")).select("pair", "a_id", "docs", "best"))
    pairs, docs, best, _ = _heavy(counts)

    def lookup(b: pa.RecordBatch) -> tuple:
        wanted = b.column("pairs").flatten().to_numpy()
        times = b.column("times").flatten().to_numpy()
        owner = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column("pairs")).to_numpy())
        at = np.minimum(np.searchsorted(pairs, wanted), max(len(pairs) - 1, 0))
        found = pairs[at] == wanted if len(pairs) else np.zeros(len(wanted), bool)
        return wanted, times, owner, at, found

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted, times, owner, at, found = lookup(b)
            edge = np.searchsorted(owner, np.arange(b.num_rows + 1))
            by_doc = []
            for value in (docs, best):
                total = np.zeros(len(wanted) + 1, np.int64)
                total[1:][found] = times[found] * value[at[found]]
                total = np.cumsum(total)
                by_doc.append(total[edge[1:]] - total[edge[:-1]])
            kept = {c: b.column(c) for c in b.schema.names if c not in ("pairs", "times")}
            yield pa.RecordBatch.from_pydict(kept | {"heavy_sum": by_doc[0], "heavy_best": by_doc[1]})

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted, times, owner, _, found = lookup(b)
            rows = b.column("row").to_numpy()[owner[~found]]
            yield pa.RecordBatch.from_pydict({"row": rows, "pair": wanted[~found], "times": times[~found]})

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    main = aligned.mapInArrow(sums, ", ".join(f"{c} {k}" for c, k in kinds.items() if c not in ("pairs", "times"))
                              + ", heavy_sum long, heavy_best long")
    rest = (aligned.select("row", "pairs", "times").mapInArrow(light, "row long, pair long, times long")
            .join(counts.select("pair", "docs", "best"), "pair")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("docs")).alias("light_sum"),
                                F.sum(F.col("times") * F.col("best").cast("long")).alias("light_best")))
    zero = F.lit(0).cast("long")
    out = main.join(rest, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        (F.col("heavy_best") + F.coalesce("light_best", zero)).alias("n_best"),
        (F.col("heavy_sum") + F.coalesce("light_sum", zero)).alias("count_sum"), "groups_sha256")
    table = counts.select("a_id", F.col("pair").bitwiseAND(F.lit((1 << width) - 1)).alias("b_id"), "docs", "best")
    return out, table


def document_alignment(docs: DataFrame) -> DataFrame:
    """Query form: one row for each document."""
    return token_alignment(docs)[0]
