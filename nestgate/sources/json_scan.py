"""Whole JSON files as splittable input (S6/S7): a structural scan whose transitions compose.

A file that holds one JSON value over many lines (usually an array of objects) cannot be cut at
line ends.  Here it is read in pieces that end at ``}``, so the file source splits it like any text, and
every split is scanned on its own:

1. For each of the two ways a split can begin (inside or outside a string) one pass notes what the
   split does: how it ends, how the depth of brackets changes, the lowest depth it reaches, and the
   bracket that opens after that.  These transitions compose, so a fold over the splits of a
   file, one small row each, gives every split its true beginning.  Only files of several splits need this.
2. With its beginning known, each split cuts out the elements of the top array (or the top object) in one
   pass.  Elements that cross split borders come as fragments and are put together by file.

What stands outside the value, a second value, brackets that do not match, empty elements and an unclosed end
are reported; no element is lost, also when a file holds several values.

The rows of step 1 (at most one for each ``spark.sql.files.maxPartitionBytes`` of input) pass through the driver,
which holds the same splits to plan the scan.  A task holds one batch and one unfinished element.

Packed files (:mod:`nestgate.sources.packed_text`) come in frames of whole lines instead of pieces; they are split
and scanned the same way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestgate.sources.packed_text import OPTIONS, unpack

PIECE_END = b"}"
ESCAPED = re.compile(rb"\\.", re.DOTALL)
QUOTE, COMMA, OPEN_LIST, CLOSE_LIST, OPEN_OBJECT, CLOSE_OBJECT = b'",[]{}'
MARKS = np.zeros(256, bool)
MARKS[list(b'",[]{}')] = True
STEP = np.zeros(256, np.int64)
STEP[[OPEN_LIST, OPEN_OBJECT]] = 1
STEP[[CLOSE_LIST, CLOSE_OBJECT]] = -1
BLANK = b" \t\r\n"
SLASHES = re.compile("^file:/+")


def marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and characters of quotes, commas and brackets, and the number of quotes up to each (mod 2).

    Pieces end at a bracket, so no escape is open where ``data`` begins.
    """
    if b"\\" in data:
        data = ESCAPED.sub(b"__", data)
    chars = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(MARKS[chars])
    chars = chars[at]
    return at, chars, np.cumsum(chars == QUOTE) & 1


# What bytes do to the scan, for a beginning outside (0) and inside (1) a string:
# (inside at the end, change of depth, lowest depth, bracket that opens after the last lowest point or 0)
Transition = tuple[tuple[int, int, int, int], tuple[int, int, int, int]]
NOTHING: Transition = ((0, 0, 0, 0), (1, 0, 0, 0))


def transition(data: bytes) -> Transition:
    _, chars, odd = marks(data)
    flips = int(odd[-1]) if len(odd) else 0
    out = []
    for inside in (0, 1):
        brackets = chars[(odd == inside) & (STEP[chars] != 0)]
        depth = np.cumsum(STEP[brackets])
        low = min(0, int(depth.min(initial=0)))
        lowest = np.flatnonzero(depth == low)
        after = int(lowest[-1]) + 1 if len(lowest) else 0
        out.append((inside ^ flips, int(depth[-1]) if len(depth) else 0, low,
                    int(brackets[after]) if after < len(brackets) else 0))
    return tuple(out)


def compose(first: Transition, second: Transition) -> Transition:
    out = []
    for inside, change, low, opens in first:
        inside2, change2, low2, opens2 = second[inside]
        later = change + low2 <= low
        out.append((inside2, change + change2, min(low, change + low2), opens2 if later else opens))
    return tuple(out)


def _pieces(spark: SparkSession, path: str | list[str], packed: bool) -> DataFrame:
    return (spark.read.options(**(OPTIONS if packed else {"lineSep": PIECE_END.decode()})).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_block_length").alias("length"), F.col("_metadata.file_size").alias("size"),
                    F.col("value").cast("binary").alias("piece")))


def _runs(batches: Iterator[pa.RecordBatch], packed: bool) -> Iterator[tuple[str, int, int, int, bytes]]:
    """``(file, block, length, size, bytes)`` of neighbouring pieces of one split in a batch, or of a packed one."""
    for b in batches:
        files, blocks = b.column("file").to_pylist(), b.column("block").to_numpy()
        lengths, sizes = b.column("length").to_numpy(), b.column("size").to_numpy()
        if packed:
            for i, piece in enumerate(b.column("piece")):
                yield files[i], int(blocks[i]), int(lengths[i]), int(sizes[i]), unpack(piece.as_buffer())
            continue
        pieces, start = b.column("piece").to_pylist(), 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or blocks[i] != blocks[start] or files[i] != files[start]:
                yield (files[start], int(blocks[start]), int(lengths[start]), int(sizes[start]),
                       PIECE_END.join(pieces[start:i]))
                start = i


SUMMARY = "file string, block long, size long, n_bytes long, states array<long>"


def _summaries(batches: Iterator[pa.RecordBatch], packed: bool = False) -> Iterator[pa.RecordBatch]:
    """Step 1: a row for each split, its transition without and with the end of its last piece."""
    now, rows, end = None, [], b"" if packed else PIECE_END

    def close():
        (file, block, size), (n, done) = now
        both = (done, compose(done, transition(end)))
        rows.append((file, block, size, n, [x for t in both for state in t for x in state]))

    for file, block, _, size, data in _runs(batches, packed):
        if now is None or now[0] != (file, block, size):
            if now is not None:
                close()
            now = ((file, block, size), (0, NOTHING))
            lead = b""
        else:
            lead = end                            # of the piece before
        n, done = now[1]
        now = (now[0], (n + len(data) + 1, compose(done, transition(lead + data))))
    if now is not None:
        close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "block", "size", "n_bytes", "states"])


def _beginnings(summaries: list) -> tuple[dict, set, set]:
    """``{(file, block): (inside, depth, top bracket)}``, the splits that hold the end of their file, and
    those of them whose last piece lacks its bracket (the reader does not say; the size does)."""
    begins: dict[tuple[str, int], tuple[int, int, int]] = {}
    ends, lacking = set(), set()
    by_file: dict[str, list] = {}
    for r in summaries:
        by_file.setdefault(r["file"], []).append(r)
    for file, splits in by_file.items():
        state = (0, 0, 0)
        splits.sort(key=lambda r: r["block"])
        ends.add((file, splits[-1]["block"]))
        if sum(r["n_bytes"] for r in splits) > splits[-1]["size"]:
            lacking.add((file, splits[-1]["block"]))
        for r in splits:
            begins[file, r["block"]] = state
            inside, depth, top = state
            now, change, low, opens = r["states"][8 + 4 * inside:12 + 4 * inside]
            state = (now, depth + change, opens if depth + low <= 0 else top)
    return begins, ends, lacking


class Cutter:
    """Cuts one split into elements; see :data:`CUT` for what it gives."""

    def __init__(self, inside: int, depth: int, top: int):
        self.inside, self.depth, self.top = inside, depth, top
        self.held: list[bytes] = []
        self.left = -1                          # bracket or comma before the open segment; -1: in another split
        self.broken = depth < 0
        self.order = 0
        self.out: list[tuple] = []

    def emit(self, kind: str, left: int, right: int, text: bytes) -> None:
        self.out.append((self.order, kind, left, right, text.decode("utf-8", "replace")))
        self.order += 1

    def segment(self, right: int, text: bytes, depth: int) -> None:
        """A segment that ends at ``right`` (-1: with the split); ``depth`` inside the segment."""
        text = b"".join(self.held) + text
        self.held = []
        if depth == 0:
            if text.strip(BLANK):
                self.emit("problem", 0, 0, b"outside: " + text.strip(BLANK)[:80])
        elif self.left == -1 and right == -1:
            self.emit("middle", -1, -1, text)
        elif self.left == -1:
            self.emit("head", -1, right, text)
        elif right == -1:
            self.emit("tail", self.left, -1, text)
        else:
            self.emit("element", self.left, right, text)

    def feed(self, data: bytes) -> None:
        if self.broken:
            return
        at, chars, odd = marks(data)
        outside = (odd == self.inside) & (chars != QUOTE)
        if len(odd):
            self.inside ^= int(odd[-1])
        at, chars = at[outside], chars[outside]
        step = STEP[chars]
        after = self.depth + np.cumsum(step)
        before = after - step
        cut = ((before == 0) & (step > 0)) | ((after == 0) & (step < 0)) | ((chars == COMMA) & (after == 1)) | (after < 0)
        done = 0
        for i in np.flatnonzero(cut).tolist():
            c, p = int(chars[i]), int(at[i])
            if after[i] < 0:
                self.emit("problem", 0, 0, b"a bracket closes nothing")
                self.broken = True
                return
            if step[i] > 0:                                  # a value opens
                self.segment(c, data[done:p], 0)
                self.emit("value", 0, 0, b"")
                self.top, self.left = c, c
                done = p if c == OPEN_OBJECT else p + 1
            elif c == COMMA:
                if self.top == OPEN_LIST:
                    self.segment(c, data[done:p], 1)
                    self.left, done = c, p + 1
            else:                                            # it closes
                self.segment(c, data[done:p + (c == CLOSE_OBJECT)], 1)
                if c - self.top != 2:                        # ] and } follow [ and { at a distance of two
                    self.emit("problem", 0, 0, b"brackets do not match")
                self.left, done = 0, p + 1
        self.depth = int(after[-1]) if len(after) else self.depth
        self.held.append(data[done:])

    def finish(self, ends_file: bool) -> None:
        if self.broken:
            return
        if ends_file and (self.depth or self.inside):
            self.emit("problem", 0, 0, b"unclosed")
        self.segment(-1, b"", self.depth)


CUT = "file string, block long, ord long, kind string, left int, right int, text string"
NAMES = ["file", "block", "ord", "kind", "left", "right", "text"]
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()]


def _cut(spark: SparkSession, path: str | list[str], packed: bool = False) -> DataFrame:
    """Step 2: rows of kind ``element``, ``tail``, ``middle`` and ``head`` (fragments), ``value`` and ``problem``."""
    pieces, end = _pieces(spark, path, packed), b"" if packed else PIECE_END      # packed pieces hold their ends
    several = pieces.filter("length < size")
    summaries = several.mapInArrow(lambda batches: _summaries(batches, packed), SUMMARY).collect()     # a row for each split
    begins, ends, lacking = _beginnings(summaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cutter, n_bytes, rows = None, None, 0, []

        def take():
            rows.extend((now[0], now[1], *x) for x in cutter.out)
            cutter.out.clear()

        def close():
            file, block, length, size = now
            whole = length >= size
            if not (n_bytes > size if whole else (file, block) in lacking):
                cutter.feed(end)
            cutter.finish(whole or (file, block) in ends)
            take()

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)
            rows.clear()
            return out

        for file, block, length, size, data in _runs(batches, packed):
            if now is None or now[:2] != (file, block):
                if now is not None:
                    close()
                now, n_bytes = (file, block, length, size), 0
                cutter = Cutter(*begins.get((file, block), (0, 0, 0)))
            else:
                cutter.feed(end)                      # of the piece before
            cutter.feed(data)
            n_bytes += len(data) + 1
            take()
            if len(rows) >= 4096:
                yield batch()
        if now is not None:
            close()
        if rows:
            yield batch()

    return pieces.mapInArrow(run, CUT)


def _joined(cut: DataFrame) -> DataFrame:
    """Elements that cross split borders, from their fragments; ``right`` is -1 where the end is missing."""
    parts = cut.filter(F.col("kind").isin("tail", "middle", "head"))
    begun = F.count_if(F.col("kind") == "tail").over(Window.partitionBy("file").orderBy("block", "ord"))
    part = F.struct("block", "ord", "text")
    return (parts.withColumn("element", begun).groupBy("file", "element").agg(
        F.min_by("block", part).alias("block"), F.min_by("ord", part).alias("ord"), F.lit("element").alias("kind"),
        F.max("left").alias("left"), F.max("right").alias("right"),
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["text"]), "").alias("text")).drop("element"))


def is_one_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else (the parser alone would stop after the first value)."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    items = listed.try_cast("array<variant>")
    return F.coalesce(named.isNotNull() & (F.size(items) == 1)
                      & F.get(items, F.lit(0)).try_cast("map<string,variant>").isNotNull(), F.lit(False))


def json_elements(spark: SparkSession, path: str | list[str], with_problems: bool = False,
                  packed: bool = False) -> DataFrame:
    """``(file, block, ord, text)``: the top object, or the elements of the top array, of every file.

    ``block`` and ``ord`` give the order in the file.  ``with_problems``: also text that is in no element
    (outside the value, or an element whose end is missing), as rows like the others.  ``packed``: files as in
    :mod:`nestgate.sources.packed_text`.
    """
    cut = _cut(spark, path, packed)
    blank = F.trim(F.col("text"), F.lit(BLANK.decode())) == ""
    taken = ~blank & (F.lit(with_problems) | (F.col("right") != -1))
    whole = (F.col("kind") == "element") & taken | F.lit(with_problems) & (F.col("kind") == "problem")     # in one scan
    return cut.filter(whole).unionByName(_joined(cut).filter(taken)).select("file", "block", "ord", "text")


def json_problems(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file_path, problem, n)``: what keeps a file from being one object or one array of objects.

    Problems: text outside the value, brackets that do not match or close nothing, an unclosed end, empty
    elements, elements that are no JSON object, more than one value, no value (also: an empty file).
    """
    cut = _cut(spark, path)
    blank = F.trim(F.col("text"), F.lit(BLANK.decode())) == ""
    alone = (F.col("left") == OPEN_LIST) & (F.col("right") == CLOSE_LIST)
    element = (F.when(F.col("right") == -1, F.lit(None))                        # its end is missing: reported as unclosed
               .when(blank, F.when(~alone, "empty element")).when(~is_one_object(F.col("text")), "not an object"))
    named = F.when(F.col("kind") == "problem", F.regexp_extract("text", "^[^:]*", 0)).when(F.col("kind") == "element", element)
    rows = cut.filter(F.col("kind").isin("element", "problem", "value")).unionByName(_joined(cut))
    per_file = rows.groupBy("file", "kind", named.alias("problem")).agg(F.count("*").alias("n"))
    problems = per_file.filter("problem is not null").select("file", "problem", "n")
    several = per_file.filter("kind = 'value' and n > 1").select("file", F.lit("several values").alias("problem"), "n")
    # scans leave out files without bytes; the listing that the driver plans them with has these too
    # (with more slashes after ``file:``)
    files = spark.read.format("binaryFile").load(path).inputFiles()
    listed = spark.createDataFrame([(SLASHES.sub("file:/", f),) for f in files], "file string")
    valued = per_file.filter("kind = 'value'").select(F.regexp_replace("file", SLASHES.pattern, "file:/").alias("file"))
    none = listed.join(valued, "file", "left_anti").select(
        "file", F.lit("no value").alias("problem"), F.lit(1).cast("long").alias("n"))
    out = problems.unionByName(several).unionByName(none)
    return out.groupBy(F.col("file").alias("file_path"), "problem").agg(F.sum("n").alias("n"))
