"""Best-fit packing of token sequences by exact-complement hashing.

Documents become token pieces of at most ``capacity`` ids (an end id closes each
document; only longer documents are cut).  The packing is planned on the
histogram of piece lengths, which has at most ``capacity`` rows whatever the
data's size: the longest remaining length opens a sequence, and an index of the
sums of one, two and three available lengths tells whether its gap can be
closed exactly.  A found combination is consumed as often as the counts of its
lengths allow.  Where no exact complement exists the longest piece that fits is
taken (best fit) and the index asked again for the smaller gap.

The plan (a few thousand rows, bounded by the number of lengths) maps the n-th
piece of a length to a sequence and an offset; the pieces get their number from
one range shuffle of slim rows, so a hot length is split over many tasks.

Defined results: null texts are empty documents of one end id; equal rows are
packed once each; an empty table gives no rows.  Extra columns are not needed
and are not read.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import row_numbers, saved

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
CACHED = 20_000                        # chunks whose ids a Python worker remembers, in each of two generations
WORDS = 150_000                        # and words and runs of signs, which chunks are made of
BLOCK_BYTES = 1 << 22                  # text bytes split together, and one text more
BLANK = re.compile(r"[ \t\n\r]+")
SEPARATORS = re.compile("[\x1c-\x1f]")     # split() takes them for white space, the tokenizer does not
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
# characters that no other one changes: normalised they are themselves or their lower case, one by one
LETTERS, NUMBERS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-įĲ-ſ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
UNUSUAL = "[^\\x00-\\x1b\\x20-\u012f\u0132-\u017f\u2010-\u2027\u2030-\u205e]"
WORD_END = f"([{LETTERS}])([^{LETTERS}{BLANKS}])"       # the tokenizer splits here, whatever follows
TOKENS = re.compile(f"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[^{LETTERS}{NUMBERS}{BLANKS}]+")

# fixed values: the steps of the tokenizer whose chunks can be encoded on their own
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
          "behavior": "Removed", "invert": True},
         {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


def _byte_level() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for 256 and up in order."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in same]
    return {b: 256 + i for i, b in enumerate(moved)}


BYTE_LEVEL = _byte_level()


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


class TokenIds(dict):
    """Ids (little-endian bytes) of the model's input strings: lower words, numbers and runs of signs."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, token: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        plain = token.isascii() and token.isalpha()
        mapped = token if plain else token.encode("utf-8").decode("latin-1").translate(BYTE_LEVEL)
        found = pack_ids([t.id for t in self.model.tokenize(mapped)])
        if len(token) <= 64:
            self[token] = found
        return found


class ChunkIds(dict):
    """Ids (little-endian bytes) of text between white space.

    The tokenizer turns white space into separators and drops it, so a text's ids are those of its
    chunks one after the other.  Texts of usual characters (Latin letters and signs, no special token)
    are lowered and split by Arrow, many at a time; each different chunk of them is split further as
    the tokenizer does it, and its words and signs go to the tokenizer's model.  Chunks of other texts
    go to the tokenizer; those of Latin-1 letters and closing punctuation to the model word by word: its
    normalisation only lowers them and its splitting parts the letters from the punctuation.
    All this holds for tokenizers with the steps ``NORMAL`` and ``SPLIT`` only; others encode whole texts.
    Two generations of ``CACHED`` chunks and one of ``WORDS`` strings bound the memory.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.simple = _steps(self.tokenizer.normalizer) == NORMAL and _steps(self.tokenizer.pre_tokenizer) == SPLIT
        self.words = TokenIds(self.tokenizer.model)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = "|".join([UNUSUAL, *added])
        self.old: dict[str, bytes] = {}

    def _encode(self, chunk: str) -> bytes:
        return pack_ids(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            plain = PLAIN.fullmatch(chunk)
            if plain is None:
                found = self._encode(chunk)
            else:
                found = self.words[plain[1].lower()]
                if plain[2]:
                    found += self[plain[2]] if plain[2] != chunk else self._encode(chunk)
        if len(chunk) <= 64:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def of_text(self, text: str | None) -> bytes:
        text = text or ""
        if not self.simple:
            return self._encode(text)
        return b"".join(map(self.__getitem__, BLANK.split(text) if SEPARATORS.search(text) else text.split()))

    def _usual(self, chunk: str) -> bytes:
        return self.words[chunk] if chunk.isalpha() else b"".join(map(self.words.__getitem__, TOKENS.findall(chunk)))

    def of_texts(self, texts: pa.Array) -> list[bytes]:
        """:meth:`of_text` of every text."""
        texts = pc.fill_null(texts, "")
        if not self.simple:
            return list(map(self.of_text, texts.to_pylist()))
        chunks = pc.utf8_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), WORD_END, r"\1 \2"))
        other = pc.match_substring_regex(texts, self.other, ignore_case=True).to_numpy(False)
        if other.any():
            chunks = pc.if_else(pa.array(other), pa.scalar([], chunks.type), chunks)
        coded = chunks.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        found = list(map(self._usual, coded.dictionary.to_numpy(False).tolist()))
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        count = size[code]                                          # ids of every chunk
        end = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        kind = np.int32 if max(end[-1], len(ids)) < 1 << 31 else np.int64
        place = np.repeat(((np.cumsum(size, dtype=np.int64) - size)[code] - end[:-1]).astype(kind), count)
        place += np.arange(len(place), dtype=kind)
        raw = memoryview(ids.take(place)).cast("B")
        cut = 4 * end[np.concatenate(([0], np.cumsum(pc.list_value_length(chunks).to_numpy(False), dtype=np.int64)))]
        out = [bytes(raw[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i in np.flatnonzero(other).tolist():
            out[i] = self.of_text(texts[i].as_py())
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``BLOCK_BYTES`` of text."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy().astype(np.int64)
        block = (np.cumsum(size) - size) // BLOCK_BYTES
        cut = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), b.num_rows]
        for start, end in zip(cut[:-1], cut[1:]):
            yield b.slice(start, end - start)


def _steps(part) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer."""
    state = json.loads(part.__getstate__()) if part is not None else {}
    return state.get("normalizers", state.get("pretokenizers", [state]))


_REMEMBERED: list[ChunkIds] = []


def chunk_ids(path: str) -> ChunkIds:
    """One cache for each Python worker; Spark reuses workers for many tasks."""
    if not _REMEMBERED or _REMEMBERED[0].path != path:
        _REMEMBERED[:] = [ChunkIds(path)]
    return _REMEMBERED[0]


def forget_chunks() -> None:
    """Gives the memory of the remembered chunks back to the system; idle workers outlive their stage."""
    if _REMEMBERED:
        _REMEMBERED.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):          # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def token_pieces(df: DataFrame, id_col: str, text: str, path: str, capacity: int, with_ids: bool) -> DataFrame:
    """Rows ``(id, piece, start, length, ids_crc32[, ids])``."""
    kind = df.schema[id_col].dataType.simpleString()
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = chunk_ids(path)
        for b in _blocks(batches):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(ids_of.of_texts(b.column(1))):
                raw += end
                for p, at in enumerate(range(0, len(raw), width)):
                    part = raw[at:at + width]
                    row.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return df.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(
        run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class SumIndex:
    """Which gaps one, two or three available lengths can close."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        self.one = self.counts > 0
        self.one[0] = False
        size = 1 << int(np.ceil(np.log2(2 * len(self.one))))
        f = np.fft.rfft(self.one, size)
        self.two = np.fft.irfft(f * f, size)[:len(self.one)] > 0.5
        self.three = np.fft.irfft(f * np.fft.rfft(self.two, size), size)[:len(self.one)] > 0.5

    def _pair(self, gap: int, left) -> list[int] | None:
        if gap < 2 or not self.two[gap]:
            return None
        a = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        for x in a[self.one[a] & self.one[gap - a]]:
            x = int(x)
            if left(x) > (x == gap - x) and left(gap - x) > (x == gap - x):
                return [x, gap - x]
        return None

    def close(self, gap: int, used: list[int]) -> list[int] | None:
        """Lengths that fill ``gap`` exactly, the longest first; ``used`` are already taken."""
        def left(x: int) -> int:
            return int(self.counts[x]) - used.count(x)

        if self.one[gap] and left(gap) > 0:
            return [gap]
        if pair := self._pair(gap, left):
            return pair
        if gap >= 3 and self.three[gap]:
            a = np.arange(gap - 2, 0, -1)
            for x in a[self.one[a] & self.two[gap - a]]:
                x = int(x)
                if left(x) > 0 and (pair := self._pair(gap - x, lambda y: left(y) - (y == x))):
                    return [x, *pair]
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    index, out = SumIndex(counts), []
    for longest in range(capacity, 0, -1):
        while counts[longest] > 0:
            used, gap = [longest], capacity - longest
            while gap > 0:
                if more := index.close(gap, used):
                    used += more
                    gap = 0
                    break
                fits = np.flatnonzero(counts[1:gap + 1])[::-1] + 1
                best = next((int(x) for x in fits if counts[x] > used.count(int(x))), 0)
                if not best:
                    break
                used.append(best)
                gap -= best
            times = min(int(counts[x]) // k for x, k in Counter(used).items())
            ended = False
            for x, k in Counter(used).items():
                counts[x] -= k * times
                ended |= counts[x] == 0
            out.append((tuple(used), times))
            if ended:
                index.refresh()
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per pattern slot: the first rank of its run of pieces, their first sequence, the offset."""
    taken, rows, sequence = Counter(), [], 0
    for used, times in patterns:
        at = 0
        for x in used:
            rows.append((x, taken[x], sequence, at))
            taken[x] += times
            at += x
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return {"length": cols[0], "rank": cols[1], "sequence": cols[2], "offset": cols[3]}


def pack(df: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Rows ``(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids])``."""
    path = tokenizer or default_tokenizer()
    pieces = saved(token_pieces(df, id_col, text, path, capacity, with_ids))
    histogram = dict(pieces.groupBy("length").count().toLocalIterator())        # capacity rows at most
    where = places(plan(histogram, capacity))
    first = np.zeros(capacity + 2, np.int64)
    for length, n in histogram.items():
        first[length + 1] = n
    first = np.cumsum(first)
    keys = where["length"] * (1 << 44) + where["rank"]
    numbered, _ = row_numbers(pieces, [F.col(c) for c in ("length", "id", "piece", "ids_crc32")], "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_chunks()                                    # the pieces are saved
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("n").to_numpy() - first[length]
            slot = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            out = {n: b.column(n) for n in names}
            out["sequence_id"] = pa.array(where["sequence"][slot] + rank - where["rank"][slot])
            out["offset"] = pa.array(where["offset"][slot])
            yield pa.RecordBatch.from_pydict(out)

    names = pieces.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    out = numbered.select(*names, "n").mapInArrow(run, f"{kinds}, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
