"""Conversation structure repair: the cheapest edits that give ``s?(ua)+`` turns, by a run-length DP.

1. Turns get a gapless number in the order (conversation, turn with nulls first, role, text); a range
   shuffle with a salt, so a conversation of any length is spread over many tasks.
2. A turn's first fault counts: blank, duplicate (role and text seen earlier in the conversation; the
   earliest number of each role and text digest comes from a partial aggregate) or truncated.  Role
   initial and fault make one symbol.
3. Symbols are gathered in segments of at most ``SEGMENT`` turns.  A conversation's segments pass from
   the last to the first: equal consecutive symbols are one run, and the costs to the end move over a run
   by the cached binary powers of the symbol's min-plus transition.  For each state in which a
   segment can be entered the choices are unrolled, the ASCII-least cheapest edit first.
4. Turns, sorted by conversation and number, stream past their segments' edits; a task holds one batch.

A conversation's audit and hash are one string each over its turns in order, so the last step reads a
conversation in one task, as a stream; everything before it is split by number.

Edits: K keep, R change the role to user or assistant, D delete, I insert an empty user or assistant
turn.  Costs: 0, 3, 4, 3; a truncated turn that stays adds 3; blank and duplicate turns must go.

Defined results: nulls in role and text are one space; null turns come first and are left out of the
gaps; a null conversation id is a conversation like others.  Turns with the same number of turn follow
by role, the text's first 32 characters and its digest.  Roles go by their first character; roles that
begin with none of s, u, a (or are empty) cannot be kept.  A conversation without turns has zeros, an empty
audit and the hash of the empty string.  Long texts are read whole; an empty table gives no rows.  Only
the four columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import SPACES, row_numbers

SEGMENT = 4096
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)          # what the repaired turns end with so far
NEXT = (USER, USER, ASSISTANT, USER)               # what an inserted or changed turn becomes
LAST = (0, 2 * INSERT, INSERT, 0)                  # least cost after the last turn
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAULTS = {"b": "blank", "d": "duplicate"}          # symbols; the others are initials, in capitals when truncated
INF = 1 << 60


def _kept(state: int, symbol: str) -> int | None:
    """The state after keeping a turn, or None where it cannot stay."""
    if symbol in FAULTS:
        return None
    s = symbol.lower()
    if s == "s":
        return SYSTEM if state == START else None
    if s == "u":
        return USER if state != USER else None
    return ASSISTANT if s == "a" and state == USER else None


def _apply(matrix, costs):
    return tuple(min(m + c for m, c in zip(row, costs)) for row in matrix)


@lru_cache(None)
def _transition(symbol: str) -> tuple:
    """Min-plus matrix of one turn: insertions before it, then its own edit."""
    own = [[INF] * 4 for _ in range(4)]
    extra = CUT if symbol.isupper() else 0
    for q in range(4):
        own[q][q] = DELETE
        if symbol not in FAULTS:
            own[q][NEXT[q]] = min(own[q][NEXT[q]], REROLE + extra)
            if (t := _kept(q, symbol)) is not None:
                own[q][t] = min(own[q][t], extra)
    inserted = [own[q] for q in range(4)]
    rows = []
    for q in range(4):
        best, at = list(inserted[q]), q
        for n in (1, 2):
            at = NEXT[at]
            best = [min(x, n * INSERT + y) for x, y in zip(best, inserted[at])]
        rows.append(tuple(best))
    return tuple(rows)


@lru_cache(None)
def _power(symbol: str, k: int) -> tuple:
    """The transition of 2^k equal turns."""
    if k == 0:
        return _transition(symbol)
    half = _power(symbol, k - 1)
    return tuple(tuple(min(row[m] + half[m][q] for m in range(4)) for q in range(4)) for row in half)


def _over_run(symbol: str, n: int, costs: tuple) -> tuple:
    """Costs before a run of ``n`` equal turns from the costs after it."""
    k = 0
    while n:
        if n & 1:
            costs = _apply(_power(symbol, k), costs)
        n >>= 1
        k += 1
    return costs


def _step(state: int, symbol: str, before: tuple, after: tuple) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with this turn's own, and the state after it."""
    letters, extra = "", CUT if symbol.isupper() else 0
    while True:
        left = before[state]
        if DELETE + after[state] == left:
            return letters + "D", state
        if INSERT + before[NEXT[state]] == left:
            letters += "I"
            state = NEXT[state]
            continue
        t = _kept(state, symbol)
        if t is not None and extra + after[t] == left:
            return letters + "K", t
        return letters + "R", NEXT[state]


def unrolled(symbols: str, after: tuple, closes: bool) -> tuple[tuple, list[str], str]:
    """Costs before a segment, and for each state it can be entered in its edits and the state after it.

    ``closes``: the segment ends its conversation, so missing turns at the end are inserted.
    """
    runs = [(s, len(list(g))) for s, g in groupby(symbols)]
    ends = [after]
    for s, n in reversed(runs):
        ends.append(_over_run(s, n, ends[-1]))
    ends.reverse()
    found: list[list[str]] = [[] for _ in range(4)]
    states = list(range(4))
    for (s, n), end in zip(runs, ends[1:]):
        inner = [end]
        for _ in range(n):
            inner.append(_apply(_transition(s), inner[-1]))
        for i in range(n, 0, -1):
            steps = [_step(q, s, inner[i], inner[i - 1]) for q in range(4)]
            for e in range(4):
                letters, states[e] = steps[states[e]]
                found[e].append(letters)
    edits = ["".join(x) for x in found]
    if closes:
        edits = [x + "I" * (LAST[q] // INSERT) for x, q in zip(edits, states)]
    return ends[0], edits, "".join(map(str, states))


@lru_cache(1 << 14)
def _short(symbols: str, after: tuple, closes: bool) -> tuple[tuple, list[str], str]:
    """Short segments repeat: remembered."""
    return unrolled(symbols, after, closes)


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The contract's faults, by ``crc32('conv:turn') % 20``: dropped, emptied, cut, repeated, wrong role."""
    said, who = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)))
    k = F.crc32(name) % 20
    return (df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), who.alias("role"), said.alias("text"), k.alias("k"))
            .filter("k <> 0")
            .select("conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _symbol():
    """Blank, or the role's initial; duplicates are not known from the row."""
    visible = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (F.when(visible == "", "b")
            .when(F.substring(visible, -1, 1).isin(".", "!", "?"), initial).otherwise(F.upper(initial)))


def _plans(segments: DataFrame, kind: str) -> DataFrame:
    """Edits of each segment for every state it can be entered in; a conversation's segments from last to first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, costs, seen = None, LAST, False
        for b in batches:
            made = []
            for conv, symbols in zip(b.column("conv").to_pylist(), b.column("symbols").to_pylist()):
                closes = not seen or conv != now
                if closes:
                    costs = LAST
                costs, edits, states = (_short if len(symbols) <= 64 else unrolled)(symbols, costs, closes)
                now, seen = conv, True
                made.append((edits, states))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([e for e, _ in made], pa.list_(pa.string())), pa.array([s for _, s in made], pa.string())],
                ["conv", "block", "symbols", "edits", "states"])

    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = segments.repartition(n, "conv").sortWithinPartitions("conv", F.desc("block"))
    return dealt.mapInArrow(run, f"conv {kind}, block long, symbols string, edits array<string>, states string")


class _Repair:
    """A conversation's turns as they stream past: edits and repaired turns."""

    def __init__(self, conv):
        self.conv, self.place, self.state, self.entered, self.letters, self.at = conv, 0, START, START, "", 0
        self.symbols, self.row = "", 0

    def enter(self, symbols: str, edits: list[str], states: str) -> None:
        self.letters, self.at, self.symbols, self.row = edits[self.entered], 0, symbols, 0
        self.entered = int(states[self.entered])

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield self._out("I", NAMES[self.state], "", None, None, None)

    def turn(self, turn, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        letter, symbol = self.letters[self.at], self.symbols[self.row]
        self.at += 1
        self.row += 1
        fault = FAULTS.get(symbol, "truncated" if symbol.isupper() else None)
        new = role
        if letter == "K":
            self.state = _kept(self.state, symbol)
        elif letter == "R":
            self.state = NEXT[self.state]
            new = NAMES[self.state]
        yield self._out(letter, new, text, turn, role, fault)

    def _out(self, letter, role, text, turn, was, fault) -> tuple:
        self.place += 1
        return self.conv, self.place - 1, letter, role, text, turn, was, fault


EDITS = "place long, edit string, role string, text string, turn {turn}, original_role string, fault string"


def _stream(rows: DataFrame, kind: str, turn_kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Repair | None = None
        schema = None
        for b in batches:
            if schema is None:
                schema = pa.schema([("conv", b.schema.field("conv").type), ("place", pa.int64()), ("edit", pa.string()),
                                    ("role", pa.string()), ("text", pa.string()), ("turn", b.schema.field("turn").type),
                                    ("original_role", pa.string()), ("fault", pa.string())])
            out: list[tuple] = []
            for conv, part, turn, role, text, symbols, edits, states in zip(*(
                    b.column(c).to_pylist() for c in ("conv", "part", "turn", "role", "text", "symbols", "edits", "states"))):
                if part == 0:                            # the conversation begins
                    if now is not None:
                        out += now.inserted()
                    now = _Repair(conv)
                    out.append((conv, -1, None, None, None, None, None, None))
                elif part == 1:
                    now.enter(symbols, edits, states)
                else:
                    out += now.turn(turn, role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        if now is not None and (out := list(now.inserted())):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return rows.mapInArrow(run, f"conv {kind}, " + EDITS.format(turn=turn_kind))


def _streamed_edits(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Edit rows; every conversation's rows are in one partition, in order, after a marker row without edit.

    ``turns (conv, turn, role, text)`` without nulls in role and text; ``convs (conv)``: all conversations.
    """
    kind, turn_kind = (turns.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    keyed = turns.withColumn("digest", F.sha2("text", 256))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc(F.substring("text", 1, 32)), F.asc("digest")]
    numbered, _ = row_numbers(keyed, order, "pos")
    firsts = (numbered.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos"))
              .select("pos", F.lit(True).alias("first")))
    block = F.floor(F.col("pos") / SEGMENT).cast("long")
    segments = (numbered.select("conv", "pos", "role", "text", block.alias("block"))
                .withColumn("plain", _symbol()).select("conv", "pos", "block", "plain")
                .join(firsts, "pos", "left")
                .withColumn("symbol", F.when((F.col("plain") != "b") & F.col("first").isNull(), "d").otherwise(F.col("plain")))
                .groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("list"))
                .select("conv", "block", F.array_join("list.symbol", "").alias("symbols")))
    plans = _plans(segments, kind)
    none = {c: F.lit(None).cast(t) for c, t in (("pos", "long"), ("turn", turn_kind), ("role", "string"), ("text", "string"),
                                                ("symbols", "string"), ("edits", "array<string>"), ("states", "string"))}
    columns = ["conv", "block", "part", *none]
    begins = convs.select("conv").distinct().withColumns({"block": F.lit(-1).cast("long"), "part": F.lit(0)} | none)
    rows = begins.select(columns).unionByName(
        plans.withColumns({"part": F.lit(1)} | {c: none[c] for c in ("pos", "turn", "role", "text")}).select(columns)).unionByName(
        numbered.withColumns({"block": block, "part": F.lit(2)} | {c: none[c] for c in ("symbols", "edits", "states")}).select(columns))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _stream(rows.repartition(n, "conv").sortWithinPartitions("conv", "block", "part", "pos"), kind, turn_kind)


def _plain(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                     *(F.coalesce(F.col(a), F.lit(" ")).alias(b) for a, b in ((role, "role"), (text, "text"))))


def repaired_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Every edit of every conversation in order: ``(conv, place, edit, role, text, turn, original_role, fault)``.

    The repaired conversation is the rows whose edit is not D.
    """
    turns = _plain(df, conv, turn, role, text)
    return _streamed_edits(turns, turns).filter("edit is not null").withColumnRenamed("conv", conv)


class _Report:
    def __init__(self, conv):
        self.conv, self.cost, self.illegal, self.faults = conv, 0, 0, {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.initial = None
        self.turns, self.letters, self.hash, self.any = 0, [], hashlib.sha256(), False

    def add(self, edit, role, text, turn, was, fault) -> None:
        self.letters.append(edit)
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None:
                if self.high is None:
                    self.low = turn
                self.turns += turn != self.high
                self.high = turn
            if self.initial is not None and (self.initial, was[:1]) not in (("s", "u"), ("u", "a"), ("a", "u")):
                self.illegal += 1
            self.initial = was[:1]
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (CUT if fault == "truncated" and edit != "D" else 0)
        if edit != "D":
            self.hash.update((b"\n" if self.any else b"") + f"{role}:{text}".encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest())


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _reports(edits: DataFrame, conv: str) -> DataFrame:
    """One row for each conversation from its streamed edits."""
    kind = edits.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, schema = None, [], None

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for b in batches:
            schema = schema or pa.schema([("conv", b.schema.field("conv").type), *((c, pa.int64()) for c in REPORT[:6]),
                                          *((c, pa.string()) for c in REPORT[6:])])
            for c, edit, *rest in zip(*(b.column(x).to_pylist() for x in (
                    "conv", "edit", "role", "text", "turn", "original_role", "fault"))):
                if edit is None:
                    if now is not None:
                        rows.append(now.row())
                    now = _Report(c)
                else:
                    now.add(edit, *rest)
            if rows:
                yield batch()
                rows.clear()
        if now is not None:
            rows.append(now.row())
            yield batch()

    out = edits.mapInArrow(run, f"conv {kind}, " + ", ".join(f"{c} long" for c in REPORT[:6]) + ", audit string, repaired_sha256 string")
    return out.withColumnRenamed("conv", conv)


def repair_report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  with_damage: bool = False) -> DataFrame:
    """One row for each conversation: faults, cost, audit and hash of the repaired turns."""
    turns = (damaged if with_damage else _plain)(df, conv, turn, role, text)
    return _reports(_streamed_edits(turns, df.select(F.col(conv).alias("conv"))), conv)


def conversation_repairs(conversations: DataFrame) -> DataFrame:
    """Query form: the damaged conversations, repaired."""
    return repair_report(conversations, with_damage=True)
