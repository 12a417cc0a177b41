"""Schema conformance of JSON documents against a declared nested schema (V1-V3).

Per path (``a``, ``a.b``, ``list[]``, ``list[].f``) and status -- ``ok``,
``wrong_type``, ``missing``, ``undeclared`` (``unparsable`` for text that is
not JSON) -- the number of documents.  Nested lists and structs are checked
at every depth; strict mode is simply "undeclared counts as a failure".

Plan, built for large inputs:

1. the declared schema becomes a trie whose nodes are numbered; a node is known by its
   segments (keys and list steps), never by text, so keys with dots or brackets are keys
   like any others;
2. Spark's ``try_parse_json`` says which texts are documents; the values of each are walked once, in
   Arrow batches inside the tasks, every declared node taking its values from its parent.  Findings are
   small integers (node and status), and only undeclared keys appear as text;
3. findings are counted by batch, then in one hash aggregate.  They are counted one by one, not as
   sets, so documents with keys of their own cost a row for each such key and no more.

What one document yields does not depend on the documents around it, and nothing is looked
for below an undeclared key or a path of any type.

Type families: integers; decimals/doubles/floats (integers fit a declared
fractional type); strings (also for declared dates/timestamps, which JSON
carries as text); booleans; objects; arrays; and null, which fits anything.

Display: segments joined by dots, list steps as ``[]``; a key holding a dot, bracket or backquote, or
empty, is set in backquotes (backquotes inside doubled).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANY = "any"


def family_of(dt: T.DataType | str) -> str:
    if isinstance(dt, str):
        return dt
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(dt, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "string"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.StructType):
        return "object"
    if isinstance(dt, (T.ArrayType,)):
        return "array"
    if isinstance(dt, T.MapType):
        return "object"
    return ANY


CONTAINER = {"object": dict, "array": list}
LIST_STEP = None               # the segment from a list to its elements


class Node:
    """A declared node: its number, segments and family; the node above and the nodes below by segment."""

    def __init__(self, number: int, segments: tuple, family: str, above: "Node | None", any_keys: bool):
        self.number, self.segments, self.family, self.above, self.any_keys = number, segments, family, above, any_keys
        self.below: dict[str | None, Node] = {}
        self.containers: list[tuple[str | None, Node]] = []        # those below that hold others


def declared_trie(schema: T.StructType, any_paths: Sequence[str | tuple] = ()) -> list[Node]:
    """All nodes, the root first and parents before what lies below them (V2: ``any_paths`` accept any type)."""
    free = {p if isinstance(p, tuple) else path_segments(p) for p in any_paths}
    nodes: list[Node] = []

    def grow(dt: T.DataType, segments: tuple, above: Node | None) -> Node:
        node = Node(len(nodes), segments, ANY if segments in free else family_of(dt), above, isinstance(dt, T.MapType))
        nodes.append(node)
        if node.family != ANY:
            steps = ([(f.name, f.dataType) for f in dt.fields] if isinstance(dt, T.StructType)
                     else [(LIST_STEP, dt.elementType)] if isinstance(dt, T.ArrayType) else [])
            for step, below in steps:
                node.below[step] = grow(below, (*segments, step), node)
        node.containers = [(step, b) for step, b in node.below.items() if b.family in CONTAINER]
        return node

    grow(schema, (), None)
    return nodes


def path_segments(path: str) -> tuple:
    """Segments of a displayed path (``a.b[].`c.d```)."""
    out = []
    for key, quoted, step in re.findall(r"([^.\[\]`]+)|`((?:[^`]|``)*)`|(\[\])", path):
        out.append(LIST_STEP if step else key or quoted.replace("``", "`"))
    return tuple(out)


def display(segments: Sequence[str | None]) -> str:
    out = "" if segments else "$"
    for s in segments:
        if s is LIST_STEP:
            out += "[]"
        else:
            quoted = s if s and not re.search(r"[.\[\]`]", s) else "`" + s.replace("`", "``") + "`"
            out += ("." if out else "") + quoted
    return out


OK, WRONG, MISSING, UNDECLARED, UNPARSABLE = range(5)
STATUS = ["ok", "wrong_type", "missing", "undeclared", "unparsable"]


# Python types of parsed JSON that a declared scalar family accepts.
SCALARS = {
    "integer": {int, type(None)},
    "number": {int, float, type(None)},
    "string": {str, type(None)},
    "boolean": {bool, type(None)},
}


def _integer(digits: str) -> int | float:
    """An integer of 64 bits; others count as numbers."""
    n = int(digits)
    return n if -(1 << 63) <= n < 1 << 63 else float(digits)


def _leaf_codes(n: Node, types: Iterable[type]) -> set[int]:
    """Findings of a node that is no container, from its values' types."""
    accepted = SCALARS.get(n.family)                # none: any type
    return {n.number * 8 + (OK if accepted is None or t in accepted else WRONG) for t in types}


def object_shape(n: Node, keys: tuple[str, ...], types: tuple[type, ...]) -> tuple[set[int], set[int], set[str]]:
    """What an object's keys and types of values tell: codes of the leaves below ``n``, the numbers of the
    nodes below that it has, its undeclared keys (displayed)."""
    codes, seen, extra = set(), set(), set()
    for key, kind in zip(keys, types):
        below = n.below.get(key)
        if below is None:
            extra.add(display((*n.segments, key)))
            continue
        seen.add(below.number)
        if below.family not in CONTAINER:
            codes |= _leaf_codes(below, (kind,))
    return codes, seen, extra


def document_findings(containers: list[Node], document, shape=object_shape) -> tuple[set[int], set[str]]:
    """Codes (node and status as one number) and undeclared keys, displayed, of one parsed document.

    The containers are walked from the root; objects of equal shape in a list are looked at once."""
    held = {0: [document]}
    codes, extra = set(), set()
    for n in containers:                            # parents come before what lies below them
        values = held.get(n.number, ())
        whole = [v for v in values if type(v) is CONTAINER[n.family]]
        fitting = len(whole)
        if fitting < len(values):
            fitting += sum(v is None for v in values)
        if fitting < len(values):
            codes.add(n.number * 8 + WRONG)
        if fitting and n.above is not None:
            codes.add(n.number * 8 + OK)
        if n.family == "array":
            element = n.below[LIST_STEP]
            below = [x for v in whole for x in v]
            if element.family in CONTAINER:
                held[element.number] = below
            else:
                codes |= _leaf_codes(element, set(map(type, below)))
        elif whole and not n.any_keys:              # a parent counts as present only as an object
            present = set()
            for keys, types in {(tuple(v), tuple(map(type, v.values()))) for v in whole}:
                found, seen, undeclared = shape(n, keys, types)
                codes |= found
                present |= seen
                extra |= undeclared
            if len(present) < len(n.below):
                codes.update(b.number * 8 + MISSING for b in n.below.values() if b.number not in present)
            for key, b in n.containers:
                held[b.number] = [v[key] for v in whole if key in v]
    return codes, extra


def findings(docs: DataFrame, text_col: str, nodes: list[Node]) -> DataFrame:
    """``(code, key, n)``: findings of the documents, counted by batch; ``key``: an undeclared key, displayed.

    ``try_parse_json`` says what is a document; the walk takes the values of one document at a time."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode, blank = json.JSONDecoder(parse_int=_integer).raw_decode, re.compile(r"[ \t\n\r]*")
        shape = lru_cache(maxsize=None)(object_shape)
        containers = [n for n in nodes if n.family in CONTAINER]
        for batch in batches:
            sets, keys = Counter(), Counter()
            shape.cache_clear()                     # what is remembered stays within a batch
            for text, parsed in zip(batch.column("text").to_pylist(), batch.column("parsed").to_pylist()):
                if not parsed:
                    sets[frozenset([UNPARSABLE])] += 1
                    continue
                text = text.decode("utf-8", "replace")
                codes, extra = document_findings(containers, decode(text, blank.match(text).end())[0], shape)
                sets[frozenset(codes)] += 1
                if extra:
                    keys.update({k.encode("utf-8", "replace").decode() for k in extra})
            codes = Counter()
            for found, n in sets.items():
                for code in found:
                    codes[code] += n
            rows = [(c, None, n) for c, n in codes.items()] + [(UNDECLARED, k, n) for k, n in keys.items()]
            yield pa.RecordBatch.from_pydict(
                {"code": pa.array([r[0] for r in rows], pa.int32()), "key": pa.array([r[1] for r in rows], pa.string()),
                 "n": pa.array([r[2] for r in rows], pa.int64())})

    text = F.col(text_col)
    return docs.select(text.cast("binary").alias("text"), F.try_parse_json(text).isNotNull().alias("parsed")).mapInArrow(
        count, "code int, key string, n bigint")


def conformance(spark: SparkSession, docs: DataFrame, text_col: str, schema: T.StructType,
                any_paths: Sequence[str | tuple] = (), strict: bool = False) -> DataFrame:
    """``(path, status, n_docs, failing)`` for JSON documents in ``text_col``.

    ``docs`` is read once.  ``any_paths``: displayed paths, or tuples of segments (``None``: a list step).
    ``failing`` marks findings that break the schema (undeclared only when strict)."""
    nodes = declared_trie(schema, any_paths)
    counted = findings(docs, text_col, nodes).groupBy("code", "key").agg(F.sum("n").alias("n_docs"))
    shown = F.array(*[F.lit(display(n.segments)) for n in nodes])
    status = F.get(F.array(*map(F.lit, STATUS)), F.col("code") % 8)
    out = counted.select(F.coalesce("key", F.get(shown, F.floor(F.col("code") / 8).cast("int"))).alias("path"),
                         status.alias("status"), "n_docs")
    bad = F.col("status").isin("wrong_type", "missing", "unparsable") | (F.lit(strict) & (F.col("status") == "undeclared"))
    return out.withColumn("failing", bad)


def dtype_report(df: DataFrame, schema: T.StructType, strict: bool = False) -> list[dict]:
    """Types-only check of an already typed DataFrame (metadata, no data pass).

    Column present, nested type equal by names and types (nullability ignored),
    undeclared columns reported only when ``strict``."""
    out = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            out.append({"column": f.name, "problem": "missing", "expected": f.dataType.simpleString(), "actual": None})
        elif have[f.name].simpleString() != f.dataType.simpleString():
            out.append({"column": f.name, "problem": "wrong_type", "expected": f.dataType.simpleString(),
                        "actual": have[f.name].simpleString()})
    if strict:
        for name in have:
            if name not in schema.fieldNames():
                out.append({"column": name, "problem": "undeclared", "expected": None,
                            "actual": have[name].simpleString()})
    return out
