"""Embedding near-duplicates on a robust-pruned flat graph built from overlapping cluster shards.

1. Equal vectors are one class, so copies are never compared.
2. Centres are fitted by spherical k-means on at most ``SAMPLE`` classes (those with the smallest
   digests); every class goes to the shards of its ``OVERLAP`` nearest centres.  Shards above two
   ``BLOCK`` are dealt out as pairs of blocks, so a task holds at most two blocks of vectors.
3. Each group builds a graph (``pruned_graph.build``).  A group's adjacency lists are united with
   those of other groups: an edge goes to every group that holds both its ends.
4. In each group all vectors search the united graph from the medoids, and what lies in range is expanded
   until nothing is new.  Found pairs are verified in double precision.  A pair that several groups
   could find counts in the first shard its vectors share, so no list of pairs is ever written:
   tasks emit counts of links by vector and a spanning forest of the links.
5. Components of the forests by large-star and small-star.

``recall`` audits: a bounded set of query vectors is compared with all rows exactly.

Bounds: the sample, at most ``CENTRES`` centres, and one size for each shard pass through the driver.
Shards grow with the table once there are ``CENTRES`` of them; the number of block pairs of a shard then
grows with the square of its size, still without a list of pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and keep their own id as component.  Vectors of different lengths never link.  -0.0 equals 0.0.
Repeated rows are returned once each and count as links of each other.  Null ids are ignored when a
component is labelled; a component of null ids has a null label and keeps none.  An empty table gives no rows.
Only the id and vector columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.llm import pruned_graph as G
from nestgate.llm.common import each_group, saved
from nestgate.llm.components import components

LEAST = 0.95
SAMPLE = 16_384              # classes the centres are fitted on
CENTRES = 4096               # at most
SHARD = 1024                 # members a shard should have
OVERLAP = 3                  # shards of a class
BLOCK = 1024                 # two blocks meet in a task at most
ODD_SHARDS = 1024            # shards for vectors of another length than most
ROUNDS = 6


def _classed(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Rows ``(id, name, raw)``: the digest and the bytes of the vector; null where it cannot be compared."""
    kind = df.schema[id_col].dataType.simpleString()
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    numbers = F.col(vector) if single else F.col(vector).cast("array<double>")
    dtype = "<f4" if single else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            values = lists.flatten()
            numbers = values.to_numpy(zero_copy_only=False).astype(dtype) + np.array(0, dtype)     # nulls become NaN
            ends = np.cumsum([0, *((x or 0) for x in pc.list_value_length(lists).to_pylist())])
            names, raws = [], []
            for lo, hi in zip(ends, ends[1:]):
                v = numbers[lo:hi]
                good = hi > lo and np.isfinite(v).all() and v.any()
                raws.append(v.tobytes() if good else None)
                names.append(hashlib.blake2b(raws[-1], digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.binary()), pa.array(raws, pa.binary())],
                                             ["id", "name", "raw"])

    return df.select(F.col(id_col).alias("id"), numbers.alias("v")).mapInArrow(run, f"id {kind}, name binary, raw binary")


def _unit(raws: list[bytes], dtype: str) -> np.ndarray:
    """Directions in single precision; scaled first, so that no square leaves the range."""
    x = np.frombuffer(b"".join(raws), dtype).reshape(len(raws), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the first ``k`` vectors."""
    centres = x[:k].copy()
    for _ in range(ROUNDS):
        nearest = np.concatenate([(x[i:i + 2048] @ centres.T).argmax(axis=1) for i in range(0, len(x), 2048)])
        sums = np.zeros(centres.shape)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres).astype(np.float32)
    return centres


def _members(classes: DataFrame, dtype: str) -> DataFrame:
    """Classes with their shards: ``(node, raw, n, shards)``."""
    total = classes.count()
    chosen = classes.orderBy("name").limit(SAMPLE).select("raw").toArrow()["raw"].to_pylist()      # SAMPLE rows at most
    sizes: dict[int, int] = {}
    for r in chosen:
        sizes[len(r)] = sizes.get(len(r), 0) + 1
    main = max(sizes, key=lambda s: (sizes[s], s), default=0)
    x = _unit([r for r in chosen if len(r) == main], dtype) if main else np.empty((0, 0), np.float32)
    k = max(1, min(CENTRES, math.ceil(total * OVERLAP / SHARD), len(x) // 4))
    centres = fit_centres(x, k) if main else x
    own = min(OVERLAP, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = b.column("raw").to_pylist()
            shards = [[-1 - len(r) % ODD_SHARDS] for r in raws]
            same = [i for i, r in enumerate(raws) if len(r) == main]
            for at in range(0, len(same), 2048):
                part = same[at:at + 2048]
                near = np.argpartition(-(_unit([raws[i] for i in part], dtype) @ centres.T), own - 1, axis=1)[:, :own]
                for i, s in zip(part, near):
                    shards[i] = sorted(s.tolist())
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("raw"), b.column("n"),
                                              pa.array(shards, pa.list_(pa.int32()))], ["node", "raw", "n", "shards"])

    return classes.select("node", "raw", "n").mapInArrow(run, "node long, raw binary, n long, shards array<int>")


def _groups(members: DataFrame) -> DataFrame:
    """Members with the groups ``(shard, p, q)`` they meet in; ``sides``: their block in each of their shards."""
    spark = members.sparkSession
    sizes = {r[0]: r[1] for r in members.select(F.explode("shards").alias("s")).groupBy("s").count().collect()}   # by shard
    blocks = {s: 1 if n <= 2 * BLOCK else -(-n // BLOCK) for s, n in sizes.items()}
    split = [(s, b) for s, b in blocks.items() if b > 1]
    table = F.broadcast(spark.createDataFrame(split, "shard int, blocks int"))            # CENTRES + ODD_SHARDS rows at most
    each = members.select("*", F.explode("shards").alias("shard")).join(table, "shard", "left")
    count = F.coalesce("blocks", F.lit(1))
    side = F.pmod(F.xxhash64(F.lit(13), "node"), count).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("count") - 1))
    return (each.withColumn("count", count).withColumn("side", side).withColumn("other", other)
            .withColumn("p", F.least("side", "other")).withColumn("q", F.greatest("side", "other"))
            .select(*(F.col(c).cast("long").alias(c) for c in ("shard", "p", "q")), "node", "raw", "n", "shards", "side"))


def _by_length(raws: list[bytes]) -> list[np.ndarray]:
    """Members of equal vector length."""
    lengths = np.array([len(r) for r in raws])
    return [np.flatnonzero(lengths == s) for s in np.unique(lengths)]


def _sorted(group: dict) -> dict:
    order = sorted(range(len(group["node"])), key=group["node"].__getitem__)
    return {c: [v[i] for i in order] for c, v in group.items()}


def _edges_of(dtype: str):
    """Step 3: the group's graph as adjacency lists, for this group and for the other shards both ends share."""
    def of(group: dict) -> dict:
        group = _sorted(group)
        shard, p, q = (group[c][0] for c in ("shard", "p", "q"))
        out: dict[str, list] = {c: [] for c in ("shard", "p", "q", "node", "near")}
        for part in _by_length(group["raw"]):
            if len(part) < 2:
                continue
            near = G.build(_unit([group["raw"][i] for i in part], dtype))
            names = [group["node"][i] for i in part]
            homes = [[s for s in group["shards"][i] if s != shard] for i in part]
            for u, row in enumerate(near):
                row = row[row >= 0].tolist()
                lists = {shard: [names[v] for v in row]}
                for s in homes[u]:
                    if shared := [names[v] for v in row if s in homes[v]]:
                        lists[s] = shared
                for s, found in lists.items():
                    out["shard"].append(s)
                    out["p"].append(p if s == shard else -1)
                    out["q"].append(q if s == shard else -1)
                    out["node"].append(names[u])
                    out["near"].append(found)
        return out
    return of


def _search(dtype: str, least: float):
    """Step 4: rows ``(u, -1, links)`` by vector, and ``(u, v, 0)`` of a spanning forest of the verified pairs."""
    def of(group: dict) -> dict:
        out: dict[str, list] = {"u": [], "v": [], "links": []}
        own = [i for i, r in enumerate(group["raw"]) if r is not None]
        lists = [i for i, r in enumerate(group["raw"]) if r is None]
        members = _sorted({c: [v[i] for i in own] for c, v in group.items() if c != "near"})
        if not own:
            return out
        shard, p, q = (group[c][0] for c in ("shard", "p", "q"))
        for part in _by_length(members["raw"]):
            m = len(part)
            if m < 2:
                continue
            names = [members["node"][i] for i in part]
            place = {name: i for i, name in enumerate(names)}
            side = np.array([members["side"][i] for i in part])
            x = _unit([members["raw"][i] for i in part], dtype)
            united: list[set[int]] = [set() for _ in range(m)]
            for i in lists:
                u = place.get(group["node"][i])
                if u is not None:
                    united[u].update(place[v] for v in group["near"][i] if v in place)
            owner = np.repeat(np.arange(m), [len(s) for s in united])
            near = G.padded(owner, np.array([v for s in united for v in sorted(s)], int), m)
            starts = np.unique([int(np.flatnonzero(side == s)[G.medoid(x[side == s])]) for s in np.unique(side)])
            found = G.in_range(x, near, least - 1e-4, starts)
            i, j = np.nonzero(np.triu(found))
            if p != q:
                across = side[i] != side[j]
                i, j = i[across], j[across]
            shards = [members["shards"][t] for t in part]
            keep = np.array([next(s for s in shards[a] if s in shards[b]) == shard for a, b in zip(i, j)], bool)
            i, j = i[keep], j[keep]
            raw = np.frombuffer(b"".join(members["raw"][t] for t in part), dtype).reshape(m, -1).astype(np.float64)
            raw = raw / np.abs(raw).max(axis=1, keepdims=True)
            norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
            true = np.concatenate([np.einsum("ij,ij->i", raw[i[k:k + 65536]], raw[j[k:k + 65536]])
                                   / (norm[i[k:k + 65536]] * norm[j[k:k + 65536]]) for k in range(0, len(i), 65536)]
                                  or [np.empty(0)]) >= least
            i, j = i[true], j[true]
            n = np.array([members["n"][t] for t in part])
            links = np.bincount(i, n[j], m) + np.bincount(j, n[i], m)
            tree = list(range(m))
            for a, b in zip(i.tolist(), j.tolist()):
                ra, rb = _root(tree, a), _root(tree, b)
                if ra != rb:
                    tree[rb] = ra
                    out["u"].append(names[a])
                    out["v"].append(names[b])
                    out["links"].append(0)
            for a in np.flatnonzero(links):
                out["u"].append(names[a])
                out["v"].append(-1)
                out["links"].append(int(links[a]))
        return out
    return of


def _root(tree: list[int], a: int) -> int:
    while tree[a] != a:
        tree[a] = tree[tree[a]]
        a = tree[a]
    return a


def flat_graph(groups: DataFrame, dtype: str) -> DataFrame:
    """Adjacency lists ``(shard, p, q, node, near)`` by the groups that hold both ends of an edge."""
    lists = each_group(groups, ["shard", "p", "q"], _edges_of(dtype),
                       "shard long, p long, q long, node long, near array<long>")
    here = lists.filter("p >= 0")
    # lists for other shards go to the groups that hold the node there
    homes = groups.select("shard", "p", "q", "node")
    there = lists.filter("p < 0").drop("p", "q").join(homes, ["shard", "node"])
    return here.unionByName(there.select(here.columns))


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = LEAST) -> DataFrame:
    """Rows ``(id, n_links, component_id, kept)`` for every row of ``df``."""
    dtype = "<f4" if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else "<f8"
    rows = saved(_classed(df, id_col, vector))
    classes = saved(rows.filter("name is not null").groupBy("name").agg(
        F.min("id").alias("first_id"), F.count("*").alias("n"), F.first("raw").alias("raw"))
        .withColumn("node", F.monotonically_increasing_id()))
    members = saved(_members(classes, dtype))
    groups = _groups(members)
    graph = saved(flat_graph(groups, dtype))
    none = {c: F.lit(None).cast(t) for c, t in (("raw", "binary"), ("n", "long"), ("shards", "array<int>"), ("side", "int"))}
    meeting = groups.withColumn("near", F.lit(None).cast("array<long>")).unionByName(graph.withColumns(none))
    found = saved(each_group(meeting, ["shard", "p", "q"], _search(dtype, least), "u long, v long, links long"))
    links = found.filter("v < 0").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    member = components(found.filter("v >= 0").select("u", "v"))
    least_id = (member.join(classes.select("node", "first_id"), "node").groupBy("root")
                .agg(F.min("first_id").alias("least")))
    label = member.join(least_id, "root").select("node", "least")
    named = (classes.select("name", "node", "n", "first_id").join(links, "node", "left").join(label, "node", "left")
             .select("name", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("least", "first_id").alias("least")))
    return (rows.drop("raw").join(named, "name", "left")
            .withColumn("component_id", F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("least")))
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")))


def embedding_components(embeddings: DataFrame) -> DataFrame:
    """Query form: one row for each vector."""
    return near_vectors(embeddings).withColumnRenamed("id", "vec_id")


def recall(df: DataFrame, found: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = LEAST,
           queries: int = 256) -> float:
    """The audit: the share of the exact links of ``queries`` vectors (smallest digests) that ``found`` counts.

    ``found``: rows ``(id_col, n_links)``.  The queries travel to all rows; every row is compared once with each.
    """
    dtype = "<f4" if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else "<f8"
    rows = _classed(df, id_col, vector).filter("name is not null")
    chosen = rows.join(rows.groupBy("name").agg(F.min("id").alias("id")).orderBy("name").limit(queries), ["name", "id"]
                       ).dropDuplicates(["name"]).select("id", "raw").toArrow().to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(chosen), np.int64)
        for b in batches:
            raws = b.column(0).to_pylist()
            for at, c in enumerate(chosen):
                x = np.frombuffer(c["raw"], dtype).astype(np.float64)
                same = [r for r in raws if len(r) == len(c["raw"])]
                if same:
                    y = np.frombuffer(b"".join(same), dtype).reshape(len(same), -1).astype(np.float64)
                    total[at] += (y @ x >= least * np.linalg.norm(x) * np.linalg.norm(y, axis=1)).sum()
        yield pa.RecordBatch.from_pydict({"id": pa.array([c["id"] for c in chosen]), "true": pa.array(total)})

    kind = df.schema[id_col].dataType.simpleString()
    true = rows.select("raw").mapInArrow(run, f"id {kind}, true long").groupBy("id").agg((F.sum("true") - 1).alias("true"))
    got = true.join(found.select(F.col(id_col).alias("id"), "n_links").dropDuplicates(["id"]), "id")
    r = got.agg(F.sum("true"), F.sum(F.least("true", "n_links"))).first()
    return 1.0 if not r[0] else r[1] / r[0]
