import math

import numpy as np
import pytest

from nestgate.llm import embedding_graph as E
from nestgate.llm import pruned_graph as G


def vectors(seed, n, dim=24, groups=12, noise=0.02):
    """Random directions, and groups of near copies of very different sizes."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for g in range(groups):
        at = r.choice(n, min(n, 2 + g * g), replace=False)
        x[at] = r.normal(size=dim) + noise * math.sqrt(dim) * r.normal(size=(len(at), dim)) * r.random((len(at), 1))
    return [[float(v) for v in row] for row in x]


def brute(rows, least=0.95):
    """All pairs in double precision, union-find."""
    good = [v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    x = [np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() if g else None for (_, v), g in zip(rows, good)]
    up, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(x[i]) == len(x[j]) and (
                    x[i] @ x[j] / math.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= least):
                n[i] += 1
                n[j] += 1
                up[find(i)] = find(j)
    label = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            label[find(i)] = min(label.get(find(i), d), d)
    return sorted(((d, n[i], label.get(find(i)), d is not None and label[find(i)] == d) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, kind="float", parts=4):
    df = spark.createDataFrame([(d, v, "x", 1) for d, v in rows],
                               f"vec_id long, embedding array<{kind}>, raw string, n int").repartition(parts)
    return sorted((tuple(r) for r in E.embedding_components(df).select(
        "vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("shard,block", [(1024, 1024), (40, 1024), (60, 25)])
def test_against_brute_force(spark, monkeypatch, shard, block):
    """One shard, many overlapping shards, and shards dealt out as pairs of blocks."""
    monkeypatch.setattr(E, "SHARD", shard)
    monkeypatch.setattr(E, "BLOCK", block)
    rows = list(enumerate(vectors(shard, 400), 7))
    # the noise is far from the threshold, so single precision input changes no pair
    want, found = brute([(d, np.float32(v).tolist()) for d, v in rows]), run(spark, rows)
    links, true = sum(r[1] for r in found), sum(r[1] for r in want)
    assert links <= true and links >= 0.99 * true
    if shard == 1024:
        assert found == want
    assert all(f[1] <= w[1] for f, w in zip(sorted(found), sorted(want)))


def test_odd_vectors_ties_and_repeated_rows(spark):
    big = 1e300
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [1.0, -0.0]), (9, [2.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [big, 0.0]), (11, [big, 0.0]),
            (12, [0.0, 1.0]), (None, [0.0, 2.0]), (None, [0.0, -1.0]), (13, [1e-300, 0.0])]
    assert run(spark, rows, "double") == brute(rows)
    assert run(spark, []) == []


def test_long_vectors(spark):
    rows = list(enumerate(vectors(3, 40, dim=5000, groups=5)))
    assert run(spark, rows, "double") == brute(rows)


def test_threshold_is_exact_in_double(spark):
    """Pairs just below and at the threshold."""
    c = 0.95
    rows = [(0, [1.0, 0.0]), (1, [c, math.sqrt(1 - c * c)]), (2, [c - 1e-9, -math.sqrt(1 - (c - 1e-9) ** 2)])]
    want = brute(rows)
    assert run(spark, rows, "double") == want and want[2][1] == 0


def test_graph_search_alone():
    """Range search on one group of 1500 vectors, 500 of them near copies of each other: nothing below, hardly any lost."""
    r = np.random.default_rng(2)
    x = r.normal(size=(1500, 32))
    x[:500] = r.normal(size=32) + 0.08 * r.normal(size=(500, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    near = G.build(x)
    assert near.shape == (1500, G.DEGREE) and (near != np.arange(1500)[:, None]).all()
    found, true = G.in_range(x, near, 0.95, np.array([G.medoid(x)])), x @ x.T >= 0.95
    np.fill_diagonal(true, False)
    assert true.sum() > 400 * 400 and (found & ~true).sum() < 20          # single precision at the edge
    assert (found & true).sum() >= 0.99 * true.sum()


def test_pruning_rule():
    """No kept neighbour hides another, and every candidate left out is hidden by a kept one."""
    r = np.random.default_rng(4)
    x = r.normal(size=(60, 8))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    nodes = np.arange(60)
    ids = np.tile(np.arange(60), (60, 1))
    near = G.robust_prune(x, nodes, ids, degree=60)
    d = 2 - 2 * x @ x.T
    for u in nodes:
        kept = [v for v in near[u] if v >= 0]
        assert u not in kept
        for v in set(range(60)) - {u}:
            hidden = any(G.ALPHA * d[k, v] <= d[u, v] + 1e-6 for k in kept if k != v and d[u, k] <= d[u, v])
            assert (v in kept) != hidden or abs(min(G.ALPHA * d[k, v] - d[u, v] for k in kept if k != v)) < 1e-5


def test_recall_audit(spark):
    rows = [(d, np.float32(v).tolist()) for d, v in enumerate(vectors(9, 300))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = E.embedding_components(df)
    assert E.recall(df, found, queries=64) >= 0.99
    assert E.recall(df, found.withColumn("n_links", found.n_links * 0), queries=300) == 0
