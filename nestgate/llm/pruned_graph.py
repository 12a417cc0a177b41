"""A robust-pruned neighbour graph of a bounded set of vectors, and range search on it (numpy, inside a task)."""

from __future__ import annotations

import numpy as np

DEGREE = 20          # neighbours kept by pruning
WIDTH = 32           # candidates a greedy search holds
STEP = 4             # of them looked around at once
ALPHA = 1.2          # a neighbour hides what is ALPHA times closer to it than to the node
SLACK = 0.05         # the range search passes through vectors this much below the wanted cosine
BATCH = 256          # nodes searched or pruned at once
PASSES = 2
WALKED = 1 << 21     # links looked along at once


def medoid(x: np.ndarray) -> int:
    """The vector nearest to the mean direction."""
    return int(np.argmax(x @ x.mean(axis=0)))


def greedy(x: np.ndarray, near: np.ndarray, queries: np.ndarray, start: np.ndarray,
           skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search: ids and cosines of the ``WIDTH`` best vectors met for each query, best first.

    ``near``: neighbours of every node (-1: none); ``start``: the nodes each search begins from;
    ``skip``: a node for each query that is passed through but not returned (the query itself).
    """
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(x)), bool)
    ids = np.full((n, WIDTH), -1)
    cos = np.full((n, WIDTH), -2.0, np.float32)
    k = min(len(start), WIDTH)
    ids[:, :k], cos[:, :k] = start[:k], queries @ x[start[:k]].T
    seen[:, start[:k]] = True
    fresh = ids >= 0
    while True:
        order = np.argsort(np.where(fresh, -cos, 3.0), axis=1)[:, :STEP]
        pick = np.where(np.take_along_axis(fresh, order, 1), np.take_along_axis(ids, order, 1), -1)
        active = np.flatnonzero((pick >= 0).any(axis=1))
        if not len(active):
            break
        fresh[rows, order] = False
        pick, r = pick[active], active[:, None]
        new = np.where((pick >= 0)[:, :, None], near[np.maximum(pick, 0)], -1).reshape(len(active), -1)
        new = np.where((new >= 0) & ~seen[r, np.maximum(new, 0)], new, -1)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1                          # each found once
        seen[np.broadcast_to(r, new.shape)[new >= 0], new[new >= 0]] = True
        found = np.einsum("qd,qrd->qr", queries[active], x[np.maximum(new, 0)])
        all_ids = np.concatenate([ids[active], new], axis=1)
        all_cos = np.concatenate([cos[active], np.where(new >= 0, found, -2.0)], axis=1)
        all_fresh = np.concatenate([fresh[active], new >= 0], axis=1)
        best = np.argsort(-all_cos, axis=1, kind="stable")[:, :WIDTH]
        ids[active], cos[active], fresh[active] = (np.take_along_axis(t, best, 1) for t in (all_ids, all_cos, all_fresh))
    if skip is not None:
        own = ids == skip[:, None]
        ids[own], cos[own] = -1, -2.0
    return ids, cos


def robust_prune(x: np.ndarray, nodes: np.ndarray, ids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours of each node from its candidates ``ids`` (-1: none), the nearest first.

    A candidate is passed over when an already chosen one is ``ALPHA`` times closer to it than the node is.
    """
    ids = np.where(ids == nodes[:, None], -1, ids)
    ids = -np.sort(-ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    v = x[np.maximum(ids, 0)]
    to_node = np.where(ids >= 0, 2 - 2 * np.einsum("bd,bcd->bc", x[nodes], v), np.inf)
    order = np.argsort(to_node, axis=1, kind="stable")
    ids, to_node = np.take_along_axis(ids, order, 1), np.take_along_axis(to_node, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    between = 2 - 2 * np.einsum("bcd,bed->bce", v, v)
    alive, count = ids >= 0, np.zeros(len(nodes), int)
    chosen = np.zeros_like(alive)
    for i in range(ids.shape[1]):
        take = alive[:, i] & (count < degree)
        chosen[:, i] = take
        count += take
        alive &= ~(take[:, None] & (ALPHA * between[:, i] <= to_node))
    out = np.full((len(nodes), degree), -1)
    at = np.cumsum(chosen, axis=1) - 1
    r, c = np.nonzero(chosen)
    out[r, at[r, c]] = ids[r, c]
    return out


def padded(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Values of each owner (ascending) in a row, filled up with -1."""
    counts = np.bincount(owner, minlength=n)
    out = np.full((n, max(1, counts.max(initial=0))), -1)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)] = value
    return out


def reachable(near: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which nodes a walk from ``start`` can come to."""
    seen = np.zeros(len(near), bool)
    seen[start] = True
    while len(start):
        start = np.unique(near[start])
        start = start[start >= 0]
        start = start[~seen[start]]
        seen[start] = True
    return seen


def entrances(near: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``near`` with links to the nodes that no walk from ``start`` comes to: each from the nearest of its own
    neighbours that a walk comes to.  Pruning keeps tight groups together but may cut all ways into them."""
    while not (seen := reachable(near, start)).all():
        lost = np.flatnonzero(~seen)
        known = (near[lost] >= 0) & seen[near[lost]]
        first = np.where(known.any(axis=1), near[lost, known.argmax(axis=1)], start[0])
        order = np.argsort(first, kind="stable")
        near = np.concatenate([near, padded(first[order], lost[order], len(near))], axis=1)
    return near


def batch_mates(x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The nearest nodes of each within one batch."""
    cos = x[nodes] @ x[nodes].T
    np.fill_diagonal(cos, -2)
    k = min(WIDTH // 2, len(nodes) - 1)
    return nodes[np.argpartition(-cos, k - 1, axis=1)[:, :k]] if k > 0 else np.full((len(nodes), 1), -1)


def build(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Neighbours of every vector: random links first, then passes of search, pruning and links back.

    Candidates are what the search finds, the node's neighbours and the nearest in its batch, so that tight
    groups far from all else hold together; their entrances are kept after every pass.
    """
    n = len(x)
    if n == 1:
        return np.full((1, DEGREE), -1)
    rng = np.random.default_rng(seed)
    near = np.full((n, DEGREE), -1)
    k = min(DEGREE // 2, n - 1)
    near[:, :k] = rng.integers(0, n - 1, (n, k))
    near[:, :k] += near[:, :k] >= np.arange(n)[:, None]
    start = np.array([medoid(x)])
    walk = near
    for _ in range(PASSES):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            nodes = order[at:at + BATCH]
            ids, _ = greedy(x, walk, x[nodes], start, skip=nodes)
            near[nodes] = robust_prune(x, nodes, np.concatenate([ids, near[nodes], batch_mates(x, nodes)], axis=1))
            back, node = near[nodes].ravel(), np.repeat(nodes, DEGREE)
            back, node = back[back >= 0], node[back >= 0]
            by = np.argsort(back, kind="stable")
            touched, place = np.unique(back[by], return_inverse=True)
            for part in range(0, len(touched), BATCH):
                mine = (place >= part) & (place < part + BATCH)
                those = touched[part:part + BATCH]
                more = padded(place[mine] - part, node[by][mine], len(those))
                near[those] = robust_prune(x, those, np.concatenate([near[those], more], axis=1))
            walk = np.concatenate([near, walk[:, DEGREE:]], axis=1)
        walk = entrances(near, start)
    return walk


def both_ways(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links, each walked from both its ends: where a node's list begins, and the lists."""
    n = len(near)
    u, v = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    u, v = u[v >= 0], v[v >= 0]
    link = np.unique(np.concatenate([u * n + v, v * n + u]))
    return np.searchsorted(link, np.arange(n + 1) * n), link % n


def _around(begins: np.ndarray, lists: np.ndarray, r: np.ndarray, y: np.ndarray, new: np.ndarray) -> None:
    """Marks in ``new`` the neighbours of each ``y`` in its row ``r``, a bounded number at a time."""
    degree = begins[y + 1] - begins[y]
    cuts = np.searchsorted(np.cumsum(degree), np.arange(1, degree.sum() // WALKED + 2) * WALKED, side="right")
    for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(y)]])):
        d = degree[lo:hi]
        at = np.arange(d.sum()) - np.repeat(np.cumsum(d) - d, d) + np.repeat(begins[y[lo:hi]], d)
        new[np.repeat(r[lo:hi], d), lists[at]] = True


def in_range(x: np.ndarray, near: np.ndarray, least: float, starts: np.ndarray) -> np.ndarray:
    """Which pairs have a cosine of about ``least`` or more, as found by range-expanding searches.

    Every vector is searched greedily from ``starts``; then the vectors found in range (with some
    slack) are looked around, along links of either direction, until none is new.  A pair found from
    either side counts.
    """
    n = len(x)
    found = np.zeros((n, n), bool)
    begins, lists = both_ways(near)
    for at in range(0, n, BATCH):
        nodes = np.arange(at, min(n, at + BATCH))
        ids, cos = greedy(x, near, x[nodes], starts)
        seen = np.zeros((len(nodes), n), bool)
        r, c = np.nonzero((cos >= least - SLACK) & (ids >= 0))
        y = ids[r, c]
        hit = cos[r, c] >= least
        found[nodes[r[hit]], y[hit]] = True
        seen[r, y] = True
        alone = np.flatnonzero(~seen[np.arange(len(nodes)), nodes])
        r, y = np.concatenate([r, alone]), np.concatenate([y, nodes[alone]])
        seen[r, y] = True
        while len(r):
            new = np.zeros((len(nodes), n), bool)
            _around(begins, lists, r, y, new)
            r, y = np.nonzero(new & ~seen)
            seen[r, y] = True
            cos = np.concatenate([np.einsum("pd,pd->p", x[nodes[r[i:i + 65536]]], x[y[i:i + 65536]])
                                  for i in range(0, len(r), 65536)]) if len(r) else np.empty(0)
            found[nodes[r[cos >= least]], y[cos >= least]] = True
            r, y = r[cos >= least - SLACK], y[cos >= least - SLACK]
    np.fill_diagonal(found, False)
    return found | found.T
