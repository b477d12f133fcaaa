"""M-trees: paged metric nodes with covering radii and parent distances, searched best first.

The greatest inner products are the nearest vectors once every vector has one more component that
brings it to the norm of the longest (and queries 0 there): then d(q, x)^2 = M^2 + |q|^2 - 2 q.x.
That distance is a metric, so a node's covering radius bounds all below it, and stored distances to
the parent tell by the triangle inequality which distances need not be computed at all.

Many queries walk a tree together: a page is read once for those whose bounds reach it, and their
distances to its vectors are one matrix product.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np

from leafmill.llm.exact_vectors import as_integers, as_longs

PAGE, FANOUT = 256, 32
# Queries that walk a tree together.
STRIP = 1024
# Bounds are compared with this slack, as a share of the longest distance: more than rounding can add up to.
SLACK = 1e-6


@dataclass
class Node:
    """A page: vectors with their distances to the page's router; in inner nodes also radii and child pages."""

    vectors: np.ndarray
    parent_distance: np.ndarray
    ids: np.ndarray | None = None
    radius: np.ndarray | None = None
    children: np.ndarray | None = None


@dataclass
class Tree:
    """``nodes[0]`` is the root; ``norm`` is the greatest squared norm. Counted are distances computed and spared, and pages read."""

    nodes: list[Node]
    norm: float
    computed: int = field(default=0, compare=False)
    spared: int = field(default=0, compare=False)
    reads: int = field(default=0, compare=False)


def lift(vectors: np.ndarray, norm: float) -> np.ndarray:
    """The vectors with the component that brings them to the common norm."""
    own = np.einsum("ij,ij->i", vectors, vectors)
    return np.hstack([vectors, np.sqrt(np.maximum(0.0, norm - own))[:, None]])


def _distances(rows: np.ndarray, router: np.ndarray) -> np.ndarray:
    apart = rows - router
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def _split(lifted: np.ndarray, order: np.ndarray, parts: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The rows at ``order`` in groups around random routers; groups of equals are cut by number."""
    routers = lifted[rng.choice(order, size=min(parts, len(order)), replace=False)]
    rows = lifted[order]
    near = (np.einsum("ij,ij->i", routers, routers)[None, :] - 2 * rows @ routers.T).argmin(axis=1)
    groups = [order[near == i] for i in range(len(routers))]
    groups = [g for g in groups if len(g)]
    if len(groups) == 1:
        return np.array_split(order, parts)
    return groups


def build(ids: np.ndarray, vectors: np.ndarray, seed: int = 0) -> Tree:
    """A tree over the vectors, built from above: at most ``FANOUT`` children a node, ``PAGE`` vectors a leaf."""
    rng = np.random.default_rng(seed)
    norm = float(np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0))
    lifted = lift(vectors, norm)
    tree = Tree([], norm)

    def add(order: np.ndarray, router: np.ndarray | None) -> int:
        at = len(tree.nodes)
        tree.nodes.append(None)
        if len(order) <= PAGE:
            own = order[np.argsort(ids[order], kind="stable")]
            far = np.zeros(len(own)) if router is None else _distances(lifted[own], router)
            tree.nodes[at] = Node(vectors[own], far, ids=ids[own])
            return at
        groups = _split(lifted, order, min(FANOUT, math.ceil(len(order) / PAGE)), rng)
        # The router of a group is its member nearest to the mean.
        heads = [g[_distances(lifted[g], lifted[g].mean(axis=0)).argmin()] for g in groups]
        radius = np.array([_distances(lifted[g], lifted[h]).max() for g, h in zip(groups, heads, strict=True)])
        far = np.zeros(len(heads)) if router is None else _distances(lifted[heads], router)
        children = np.array([add(g, lifted[h]) for g, h in zip(groups, heads, strict=True)])
        tree.nodes[at] = Node(vectors[heads], far, radius=radius, children=children)
        return at

    if len(ids):
        add(np.arange(len(ids)), None)
    return tree


def _search_all(tree: Tree, query: np.ndarray, own_id: int, k: int):
    """As ``search``, over all pages, for numbers that doubles don't multiply exactly."""
    scores, ids, factors = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), as_integers(query[None, :])
    for node in tree.nodes:
        if node.ids is not None:
            wanted = node.ids != own_id
            found = (as_integers(node.vectors[wanted]) * factors).sum(axis=1)
            scores, ids = np.concatenate([scores, as_longs(np.asarray(found, dtype=object))]), np.concatenate([ids, node.ids[wanted]])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
    return scores, ids


class _Best:
    """The first ``k`` hits of each query, and the least score (then greatest id) that another must have."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least
        self.below = np.full(len(least), np.iinfo(np.int64).max)
        self.hits = (np.empty(0, np.int64),) * 3
        self.more: list[tuple] = []
        self.waiting = 0

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> bool:
        """Whether the least scores were brought up to date, which is put off until it pays."""
        low = self.least[at]
        wanted = (scores > low) | ((scores == low) & (ids < self.below[at]))
        self.more.append((at[wanted], scores[wanted].astype(np.int64), ids[wanted]))
        self.waiting += len(self.more[-1][0])
        if self.waiting < self.k * len(self.least):
            return False
        self.settle()
        return True

    def settle(self) -> None:
        at, scores, ids = (np.concatenate(x) for x in zip(self.hits, *self.more, strict=True))
        order = np.lexsort((ids, -scores, at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        order, at, place = order[place < self.k], at[place < self.k], place[place < self.k]
        self.hits, self.more, self.waiting = (at, scores[order], ids[order]), [], 0
        last = place == self.k - 1
        self.least[at[last]], self.below[at[last]] = self.hits[1][last], self.hits[2][last]


def _walk(tree: Tree, queries: np.ndarray, own_ids: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, ...]:
    own = np.einsum("ij,ij->i", queries, queries)
    base = tree.norm + own
    slack = SLACK * (math.sqrt(tree.norm) + np.sqrt(own))
    asked = queries.astype(tree.nodes[0].vectors.dtype)
    best = _Best(least, k)

    def reach() -> np.ndarray:
        return np.sqrt(np.maximum(0.0, base - 2.0 * best.least)) + slack

    limit = reach()
    # Queries without a least score first go down to one leaf each (False sorts before True).
    everyone = np.arange(len(queries))
    heap = [(bool(np.isfinite(least).all()), 0.0, 0, 0, everyone, np.zeros(len(queries)), None)]
    pushed = 1
    while heap:
        later, _, _, page, at, nearest, router_distance = heapq.heappop(heap)
        node = tree.nodes[page]
        inside = node.radius if node.ids is None else np.zeros(len(node.vectors))
        n_pairs = len(at) * len(node.vectors)
        near = nearest <= limit[at]
        chosen = np.arange(len(node.vectors))
        if router_distance is not None:
            low, high = router_distance - limit[at], router_distance + limit[at]
            near &= (low <= (node.parent_distance + inside).max()) & (high >= (node.parent_distance - inside).min())
            if near.any():
                chosen = np.flatnonzero((node.parent_distance + inside >= low[near].min()) & (node.parent_distance - inside <= high[near].max()))
        at, nearest = at[near], nearest[near]
        tree.spared += n_pairs - len(at) * len(chosen)
        if not len(at) or not len(chosen):
            continue
        # Vectors x queries.
        found = node.vectors[chosen] @ asked[at].T
        tree.computed += found.size
        tree.reads += 1
        if node.ids is None:
            far = np.sqrt(np.maximum(0.0, base[at] - 2.0 * found.astype(np.float64)))
            low = np.maximum(far - node.radius[chosen, None], nearest)
            first = np.zeros(len(at), dtype=np.int64) - 1 if later else far.argmin(axis=0)
            for i, child in enumerate(node.children[chosen].tolist()):
                reached = low[i] <= limit[at]
                for last, those in ((False, np.flatnonzero(reached & (first == i))), (True, np.flatnonzero(reached & (first != i)))):
                    if len(those):
                        heapq.heappush(heap, (last, float(low[i, those].min()), pushed, child, at[those], low[i, those], far[i, those]))
                        pushed += 1
            continue
        row, column = np.divmod(np.flatnonzero(found >= best.least[at].astype(found.dtype)), len(at))
        names, hit = node.ids[chosen][row], at[column]
        other = names != own_ids[hit]
        if best.add(hit[other], found[row, column][other], names[other]):
            limit = reach()
    best.settle()
    return best.hits


def search_many(tree: Tree, queries: np.ndarray, own_ids: np.ndarray, k: int, least: np.ndarray | None = None, exact: bool = True):
    """``(at, scores, ids)``: for the query at each place, the tree's first ``k`` by inner product, then smaller id, without its own id.

    ``least``: rows that score below a query's are not wanted; minus infinity for none. ``exact``: the
    type of the tree's vectors holds all products exactly; if it doesn't, nothing is spared, and
    products are made of Python integers.
    """
    found = [(np.empty(0, np.int64),) * 3]
    if not exact:
        for i, (query, name) in enumerate(zip(queries, own_ids.tolist(), strict=True)):
            scores, ids = _search_all(tree, query, name, k)
            found.append((np.full(len(ids), i), scores, ids))
    elif tree.nodes:
        low = np.full(len(queries), -np.inf) if least is None else least.astype(np.float64)
        for start in range(0, len(queries), STRIP):
            part = slice(start, start + STRIP)
            at, scores, ids = _walk(tree, queries[part].astype(np.float64), own_ids[part], k, low[part])
            found.append((at + start, scores, ids))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search(tree: Tree, query: np.ndarray, own_id: int, k: int, least: int | None = None, exact: bool = True):
    """``(scores, ids)``: as ``search_many``, for one query."""
    low = None if least is None else np.array([least], dtype=np.float64)
    return search_many(tree, query[None, :], np.array([own_id]), k, low, exact)[1:]
