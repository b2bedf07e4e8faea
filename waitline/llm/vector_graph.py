"""A flat graph over the unit vectors of one shard, searched by many queries in step.

Vectors are inserted in small batches: a greedy search finds candidates, robust pruning keeps a
few that lie in different directions, and each kept neighbour gets an edge back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 24
BEAM = 32
BATCH = 512
AT_ONCE = 4
IN_BATCH = 8
MENDINGS = 4
MEDOIDS = 8
#: Of squared distances: an edge is left out if a kept neighbour is this much nearer to its end.
ALPHA = 1.44
PAIRS = 1 << 16


@dataclass
class Graph:
    """``links[n]`` are the neighbours of vector n, filled up with -1; ``entries`` are medoids."""

    vectors: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def medoids(vectors: np.ndarray) -> np.ndarray:
    """The vector nearest to the mean of all, and of the cells around a few of them."""
    pivots = vectors[np.linspace(0, len(vectors) - 1, MEDOIDS).astype(int)]
    cell = (vectors @ pivots.T).argmax(1)
    found = [(vectors @ vectors.mean(0)).argmax()]
    for n in np.unique(cell):
        members = np.flatnonzero(cell == n)
        found.append(members[(vectors[members] @ vectors[members].mean(0)).argmax()])
    return np.unique(found)


def greedy(
    graph: Graph, queries: np.ndarray, width: int, least: float | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best-first search of all queries at once.

    The ids and similarities of the ``width`` best, best first and filled up with -1; a table of
    what each query has seen, and one of what it has seen at ``least`` or more.
    """
    vectors, links, entries = graph.vectors, graph.links, graph.entries
    n_queries = len(queries)
    seen = np.zeros((n_queries, len(vectors)), bool)
    inside = np.zeros_like(seen) if least is not None else seen[:, :0]
    ids = np.full((n_queries, width + len(entries)), -1, np.int32)
    sims = np.full(ids.shape, -np.inf, np.float32)
    ids[:, : len(entries)] = entries
    sims[:, : len(entries)] = queries @ vectors[entries].T
    seen[:, entries] = True
    if least is not None:
        inside[:, entries] = sims[:, : len(entries)] >= least
    order = np.argsort(-sims, 1, kind="stable")[:, :width]
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    unopened = ids >= 0
    active = np.arange(n_queries)
    while True:
        active = active[unopened[active].any(1)]
        if not len(active):
            return ids, sims, seen, inside
        at = np.argsort(~unopened[active], 1, kind="stable")[:, :AT_ONCE]
        rows = active[:, None]
        opened = np.where(unopened[rows, at], ids[rows, at], -1)
        unopened[rows, at] = False
        near = np.where(opened[:, :, None] >= 0, links[opened], -1).reshape(len(active), -1)
        near.sort(1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[rows, near]] = -1
        at_query, column = np.nonzero(near >= 0)
        found = near[at_query, column]
        seen[active[at_query], found] = True
        reached = np.full(near.shape, -np.inf, np.float32)
        score = np.einsum("ij,ij->i", queries[active[at_query]], vectors[found])
        reached[at_query, column] = score
        if least is not None:
            inside[active[at_query], found] = score >= least
        all_ids = np.concatenate([ids[active], near], 1)
        all_sims = np.concatenate([sims[active], reached], 1)
        all_open = np.concatenate([unopened[active], near >= 0], 1)
        order = np.argsort(-all_sims, 1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        sims[active] = np.take_along_axis(all_sims, order, 1)
        unopened[active] = np.take_along_axis(all_open, order, 1)


def pruned(vectors: np.ndarray, near: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of each row of candidates, best first, those that no kept one is much nearer to."""
    points = vectors[near]
    apart = 2 - 2 * (points @ points.transpose(0, 2, 1))
    own = 2 - 2 * sims
    alive = near >= 0
    kept = np.full((len(near), degree), -1, np.int32)
    for slot in range(degree):
        rows = np.flatnonzero(alive.any(1))
        if not len(rows):
            break
        pick = alive[rows].argmax(1)
        kept[rows, slot] = near[rows, pick]
        alive[rows] &= ALPHA * apart[rows, pick] > own[rows]
        alive[rows, pick] = False
    return kept


def _candidates(graph: Graph, batch: np.ndarray, vectors: np.ndarray):
    """What a greedy search finds for the vectors of a batch, and the nearest of the batch."""
    ids, sims, _, _ = greedy(graph, vectors[batch], BEAM)
    own = vectors[batch] @ vectors[batch].T
    np.fill_diagonal(own, -np.inf)
    count = min(IN_BATCH, len(batch) - 1)
    best = np.argsort(-own, 1)[:, :count]
    ids = np.concatenate([ids, batch[best].astype(np.int32)], 1)
    sims = np.concatenate([sims, np.take_along_axis(own, best, 1)], 1)
    order = np.argsort(-sims, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _add_back(links: np.ndarray, vectors: np.ndarray, batch: np.ndarray, kept: np.ndarray):
    """Edges from the kept neighbours to the batch; full rows are pruned."""
    row, slot = np.nonzero(kept >= 0)
    to, of = kept[row, slot], batch[row].astype(np.int32)
    known = (links[to] == of[:, None]).any(1)
    to, of = to[~known], of[~known]
    order = np.argsort(to, kind="stable")
    to, of = to[order], of[order]
    place = np.arange(len(to)) - np.searchsorted(to, to) + (links[to] >= 0).sum(1)
    fits = place < links.shape[1]
    links[to[fits], place[fits]] = of[fits]
    full = np.unique(to[~fits])
    if not len(full):
        return
    more = [of[~fits][to[~fits] == node] for node in full]
    wide = np.full((len(full), links.shape[1] + BEAM), -1, np.int32)
    wide[:, : links.shape[1]] = links[full]
    for n, (node, extra) in enumerate(zip(full, more, strict=True)):
        nearest = extra[np.argsort(-(vectors[extra] @ vectors[node]))[:BEAM]]
        wide[n, links.shape[1] : links.shape[1] + len(nearest)] = nearest
    links[full] = -1
    links[full, :DEGREE] = _best_of(vectors, full, wide)


def _best_of(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
    kept = np.full((len(nodes), DEGREE), -1, np.int32)
    for start in range(0, len(nodes), BATCH):
        part = slice(start, start + BATCH)
        sims = np.einsum("ij,ikj->ik", vectors[nodes[part]], vectors[near[part]])
        sims[near[part] < 0] = -np.inf
        order = np.argsort(-sims, 1, kind="stable")
        kept[part] = pruned(
            vectors,
            np.take_along_axis(near[part], order, 1),
            np.take_along_axis(sims, order, 1),
            DEGREE,
        )
    return kept


def build(vectors: np.ndarray) -> Graph:
    """The graph of the vectors, which are unit vectors of 32-bit floats."""
    n = len(vectors)
    links = np.full((n, 2 * DEGREE), -1, np.int32)
    entries = medoids(vectors)
    graph = Graph(vectors, links, entries[:1])
    order = np.random.default_rng(n).permutation(np.delete(np.arange(n), entries[0]))
    done = 0
    while done < len(order):
        batch = order[done : done + min(BATCH, done + 1)]
        kept = pruned(vectors, *_candidates(graph, batch, vectors), DEGREE)
        links[batch, :DEGREE] = kept
        _add_back(links, vectors, batch, kept)
        done += len(batch)
    wide = np.flatnonzero(links[:, DEGREE] >= 0)
    links[wide, :DEGREE] = _best_of(vectors, wide, links[wide])
    links[:, DEGREE:] = -1
    graph = Graph(vectors, links, entries)
    for _ in range(MENDINGS):
        lost = np.flatnonzero(~_reached(graph))
        if not len(lost):
            break
        _lead_to(graph, lost)
    return graph


def _reached(graph: Graph) -> np.ndarray:
    """Which vectors a path leads to from an entry."""
    reached = np.zeros(len(graph.vectors), bool)
    front = graph.entries
    while len(front):
        reached[front] = True
        front = np.unique(graph.links[front])
        front = front[front >= 0]
        front = front[~reached[front]]
    return reached


def _lead_to(graph: Graph, lost: np.ndarray) -> None:
    """Edges to vectors that no path leads to, each from the nearest found that has room."""
    for start in range(0, len(lost), BATCH):
        part = lost[start : start + BATCH]
        ids, _, _, _ = greedy(graph, graph.vectors[part], BEAM)
        for node, near in zip(part, ids, strict=True):
            for by in near[near >= 0]:
                room = np.flatnonzero(graph.links[by] < 0)
                if len(room):
                    graph.links[by, room[0]] = node
                    break


def within(graph: Graph, queries: np.ndarray, least: float, width: int):
    """Pairs (query, vector) at ``least`` or more, by batches of queries.

    After the greedy search every vector in range is opened, and what that reaches, as long as
    anything new is in range, however many that are.
    """
    for start in range(0, len(queries), BATCH):
        part = queries[start : start + BATCH]
        _, _, seen, inside = greedy(graph, part, width, least)
        opened = np.zeros_like(inside)
        while True:
            query, node = np.nonzero(inside & ~opened)
            if not len(query):
                break
            for at in range(0, len(query), PAIRS):
                q, v = query[at : at + PAIRS], node[at : at + PAIRS]
                opened[q, v] = True
                near = graph.links[v]
                fresh = (near >= 0) & ~seen[q[:, None], near]
                row, column = np.nonzero(fresh)
                flat = np.unique(q[row] * len(graph.vectors) + near[row, column])
                q, v = np.divmod(flat, len(graph.vectors))
                seen[q, v] = True
                inside[q, v] = np.einsum("ij,ij->i", part[q], graph.vectors[v]) >= least
        query, node = np.nonzero(inside)
        yield start + query, node
