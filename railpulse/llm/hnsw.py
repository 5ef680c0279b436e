"""A hierarchical navigable small-world graph, searched by many queries at once.

Every node is in layer 0 and, with geometrically falling chance, in layers above.
A search descends greedily through the upper layers and widens to a beam in layer
0. All steps run over a batch of queries as array operations. Similarities are
dot products of unit vectors.
"""

from __future__ import annotations

import numpy as np

LINKS = 12
BUILD_BEAM = 48
BATCH = 1024


def _choose(base: np.ndarray, candidates: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` diverse neighbours per row: those nearer to the row than to a chosen one first.

    ``candidates`` are sorted by falling similarity to ``base``, padded with -1. Places that stay
    free go to the nearest of the others.
    """
    rows, width = candidates.shape
    real = candidates >= 0
    found = vectors[np.where(real, candidates, 0)]
    to_base = np.where(real, np.einsum("rwd,rd->rw", found, base), -np.inf)
    among = np.matmul(found, found.transpose(0, 2, 1))
    chosen = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -np.inf)
    for j in range(width):
        take = real[:, j] & (closest[:, j] < to_base[:, j]) & (chosen.sum(axis=1) < most)
        chosen[:, j] = take
        closest = np.where(take[:, None], np.maximum(closest, among[:, j]), closest)
    order = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
    picked = np.take_along_axis(candidates, order, axis=1)
    if picked.shape[1] < most:
        picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
    return picked


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 0):
        """``vectors`` are unit rows; equal ones had better be merged before."""
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        self.levels = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 8) if n else np.zeros(0, int)
        self.layers = [np.full((n, 2 * LINKS if level == 0 else LINKS), -1, np.int32) for level in range(int(self.levels.max(initial=0)) + 1)]
        self.entry = int(self.levels.argmax()) if n else -1
        self._build(rng)

    @classmethod
    def restored(cls, vectors: np.ndarray, levels: np.ndarray, links: np.ndarray) -> Graph:
        """The graph of ``vectors`` from its levels and the links of all layers in a row."""
        graph, n, at = cls.__new__(cls), len(vectors), 0
        graph.vectors = np.ascontiguousarray(vectors, np.float32)
        graph.levels, graph.layers = levels.astype(int), []
        for level in range(int(graph.levels.max(initial=0)) + 1):
            width = 2 * LINKS if level == 0 else LINKS
            graph.layers.append(links[at:at + n * width].reshape(n, width))
            at += n * width
        graph.entry = int(graph.levels.argmax()) if n else -1
        return graph

    # -- search ---------------------------------------------------------------

    def _beam(self, queries: np.ndarray, starts: np.ndarray, width: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes found per query, most similar first, padded with -1."""
        links = self.layers[layer]
        count = len(queries)
        ids = np.full((count, width), -1, np.int64)
        sims = np.full((count, width), -np.inf, np.float32)
        ids[:, 0] = starts
        sims[:, 0] = np.einsum("qd,qd->q", self.vectors[starts], queries)
        opened = np.zeros((count, width), bool)
        seen = np.zeros((count, len(self.vectors)), bool)
        seen[np.arange(count), starts] = True
        live = np.arange(count)
        while len(live):
            waiting = ~opened[live] & (ids[live] >= 0)
            some = waiting.any(axis=1)
            live, waiting = live[some], waiting[some]
            if not len(live):
                break
            at = waiting.argmax(axis=1)
            opened[live, at] = True
            near = links[ids[live, at]].astype(np.int64)
            fresh = (near >= 0) & ~seen[live[:, None], near]
            near = np.where(fresh, near, 0)
            rows, columns = np.nonzero(fresh)
            seen[live[rows], near[rows, columns]] = True
            found = np.full(near.shape, -np.inf, np.float32)
            found[rows, columns] = np.einsum("kd,kd->k", self.vectors[near[rows, columns]], queries[live[rows]])
            better = found > sims[live, -1][:, None]
            hit = better.any(axis=1)
            at = live[hit]
            if not len(at):
                continue
            all_sims = np.concatenate([sims[at], np.where(better[hit], found[hit], -np.inf)], axis=1)
            all_ids = np.concatenate([ids[at], np.where(better[hit], near[hit], -1)], axis=1)
            all_opened = np.concatenate([opened[at], np.zeros((len(at), near.shape[1]), bool)], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            sims[at] = np.take_along_axis(all_sims, order, axis=1)
            ids[at] = np.take_along_axis(all_ids, order, axis=1)
            opened[at] = np.take_along_axis(all_opened, order, axis=1)
        return ids, sims

    def _descend(self, queries: np.ndarray, down_to: int = 0, starts: np.ndarray | None = None) -> np.ndarray:
        starts = np.full(len(queries), self.entry) if starts is None else starts
        for layer in range(len(self.layers) - 1, down_to, -1):
            starts = self._beam(queries, starts, 1, layer)[0][:, 0]
        return starts

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities per query, ``width`` at most, most similar first."""
        ids = np.full((len(queries), width), -1, np.int64)
        sims = np.full((len(queries), width), -np.inf, np.float32)
        step = max(16, min(BATCH, (64 << 20) // max(1, len(self.vectors))))
        for at in range(0, len(queries), step):
            part = np.ascontiguousarray(queries[at:at + step], np.float32)
            ids[at:at + step], sims[at:at + step] = self._beam(part, self._descend(part), width, 0)
        return ids, sims

    # -- construction ------------------------------------------------------------

    def _build(self, rng: np.random.Generator) -> None:
        n = len(self.vectors)
        if n < 2:
            return
        rest = rng.permutation(n)
        order = np.concatenate([[self.entry], rest[rest != self.entry]])
        done = 1
        while done < n:
            size = min(n - done, max(16, min(BATCH, done)))
            self._insert(order[done:done + size])
            done += size

    def _insert(self, nodes: np.ndarray) -> None:
        queries = self.vectors[nodes]
        inside = queries @ queries.T
        np.fill_diagonal(inside, -np.inf)
        starts = np.full(len(nodes), self.entry)
        for layer in range(len(self.layers) - 1, -1, -1):
            here = np.flatnonzero(self.levels[nodes] >= layer)
            above = np.flatnonzero(self.levels[nodes] < layer)
            if len(above):
                starts[above] = self._beam(queries[above], starts[above], 1, layer)[0][:, 0]
            if not len(here):
                continue
            ids, sims = self._beam(queries[here], starts[here], BUILD_BEAM, layer)
            starts[here] = ids[:, 0]
            # Nodes of the same batch do not see each other in the graph yet.
            mates = np.where((self.levels[nodes] >= layer)[None, :], inside[here], -np.inf)
            keep = min(BUILD_BEAM, mates.shape[1])
            best = np.argpartition(-mates, keep - 1, axis=1)[:, :keep]
            best_sims = np.take_along_axis(mates, best, axis=1)
            ids = np.concatenate([ids, np.where(np.isfinite(best_sims), nodes[best], -1)], axis=1)
            sims = np.concatenate([sims, best_sims], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
            links = _choose(queries[here], np.take_along_axis(ids, order, axis=1), self.vectors, LINKS)
            self.layers[layer][nodes[here], :LINKS] = links
            self._link_back(layer, nodes[here], links)

    def _link_back(self, layer: int, nodes: np.ndarray, links: np.ndarray) -> None:
        table = self.layers[layer]
        width = table.shape[1]
        rows, columns = np.nonzero(links >= 0)
        target, source = links[rows, columns].astype(np.int64), nodes[rows]
        # A target keeps the nearest ``width`` of the new ones as candidates beside what it has.
        sims = np.einsum("kd,kd->k", self.vectors[target], self.vectors[source])
        order = np.lexsort((-sims, target))
        target, source = target[order], source[order]
        unique, first = np.unique(target, return_index=True)
        place = np.arange(len(target)) - np.repeat(first, np.diff([*first, len(target)]))
        slot = np.repeat(np.arange(len(unique)), np.diff([*first, len(target)]))
        new = np.full((len(unique), width), -1, np.int64)
        fits = place < width
        new[slot[fits], place[fits]] = source[fits]
        candidates = np.concatenate([table[unique].astype(np.int64), new], axis=1)
        candidates.sort(axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        real = candidates >= 0
        sims = np.where(real, np.einsum("rwd,rd->rw", self.vectors[np.where(real, candidates, 0)], self.vectors[unique]), -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")
        candidates = np.take_along_axis(np.where(real, candidates, -1), order, axis=1)
        table[unique] = _choose(self.vectors[unique], candidates, self.vectors, width)
