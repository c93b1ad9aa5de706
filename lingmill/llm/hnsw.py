"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Many nodes are inserted, and many queries walked, at a time: every step expands the
best open candidates of all of them at once. Nodes are numbered by level, highest first,
so a level's nodes are a prefix and its graph is built once those above it are whole.
"""

from __future__ import annotations

import io

import numpy as np

NEIGHBOURS = 12
BUILD_BEAM = 40
BATCH = 256
DENSE = 512
EXPANDED = 4
# Candidates that a node gets from its own batch.
OWN_NEAREST = 16
NOTHING = np.float32(-2)


class Graph:
    def __init__(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, links: list[np.ndarray]):
        self.ids, self.weights, self.vectors, self.links = ids, weights, vectors, links
        self.size, width = vectors.shape
        # Row ``size`` stands for no node.
        self.near = np.zeros((self.size + 1, width), dtype=np.float32)
        self.near[: self.size] = vectors

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, weights=self.weights, vectors=self.vectors, **{f"l{i}": x for i, x in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        with np.load(io.BytesIO(data)) as held:
            levels = sum(name[0] == "l" for name in held.files)
            return cls(held["ids"], held["weights"], held["vectors"], [held[f"l{i}"] for i in range(levels)])

    def search(self, queries: np.ndarray, beam: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities), ``beam`` per query and unordered, on level ``floor``."""
        queries = queries.astype(np.float32)
        entry = np.zeros(len(queries), dtype=np.int64)
        for level in range(len(self.links) - 1, floor, -1):
            entry = self._walk(level, queries, entry, 1)[0][:, 0]
        return self._walk(floor, queries, entry, beam)

    def _walk(self, level: int, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        links, none, many = self.links[level], self.size, len(queries)
        seen = np.zeros((many, none + 1), dtype=bool)
        seen[:, none] = True
        ids = np.full((many, beam), none)
        sims = np.full((many, beam), NOTHING)
        todo = np.zeros((many, beam), dtype=bool)
        ids[:, 0] = entry
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.near[entry])
        todo[:, 0] = True
        seen[np.arange(many), entry] = True
        width = min(EXPANDED, beam)
        active = np.arange(many)
        while len(active):
            ranked = np.where(todo[active], sims[active], NOTHING - 1)
            pick = np.argpartition(-ranked, width - 1, axis=1)[:, :width]
            live = np.take_along_axis(ranked, pick, axis=1) >= NOTHING
            going = live.any(axis=1)
            active, pick, live = active[going], pick[going], live[going]
            if not len(active):
                break
            row = active[:, None]
            todo[row, pick] = False
            found = links[np.where(live, ids[row, pick], len(links) - 1)].reshape(len(active), -1)
            found = np.sort(found, axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = none
            found[seen[row, found]] = none
            seen[row, found] = True
            close = np.matmul(self.near[found], queries[active][:, :, None])[:, :, 0]
            close[found == none] = NOTHING
            all_ids = np.concatenate([ids[active], found], axis=1)
            all_sims = np.concatenate([sims[active], close], axis=1)
            all_todo = np.concatenate([todo[active], found < none], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, top, axis=1)
            sims[active] = np.take_along_axis(all_sims, top, axis=1)
            todo[active] = np.take_along_axis(all_todo, top, axis=1)
        return ids, sims

    def spread(self, found: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of each row's nodes: first those nearer to the row's own node than
        to any chosen before, then the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        found, sims = np.take_along_axis(found, order, axis=1), np.take_along_axis(sims, order, axis=1)
        near = self.near[found]
        among = np.matmul(near, near.transpose(0, 2, 1))
        closest = np.full(found.shape, NOTHING - 1)
        kept = np.zeros(found.shape, dtype=bool)
        for c in range(found.shape[1]):
            take = (found[:, c] < self.size) & (sims[:, c] > closest[:, c])
            kept[:, c] = take
            closest = np.where(take[:, None], np.maximum(closest, among[:, c, :]), closest)
        rank = np.argsort(~kept * 1 + (found == self.size) * 2, axis=1, kind="stable")[:, :most]
        return np.take_along_axis(found, rank, axis=1)

    def _connect(self, level: int, nodes: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        """Links new nodes to their candidates, both ways."""
        links, none = self.links[level], self.size
        most = links.shape[1]
        sims = np.where(found == nodes[:, None], NOTHING, sims)
        found = np.where((sims <= NOTHING), none, found)
        chosen = self.spread(found, sims, min(NEIGHBOURS, most))
        links[nodes, : chosen.shape[1]] = chosen
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        real = target < none
        source, target = source[real], target[real]
        if not len(target):
            return
        close = np.einsum("nd,nd->n", self.near[source], self.near[target])
        order = np.lexsort((-close, target))
        source, target = source[order], target[order]
        fresh = np.concatenate([[True], target[1:] != target[:-1]])
        starts = np.flatnonzero(fresh)
        place = np.arange(len(target)) - np.repeat(starts, np.diff(np.append(starts, len(target))))
        owners = target[starts]
        few = place < most
        wide = np.full((len(owners), 2 * most), none)
        wide[:, :most] = links[owners]
        wide[(np.cumsum(fresh) - 1)[few], most + place[few]] = source[few]
        wide = np.sort(wide, axis=1)
        wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = none
        wide = np.sort(wide, axis=1)
        full = wide[:, most] < none
        links[owners[~full]] = wide[~full, :most]
        over = np.flatnonzero(full)
        for at in range(0, len(over), 4 * BATCH):
            part = over[at : at + 4 * BATCH]
            own = self.near[owners[part]]
            close = np.matmul(self.near[wide[part]], own[:, :, None])[:, :, 0]
            close[wide[part] == none] = NOTHING
            links[owners[part]] = self.spread(wide[part], close, most)


def build(ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, seed: int = 0) -> Graph:
    """A graph over rows of unit length. Levels are drawn by a seeded generator in id order."""
    order = np.argsort(ids, kind="stable")
    drawn = np.random.default_rng(seed).random(len(ids))
    level = np.floor(-np.log1p(-drawn) / np.log(NEIGHBOURS)).astype(int)
    by_level = np.argsort(-level, kind="stable")
    level, order = level[by_level], order[by_level]
    graph = Graph(ids[order], weights[order], vectors[order], [])
    none = graph.size
    counts = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
    while len(counts) > 1 and counts[-1] < NEIGHBOURS:
        counts.pop()
    graph.links = [
        np.full((count + 1, NEIGHBOURS * (2 if k == 0 else 1)), none) for k, count in enumerate(counts)
    ]
    for k in range(len(counts) - 1, -1, -1):
        done = min(counts[k], DENSE)
        nodes = np.arange(done)
        sims = graph.near[:done] @ graph.near[:done].T
        keep = min(done, BUILD_BEAM + 1)
        near = np.argpartition(-sims, keep - 1, axis=1)[:, :keep] if done else np.empty((0, 0), dtype=int)
        graph._connect(k, nodes, near, np.take_along_axis(sims, near, axis=1))
        while done < counts[k]:
            nodes = np.arange(done, min(counts[k], done + BATCH))
            found, sims = graph.search(graph.near[nodes], BUILD_BEAM, floor=k)
            own = graph.near[nodes] @ graph.near[nodes].T
            keep = min(len(nodes), OWN_NEAREST)
            near = np.argpartition(-own, keep - 1, axis=1)[:, :keep]
            graph._connect(
                k, nodes, np.concatenate([found, nodes[near]], axis=1),
                np.concatenate([sims, np.take_along_axis(own, near, axis=1)], axis=1),
            )
            done += len(nodes)
    return graph

