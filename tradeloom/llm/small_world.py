"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches.

Nodes are ordered by falling level, so that each layer is a prefix of the nodes. A node's neighbours in
a layer are chosen among the best found by a beam search for it: one is taken if it is closer to the
node than to any neighbour taken before, and free places go to the best of the rest. Links go both
ways; a node with too many chooses again. All steps work on a batch of nodes or queries at once.

A graph holds the vectors as they came and unit vectors in single precision; those in double precision
are made for the nodes that are asked for. Pairs are handed out in pieces, so that a query with very many
links, or many such queries, take no more memory than a piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LINKS, BASE_LINKS, BUILD_BEAM, BATCH, SEED = 12, 24, 48, 256, 23
_AT_ONCE = 4  # nodes that a beam opens per step
SCAN_SHARE = 16
_VISITED_CELLS = 32_000_000
_PAIRS = 65_536  # compared in double precision at once
_ROWS = 8192  # normalised at once


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


class SmallWorld:
    """`vectors` are those given, in node order; `order` gives each node's input row."""

    def __init__(self, vectors: np.ndarray):
        dice = np.random.default_rng(SEED)
        levels = np.floor(-np.log(1 - dice.random(len(vectors))) / np.log(LINKS)).astype(np.int64)
        self.order = np.argsort(-levels, kind="stable")
        self.vectors = vectors[self.order]
        self.small = self._small()
        sizes = [int((levels >= level).sum()) for level in range(int(levels.max(initial=0)) + 1)]
        self.tables: list[np.ndarray] = [np.zeros((0, 0), np.int32)] * len(sizes)
        for level in reversed(range(len(sizes))):
            self._build(level, sizes[level])

    @property
    def unit(self) -> np.ndarray:
        return unit_rows(self.vectors)

    def _small(self) -> np.ndarray:
        small = np.empty(self.vectors.shape, np.float32)
        for at in range(0, len(small), _ROWS):
            small[at : at + _ROWS] = unit_rows(self.vectors[at : at + _ROWS])
        return small

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "small"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.small = self._small()

    def cosines(self, queries: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Of pairs of a query, a unit vector, and a node, in double precision."""
        cosines = np.empty(len(rows))
        for at in range(0, len(rows), _PAIRS):
            some = slice(at, at + _PAIRS)
            cosines[some] = np.einsum("kd,kd->k", queries[rows[some]], unit_rows(self.vectors[nodes[some]]))
        return cosines

    def _build(self, level: int, size: int) -> None:
        table = np.full((size, BASE_LINKS if level == 0 else LINKS), -1, np.int32)
        self.tables[level] = table
        done = min(1, size)
        while done < size:
            end = min(size, done + min(done, BATCH))
            batch = np.arange(done, end)
            entry = self._descend(self.small[batch], level)
            found, close, _ = self._beam(self.small[batch], entry, level, BUILD_BEAM, 2.0, done)
            among = self.small[batch] @ self.small[batch].T
            np.fill_diagonal(among, -np.inf)
            nodes = np.concatenate([found, np.broadcast_to(batch, (len(batch), len(batch)))], axis=1)
            sims = np.concatenate([close, among], axis=1)
            table[batch] = self._choose(nodes, sims, table.shape[1], BUILD_BEAM)
            self._link_back(table, batch)
            done = end

    def _choose(self, nodes: np.ndarray, sims: np.ndarray, links: int, beam: int) -> np.ndarray:
        """Per row up to `links` of the nodes, -1 where there are fewer; sims of -inf are no node."""
        beam = min(beam, nodes.shape[1])
        top = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        nodes, sims = np.take_along_axis(nodes, top, 1), np.take_along_axis(sims, top, 1)
        valid = np.isfinite(sims)
        nodes = np.where(valid, nodes, -1)
        vectors = self.small[np.maximum(nodes, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        taken, nearest = np.zeros(nodes.shape, bool), np.full(nodes.shape, -np.inf, np.float32)
        for j in range(beam):
            take = valid[:, j] & (sims[:, j] > nearest[:, j]) & (taken.sum(axis=1) < links)
            taken[:, j] = take
            nearest = np.where(take[:, None], np.maximum(nearest, between[:, j]), nearest)
        rank = np.where(taken, 0, 1) + np.where(valid, 0, 2)
        first = np.argsort(rank, axis=1, kind="stable")[:, :links]
        chosen = np.take_along_axis(nodes, first, 1)
        if chosen.shape[1] < links:
            chosen = np.pad(chosen, ((0, 0), (0, links - chosen.shape[1])), constant_values=-1)
        return chosen

    def _link_back(self, table: np.ndarray, batch: np.ndarray) -> None:
        links = table.shape[1]
        to, source = table[batch].ravel(), np.repeat(batch, links)
        to, source = to[to >= 0], source[to >= 0]
        pairs = np.unique(to.astype(np.int64) * len(self.small) + source)
        to, source = np.divmod(pairs, len(self.small))
        known = (table[to] == source[:, None]).any(axis=1)
        to, source = to[~known], source[~known]
        while len(to):
            starts = np.searchsorted(to, to, side="left")
            now = np.arange(len(to)) - starts < links  # the rest of a node's new links waits a round
            some, rows = np.unique(to[now], return_inverse=True)
            place = np.arange(len(to))[now] - starts[now]
            fresh = np.full((len(some), int(place.max()) + 1), -1, np.int64)
            fresh[rows, place] = source[now]
            nodes = np.concatenate([table[some], fresh], axis=1)
            sims = np.einsum("qd,qkd->qk", self.small[some], self.small[np.maximum(nodes, 0)])
            sims = np.where(nodes >= 0, sims, -np.inf)
            table[some] = self._choose(nodes, sims, links, nodes.shape[1])
            to, source = to[~now], source[~now]

    def _descend(self, queries: np.ndarray, level: int) -> np.ndarray:
        """One entry per query for a layer, through all layers above."""
        entry = np.zeros((len(queries), 1), np.int64)
        for above in reversed(range(level + 1, len(self.tables))):
            entry = self._beam(queries, entry, above, 4, 2.0)[0][:, :1]
        return entry

    def _beam(self, queries, entry, level, width, threshold, built=None):
        """The `width` best nodes per query (-1, -inf where fewer), and (query, node) of all nodes met
        with a similarity of `threshold` or more."""
        table, total = self.tables[level], len(queries)
        reach = built or len(table)
        step = max(1, min(total, _VISITED_CELLS // max(reach, 1)))
        if step < total:
            parts = [self._beam(queries[i : i + step], entry[i : i + step], level, width, threshold, built) for i in range(0, total, step)]
            hits = [np.stack([part[2][0] + i * step, part[2][1]]) for i, part in enumerate(parts)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate(hits, axis=1)
        met = np.zeros((total, reach), bool)
        nodes = np.full((total, width), -1, np.int64)
        sims = np.full((total, width), -np.inf, np.float32)
        opened = np.zeros((total, width), bool)
        hits: list[np.ndarray] = []
        rows, fresh = np.arange(total), entry
        while len(rows):
            fresh = np.sort(fresh, axis=1)
            repeated = np.zeros(fresh.shape, bool)
            repeated[:, 1:] = fresh[:, 1:] == fresh[:, :-1]
            usable = (fresh >= 0) & (fresh < reach) & ~repeated
            safe = np.where(usable, fresh, 0)
            usable &= ~met[rows[:, None], safe]
            close = np.einsum("qd,qkd->qk", queries[rows], self.small[safe])
            close = np.where(usable, close, -np.inf).astype(np.float32)
            r, c = np.nonzero(usable)
            met[rows[r], safe[r, c]] = True
            r, c = np.nonzero(close >= threshold)
            if len(r):
                hits.append(np.stack([rows[r], safe[r, c]]))
            all_nodes = np.concatenate([nodes[rows], np.where(usable, safe, -1)], axis=1)
            all_sims = np.concatenate([sims[rows], close], axis=1)
            all_opened = np.concatenate([opened[rows], np.zeros(close.shape, bool)], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            nodes[rows] = np.take_along_axis(all_nodes, best, 1)
            sims[rows] = np.take_along_axis(all_sims, best, 1)
            opened[rows] = np.take_along_axis(all_opened, best, 1)
            closed = opened[rows] | (nodes[rows] < 0)
            rows, closed = rows[~closed.all(axis=1)], closed[~closed.all(axis=1)]
            if not len(rows):
                break
            # Beams are sorted, so the first closed-off places are the best ones not yet opened.
            places = np.argsort(closed, axis=1, kind="stable")[:, : min(_AT_ONCE, width)]
            open_now = ~np.take_along_axis(closed, places, 1)
            chosen = np.where(open_now, nodes[rows[:, None], places], -1)
            opened[rows[:, None], places] = True
            fresh = np.where(chosen[:, :, None] >= 0, table[np.maximum(chosen, 0)], -1).reshape(len(rows), -1)
        return nodes, sims, np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), np.int64)

    def near(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) with a cosine of `least` or more that beams of at least `width` meet."""
        return _together(self.near_pieces(queries, least, width))

    def near_pieces(self, queries: np.ndarray, least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same in pieces. The beam of a query that is full of such nodes is widened until it is not; from a
        share of one in SCAN_SHARE of the graph on, a scan of it costs less than a wider beam."""
        small = queries.astype(np.float32)
        margin = least - 1e-4  # single precision finds, double precision decides
        todo, widened = np.arange(len(queries)), False
        while len(todo):
            if len(self.small) <= width or widened and len(self.small) <= SCAN_SHARE * width:
                for rows, nodes in self.scan_pieces(queries[todo], least):
                    yield todo[rows], nodes
                break
            still = []
            step = max(1, _VISITED_CELLS // 8 // min(SCAN_SHARE * width, len(self.small)))  # a beam meets some nodes for each place
            for at in range(0, len(todo), step):
                some = todo[at : at + step]
                entry = self._descend(small[some], 0)
                _, sims, hits = self._beam(small[some], entry, 0, width, margin)
                full = sims[:, -1] >= margin
                keep = ~full[hits[0]]
                rows, nodes = some[hits[0][keep]], hits[1][keep]
                exact = self.cosines(queries, rows, nodes) >= least
                yield rows[exact], nodes[exact]
                still.append(some[full])
            todo, width, widened = np.concatenate(still), 2 * width, True

    def scan(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The same, without the graph and complete."""
        return _together(self.scan_pieces(queries, least))

    def scan_pieces(self, queries: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, _VISITED_CELLS // 8 // _ROWS)
        for first in range(0, len(self.vectors), _ROWS):
            unit = unit_rows(self.vectors[first : first + _ROWS])
            for at in range(0, len(queries), step):
                rows, nodes = np.nonzero(queries[at : at + step] @ unit.T >= least)
                yield rows + at, nodes + first


def _together(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *pieces]
    return np.concatenate([rows for rows, _ in found]), np.concatenate([nodes for _, nodes in found])
