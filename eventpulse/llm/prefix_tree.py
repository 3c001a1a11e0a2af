"""A join of ordered sets on a compressed prefix tree.

Sets are sequences in one global order. The tree shares their common beginnings: an
edge holds the members between two branchings. A probe walks the tree level by level.
At each edge the members it shares are counted once for all sets below; a subtree is
left when what it shares so far, plus the most that its remaining length and the
probe's remaining members allow, stays under what its shortest set needs.
"""

from __future__ import annotations

import numpy as np


def needed(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Members that sets of these sizes must share for a similarity of 0.75: 100 * shared >= 75 * union."""
    return -(-3 * (n + m) // 7)


class PrefixTree:
    """``sets``: arrays of increasing ranks. ``sizes``: full sizes, which may count members that no other set has."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        flat, edge_from, edge_to, parent = [], [], [], []
        sets_of: list[list[int]] = []  # by the edge at whose end they end
        at = 0

        def edge(members: np.ndarray, above: int) -> int:
            nonlocal at
            flat.append(members)
            edge_from.append(at)
            at += len(members)
            edge_to.append(at)
            parent.append(above)
            sets_of.append([])
            return len(parent) - 1

        # The open path: edges with the depth at which they end. A new set leaves it where it stops agreeing.
        path: list[tuple[int, int]] = []
        last = np.zeros(0, np.int64)
        for i in order:
            own = sets[i]
            short = min(len(own), len(last))
            differ = np.flatnonzero(own[:short] != last[:short])
            shared = int(differ[0]) if len(differ) else short
            while path and path[-1][1] > shared:
                number, end = path.pop()
                begin = end - (edge_to[number] - edge_from[number])
                if begin < shared:  # split: the upper part stays on the path
                    upper = edge(np.zeros(0, np.int64), parent[number])
                    cut_at = edge_from[number] + shared - begin
                    edge_from[upper], edge_to[upper] = edge_from[number], cut_at
                    edge_from[number], parent[number] = cut_at, upper
                    path.append((upper, shared))
            if len(own) > shared or not path:
                path.append((edge(own[shared:], path[-1][0] if path else -1), len(own)))
            sets_of[path[-1][0]].append(i)
            last = own
        self.members = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        self.begin, self.end = np.array(edge_from, np.int64), np.array(edge_to, np.int64)
        self.sizes = sizes
        n = len(parent)
        # Bounds of what lies below each edge.
        self.longest_rest, self.least_size = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        for i, own in enumerate(sets_of):
            if own:
                self.least_size[i] = sizes[own].min()
        self.ending = np.array([i for own in sets_of for i in own], np.int64)
        self.first_ending = np.concatenate(([0], np.cumsum([len(own) for own in sets_of]))).astype(np.int64)
        depth = np.zeros(n, np.int64)
        for i in range(n):
            above, steps = parent[i], 0
            while above >= 0:
                above, steps = parent[above], steps + 1
            depth[i] = steps
        for i in np.argsort(-depth, kind="stable").tolist():
            if (above := parent[i]) >= 0:
                self.longest_rest[above] = max(self.longest_rest[above], self.longest_rest[i] + self.end[i] - self.begin[i])
                self.least_size[above] = min(self.least_size[above], self.least_size[i])
        by_parent = np.argsort(parent, kind="stable")
        self.children = by_parent
        sorted_parents = np.array(parent, np.int64)[by_parent]
        self.first_child = np.searchsorted(sorted_parents, np.arange(-1, n))  # of the root first, then of each edge
        self.last_child = np.searchsorted(sorted_parents, np.arange(-1, n), side="right")

    def probe(self, own: np.ndarray, size: int, marked: np.ndarray) -> np.ndarray:
        """Sets that share enough with the probe. ``marked`` is an all-false array over ranks, given back so."""
        marked[own] = True
        found = [np.zeros(0, np.int64)]
        edges = self.children[self.first_child[0] : self.last_child[0]]
        shared = np.zeros(len(edges), np.int64)
        while len(edges):
            lengths = self.end[edges] - self.begin[edges]
            shift = np.cumsum(lengths) - lengths
            places, _ = _spread(self.begin[edges], self.end[edges])
            hits = np.concatenate(([0], np.cumsum(marked[self.members[places]])))
            shared = shared + hits[shift + lengths] - hits[shift]
            # What the probe has left beyond the edge's last member.
            ends = np.where(lengths > 0, self.members[np.maximum(self.end[edges] - 1, 0)], -1)
            left = np.minimum(self.longest_rest[edges], len(own) - np.searchsorted(own, ends, side="right"))
            alive = shared + left >= needed(self.least_size[edges], size)
            edges, shared = edges[alive], shared[alive]
            ending, of = _spread(self.first_ending[edges], self.first_ending[edges + 1])
            sets = self.ending[ending]
            found.append(sets[shared[of] >= needed(self.sizes[sets], size)])
            below, of = _spread(self.first_child[edges + 1], self.last_child[edges + 1])
            edges, shared = self.children[below], shared[of]
        marked[own] = False
        return np.concatenate(found)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each first up to each last, and the place of the pair that each is from."""
    n = last - first
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n), np.repeat(np.arange(len(n)), n)
