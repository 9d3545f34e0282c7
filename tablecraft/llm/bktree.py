"""Burkhard-Keller trees over 64-bit fingerprints, many trees at a time in numpy arrays."""

from __future__ import annotations

import numpy as np

#: Pairs of a query and a node that are held at a time.
BLOCK = 1 << 20


class Forest:
    """One tree per shard. A node's children are keyed by their Hamming distance to the node.

    All trees are built together, a level at a time: the first fingerprint of each group is its
    node, and the rest of the group falls into child groups by distance to that node. The edges
    are kept sorted by (parent, distance), so the edges that a search follows are one slice.
    """

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        self.prints = prints
        size = len(prints)
        roots, heads, tails, keys = [], [], [], []
        rest = np.argsort(shard, kind="stable")
        group = shard[rest]
        parent = np.full(size, -1, dtype=np.int64)
        away = np.zeros(size, dtype=np.int64)
        first_level = True
        while len(rest):
            starts = np.r_[True, group[1:] != group[:-1]]
            node = rest[starts][np.cumsum(starts) - 1]
            if first_level:
                roots, self.shards = rest[starts], group[starts]
            else:
                heads.append(parent[rest[starts]])
                tails.append(rest[starts])
                keys.append(away[rest[starts]])
            rest, node = rest[~starts], node[~starts]
            distance = np.bitwise_count(prints[rest] ^ prints[node]).astype(np.int64)
            parent[rest], away[rest] = node, distance
            code = node * 65 + distance
            order = np.argsort(code, kind="stable")
            rest, group, first_level = rest[order], code[order], False
        self.roots = np.asarray(roots, dtype=np.int64)
        code = np.concatenate([h * 65 + k for h, k in zip(heads, keys)]) if heads else np.empty(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.edges = code[order]
        self.children = (np.concatenate(tails) if tails else np.empty(0, np.int64))[order]

    def search(self, shard: np.ndarray, prints: np.ndarray, radius: int):
        """Yield (query positions, node positions) of all fingerprints within the radius in the query's shard."""
        at = np.searchsorted(self.shards, shard)
        at[at == len(self.shards)] = 0
        known = np.flatnonzero(self.shards[at] == shard) if len(self.shards) else np.empty(0, np.int64)
        stack = [(known[i:i + BLOCK], self.roots[at[known[i:i + BLOCK]]]) for i in range(0, len(known), BLOCK)]
        while stack:
            query, node = stack.pop()
            distance = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), side="right")
            count = high - low
            if not count.any():
                continue
            ends = np.cumsum(count)
            for a, b in _slices(ends):
                part = count[a:b]
                total = int(part.sum())
                if total:
                    steps = np.arange(total) - np.repeat(np.cumsum(part) - part, part)
                    stack.append((np.repeat(query[a:b], part), self.children[np.repeat(low[a:b], part) + steps]))


def _slices(ends: np.ndarray):
    """Cut positions so that about BLOCK children are expanded at a time."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, side="right")))
        yield a, b
        a = b


def roots_of(size: int, links) -> np.ndarray:
    """The smallest position that each of ``size`` positions reaches over the links (pairs of arrays)."""
    label = np.arange(size)
    for a, b in links:
        while True:
            ra, rb = label[a], label[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while (label[label] != label).any():
                label = label[label]
    return label
