"""Search in BK-trees of fingerprints, many trees at once.

A tree's root is its first fingerprint; a node's children hang on edges marked
with their Hamming distance to it, one child per distance. By the triangle
inequality a fingerprint within the radius of the query can only lie below edges
whose mark differs from the query's own distance to the node by no more than the
radius, so only those are followed.

One call handles a batch of small shards, each with a tree of its own; all trees
are built and searched level by level with arrays.
"""

from __future__ import annotations

import numpy as np

QUERIES_AT_ONCE = 1024


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Forest:
    """A tree for each shard over the rows marked ``in_tree``; prints of a shard differ."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray, in_tree: np.ndarray):
        self.prints, self.marks = prints, prints.shape[1] * 64 + 1
        rows = np.flatnonzero(in_tree)
        shards, first, place = np.unique(shard[rows], return_index=True, return_inverse=True)
        at = rows[first][place]  # the node each row has come to; the shard's first row is the root
        self.root = np.full(int(shard.max()) + 1 if len(shard) else 0, -1)
        self.root[shards] = rows[first]
        parent, mark, nodes = [], [], []
        moving = rows != at
        rows, at = rows[moving], at[moving]
        while len(rows):
            far = distances(prints[rows], prints[at])
            _, first, place = np.unique(at * self.marks + far, return_index=True, return_inverse=True)
            child = rows[first]  # the first to come along an edge becomes its child
            nodes.append(child)
            parent.append(at[first])
            mark.append(far[first])
            at = child[place]
            moving = rows != at
            rows, at = rows[moving], at[moving]
        self.nodes, self.edges = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if nodes:
            edges = np.concatenate(parent) * self.marks + np.concatenate(mark)
            order = np.argsort(edges)
            self.nodes, self.edges = np.concatenate(nodes)[order], edges[order]

    def near(self, queries: np.ndarray, shard: np.ndarray, radius: int):
        """(query, node, distance) of all nodes of the queries' own shards within the radius."""
        at = self.root[shard]
        queries, at = queries[at >= 0], at[at >= 0]
        found = []
        while len(queries):
            far = distances(self.prints[queries], self.prints[at])
            hit = far <= radius
            found.append((queries[hit], at[hit], far[hit]))
            base = at * self.marks
            low = np.searchsorted(self.edges, base + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edges, base + np.minimum(far + radius, self.marks - 1), side="right")
            many = high - low
            queries = np.repeat(queries, many)
            starts = np.cumsum(many) - many
            at = self.nodes[np.repeat(low - starts, many) + np.arange(len(queries))]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(part) for part in zip(*found))


def spanning_links(prints: np.ndarray, shard: np.ndarray, in_tree: np.ndarray, radius: int):
    """Links within the radius that connect all that the radius connects: (row, row, distance).

    Rows in a tree are linked among themselves, the other rows of a shard to those in
    its tree. Of the links of a query the nearest come first, and a link between rows
    that are already connected is left out, so there are fewer than two for each row.
    """
    forest = Forest(prints, shard, in_tree)
    label = np.arange(len(prints))
    out = []
    for start in range(0, len(prints), QUERIES_AT_ONCE):
        rows = np.arange(start, min(start + QUERIES_AT_ONCE, len(prints)))
        query, node, far = forest.near(rows, shard[rows], radius)
        new = ~in_tree[query] | (node < query)
        query, node, far = query[new], node[new], far[new]
        order = np.argsort(far, kind="stable")
        query, node, far = query[order], node[order], far[order]
        while True:
            a, b = label[query], label[node]
            apart = a != b
            if not apart.any():
                break
            query, node, far, a, b = query[apart], node[apart], far[apart], a[apart], b[apart]
            high, first = np.unique(np.maximum(a, b), return_index=True)  # the nearest link of each
            out.append((query[first], node[first], far[first]))
            label[high] = np.minimum(a, b)[first]
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out))
