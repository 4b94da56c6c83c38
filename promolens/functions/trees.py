"""Regression trees on ranges, grown leaf by leaf from summed gradients; plain arrays, used inside tasks and by the driver."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

Histograms = dict[int, np.ndarray]


@dataclass
class Tree:
    """Nodes as arrays; rows of a range up to ``limit`` go left. A leaf has no left child but a value."""

    feature: list[int] = field(default_factory=list)
    limit: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for name, empty in (("feature", -1), ("limit", -1), ("left", -1), ("right", -1), ("value", 0.0)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def leaves_of(self, ranges: np.ndarray) -> np.ndarray:
        feature, limit, left, right = (np.array(v) for v in (self.feature, self.limit, self.left, self.right))
        node, at = np.zeros(len(ranges), np.int64), np.arange(len(ranges))
        while len(at):
            at = at[left[node[at]] >= 0]
            n = node[at]
            node[at] = np.where(ranges[at, feature[n]] <= limit[n], left[n], right[n])
        return node

    def values_of(self, ranges: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves_of(ranges)]


@dataclass
class Settings:
    rounds: int = 100
    leaves: int = 31
    depth: int = 12
    rate: float = 0.1
    bins: int = 128
    min_rows: int = 20
    pull: float = 1.0  # rows of value 0 that every leaf is mixed with
    row_share: float = 0.8
    feature_share: float = 0.8
    patience: int = 10
    refresh: int = 10
    weight: float = 1.0  # rows of the mean target that every category is mixed with
    seed: int = 42


def ranges_of(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Number of the range of each value; 0 is for missing values and for values below all training rows."""
    columns = [np.where(np.isnan(values[:, i]), 0, np.searchsorted(e, values[:, i], side="right")) for i, e in enumerate(edges)]
    return np.stack(columns, axis=1).astype(np.uint8)


def drawn(marks: np.ndarray, number: int, share: float) -> np.ndarray:
    """A share of the rows that follows from their marks and a number."""
    mixed = (marks.astype(np.uint64) ^ np.uint64(number * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(40)).astype(float) < share * 2**24


@dataclass
class Node:
    """A leaf that may be split: its summed gradients and rows by (feature, range) and its best split."""

    depth: int
    total: float
    rows: int
    sums: np.ndarray | None = None
    gain: float = 0.0
    feature: int = -1
    limit: int = -1
    children: tuple[int, int] | None = None


def best_split(sums: np.ndarray, features: list[int], s: Settings) -> tuple[float, int, int, np.ndarray]:
    """(gain, feature, limit, (gradient, rows) left); the first of equal gains. Gain 0 where no split is allowed."""
    left = sums.cumsum(axis=1)
    whole = left[:, -1:, :]
    right = whole - left
    worth = lambda x: x[..., 0] ** 2 / (x[..., 1] + s.pull)
    gain = worth(left) + worth(right) - worth(whole)
    allowed = (left[..., 1] >= s.min_rows) & (right[..., 1] >= s.min_rows)
    gain = np.where(allowed, gain, 0.0)
    at = int(gain.argmax())
    f, limit = divmod(at, gain.shape[1])
    return float(gain.flat[at]), features[f], limit, left[f, limit]


def grow(histograms: Callable[[Tree, list[int]], Histograms], features: list[int], step: float, s: Settings) -> Tree:
    """One tree, best leaf first. ``histograms`` sums the drawn rows at nodes of a tree by (feature, range)."""
    tree = Tree()
    root = tree.add()
    sums = histograms(tree, [root])[root]
    nodes = {root: Node(0, sums[0, :, 0].sum(), int(sums[0, :, 1].sum()), sums)}
    kept = Tree()
    kept.add()
    place, waiting, leaves = {root: 0}, [], 1

    def offer(n: int) -> None:
        node = nodes[n]
        if node.depth < s.depth:
            # Sums are whole numbers of the step; the gain is compared in units of the target.
            node.gain, node.feature, node.limit, _ = best_split(node.sums * np.array([step, 1.0]), features, s)
            if node.gain > 1e-12:
                heapq.heappush(waiting, (-node.gain, n))

    def look_ahead(wanted: list[int]) -> None:
        """Sums of the children of all leaves that may come next, in one pass."""
        smaller = []
        for n in wanted:
            node = nodes[n]
            part = node.sums[features.index(node.feature), : node.limit + 1].sum(axis=0)
            a, b = tree.add(), tree.add()
            tree.feature[n], tree.limit[n], tree.left[n], tree.right[n] = node.feature, node.limit, a, b
            node.children = (a, b)
            nodes[a] = Node(node.depth + 1, part[0], int(part[1]))
            nodes[b] = Node(node.depth + 1, node.total - part[0], node.rows - int(part[1]))
            smaller.append((a, b, n) if nodes[a].rows <= nodes[b].rows else (b, a, n))
        found = histograms(tree, [c for c, _, _ in smaller])
        for c, other, n in smaller:
            nodes[c].sums, nodes[other].sums = found[c], nodes[n].sums - found[c]

    offer(root)
    while waiting and leaves < s.leaves:
        _, n = heapq.heappop(waiting)
        node = nodes[n]
        if node.children is None:
            look_ahead([n, *sorted(m for _, m in waiting if nodes[m].children is None)])
        at = place[n]
        kept.feature[at], kept.limit[at] = node.feature, node.limit
        kept.left[at], kept.right[at] = kept.add(), kept.add()
        place[node.children[0]], place[node.children[1]] = kept.left[at], kept.right[at]
        leaves += 1
        for c in node.children:
            offer(c)
    for n, at in place.items():
        if kept.left[at] < 0:
            kept.value[at] = float(s.rate * nodes[n].total * step / (nodes[n].rows + s.pull))
    return kept


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)
