"""Histogram regression trees: what a task does with its rows (numpy).

Features are bin numbers of one byte. Gradients are integers (residuals in units of
``1 / scale``), so sums are exact and a tree does not depend on how its rows are
spread or in which order partial histograms are added: :mod:`seriesforge.plans.trees`
grows the same tree from histograms that Spark sums as from rows inside a task.

A tree is grown level by level. With a limit on leaves the splits are then taken
best first: a split's gain does not depend on when it is made, so the tree is the
one that leaf-wise growth makes (within the depth limit).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
CACHED = 1 << 15  # values in one array of a level


@dataclass(frozen=True)
class Trees:
    """Sizes of a candidate. ``boost``: every tree fits what the trees before it
    left; ``forest``: every tree fits rows drawn with replacement, and the mean
    counts. ``min_leaf`` and ``min_split`` count rows (draws in a forest), ``l2`` is
    added to a leaf's rows. With ``patience`` a boosted model stops after so many
    rounds without a lower validation error and keeps the rounds up to the lowest."""

    kind: str = "boost"
    trees: int = 500
    max_depth: int = 8
    learning_rate: float = 0.05
    max_leaves: int = 0
    min_leaf: int = 1
    min_split: int = 2
    l2: float = 0.0
    patience: int = 0
    seed: int = 42


#: Shares of draws 0, 1, 2, ... when rows are drawn with replacement (Poisson of mean 1).
DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1, 16)))))


def draws(row: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree, by a hash of its number."""
    x = row.astype(U64) ^ U64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> U64(shift))) * U64(factor)
    x ^= x >> U64(33)
    return np.searchsorted(DRAWS, (x >> U64(11)).astype(float) / (1 << 53), "right").astype(np.int64)


def histogram(bins: np.ndarray, order: np.ndarray, node: np.ndarray, g: np.ndarray, w: np.ndarray | None):
    """Sums over the rows of each (feature, node, bin), in that order: feature, node,
    bin, n, g. ``bins`` is features x rows, ``order`` sorts the rows of every feature
    by bin, ``node`` (16 bits) counts from 0, ``w`` counts a row several times."""
    features, rows = order.shape
    if not rows:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    nodes = node[order]
    order = np.take_along_axis(order, np.argsort(nodes, axis=1, kind="stable"), axis=1)
    key = node[order].astype(np.int32) << 8 | np.take_along_axis(bins, order, axis=1)
    last = np.ones((features, rows), bool)
    last[:, :-1] = key[:, 1:] != key[:, :-1]
    at = np.flatnonzero(last)
    feature = at // rows
    total = np.cumsum(g[order], axis=1).ravel()[at]
    count = np.cumsum(w[order], axis=1).ravel()[at] if w is not None else at - feature * rows + 1
    first = np.ones(len(at), bool)
    first[1:] = feature[1:] != feature[:-1]
    for x in (total, count):
        x[1:] = np.where(first[1:], x[1:], np.diff(x))
    found = key.ravel()[at]
    return feature, found >> 8, found & 255, count, total


def best_splits(feature, node, bin_, n, g, nodes: int, p: Trees):
    """For each node gain, feature, bin, and rows and gradient on the left of its best
    split (gain 0: none); equal gains: the first feature, then the first bin. The
    arguments are sorted by feature, node and bin, as :func:`histogram` gives them."""
    out = np.zeros(nodes), *(np.full(nodes, -1, np.int64) for _ in range(4))
    if not len(feature):
        return out
    start = np.ones(len(feature), bool)
    start[1:] = (feature[1:] != feature[:-1]) | (node[1:] != node[:-1])
    segment = np.cumsum(start) - 1
    first = np.flatnonzero(start)
    end = np.append(first[1:], len(feature)) - 1
    cn, cg = np.cumsum(n), np.cumsum(g)
    before_n, before_g = (cn - n)[first], (cg - g)[first]
    left_n, left_g = cn - before_n[segment], cg - before_g[segment]
    all_n, all_g = left_n[end][segment], left_g[end][segment]
    right_n, right_g = all_n - left_n, all_g - left_g
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = left_g.astype(float) ** 2 / (left_n + p.l2) + right_g.astype(float) ** 2 / (right_n + p.l2)
        gain = parts - all_g.astype(float) ** 2 / (all_n + p.l2)
    good = (left_n >= p.min_leaf) & (right_n >= max(1, p.min_leaf)) & (all_n >= p.min_split)
    good &= gain > 1e-10 * parts  # no gain but rounding
    at = np.flatnonzero(good)
    np.maximum.at(out[0], node[at], gain[at])
    at = at[gain[at] == out[0][node[at]]]
    which, place = np.unique(node[at], return_index=True)
    at = at[place]
    for x, value in zip(out[1:], (feature, bin_, left_n, left_g)):
        x[which] = value[at]
    return out


class Growing:
    """A tree while it grows. ``path`` numbers its nodes: 1 is the root, 2p and 2p + 1
    are the children of p."""

    def __init__(self, n: int, g: int, path: int = 1):
        self.path, self.feature, self.bin, self.left = [path], [-1], [-1], [-1]
        self.n, self.g, self.gain = [n], [g], [0.0]

    def split(self, node: int, feature: int, bin_: int, n: int, g: int, gain: float) -> None:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin_, len(self.n), gain
        p = self.path[node]
        self.path += [2 * p, 2 * p + 1]
        self.n += [n, self.n[node] - n]
        self.g += [g, self.g[node] - g]
        for x, none in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.gain, 0.0)):
            x += [none, none]

    def graft(self, node: int, other: "Growing") -> None:
        """``other`` grew from this node."""
        todo = [(node, 0)]
        while todo:
            mine, theirs = todo.pop()
            if other.left[theirs] >= 0:
                down = other.left[theirs]
                self.split(mine, other.feature[theirs], other.bin[theirs], other.n[down], other.g[down], other.gain[theirs])
                todo += [(self.left[mine], down), (self.left[mine] + 1, down + 1)]

    def taken(self, max_leaves: int) -> set[int]:
        """The nodes whose splits are made, best first, until there are so many leaves
        (0: all splits)."""
        kept, heap, leaves = set(), [(-self.gain[0], self.path[0], 0)], 1
        while heap and (not max_leaves or leaves < max_leaves):
            _, _, i = heapq.heappop(heap)
            if self.left[i] >= 0:
                kept.add(i)
                leaves += 1
                for j in (self.left[i], self.left[i] + 1):
                    heapq.heappush(heap, (-self.gain[j], self.path[j], j))
        return kept

    def worth(self, nodes: list[int], max_leaves: int) -> list[int]:
        """Of nodes of the last level those that may have a place in the tree: later
        splits only take places away, so a node whose parent's split has none now
        never gets one."""
        if not max_leaves:
            return nodes
        down = {j for i in self.taken(max_leaves) for j in (self.left[i], self.left[i] + 1)}
        return [i for i in nodes if i in down or i == 0]

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row (column of ``bins``) ends."""
        return descend(np.array(self.feature), np.array(self.bin), np.array(self.left), np.zeros(bins.shape[1], np.int64), bins)

    def finished(self, p: Trees) -> tuple["Growing", np.ndarray]:
        """The tree with its splits taken best first, within ``max_leaves``, and its
        nodes in order of their paths; and the new node for each old one."""
        kept = self.taken(p.max_leaves)
        out, new, todo = Growing(self.n[0], self.g[0], self.path[0]), np.full(len(self.n), -1), [0]
        new[0] = 0
        for i in todo:  # breadth first is the order of the paths
            if i in kept:
                down = self.left[i]
                out.split(int(new[i]), self.feature[i], self.bin[i], self.n[down], self.g[down], self.gain[i])
                new[down], new[down + 1] = out.left[new[i]], out.left[new[i]] + 1
                todo += [down, down + 1]
        for i in range(len(self.n)):  # parents come before their children
            if self.left[i] >= 0 and i not in kept:
                new[self.left[i]] = new[self.left[i] + 1] = new[i]
        return out, new

    def values(self, p: Trees, scale: float) -> np.ndarray:
        """What each leaf adds to a prediction."""
        value = np.array(self.g) / scale / np.maximum(np.array(self.n) + p.l2, 1e-300)
        return value * (p.learning_rate if p.kind == "boost" else 1 / p.trees)


def descend(feature: np.ndarray, bin_: np.ndarray, left: np.ndarray, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """From the nodes ``at`` (one for each column of ``bins``) down to leaves."""
    rows = np.arange(bins.shape[1])
    while len(rows):
        here = at[rows]
        rows = rows[feature[here] >= 0]
        here = at[rows]
        at[rows] = left[here] + (bins[feature[here], rows] > bin_[here])
    return at


def best_in_rows(bin_: np.ndarray, g: np.ndarray, w: np.ndarray | None, starts: np.ndarray, p: Trees, floor: np.ndarray):
    """:func:`best_splits` of rows that lie sorted by node and bin, feature by feature
    (``bin_``, ``g`` and ``w`` are features x rows; the nodes begin at ``starts``), but
    only of the nodes (first of the results) with a gain above their ``floor``."""
    features, rows = bin_.shape
    size = np.diff(np.append(starts, rows))
    reach = np.zeros((features, rows + 1))
    np.cumsum(g, axis=1, out=reach[:, 1:])  # integers below 2**53: exact
    before = reach[:, starts]
    all_g = reach[0, starts + size] - before[0]
    left_g = reach[:, 1:] - np.repeat(before, size, axis=1)
    right_g = np.repeat(all_g, size) - left_g
    if w is None:
        left_n = (np.arange(rows) - np.repeat(starts, size) + 1)[None]
        all_n = size
    else:
        reach = np.zeros((features, rows + 1), np.int64)
        np.cumsum(w, axis=1, out=reach[:, 1:])
        all_n = reach[0, starts + size] - reach[0, starts]
        left_n = reach[:, 1:] - np.repeat(reach[:, starts], size, axis=1)
    right_n = np.repeat(all_n, size) - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g ** 2 / (left_n + p.l2)
        gain += right_g ** 2 / (right_n + p.l2)
        limit = 1e-10 * gain
        gain -= np.repeat(all_g ** 2 / (all_n + p.l2), size)
    good = gain > limit
    good &= (left_n >= p.min_leaf) & (right_n >= max(1, p.min_leaf)) & np.repeat(all_n >= p.min_split, size)
    good[:, :-1] &= (bin_[:, 1:] != bin_[:, :-1])  # a bin is not cut; nodes end anyway
    gain = np.where(good, gain, 0.0)
    best = np.maximum.reduceat(gain, starts, axis=1)
    feature = best.argmax(axis=0)
    top = best[feature, np.arange(len(starts))]
    node = np.flatnonzero(top > floor)
    top, feature, size = top[node], feature[node], size[node]
    # the first place in each of these nodes that has its gain
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(feature * rows + starts[node] - first, size)
    hit = np.flatnonzero(gain.ravel().take(at) == np.repeat(top, size))
    at = at[hit[np.searchsorted(hit, first)]]
    n = left_n[0].take(at - feature * rows) if w is None else left_n.ravel().take(at)
    return node, top, feature, bin_.ravel().take(at), n, left_g.ravel().take(at)


def grow(bins: np.ndarray, g: np.ndarray, w: np.ndarray | None, p: Trees, order: np.ndarray, path: int = 1) -> tuple[Growing, np.ndarray]:
    """A tree (below ``path``) from rows, and the node of each row. ``order`` sorts the
    rows of every feature by bin. Not cut to ``max_leaves`` yet."""
    features, rows = order.shape
    node_of = np.zeros(rows, np.int64)
    tree = Growing(int(w.sum()) if w is not None else rows, int(g.sum()), path)
    # some features at a time: arrays that stay in the processor's cache
    step = max(1, CACHED // max(1, rows))
    parts = []
    for lo in range(0, features, step):
        some = order[lo:lo + step]
        parts.append([some, bins[lo:lo + step].ravel().take(some + (np.arange(len(some)) * rows)[:, None])])
    g = g.astype(float)
    frontier = [0]
    for _ in range(p.max_depth - (path.bit_length() - 1)):
        frontier = [i for i in tree.worth(frontier, p.max_leaves) if tree.n[i] >= max(p.min_split, 2 * p.min_leaf, 2)]
        if not frontier:
            break
        more = CACHED // max(1, parts[0][0].shape[1]) // step
        if more > 1 and len(parts) > 1:  # fewer rows are left: more features at a time
            parts = [[np.concatenate(x) for x in zip(*parts[i:i + more])] for i in range(0, len(parts), more)]
            step *= more
        compact = np.full(len(tree.n), 65535, np.uint16)
        compact[frontier] = np.arange(len(frontier))
        node = compact.take(node_of)
        for k, part in enumerate(parts):
            some, values = part
            nodes = node.take(some)
            if k == 0:
                width = int((nodes[0] != 65535).sum())
            if width < nodes.shape[1]:
                keep = nodes != 65535
                some, values, nodes = (x[keep].reshape(len(x), width) for x in (some, values, nodes))
            turn = np.argsort(nodes, axis=1, kind="stable")
            turn += (np.arange(len(turn)) * width)[:, None]
            some, values = part[:] = some.take(turn), values.take(turn)
            if k == 0:
                starts = np.searchsorted(nodes[0].take(turn[0]), np.arange(len(frontier)))
            if k == 0:
                found = np.zeros((5, len(frontier)))  # whole numbers below 2**53 but for the gain
            which, *best = best_in_rows(values, g.take(some), None if w is None else w.take(some), starts, p, found[0])
            best[1] = best[1] + k * step
            found[:, which] = best
        nxt = []
        for i, gain, *split in zip(frontier, found[0].tolist(), *found[1:].astype(np.int64).tolist()):
            if gain > 0:
                tree.split(i, *split, gain)
                nxt += [tree.left[i], tree.left[i] + 1]
        some = parts[0][0][0]
        here = node_of[some]
        left = np.array(tree.left)[here]
        some, here, left = some[left >= 0], here[left >= 0], left[left >= 0]
        node_of[some] = left + (bins[np.array(tree.feature)[here], some] > np.array(tree.bin)[here])
        frontier = nxt
    return tree, node_of


def by_bin(bins: np.ndarray) -> np.ndarray:
    return np.argsort(bins, axis=1, kind="stable").astype(np.int32)


def gradients(residual: np.ndarray, scale: float) -> np.ndarray:
    return np.rint(residual * scale).astype(np.int64)


def boosted(bins: np.ndarray, y: np.ndarray, valid: np.ndarray, p: Trees, base: float, scale: float):
    """All rounds of a boosted model: (tree, leaf values) of each round kept, and the
    validation error (root mean square) after every round run."""
    train, order = ~valid, None
    inside, truth = np.ascontiguousarray(bins[:, train]), y[train]
    order = by_bin(inside)
    outside, checked = np.ascontiguousarray(bins[:, valid]), y[valid]
    pred, guess = np.full(len(truth), base), np.full(len(checked), base)
    trees, errors = [], []
    for _ in range(p.trees):
        tree, node = grow(inside, gradients(truth - pred, scale), None, p, order)
        tree, new = tree.finished(p)
        value = tree.values(p, scale)
        pred += value[new[node]]
        trees.append((tree, value))
        if len(checked):
            guess += value[tree.route(outside)]
            errors.append(float(np.sqrt(np.mean((checked - guess) ** 2))))
            if p.patience and len(errors) - 1 - int(np.argmin(errors)) >= p.patience:
                break
    if p.patience and errors:
        trees = trees[:int(np.argmin(errors)) + 1]
    return trees, errors


def forest(bins: np.ndarray, y: np.ndarray, row: np.ndarray, p: Trees, base: float, scale: float, trees: range):
    """(tree, leaf values) of some trees of a forest."""
    g0 = gradients(y - base, scale)
    for t in trees:
        w = draws(row, p.seed, t)
        drawn = np.flatnonzero(w)
        some = np.ascontiguousarray(bins[:, drawn])
        tree, _ = grow(some, g0[drawn] * w[drawn], w[drawn], p, by_bin(some))
        tree, _ = tree.finished(p)
        yield t, tree, tree.values(p, scale)
