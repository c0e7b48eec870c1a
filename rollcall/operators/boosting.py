"""Histogram boosting of many models at once.

Trees are grown best-first on binned features: at most LEAVES leaves, at least MIN_LEAF rows a leaf, missing numbers go to the side
that gains more, categories go left or right as subsets. All folds, learning rates and groups of a comparison are models over one
table; scores after fewer rounds are read off the longest run.

Gradients are whole multiples of 2**-30, so sums do not depend on the order of addition: a model is the same for any partitioning and
after lost executors.

A pass over the rows adds up one histogram per (model, node) for large nodes. A node of at most IN_TASK_ROWS rows is finished by the one task
that gets its rows (as in PLANET, Panda et al. 2009), and a model that learns from at most JAVA_ROWS rows (a byte per row and
feature) is fitted by one task with all its rounds, in Java (``Boosting.java``) or, where that cannot be compiled and for at most
MODEL_ROWS rows, in numpy; all give the tree that passes would. No other rows leave their partition: between rounds a partition keeps
its bins and raw scores, persisted and, every CHECKPOINT_ROUNDS rounds, checkpointed.

Rows travel in blocks: the bins of some rows one after the other, and a byte per row for the label.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators import kernel
from rollcall.operators.ordering import spaced_quantiles
from rollcall.session import materialize, scratch_root, ship_package

LEAVES, MIN_LEAF, MAX_BINS = 31, 20, 255
MIN_HESSIAN = 1e-3

#: Hessian that a category needs for a side of its own; smoothing of a category's mean.
CATEGORY_SUPPORT = 10.0

UNIT = 1 << 30
IN_TASK_ROWS = 1 << 17
MODEL_ROWS = 1 << 20
#: Held in Java by about 50 bytes a row, besides the blocks.
JAVA_ROWS = 1 << 22
CHECKPOINT_ROUNDS = 25

#: Features are counted together while they have no more combinations of bins than this; small nodes count each by itself.
JOINT_CELLS, JOINT_ROWS = 1 << 10, 1 << 10


# --- bins ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Upper edges of numeric features and values of categorical ones; the last bin of all holds missing values."""

    numeric: dict[str, list[float]]
    categorical: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def width(self) -> int:
        sizes = [len(e) + 1 for e in self.numeric.values()] + [len(c) for c in self.categorical.values()]
        return max(sizes) + 1

    def columns(self) -> list[Column]:
        """Features as the binning reads them."""
        return [F.col(c).cast("double").alias(c) for c in self.numeric] + [
            F.col(c).cast("string").alias(c) for c in self.categorical
        ]

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bin of every row and feature."""
        missing = self.width - 1
        out = np.empty((batch.num_rows, len(self.names)), np.uint8)
        for k, (name, edges) in enumerate(self.numeric.items()):
            x = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            out[:, k] = np.where(np.isnan(x), missing, np.searchsorted(np.array(edges), x, side="left"))
        for k, (name, values) in enumerate(self.categorical.items(), len(self.numeric)):
            place = {v: i for i, v in enumerate(values)}
            coded = batch.column(name).dictionary_encode(null_encoding="encode")
            known = np.array([place.get(v, missing) for v in coded.dictionary.to_pylist()], np.uint8)
            out[:, k] = known[coded.indices.to_numpy(zero_copy_only=False)]
        return out


def fit_bins(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Bins:
    """Bins of all rows: one bin per value up to MAX_BINS values, quantiles of a feature beyond."""
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric]))
    ).select("col.*")
    cells = cells.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = materialize(cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "feature-values")
    # One row per feature.
    sizes = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [c for c in numeric if sizes.get(c, 0) <= MAX_BINS]
    many = [c for c in numeric if c not in few]
    values: dict[str, list[float]] = {c: [] for c in few}
    # At most MAX_BINS rows per feature.
    for row in counts.where(F.col("feature").isin(few)).collect():
        values[row["feature"]].append(row["value"])
    edges = {}
    for c in few:
        own = sorted(values[c])
        edges[c] = [a + (b - a) / 2 for a, b in zip(own, own[1:], strict=False)]
    if many:
        # Values stand as often as they occur: quantiles of the rows.
        wide = counts.where(F.col("feature").isin(many))
        for row in spaced_quantiles(wide, "value", "n", MAX_BINS, ["feature"]).collect():
            edges[row["feature"]] = sorted(set(row["edges"]))
    kinds = {}
    for c in categorical:
        found = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct().limit(MAX_BINS).collect()
        if len(found) == MAX_BINS:
            raise ValueError(f"{c} has {MAX_BINS} categories or more")
        kinds[c] = sorted(r[0] for r in found)
    return Bins({c: edges[c] for c in numeric}, kinds)


# --- trees ---------------------------------------------------------------------------------------------------------


@dataclass
class Split:
    gain: float
    feature: int
    #: Per bin of the feature, whether it goes left.
    left: np.ndarray


@dataclass
class Node:
    """Totals of a node's gradients, hessians and rows; its split once known (``None``: none is worth it)."""

    totals: tuple[int, int, int]
    split: Split | None = None
    known: bool = False
    hist: np.ndarray | None = None
    children: tuple[Node, Node] | None = None
    leaf: int = -1


def histogram(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, width: int) -> np.ndarray:
    """Sums of gradients, hessians and rows per (feature, bin)."""
    n, features = bins.shape
    place = (bins + np.arange(features) * width).ravel()
    total = features * width
    parts = [np.bincount(place, np.repeat(v, features), total) for v in (gradient, hessian)]
    return np.stack([*parts, np.bincount(place, minlength=total)]).astype(np.int64).reshape(3, features, width)


class Layout:
    """Rows of a node or model that are all here, laid out for counting and splitting.

    Features of few bins are one column of their combinations, so that a node is counted in fewer passes over its rows. A
    feature's own sums are those over the other features of its column, in whole numbers, so histograms are the same.
    """

    def __init__(self, bins: np.ndarray, width: int) -> None:
        self.bins, self.by_feature = bins, np.ascontiguousarray(bins.T)
        self.shape, missing = (bins.shape[1], width), width - 1
        # Rows by bin, for each feature.
        self.order = [column.argsort(kind="stable").astype(np.int32) for column in self.by_feature]
        self.starts = [np.cumsum([0, *np.bincount(column, minlength=width)]) for column in self.by_feature]
        if len(bins) < JOINT_ROWS:
            return
        used, codes = [], []
        for column in self.by_feature:
            empty = column == missing
            top = 0 if empty.all() else int(column[~empty].max()) + 1
            codes.append(np.where(empty, top, column).astype(np.int64))
            used.append(np.append(np.arange(top), [missing] * bool(empty.any())).astype(np.int64))
        groups: list[list[int]] = []
        sizes: list[int] = []
        for f in sorted(range(len(codes)), key=lambda f: -len(used[f])):
            own = len(used[f])
            at = next((k for k, size in enumerate(sizes) if size * own <= JOINT_CELLS), len(sizes))
            if at == len(sizes):
                groups.append([])
                sizes.append(1)
            groups[at].append(f)
            sizes[at] *= own
        self.sizes = sizes
        self.cells = np.zeros((len(groups), len(bins)), np.int64)
        # The cells of each (feature, bin), one after the other.
        parts, lengths, places, first = [], [], [], 0
        for k, (members, size) in enumerate(zip(groups, sizes, strict=True)):
            for f in members:
                self.cells[k] *= len(used[f])
                self.cells[k] += codes[f]
            grid = np.arange(first, first + size).reshape([len(used[f]) for f in members])
            for axis, f in enumerate(members):
                parts.append(np.moveaxis(grid, axis, 0).ravel())
                lengths += [size // len(used[f])] * len(used[f])
                places.append(f * width + used[f])
            first += size
        self.parts, self.places = np.concatenate(parts), np.concatenate(places)
        self.firsts = np.cumsum([0, *lengths[:-1]])

    def held(self, feature: int, wanted: np.ndarray) -> int:
        """Number of rows whose bin of the feature is wanted."""
        return int(np.diff(self.starts[feature])[wanted].sum())

    def having(self, feature: int, wanted: np.ndarray) -> np.ndarray:
        """Rows whose bin of the feature is wanted."""
        runs = np.flatnonzero(np.diff(np.concatenate([[False], wanted, [False]]))).reshape(-1, 2)
        starts = self.starts[feature]
        return np.concatenate([self.order[feature][starts[a] : starts[b]] for a, b in runs])

    def histogram(self, rows: np.ndarray | None, gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
        """Sums of gradients, hessians and rows per (feature, bin) over some rows, or all."""
        if len(gradient if rows is None else rows) < JOINT_ROWS:
            at = slice(None) if rows is None else rows
            return histogram(self.bins[at], gradient[at], hessian[at], self.shape[1])
        if rows is not None:
            gradient, hessian = gradient.take(rows), hessian.take(rows)
        sums, first = np.empty((3, sum(self.sizes)), np.int64), 0
        for column, size in zip(self.cells, self.sizes, strict=True):
            cells, own = column if rows is None else column.take(rows), slice(first, first + size)
            sums[0, own] = np.bincount(cells, gradient, size)
            sums[1, own] = np.bincount(cells, hessian, size)
            sums[2, own] = np.bincount(cells, minlength=size)
            first += size
        out = np.zeros((3, self.shape[0] * self.shape[1]), np.int64)
        out[:, self.places] = np.add.reduceat(sums.take(self.parts, axis=1), self.firsts, axis=1)
        return out.reshape(3, *self.shape)


def best_splits(hists: np.ndarray, n_numeric: int) -> list[Split | None]:
    """The split of each node that gains most; the first of equal ones by feature, side of missing values and bin."""
    features, width = hists.shape[2:]
    totals = hists[:, :, 0].sum(axis=2)
    missing = hists[..., -1:]
    upto = hists[..., :-1].cumsum(axis=3)
    if features > n_numeric:
        kinds = hists[:, :, n_numeric:]
        g, h, n = kinds[:, 0], kinds[:, 1], kinds[:, 2]
        weight = totals[:, 2] / np.maximum(totals[:, 1], 1)
        used = (n > 0) & (h * weight[:, None, None] >= CATEGORY_SUPPORT)
        mean = np.where(used, g / (h + CATEGORY_SUPPORT * UNIT), np.inf)
        order = mean.argsort(axis=2, kind="stable")
        ordered = np.take_along_axis(np.where(used[:, None], kinds, 0), order[:, None], axis=3)
        upto[:, :, n_numeric:] = ordered.cumsum(axis=3)[..., :-1]
    # Both sides of missing values are the same where there are none; an empty bin splits as the one before it does.
    left = np.stack([upto, upto + missing], axis=3) if missing[:, 2].any() else upto[:, :, :, None]
    fine = (left[:, 2] >= MIN_LEAF) & (left[:, 2] <= totals[:, 2, None, None, None] - MIN_LEAF)
    fine[:, :n_numeric, :, 1:] &= hists[:, 2, :n_numeric, None, 1:-1] > 0
    fine[:, n_numeric:, 1:] = False
    found: list[Split | None] = []
    for k, total in enumerate(totals):
        found.append(None)
        at = np.flatnonzero(fine[k])
        a = left[k].reshape(3, -1).take(at, axis=1)
        b = total[:, None] - a
        enough = np.minimum(a[1], b[1]) >= MIN_HESSIAN * UNIT
        if not enough.any():
            continue
        if not enough.all():
            at, a, b = at[enough], a[:, enough], b[:, enough]
        a, b = a[:2].astype(float), b[:2].astype(float)
        worth = a[0] * a[0] / a[1] + b[0] * b[0] / b[1]
        best = int(worth.argmax())
        gain = float(worth[best] - float(total[0]) * float(total[0]) / float(total[1]))
        if gain <= 0:
            continue
        f, side, upper = np.unravel_index(at[best], fine.shape[1:])
        goes = np.zeros(width, bool)
        if f < n_numeric:
            goes[: upper + 1] = True
            goes[-1] = side == 1
        else:
            own = order[k, f - n_numeric, : upper + 1]
            goes[own[used[k, f - n_numeric, own]]] = True
        found[k] = Split(gain, int(f), goes)
    return found


def judge(nodes: Sequence[Node], n_numeric: int) -> None:
    """Find the splits of nodes from their histograms."""
    open_nodes = [node for node in nodes if node.totals[2] >= 2 * MIN_LEAF]
    for node in nodes:
        node.split, node.known = None, True
    if open_nodes:
        splits = best_splits(np.stack([node.hist for node in open_nodes]), n_numeric)
        for node, split in zip(open_nodes, splits, strict=True):
            node.split = split


def _totals(hist: np.ndarray) -> tuple[int, int, int]:
    return tuple(int(x) for x in hist[:, 0].sum(axis=1))


def select(root: Node) -> tuple[list[Node], list[Node]]:
    """Split nodes in best-first order within LEAVES leaves, and those among them whose children are not known yet.

    Nodes found beyond an unknown one may fall out again when that one is known.
    """
    heap, chosen, open_nodes, turn = [], [], [], 0

    def push(node: Node) -> None:
        nonlocal turn
        if node.known and node.split is not None:
            heapq.heappush(heap, (-node.split.gain, turn, node))
        turn += 1

    push(root)
    while heap and len(chosen) < LEAVES - 1:
        _, _, node = heapq.heappop(heap)
        chosen.append(node)
        if node.children is None or not all(c.known for c in node.children):
            open_nodes.append(node)
        else:
            for child in node.children:
                push(child)
    return chosen, open_nodes


def finish(
    root: Node, layout: Layout, gradient: np.ndarray, hessian: np.ndarray, n_numeric: int
) -> tuple[list[Node], np.ndarray]:
    """Grow a node whose rows are all here. Returns its leaves, and the place of every row's leaf among them."""
    if root.hist is None:
        root.hist = layout.histogram(None, gradient, hessian)
        root.totals = _totals(root.hist)
    judge([root], n_numeric)
    rows = len(gradient)
    leaf_of = np.zeros(rows, np.min_scalar_type(LEAVES))
    heap = [(-root.split.gain, 0, root, 0)] if root.split else []
    turn, leaves = 1, [root]
    while heap and len(leaves) < LEAVES:
        _, _, node, place = heapq.heappop(heap)
        feature, left = node.split.feature, node.split.left
        # The smaller side gets a place of its own, the other one keeps the node's.
        small = int(2 * node.hist[2, feature, left].sum() > node.totals[2])
        wanted = ~left if small else left
        if layout.held(feature, wanted) <= node.totals[2] + rows // 16:
            at = layout.having(feature, wanted)
            at = at.compress(leaf_of.take(at) == place)
        else:
            at = np.flatnonzero(leaf_of == place)
            at = at.compress(wanted.take(layout.by_feature[feature].take(at)))
        hists: list = [None, None]
        hists[small] = layout.histogram(at, gradient, hessian)
        hists[1 - small] = node.hist - hists[small]
        node.children = tuple(Node(_totals(h), hist=h) for h in hists)
        node.hist = None
        judge(node.children, n_numeric)
        places = (place, len(leaves)) if small else (len(leaves), place)
        leaf_of[at] = len(leaves)
        leaves[place] = node.children[1 - small]
        leaves.append(node.children[small])
        for child, own in zip(node.children, places, strict=True):
            if child.split is not None:
                heapq.heappush(heap, (-child.split.gain, turn, child, own))
            turn += 1
    for node in leaves:
        node.hist = None
    return leaves, leaf_of


class Tree:
    """A tree as arrays; nodes 0, 1, ...; a leaf has feature -1. Bins that go left are held a bit each."""

    def __init__(
        self, feature: np.ndarray, left_bins: np.ndarray, child: np.ndarray, value: np.ndarray, gain: np.ndarray
    ) -> None:
        self.feature, self.child, self.value, self.gain = feature, child, value, gain
        self.width, self.bits = left_bins.shape[1], np.packbits(left_bins, axis=1)

    @property
    def left_bins(self) -> np.ndarray:
        return np.unpackbits(self.bits, axis=1, count=self.width).astype(bool)

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """Node in which each row ends."""
        at, left = np.zeros(len(bins), np.int64), self.left_bins
        active = np.arange(len(bins)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(active):
            node = at[active]
            goes = left[node, bins[active, self.feature[node]]]
            at[active] = self.child[node, np.where(goes, 0, 1)]
            active = active[self.feature[at[active]] >= 0]
        return at


class Walker:
    """Ends of a tree for many rows at once: of every node whose test a bin fails, the leaves on its left fall out, and the first
    leaf left is the row's (as in QuickScorer, Lucchese et al. 2015). A row costs one step per feature, not per node on its path."""

    def __init__(self, tree: Tree) -> None:
        spans, leaves, stack = {}, [], [(0, False)]
        while stack:
            node, done = stack.pop()
            if tree.feature[node] < 0:
                spans[node] = (len(leaves), len(leaves) + 1)
                leaves.append(node)
            elif done:
                spans[node] = (spans[int(tree.child[node, 0])][0], spans[int(tree.child[node, 1])][1])
            else:
                stack += [(node, True), (int(tree.child[node, 1]), False), (int(tree.child[node, 0]), False)]
        #: Leaves still possible, a bit each, by bin of a feature.
        self.masks: dict[int, np.ndarray] = {}
        left = tree.left_bins
        for node in np.flatnonzero(tree.feature >= 0):
            first, end = spans[int(tree.child[node, 0])]
            mask = self.masks.setdefault(int(tree.feature[node]), np.full(tree.width, -1, np.int32))
            mask[~left[node]] &= np.int32(~(((1 << (end - first)) - 1) << first))
        self.value = tree.value[leaves]

    def values(self, columns: np.ndarray) -> np.ndarray:
        """Values of the leaves of rows whose bins are given by feature."""
        if not self.masks:
            return np.broadcast_to(self.value[0], columns.shape[1])
        left = None
        for f, mask in self.masks.items():
            own = mask.take(columns[f])
            left = own if left is None else np.bitwise_and(left, own, out=left)
        return self.first(left)

    def first(self, left: np.ndarray) -> np.ndarray:
        """Value of the first leaf that is left."""
        # The lowest bit is a power of two, so its exponent is exact.
        return self.value.take(np.frexp((left & -left).astype(np.float32))[1] - 1)


def as_tree(root: Node, width: int, step: float) -> Tree:
    """The best-first tree below a node, with the values of its leaves. Every node gets its number as ``leaf``."""
    chosen = {id(n) for n in select(root)[0]}
    nodes, queue = [], [root]
    while queue:
        node = queue.pop(0)
        node.leaf = len(nodes)
        nodes.append(node)
        if id(node) in chosen:
            queue += node.children
    feature, gain = np.full(len(nodes), -1), np.zeros(len(nodes))
    left, child, value = np.zeros((len(nodes), width), bool), np.zeros((len(nodes), 2), np.int64), np.zeros(len(nodes))
    for k, node in enumerate(nodes):
        if id(node) in chosen:
            feature[k], left[k], gain[k] = node.split.feature, node.split.left, node.split.gain / UNIT
            child[k] = [c.leaf for c in node.children]
        else:
            g, h, _ = node.totals
            value[k] = -step * g / h if h else 0.0
    return Tree(feature, left, child, value, gain)


@dataclass
class Forest:
    """A fitted model: log odds of the training rows and a tree per round."""

    name: str
    start: float
    trees: list[Tree] = field(default_factory=list)

    @cached_property
    def walkers(self) -> list[Walker]:
        return [Walker(tree) for tree in self.trees]

    def raw(self, bins: np.ndarray, stages: Sequence[int]) -> list[np.ndarray]:
        """Raw scores after some numbers of rounds, ascending."""
        score, found = np.full(len(bins), self.start), []
        columns = np.ascontiguousarray(bins.T)
        for k, tree in enumerate(self.trees):
            if k in stages:
                found.append(score.copy())
            score += self.walkers[k].values(columns)
        found += [score.copy()] * (len(stages) - len(found))
        return found

    def raw_exchanged(self, columns: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of rows whose bins are given by feature, and those with one feature's bins exchanged, by feature and repeat.

        The same as :meth:`raw` of each, but a tree asks for the other features' bins once, and only for features that it tests.
        """
        plain, exchanged = np.full(columns.shape[1], self.start), np.full(given.shape, self.start)
        for walker in self.walkers:
            tested = list(walker.masks)
            own = [walker.masks[f].take(columns[f]) for f in tested]
            # Leaves that the features before each one, and those after it, leave.
            before, after = [None], [None]
            for x in own:
                before.append(x if before[-1] is None else before[-1] & x)
            for x in own[:0:-1]:
                after.append(x if after[-1] is None else after[-1] & x)
            value = walker.first(before[-1]) if tested else walker.value[0]
            plain += value
            for f in range(len(given)):
                if f not in walker.masks:
                    exchanged[f] += value
                    continue
                k, left = tested.index(f), walker.masks[f].take(given[f])
                for rest in (before[k], after[len(tested) - 1 - k]):
                    if rest is not None:
                        left &= rest
                exchanged[f] += walker.first(left)
        return plain, exchanged


def exponential(x: np.ndarray) -> np.ndarray:
    """The exponential by additions and multiplications only, whose results are the same on any machine and in Java."""
    x = np.clip(x, -700, 700)
    k = np.rint(x * 1.4426950408889634)
    x -= k * 0.6931471803691238
    x -= k * 1.9082149292705877e-10
    out = np.full(len(x), 1 / math.factorial(13))
    for n in range(12, -1, -1):
        out *= x
        out += 1 / math.factorial(n)
    return np.ldexp(out, k.astype(np.int32))


def gradients(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chance = exponential(-raw)
    chance += 1
    np.divide(1, chance, out=chance)
    gradient, hessian = chance - label, 1 - chance
    hessian *= chance
    for x in (gradient, hessian):
        x *= UNIT
        np.rint(x, out=x)
    return gradient, hessian


def log_odds(positives: int, rows: int) -> float:
    """Log odds of the label; a table with one class only is kept half a row away from certainty."""
    inner = min(max(positives, 0.5), rows - 0.5) if rows else 0.5
    return float(np.log(inner / (max(rows, 1) - inner)))


def boost(name: str, bins: np.ndarray, label: np.ndarray, step: float, rounds: int, width: int, n_numeric: int) -> Forest:
    """All rounds of a model whose rows are all here."""
    forest = Forest(name, log_odds(int(label.sum()), len(label)))
    raw = np.full(len(label), forest.start)
    layout = Layout(bins, width)
    for _ in range(rounds):
        root = Node((0, 0, 0))
        leaves, leaf_of = finish(root, layout, *gradients(raw, label), n_numeric)
        tree = as_tree(root, width, step)
        forest.trees.append(tree)
        raw += tree.value[[node.leaf for node in leaves]].take(leaf_of)
    return forest


# --- fitting -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    """A model to fit: the rows it learns from, its learning rate and its rounds."""

    name: str
    train: Column
    step: float = 0.05
    rounds: int = 300


@dataclass(frozen=True)
class Models:
    bins: Bins
    forests: dict[str, Forest]


def fit_many(
    df: DataFrame,
    specs: Sequence[Spec],
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str = "label",
    in_task_rows: int | None = None,
) -> Models:
    """Fit all models over one bin table. ``label`` holds 0 and 1."""
    native = kernel.register(df.sparkSession)
    limit, whole = (IN_TASK_ROWS, JAVA_ROWS if native else MODEL_ROWS) if in_task_rows is None else (in_task_rows, in_task_rows)
    ship_package(df.sparkSession)
    bins = fit_bins(df, numeric, categorical)
    member = F.array(*[F.coalesce(s.train, F.lit(False)) for s in specs])
    rows = df.select(*bins.columns(), F.col(label).cast("double").alias("_label"), member.alias("_member"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = bins.of(batch)
            y = batch.column("_label").cast(pa.int8()).fill_null(NO_LABEL).to_numpy(zero_copy_only=False)
            chosen = _flags(batch.column("_member"), batch.num_rows)
            if chosen[y == NO_LABEL].any():
                raise ValueError("a row to learn from has no label")
            told = [
                pa.array([x.tobytes()], pa.binary()),
                pa.array([y.tobytes()], pa.binary()),
                pa.array([np.packbits(chosen, axis=1).tobytes()], pa.binary()),
                *[pa.array([v.tolist()], pa.list_(pa.int64())) for v in (chosen.sum(axis=0), chosen[y == 1].sum(axis=0))],
            ]
            yield pa.RecordBatch.from_arrays(told, names=["bins", "label", "member", "rows", "positives"])

    packed = rows.mapInArrow(pack, "bins binary, label binary, member binary, rows array<long>, positives array<long>")
    table = materialize(packed, "bin-table")
    sums = table.agg(
        *[F.coalesce(F.sum(F.col(c)[k]), F.lit(0)).alias(f"{c}{k}") for c in ("rows", "positives") for k in range(len(specs))]
    ).first()
    counts = [sums[f"rows{k}"] for k in range(len(specs))]
    starts = [log_odds(sums[f"positives{k}"], counts[k]) for k in range(len(specs))]
    small = [(k, specs[k]) for k in range(len(specs)) if counts[k] <= whole]
    large = [(k, specs[k]) for k in range(len(specs)) if counts[k] > whole]
    forests = {}
    if small:
        own = _members(table, small, len(specs), len(bins.names))
        forests |= _fit_in_java(own, small, starts, bins) if native else _fit_in_tasks(own, small, bins)
    if large:
        forests |= _fit_in_passes(table, large, [starts[k] for k, _ in large], len(specs), bins, limit)
    return Models(bins, {s.name: forests[s.name] for s in specs})


#: Stands for a missing label.
NO_LABEL = -1


def _flags(column: pa.Array, rows: int) -> np.ndarray:
    """Arrays of equally many booleans as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(rows, -1)


def _block(bins: bytes, label: bytes, member: bytes, models: int, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and models of a block's rows."""
    y = np.frombuffer(label, np.int8)
    member = np.frombuffer(member, np.uint8).reshape(len(y), -1)
    return np.frombuffer(bins, np.uint8).reshape(len(y), features), y, np.unpackbits(member, axis=1, count=models).astype(bool)


def _members(table: DataFrame, specs: list[tuple[int, Spec]], models: int, features: int) -> DataFrame:
    """(model, bins, label): the blocks of each model's rows, one range or more to a model."""
    places = [k for k, _ in specs]

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                x, y, member = _block(*block, models, features)
                for k in places:
                    if member[:, k].any():
                        own = [x[member[:, k]].tobytes()], [y[member[:, k]].tobytes()]
                        told = [pa.array([k], pa.int32()), *[pa.array(v, pa.binary()) for v in own]]
                        yield pa.RecordBatch.from_arrays(told, names=["model", "bins", "label"])

    blocks = table.select("bins", "label", "member").mapInArrow(share, "model int, bins binary, label binary")
    # Ranges are cut by samples: with a few for each model, no two large models share one.
    return blocks.repartitionByRange(4 * len(specs), "model")


def _fit_in_java(members: DataFrame, specs: list[tuple[int, Spec]], starts: Sequence[float], bins: Bins) -> dict[str, Forest]:
    """Models of few rows: a task each."""
    shape = (len(bins.names), bins.width, len(bins.numeric), LEAVES, MIN_LEAF, MIN_HESSIAN, CATEGORY_SUPPORT)
    settings = F.create_map(
        *[x for k, s in specs for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in (starts[k], s.step, s.rounds, *shape)]))]
    )
    fitted = members.groupBy("model").agg(F.collect_list(F.struct("bins", "label")).alias("blocks"))
    # The trees of a model, which are of bounded size.
    told = fitted.select("model", F.call_udf(kernel.BOOST, F.col("blocks"), settings[F.col("model")]).alias("trees")).collect()
    trees = {r["model"]: r["trees"] for r in told}
    # A model without rows has no trees.
    return {
        s.name: Forest(s.name, starts[k], _trees(trees[k], bins.width)) if k in trees else Forest(s.name, 0.0) for k, s in specs
    }


def _trees(told: bytes, width: int) -> list[Tree]:
    """Trees as ``Boosting.java`` writes them."""
    node = np.dtype([("value", "<f8"), ("gain", "<f8"), ("feature", "<i4"), ("child", "<i4", 2), ("left", "u1", (width + 7) // 8)])
    found, at = [], 0
    while at < len(told):
        size = int.from_bytes(told[at : at + 4], "little")
        own = np.frombuffer(told, node, size, at + 4)
        at += 4 + size * node.itemsize
        left = np.unpackbits(own["left"], axis=1, count=width).astype(bool)
        wide = (own["feature"].astype(np.int64), own["child"].astype(np.int64))
        found.append(Tree(wide[0], left, wide[1], own["value"].copy(), own["gain"].copy()))
    return found


def _fit_in_tasks(members: DataFrame, specs: list[tuple[int, Spec]], bins: Bins) -> dict[str, Forest]:
    """Models of few rows: a task each, in numpy."""
    told = {k: (s.name, s.step, s.rounds) for k, s in specs}
    features, width, n_numeric = len(bins.names), bins.width, len(bins.numeric)

    def fit(rows: pa.Table) -> pa.Table:
        k = rows.column("model")[0].as_py()
        name, step, rounds = told[k]
        x, y = (b"".join(v.as_buffer() for v in rows.column(c)) for c in ("bins", "label"))
        label = np.frombuffer(y, np.int8).astype(float)
        forest = boost(name, np.frombuffer(x, np.uint8).reshape(-1, features), label, step, rounds, width, n_numeric)
        return pa.table({"model": pa.array([k], pa.int32()), "forest": pa.array([pickle.dumps(forest)], pa.binary())})

    fitted = members.groupBy("model").applyInArrow(fit, "model int, forest binary")
    # A forest per model, which is of bounded size.
    found = {r["model"]: pickle.loads(r["forest"]) for r in fitted.collect()}
    return {s.name: found.get(k, Forest(s.name, 0.0)) for k, s in specs}


def _fit_in_passes(
    table: DataFrame, specs: list[tuple[int, Spec]], starts: list[float], models: int, bins: Bins, limit: int
) -> dict[str, Forest]:
    """Models of many rows: histograms of all models and nodes from one aggregate per level."""
    context = table.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{scratch_root(table.sparkSession)}/boosting")
    features, width, n_numeric = len(bins.names), bins.width, len(bins.numeric)
    places, first = [k for k, _ in specs], np.array(starts)

    def blocks(rows):
        for row in rows:
            x, y, member = _block(bytes(row["bins"]), bytes(row["label"]), bytes(row["member"]), models, features)
            yield x, y.astype(float), member[:, places], np.repeat(first[None, :], len(y), axis=0)

    state = table.rdd.mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    forests = [Forest(s.name, start) for (_, s), start in zip(specs, starts, strict=True)]
    partitions = min(state.getNumPartitions(), 4 * len(specs)) or 1
    old = []
    for turn in range(max(s.rounds for _, s in specs)):
        roots = {m: Node((0, 0, 1 << 62)) for m, (_, s) in enumerate(specs) if turn < s.rounds}
        _grow(state, roots, features, width, n_numeric, limit, partitions)
        trees = {m: as_tree(root, width, specs[m][1].step) for m, root in roots.items()}
        for m, tree in trees.items():
            forests[m].trees.append(tree)
        sent = context.broadcast(trees)

        def follow(held, sent=sent):
            x, y, member, raw = held
            raw = raw.copy()
            for m, tree in sent.value.items():
                raw[:, m] += tree.value[tree.leaves_of(x)]
            return x, y, member, raw

        following = state.map(follow).persist(StorageLevel.MEMORY_AND_DISK)
        old.append(state)
        if turn % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
            following.checkpoint()
            following.count()
            for done in old:
                done.unpersist()
            old = []
        elif len(old) > 2:
            old.pop(0).unpersist()
        state = following
    for done in [*old, state]:
        done.unpersist()
    return {f.name: f for f in forests}


def _grow(state, roots: dict[int, Node], features: int, width: int, n_numeric: int, limit: int, partitions: int) -> None:
    """Make the splits of all trees known, as far as best-first selection needs them."""
    wanted = [(m, root) for m, root in roots.items()]
    while wanted:
        plan = {}
        for m, node in wanted:
            plan.setdefault(m, []).append(node)
        # Partial trees to route rows by, and what is wanted of the nodes in which they end.
        routes, jobs = {}, {}
        for m, nodes in plan.items():
            ids = {id(n) for n in nodes}
            routes[m] = _route(roots[m], ids, width)
            jobs[m] = {n.leaf: n.totals[2] <= limit for n in nodes}

        def emit(held, routes=routes, jobs=jobs):
            x, y, member, raw = held
            for m, route in routes.items():
                g, h = gradients(raw[:, m], y)
                at = np.where(member[:, m], route.leaves_of(x), -1)
                for leaf, rows_wanted in jobs[m].items():
                    own = np.flatnonzero(at == leaf)
                    if not len(own):
                        continue
                    if rows_wanted:
                        yield (m, leaf), [(x[own], g[own], h[own])]
                    else:
                        yield (m, leaf), histogram(x[own], g[own], h[own], width)

        def close(found):
            if isinstance(found, np.ndarray):
                return found
            x, g, h = (np.concatenate(parts) for parts in zip(*found, strict=True))
            node = Node((0, 0, 0))
            finish(node, Layout(x, width), g, h, n_numeric)
            return node

        # Rows of small nodes and histograms of large ones: both are of bounded size.
        answers = dict(state.flatMap(emit).reduceByKey(lambda a, b: a + b, partitions).mapValues(close).collect())
        for m, node in wanted:
            found = answers.get((m, node.leaf))
            if isinstance(found, Node):
                node.totals, node.split, node.known, node.children = found.totals, found.split, True, found.children
            else:
                node.hist = np.zeros((3, features, width), np.int64) if found is None else found
                node.totals = _totals(node.hist)
                judge([node], n_numeric)
        wanted = []
        for m, root in roots.items():
            for node in select(root)[1]:
                if node.children is None:
                    node.children = _children(node)
                    node.hist = None
                wanted += [(m, c) for c in node.children if not c.known]


def _children(node: Node) -> tuple[Node, Node]:
    """Children with their totals, from the histogram of a split node."""
    goes = node.split.left
    own = node.hist[:, node.split.feature]
    left, right = (Node(tuple(int(v) for v in own[:, side].sum(axis=1))) for side in (goes, ~goes))
    return left, right


def _route(root: Node, ends: set[int], width: int) -> Tree:
    """The tree down to some nodes, which get their place in it as ``leaf``."""
    nodes, queue = [], [root]
    while queue:
        node = queue.pop(0)
        node.leaf = len(nodes)
        nodes.append(node)
        if id(node) not in ends and node.children is not None:
            queue += node.children
    feature = np.full(len(nodes), -1)
    left, child = np.zeros((len(nodes), width), bool), np.zeros((len(nodes), 2), np.int64)
    for k, node in enumerate(nodes):
        if id(node) not in ends and node.children is not None:
            feature[k], left[k], child[k] = node.split.feature, node.split.left, [c.leaf for c in node.children]
    return Tree(feature, left, child, np.zeros(len(nodes)), np.zeros(len(nodes)))


# --- scoring -------------------------------------------------------------------------------------------------------


def score_many(
    models: Models, df: DataFrame, keep: Sequence[str], asked: Sequence[tuple[str, Sequence[int] | None, Column]]
) -> DataFrame:
    """Rows (keep..., model, rounds, prediction): for every (model, rounds, condition) the rows that meet the condition.

    ``rounds``: after how many rounds to read the score, ``None`` for all of the model's.
    """
    spark = df.sparkSession
    ship_package(spark)
    bins = models.bins
    plan = []
    for name, stages, _ in asked:
        full = len(models.forests[name].trees)
        plan.append((name, sorted(stages) if stages else [full]))
    chosen = F.array(*[F.coalesce(condition, F.lit(False)) for _, _, condition in asked])
    rows = df.select(F.struct(*keep).alias("_row"), *bins.columns(), chosen.alias("_chosen"))
    sent = spark.sparkContext.broadcast(models)
    row_type = rows.schema["_row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forests = sent.value.forests
        for batch in batches:
            if not batch.num_rows:
                continue
            x = bins.of(batch)
            picked = _flags(batch.column("_chosen"), batch.num_rows)
            for k, (name, stages) in enumerate(plan):
                own = np.flatnonzero(picked[:, k])
                if not len(own):
                    continue
                kept = batch.column("_row").take(pa.array(own))
                for stage, raw in zip(stages, forests[name].raw(x[own], stages), strict=True):
                    told = [
                        kept,
                        pa.repeat(name, len(own)),
                        pa.array(np.full(len(own), stage, np.int32)),
                        pa.array(1 / (1 + np.exp(-raw))),
                    ]
                    yield pa.RecordBatch.from_arrays(told, names=["_row", "model", "rounds", "prediction"])

    scored = rows.mapInArrow(score, f"_row {row_type}, model string, rounds int, prediction double")
    return scored.select("_row.*", "model", "rounds", "prediction")


def split_gains(models: Models, name: str) -> list[tuple[str, float]]:
    """Each feature's share of what all splits of a model gain."""
    names, sums = models.bins.names, np.zeros(len(models.bins.names))
    for tree in models.forests[name].trees:
        inner = tree.feature >= 0
        np.add.at(sums, tree.feature[inner], tree.gain[inner])
    total = sums.sum() or 1.0
    return [(n, float(s / total)) for n, s in zip(names, sums, strict=True)]
