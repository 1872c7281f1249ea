"""Contributions of each feature to a forest's fraud probability (path-dependent Shapley values).

For a leaf with value ``v`` whose path tests the features ``F``, let ``z_j`` be the share of training weight that the
path's tests on ``j`` let through and ``o_j`` whether the row passes them. The leaf adds to feature ``i``

    v * (o_i - z_i) * sum over S in F without i of |S|! (|F|-|S|-1)! / |F|! * prod_{j in S} o_j * prod_{j not in S} z_j

The factorial weights are the integral of ``t^|S| (1-t)^(|F|-|S|-1)`` over [0, 1], so the sum is the integral of
``prod_{j != i} (z_j (1-t) + o_j t)``: a polynomial that a few Gauss-Legendre points integrate exactly.

Spark partitions the rows; each task applies the trees to Arrow batches. The trees are model parameters, of size
``trees * 2^(depth+1)`` nodes at most, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.ml.features import FEATURES
from ledgerflow.settings import scratch_dir, ship

# Up to this many features on a path, a leaf's table of all pass/fail patterns is kept; it has 2^k rows.
KEPT_FEATURES = 6
# Up to this many rows, a tree's leaves are evaluated as arrays of (rows, leaves, features, points), in steps of so many cells.
FEW_ROWS, MOST_CELLS = 64, 4_000_000
# A task evaluates this many rows at once: what a leaf's patterns and a subtree's states cost is shared by them.
ROWS_AT_ONCE = 200_000
# From so many rows, those that a subtree cannot tell apart are evaluated once. It may tell apart one state for so many rows.
MANY_ROWS, ROWS_PER_STATE = 25_000, 16
# Looked up together: features with at most so many combinations of positions, and so many rows, which stay in a core's cache.
JOINT_POSITIONS, ROWS_IN_CACHE = 32_768, 16_384
# Trees are gathered and broadcast up to this many nodes.
MOST_NODES = 4_000_000


@dataclass(frozen=True)
class Tree:
    """One tree as parallel arrays; ``left`` is -1 at a leaf, and a test sends ``x <= threshold`` to the left."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    # Tables of leaves by node. A worker holds one copy of a tree, so each is made once there, not once per batch.
    tables: dict[int, np.ndarray] = field(default_factory=dict, compare=False, repr=False)
    paths_of: dict[int, Paths] = field(default_factory=dict, compare=False, repr=False)
    tests_of: dict[int, dict[int, np.ndarray]] = field(default_factory=dict, compare=False, repr=False)

    def tests(self, node: int) -> dict[int, np.ndarray]:
        """The thresholds at and below a node by feature, in order; kept once found. Nodes without weight have none."""
        if node not in self.tests_of:
            parts = []
            if self.left[node] >= 0:
                parts = [self.tests(int(c)) for c in (self.left[node], self.right[node]) if self.cover[c] > 0]
                parts.append({int(self.feature[node]): self.threshold[node : node + 1]})
            self.tests_of[node] = {j: np.unique(np.concatenate([p[j] for p in parts if j in p])) for j in {j: None for p in parts for j in p}}
        return self.tests_of[node]

    def paths(self, width: int) -> Paths:
        """All leaves with their paths, found level by level and kept."""
        if width not in self.paths_of:
            self.paths_of[width] = leaf_paths(self, width)
        return self.paths_of[width]

    def expected(self) -> float:
        """Average value of the leaves, weighted by training weight."""
        paths = self.paths(int(self.feature.max(initial=0)) + 1)
        return float(paths.value @ paths.share.prod(axis=1))


@dataclass(frozen=True)
class Paths:
    """The leaves of a tree as arrays (leaves, features): a path tests ``low < x <= high`` and lets ``share`` of the weight through.

    A feature that a path does not test has no limits and a share of 1.
    """

    value: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def passed(self, x: np.ndarray) -> np.ndarray:
        """(rows, leaves, features): whether each row passes each leaf's tests on each feature; NaN goes to the right."""
        return ~(x[:, None, :] <= self.low) & ((x[:, None, :] <= self.high) | (self.high == np.inf))


def leaf_paths(tree: Tree, width: int) -> Paths:
    """The paths of all leaves that any training weight reaches, one level of the tree at a time."""
    at = np.zeros(1, dtype=np.int64)
    low, high, share = np.full((1, width), -np.inf), np.full((1, width), np.inf), np.ones((1, width))
    done = []
    while len(at):
        leaf = tree.left[at] < 0
        done.append((tree.value[at[leaf]], low[leaf], high[leaf], share[leaf]))
        inner = ~leaf
        at, low, high, share = at[inner], low[inner], high[inner], share[inner]
        left, right, row, j = tree.left[at], tree.right[at], np.arange(len(at)), tree.feature[at]
        total, edge = tree.cover[left] + tree.cover[right], tree.threshold[at]
        parts = []
        for child, is_left in ((left, True), (right, False)):
            lows, highs, shares = low.copy(), high.copy(), share.copy()
            if is_left:
                highs[row, j] = np.minimum(highs[row, j], edge)
            else:
                lows[row, j] = np.maximum(lows[row, j], edge)
            with np.errstate(invalid="ignore", divide="ignore"):
                shares[row, j] *= tree.cover[child] / total
            some = tree.cover[child] > 0
            parts.append((child[some], lows[some], highs[some], shares[some]))
        at, low, high, share = (np.concatenate(p) for p in zip(*parts))
    return Paths(*(np.concatenate(p) for p in zip(*done)))


def contributions_of_few(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """Contributions (rows, features) of all rows and leaves of a tree at once."""
    rows, width = x.shape
    phi = np.zeros((rows, width))
    points, weights = quadrature(width)
    for tree in trees:
        paths = tree.paths(width)
        # The polynomials' factors at the points, once per tree: for a test that fails and what passing adds.
        failed = paths.share[..., None] * (1.0 - points)
        for first in range(0, rows, step := max(1, MOST_CELLS // max(1, failed.size))):
            passed = paths.passed(x[first : first + step])
            factor = failed + passed[..., None] * points
            others = (factor.prod(axis=2, keepdims=True) / factor) @ weights
            phi[first : first + step] += ((passed - paths.share) * others * paths.value[:, None]).sum(axis=1)
    return phi / len(trees)


def quadrature(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on [0, 1] that are exact for the polynomials of ``width`` features."""
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (width + 1) // 2))
    return (nodes + 1.0) / 2.0, weights / 2.0


def node_table(spark: SparkSession, model: PipelineModel, path: str | None = None) -> DataFrame:
    """The nodes of a fitted forest, as Spark stores them with the model."""
    path = path or scratch_dir(spark, "forest")
    model.stages[-1].write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def read_trees(nodes: DataFrame) -> list[Tree]:
    """Arrays of all trees. The number of nodes depends on the model, not on the data, and is checked."""
    count = nodes.count()
    if count > MOST_NODES:
        raise ValueError(f"the forest has {count} nodes; explanations take up to {MOST_NODES}, so lower its depth or trees")
    flat = nodes.select(
        F.col("treeID").alias("tree"),
        "id",
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x).alias("cover"),
        F.get("impurityStats", F.lit(1)).alias("fraud"),
    ).toPandas()
    trees = []
    for _, part in flat.sort_values(["tree", "id"]).groupby("tree", sort=True):
        cover = part["cover"].to_numpy(float)
        value = np.divide(part["fraud"].to_numpy(float), cover, out=np.zeros(len(part)), where=cover > 0)
        trees.append(
            Tree(
                left=part["left"].to_numpy(int),
                right=part["right"].to_numpy(int),
                feature=part["feature"].to_numpy(int),
                threshold=part["threshold"].fillna(0.0).to_numpy(float),
                cover=cover,
                value=value,
            )
        )
    return trees


def _leaf_table(value: float, shares: list[float], points: np.ndarray, weights: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Contribution of each path feature for the given pass/fail patterns: array (patterns, k)."""
    k = len(shares)
    z = np.array(shares)
    passed = ((patterns[:, None] >> np.arange(k)) & 1).astype(float)
    factor = z * (1.0 - points[:, None, None]) + passed * points[:, None, None]
    others = factor.prod(axis=2, keepdims=True) / factor
    return value * (passed - z) * np.tensordot(weights, others, axes=1)


def contributions(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """Contributions (rows, features), averaged over the trees. Exact up to rounding."""
    rows, width = x.shape
    if rows <= FEW_ROWS:
        return contributions_of_few(trees, x)
    if rows >= MANY_ROWS:
        return contributions_of_many(trees, x)
    phi, columns = np.zeros((width, rows)), np.ascontiguousarray(x.T)
    for tree in trees:
        walk(tree, 0, {}, np.zeros(rows, dtype=_bits(width)), columns, phi, quadrature(width))
    return phi.T / len(trees)


def _bits(width: int) -> type:
    """A type with one bit per feature."""
    return np.int16 if width < 15 else np.int64


def walk(
    tree: Tree, node: int, path: dict[int, float], pattern: np.ndarray, columns: np.ndarray, phi: np.ndarray, rule: tuple[np.ndarray, np.ndarray]
) -> None:
    """Adds what the leaves below ``node`` contribute to ``phi`` (features, rows).

    ``path`` holds the shares of the features tested so far, and bit n of ``pattern`` whether a row passes the n-th of them.
    """
    if tree.left[node] < 0:
        if path and tree.value[node] != 0.0:
            size, at = 1 << len(path), pattern.astype(np.intp)
            if len(path) <= KEPT_FEATURES:
                if node not in tree.tables:
                    tree.tables[node] = _leaf_table(tree.value[node], list(path.values()), *rule, np.arange(size)).T.copy()
                table = tree.tables[node]
            else:  # only the patterns that occur
                present = np.flatnonzero(np.bincount(at, minlength=size))
                table = np.zeros((len(path), size))
                table[:, present] = _leaf_table(tree.value[node], list(path.values()), *rule, present).T
            for own, j in zip(table, path):
                phi[j] += own.take(at)
        return
    j, kind = int(tree.feature[node]), pattern.dtype.type
    left = columns[j] <= tree.threshold[node]
    total = tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
    bit = list(path).index(j) if j in path else len(path)
    for child, goes in ((tree.left[node], left), (tree.right[node], ~left)):
        if tree.cover[child] <= 0:
            continue
        # A feature that is tested again passes if all its tests do.
        passed = pattern & ~(~goes * kind(1 << bit)) if j in path else pattern | goes * kind(1 << bit)
        walk(tree, int(child), {**path, j: path.get(j, 1.0) * tree.cover[child] / total}, passed, columns, phi, rule)


def contributions_of_many(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """Contributions (rows, features), with one walk of a small subtree for all rows that it cannot tell apart.

    What the leaves below a node add to a row depends on a few positions only: for each feature, whether the row passes the tests
    above the node, and between which thresholds below the node its value lies. A node with few such states is walked once per
    state, and each row looks its own up; other nodes are divided into their children. Positions among the thresholds of the
    whole forest stand for the values.
    """
    rows, width = x.shape
    edges = [np.unique(np.concatenate([t.threshold[(t.left >= 0) & (t.feature == j)] for t in trees])) for j in range(width)]
    # NaN lies behind all thresholds: it goes to the right.
    position = [np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]
    joint = joint_features([len(e) + 1 for e in edges])
    places = [np.ravel_multi_index([position[j] for j in group], [len(edges[j]) + 1 for j in group]) for group in joint]
    rule, most = quadrature(width), max(2, rows // ROWS_PER_STATE)
    # Four features lie side by side, so that a row finds them with one look.
    sets = -(-width // 4)
    phi, found = np.zeros((sets, rows, 4)), np.zeros((ROWS_IN_CACHE, 4))

    def visit(tree: Tree, node: int, path: dict[int, tuple[float, int, int]]) -> None:
        """``path`` holds for each feature tested so far the share let through and the positions, first and behind the last, that pass."""
        below = tree.tests(node)
        seen.add(node)
        sizes = {j: (j in path) + len(below.get(j, ())) + 1 for j in {**path, **below}}
        if tree.left[node] < 0 or math.prod(sizes.values()) <= most:
            if path or below:
                look_up(tree, node, path, below, sizes)
            return
        j = int(tree.feature[node])
        edge = int(np.searchsorted(edges[j], tree.threshold[node]))
        share, low, high = path.get(j, (1.0, 0, len(edges[j]) + 1))
        left, right = int(tree.left[node]), int(tree.right[node])
        total = tree.cover[left] + tree.cover[right]
        for child, inside in ((left, (low, min(high, edge + 1))), (right, (max(low, edge + 1), high))):
            if tree.cover[child] > 0:
                visit(tree, child, {**path, j: (share * tree.cover[child] / total, *inside)})

    def look_up(tree: Tree, node: int, path: dict, below: dict[int, np.ndarray], sizes: dict[int, int]) -> None:
        states = math.prod(sizes.values())
        every, step = np.arange(states), 1
        pattern, columns, steps = np.zeros(states, _bits(width)), np.zeros((width, states)), {}
        for j, size in sizes.items():
            state = every // step % size
            of = np.zeros(len(edges[j]) + 1, np.intp)
            if j in below:
                of[1:] = np.searchsorted(below[j], edges[j], side="right")
                columns[j] = np.append(below[j], np.inf)[np.maximum(state - (j in path), 0)]
            if j in path:  # state 0: a test above fails
                _, low, high = path[j]
                of += 1
                of[:low] = of[high:] = 0
                pattern |= (state > 0) * pattern.dtype.type(1 << list(path).index(j))
            steps[j] = of * step
            step *= size
        table = np.zeros((4 * sets, states))
        walk(tree, node, {j: share for j, (share, _, _) in path.items()}, pattern, columns, table, rule)
        table = np.ascontiguousarray(table.reshape(sets, 4, states).transpose(0, 2, 1))
        lookups = []
        for group, place in zip(joint, places):
            if any(j in steps for j in group):
                parts = [steps.get(j, np.zeros(len(edges[j]) + 1, np.intp)) for j in group]
                lookups.append((reduce(np.add.outer, parts).reshape(-1), place))
        used = sorted({j // 4 for j in sizes})
        for first in range(0, rows, ROWS_IN_CACHE):
            some = slice(first, first + ROWS_IN_CACHE)
            at = reduce(np.add, [of.take(place[some]) for of, place in lookups])
            for k in used:
                np.take(table[k], at, axis=0, out=found[: len(at)], mode="clip")
                phi[k, some] += found[: len(at)]

    for tree in trees:
        seen: set[int] = set()
        visit(tree, 0, {})
        for node in tree.tests_of.keys() - seen:  # the next batch asks for the same nodes; the others would fill memory
            del tree.tests_of[node]
    return phi.transpose(1, 0, 2).reshape(rows, -1)[:, :width] / len(trees)


def joint_features(sizes: Sequence[int]) -> list[list[int]]:
    """The features in groups with few combinations of positions, the largest features first."""
    groups: list[list[int]] = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        room = [g for g in groups if math.prod(sizes[i] for i in g) * sizes[j] <= JOINT_POSITIONS]
        if room:
            room[0].append(j)
        else:
            groups.append([j])
    return groups


def gathered(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches put together until they have at least ``rows`` rows; empty ones are left out."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not batch.empty:
            held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def tree_contributions(
    model: PipelineModel,
    df: DataFrame,
    id_col: str = "transaction_id",
    cols: Sequence[str] = FEATURES,
    keep: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """(id, base, probability, phi[n], x[n], kept columns) for each row; base + sum(phi) = probability."""
    ship(df.sparkSession)
    trees = read_trees(node_table(df.sparkSession, model, path))
    base = float(np.mean([t.expected() for t in trees]))
    shared = df.sparkSession.sparkContext.broadcast(trees)
    inputs = df.select(id_col, *keep, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields
    ) + ", base double, probability double, phi array<double>"

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, ROWS_AT_ONCE):
            phi = contributions(shared.value, np.stack(batch["x"].to_numpy()))
            yield batch.assign(base=base, probability=base + phi.sum(axis=1), phi=list(phi))

    return inputs.mapInPandas(explain, schema)
