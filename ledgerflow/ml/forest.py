"""A forest for two classes, grown from counts over binned rows; the result is a model of ``pyspark.ml``.

The method is that of ``RandomForestClassifier``: every tree sees each row as often as a Poisson draw of mean one says, a node tests
a random choice of the features at thresholds that divide a sample into about 32 bins, the best fall of the Gini impurity wins, and
leaves beside each other that predict the same are one. What differs is what is kept and moved. A row is one byte per feature, which
holds its bin and its label. Neither its draws nor its nodes are kept: the draws come from a generator that is seeded with the
row's block and the tree, so that every pass finds them again, and rows walk down the trees. A pass adds up a level of some trees:
each task counts its rows per node, feature, bin and label, and Spark adds up these counts per tree. So what is shuffled and kept
depends on the number of tasks and on the size of the model, not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.ml.boosting import binned, drawn, plain, thresholds_of
from ledgerflow.settings import scratch_dir, ship

BLOCK_ROWS = 65_536
# A task holds this many counts at once; a level with more is added up in several passes, each for some of the trees.
MOST_CELLS = 16_000_000
# Counts are shuffled in pieces of this many nodes.
PIECE_NODES = 512
BLOCKS = "block long, bins binary"
# A node that is not divided: no byte of a row lies above.
WHOLE = 255
#: Up to so many copies a Poisson draw of mean one gives a share that a double can tell from one.
SHARES = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))
EPSILON = np.finfo(float).eps


@dataclass
class Growing:
    """A tree as parallel lists, level by level; the right child follows the left one, and a leaf is its own left child.

    ``cut`` is the last byte that goes left. ``counts`` are draws per label, ``open`` the nodes of the newest level that may be
    divided and ``chosen`` the features that each of these may test.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    counts: np.ndarray
    open: np.ndarray
    chosen: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int16))


# ---- rows in tasks ------------------------------------------------------------------------------------------------


def packer(thresholds: Sequence[np.ndarray]) -> Callable:
    """Turns rows (features and label) into numbered blocks; a row is twice its bin plus its label for each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, n = TaskContext.get().partitionId() << 32, 0

        def block(rows):
            return pa.record_batch([pa.array([first + n], pa.int64()), pa.array([rows.tobytes()], pa.binary())], names=["block", "bins"])

        held = np.zeros((0, len(thresholds)), np.uint8)
        for batch in batches:
            *values, label = [plain(c) for c in batch.columns]
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels have to be 0 or 1")
            held = np.concatenate([held, (2 * binned(values, thresholds) + label.astype(np.uint8)).T])
            while len(held) >= BLOCK_ROWS:
                yield block(held[:BLOCK_ROWS])
                held, n = held[BLOCK_ROWS:], n + 1
        if len(held):
            yield block(held)

    return run


def draws(rows: int, seed: int, block: int, tree: int) -> np.ndarray:
    """How often a tree sees each row of a block: Poisson with mean one, the same at every call."""
    rng = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, block >> 32, block & 0xFFFFFFFF, tree]))
    high = rng.integers(0, 65_536, rows, np.uint16)
    edges = np.unique((SHARES * 65_536).astype(np.int64).clip(0, 65_535)).astype(np.uint16)
    seen, unsure = np.zeros(rows, np.uint8), np.zeros(rows, bool)
    for edge in edges:
        seen += high > edge
        unsure |= high == edge
    # Sixteen digits decide all but one in some thousand; those get the digits they lack.
    at = np.flatnonzero(unsure)
    seen[at] = np.searchsorted(SHARES, (high[at] + rng.random(len(at))) / 65_536, side="right")
    return seen


def reached(flat: np.ndarray, at: np.ndarray, tree: Growing, level: int) -> np.ndarray:
    """The node that each row reaches in ``level`` steps; ``at`` is where the row starts in ``flat``."""
    feature, left = tree.feature.astype(np.intp), tree.left.astype(np.intp)
    node = np.zeros(len(at), np.intp)
    for _ in range(level):
        node = left.take(node) + (flat.take(feature.take(node) + at) > tree.cut.take(node))
    return node


def counter(trees: dict[int, Growing], width: int, level: int, size: int, seed: int | None) -> Callable:
    """Draws per open node, tested feature and byte, for each tree: pieces of some nodes each. No seed: each row counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((tree.chosen.shape[1], len(tree.open) * size)) for t, tree in trees.items()}
        for batch in batches:
            for block, bins in zip(batch.column("block").to_pylist(), batch.column("bins")):
                flat = np.frombuffer(bins.as_buffer(), np.uint8)
                for t, tree in trees.items():
                    count(flat, block, t, tree, sums[t])
        for t, tree in trees.items():
            whole = sums[t].reshape(tree.chosen.shape[1], len(tree.open), size).transpose(1, 0, 2)
            for first in range(0, len(tree.open), PIECE_NODES):
                piece = np.ascontiguousarray(whole[first : first + PIECE_NODES]).astype(np.int64)
                kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.int64) if piece.max() <= np.iinfo(k).max)
                yield pa.record_batch(
                    [pa.array([t], pa.int32()), pa.array([first], pa.int32()), pa.array([piece.astype(kind).tobytes()], pa.binary())],
                    names=["tree", "first", "sums"],
                )

    def count(flat: np.ndarray, block: int, t: int, tree: Growing, total: np.ndarray) -> None:
        rows = len(flat) // width
        seen = draws(rows, seed, block, t) if seed is not None else np.ones(rows, np.uint8)
        some = np.flatnonzero(seen != 0)
        at, times = some * width, seen.take(some).astype(float)
        node = reached(flat, at, tree, level)
        slots = np.full(len(tree.left), -1, np.intp)
        slots[tree.open] = np.arange(len(tree.open))
        slot = slots.take(node)
        inside = slot >= 0
        if not inside.all():
            slot, at, times = slot[inside], at[inside], times[inside]
        cell = slot * size
        for own, chosen in zip(total, tree.chosen.T.astype(np.intp)):
            np.add.at(own, cell + flat.take(at + chosen.take(slot)), times)

    return run


def divider(trees: dict[int, Growing], size: int, weights: tuple[float, float]) -> Callable:
    """Adds up the pieces of a tree's nodes and finds the best division of each: (nodes, 7) numbers, see ``best``."""

    def run(table: pa.Table) -> pa.Table:
        t, first = table.column("tree")[0].as_py(), table.column("first")[0].as_py()
        chosen = trees[t].chosen[first : first + PIECE_NODES]
        cells = len(chosen) * chosen.shape[1] * size
        total = np.zeros(cells)
        for chunk in table.column("sums").chunks:
            for piece in chunk:
                data = piece.as_buffer()
                kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[data.size // cells]
                total += np.frombuffer(data, kind)
        found = best(total.reshape(len(chosen), chosen.shape[1], size // 2, 2), chosen, weights)
        return pa.table({"tree": pa.array([t], pa.int32()), "first": pa.array([first], pa.int32()), "found": pa.array([found.tobytes()], pa.binary())})

    return run


def impurity(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    total = zeros + ones
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, 1.0 - (zeros / total) ** 2 - (ones / total) ** 2, 0.0)


def best(sums: np.ndarray, chosen: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """For each node: feature, last bin that goes left, gain (0: not divided), draws per label of the node and of its left side."""
    upto = sums.cumsum(axis=2)
    whole = upto[:, :1, -1:, :]
    low, high = upto, whole - upto
    parts = [np.moveaxis(n, -1, 0) * np.reshape(weights, (2, 1, 1, 1)) for n in (low, high, whole)]
    (low0, low1), (high0, high1), (all0, all1) = parts
    with np.errstate(invalid="ignore", divide="ignore"):
        total = all0 + all1
        share = (low0 + low1) / total
        gain = impurity(all0, all1) - share * impurity(low0, low1) - (high0 + high1) / total * impurity(high0, high1)
    gain = np.where((low.sum(axis=3) > 0) & (high.sum(axis=3) > 0), gain, 0.0).reshape(len(sums), -1)
    at, node = gain.argmax(axis=1), np.arange(len(sums))
    nth, cut = np.divmod(at, sums.shape[2])
    return np.column_stack([chosen[node, nth], cut, gain[node, at], whole[:, 0, 0], low[node, nth, cut]]).astype(float)


# ---- growing ------------------------------------------------------------------------------------------------------


def grow(tree: Growing, found: np.ndarray, weights: tuple[float, float], last: bool) -> None:
    """Divides the open nodes as found; children that are pure, or on the last level, are closed."""
    node, split = tree.open, found[:, 2] > 0
    tree.counts[node] = found[:, 3:5]
    node, found = node[split], found[split]
    tree.feature[node], tree.cut[node], tree.gain[node] = found[:, 0], 2 * found[:, 1] + 1, found[:, 2]
    tree.left[node] = len(tree.left) + 2 * np.arange(len(node))
    counts = np.stack([found[:, 5:7], found[:, 3:5] - found[:, 5:7]], axis=1).reshape(-1, 2)
    new = np.arange(len(tree.left), len(tree.left) + len(counts))
    tree.feature = np.append(tree.feature, np.zeros(len(new), np.int16))
    tree.cut = np.append(tree.cut, np.full(len(new), WHOLE, np.uint8))
    tree.left = np.append(tree.left, new.astype(np.int32))
    tree.gain = np.append(tree.gain, np.full(len(new), -1.0))
    tree.counts = np.concatenate([tree.counts, counts])
    tree.open = new[impurity(*(counts * weights).T) >= EPSILON] if not last else new[:0]


def node_rows(nth: int, tree: Growing, thresholds: Sequence[np.ndarray], weights: tuple[float, float]) -> pa.Table:
    """The nodes as a stored model has them: numbered from the root, left before right, after neighbours that predict the same are one."""
    stats = tree.counts * weights
    said = (stats[:, 1] > stats[:, 0]).astype(float)
    left = tree.left.tolist()
    inner, size = [own != i for i, own in enumerate(left)], [1] * len(left)
    for i in range(len(left) - 1, -1, -1):
        if inner[i]:
            a, b = left[i], left[i] + 1
            inner[i] = inner[a] or inner[b] or said[a] != said[b]
            size[i] = 1 + size[a] + size[b] if inner[i] else 1
    ids, order, todo = {0: 0}, [], [0]
    while todo:
        order.append(i := todo.pop())
        if inner[i]:
            a, b = left[i], left[i] + 1
            ids[a], ids[b] = ids[i] + 1, ids[i] + 1 + size[a]
            todo += [b, a]
    split = [
        {"featureIndex": int(tree.feature[i]), "leftCategoriesOrThreshold": [float(thresholds[tree.feature[i]][tree.cut[i] // 2])], "numCategories": -1}
        if inner[i]
        else {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        for i in order
    ]
    columns = {
        "id": pa.array([ids[i] for i in order], pa.int32()),
        "prediction": pa.array(said[order]),
        "impurity": pa.array(impurity(*stats[order].T)),
        "impurityStats": pa.array(stats[order].tolist(), pa.list_(pa.float64())),
        "rawCount": pa.array(tree.counts[order].sum(axis=1).astype(np.int64)),
        "gain": pa.array([float(tree.gain[i]) if inner[i] else -1.0 for i in order]),
        "leftChild": pa.array([ids[left[i]] if inner[i] else -1 for i in order], pa.int32()),
        "rightChild": pa.array([ids[left[i] + 1] if inner[i] else -1 for i in order], pa.int32()),
        "split": pa.array(
            split,
            pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]),
        ),
    }
    nodes = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    return pa.table({"treeID": pa.array([nth] * len(order), pa.int32()), "nodeData": nodes})


def as_model(estimator: RandomForestClassifier, nodes: pa.Table, trees: int, width: int, df: DataFrame) -> RandomForestClassificationModel:
    """The model that ``estimator`` would have fitted, out of its nodes; written and loaded as stored models are."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "model")
    names = "org.apache.spark.ml.classification."
    shape = {"numFeatures": width, "numClasses": 2}
    own = {"class": f"{names}RandomForestClassificationModel", "numTrees": trees, **shape}
    DefaultParamsWriter.saveMetadata(estimator, path, spark, extraMetadata=own)
    one = DecisionTreeClassifier(featuresCol=estimator.getFeaturesCol(), labelCol=estimator.getLabelCol(), maxDepth=estimator.getMaxDepth())
    # The Python writer names the estimator's own class; a tree of a stored forest has the class of a fitted tree.
    each = DefaultParamsWriter._get_metadata_to_save(one, spark, {"class": f"{names}DecisionTreeClassificationModel", **shape})
    spark.createDataFrame([(t, each, 1.0) for t in range(trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def classes(train: DataFrame, label: str) -> dict[float | None, int]:
    """Rows per label."""
    return {r[0]: r[1] for r in train.groupBy(F.col(label).cast("double")).agg(F.count(F.lit(1))).collect()}


def fit(
    estimator: RandomForestClassifier, train: DataFrame, cols: Sequence[str], per_class: dict[float, int], per_node: int, bootstrap: bool = True
) -> RandomForestClassificationModel:
    """Trees with balanced class weights on ``cols``; labels are 0 and 1, both occur, and a null or NaN anywhere is an error."""
    spark, label, seed = train.sparkSession, estimator.getLabelCol(), estimator.getSeed()
    ship(spark)
    inputs = train.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    if sorted(per_class, key=str) != [0.0, 1.0]:
        raise ValueError("labels have to be 0 and 1")
    rows, width, depth = sum(per_class.values()), len(cols), estimator.getMaxDepth()
    weights = (rows / (2 * per_class[0.0]), rows / (2 * per_class[1.0]))
    sample = drawn(inputs, rows, seed).toArrow().combine_chunks()
    heavy = np.array(weights)[plain(sample.column("y").combine_chunks()).astype(int)]
    thresholds = tuple(thresholds_of(plain(sample.column(f"x{i}").combine_chunks()), rows, heavy) for i in range(width))
    size = 2 * (max(map(len, thresholds)) + 1)

    parts = max(1, min(rows // BLOCK_ROWS, spark.sparkContext.defaultParallelism))
    path = scratch_dir(spark, "forest-blocks")
    inputs.mapInArrow(packer(thresholds), BLOCKS).repartition(parts).write.parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)

    rng = np.random.default_rng(seed)
    trees = [
        Growing(np.zeros(1, np.int16), np.full(1, WHOLE, np.uint8), np.zeros(1, np.int32), np.full(1, -1.0), np.zeros((1, 2)), np.zeros(1, int))
        for _ in range(estimator.getNumTrees())
    ]
    for level in range(max(1, depth)):
        for tree in trees:
            every = np.tile(np.arange(width, dtype=np.int16), (len(tree.open), 1))
            tree.chosen = every if per_node >= width else rng.permuted(every, axis=1)[:, :per_node]
        for group in groups(trees, size):
            found = counted(blocks, group, width, level, size, weights, seed if bootstrap else None)
            for t, tree in group.items():
                if depth == 0:
                    found[t][:, 2] = 0.0
                grow(tree, found[t], weights, level == depth - 1)
    nodes = pa.concat_tables([node_rows(t, tree, thresholds, weights) for t, tree in enumerate(trees)])
    return as_model(estimator, nodes, len(trees), width, train)


def groups(trees: Sequence[Growing], size: int) -> Iterator[dict[int, Growing]]:
    """Trees with open nodes, as many at a time as a task can hold the counts of."""
    group, cells = {}, 0
    for t, tree in enumerate(trees):
        if not len(tree.open):
            continue
        own = tree.chosen.size * size
        if group and cells + own > MOST_CELLS:
            yield group
            group, cells = {}, 0
        group[t] = tree
        cells += own
    if group:
        yield group


def counted(blocks: DataFrame, group: dict[int, Growing], width: int, level: int, size: int, weights, seed) -> dict[int, np.ndarray]:
    """The best division of each open node of these trees: one pass over the blocks and one small shuffle."""
    sums = blocks.mapInArrow(counter(group, width, level, size, seed), "tree int, first int, sums binary")
    found = sums.groupBy("tree", "first").applyInArrow(divider(group, size, weights), "tree int, first int, found binary").collect()
    out = {}
    for t in group:
        pieces = sorted((r["first"], r["found"]) for r in found if r["tree"] == t)
        out[t] = np.concatenate([np.frombuffer(p, np.float64).reshape(-1, 7) for _, p in pieces])
    return out
