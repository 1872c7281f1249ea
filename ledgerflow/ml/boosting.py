"""Boosted trees for two classes, grown from histograms of binned rows.

The method is that of ``GBTClassifier``: logistic loss, regression trees on its slope, thresholds that divide a sample of the
values into about 32 bins, leaves that hold the mean slope, a first tree of weight one. What differs is how rows are kept. A row
is one byte per feature, its label and its margin, in blocks of some thousand rows that are written to the shared folder. Each
level of a tree is one pass over the blocks: every task adds up its rows per node, feature and bin, and only these sums reach the
driver, a few thousand numbers a task. A pass applies the trees grown since the blocks were written, so blocks do not change from
pass to pass; every ``KEEP_ROUNDS`` rounds they are written anew with their margins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.settings import scratch_dir, ship

# As many bins are aimed at; a sample above its expected size gives some more.
BINS = 32
# The cut of a node that is not divided: no bin lies above.
WHOLE = 255
# Thresholds come from about this many rows, or from all rows if there are no more.
SAMPLE_ROWS = 10_000
BLOCK_ROWS = 16_384
KEEP_ROUNDS = 20
# Features that have at most this many combinations of bins are counted together.
JOINT_BINS = 1024
ROUNDING = 1e-12
BLOCKS = "bins binary, label binary, margin binary"


@dataclass(frozen=True)
class Tree:
    """A complete tree: for each inner node, level by level, a feature and the last bin that goes left; the leaves' values.

    A node that is not divided sends all rows left, and all leaves below it hold its value.
    """

    features: tuple[int, ...]
    cuts: tuple[int, ...]
    leaves: tuple[float, ...]
    weight: float


@dataclass(frozen=True)
class Boosted:
    """The fitted model: its inputs, the thresholds of each and the trees."""

    cols: tuple[str, ...]
    thresholds: tuple[np.ndarray, ...]
    trees: tuple[Tree, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (0/1) and ``probability`` of class 1; a null or NaN input is an error."""
        ship(df.sparkSession)
        thresholds, trees = self.thresholds, self.trees

        @F.arrow_udf(T.DoubleType())
        def margin(*values: pa.Array) -> pa.Array:
            bins = binned([plain(v) for v in values], thresholds)
            out = np.zeros(bins.shape[1])
            for at in range(0, len(out), BLOCK_ROWS):
                out[at : at + BLOCK_ROWS] = margins(bins[:, at : at + BLOCK_ROWS], out[at : at + BLOCK_ROWS], trees)
            return pa.array(out)

        known = df.withColumn("_margin", margin(*[F.col(c).cast("double") for c in self.cols]))
        probability = 1 - 1 / (1 + F.exp(2 * F.col("_margin")))
        return known.withColumns({"prediction": (F.col("_margin") > 0).cast("int"), "probability": probability}).drop("_margin")


# ---- rows in tasks ------------------------------------------------------------------------------------------------


def plain(values: pa.Array) -> np.ndarray:
    """The numbers of a column; null and NaN are errors, as they are for ``VectorAssembler``."""
    if values.null_count:
        raise ValueError("a model input is null")
    found = values.to_numpy(zero_copy_only=False)
    if np.isnan(found).any():
        raise ValueError("a model input is NaN")
    return found


def binned(values: Sequence[np.ndarray], thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """One row of bytes per feature: how many thresholds lie below the value."""
    return np.stack([np.searchsorted(t, v).astype(np.uint8) for v, t in zip(values, thresholds)])


def nodes(bins: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """The node that each row reaches on the given level, numbered from 0 on each level."""
    at = np.zeros(bins.shape[1], np.uint8 if levels <= 8 else np.uint32)
    for level in range(levels):
        right = np.zeros(bins.shape[1], bool)
        for k in range(1 << level):
            feature, cut = tree.features[(1 << level) - 1 + k], tree.cuts[(1 << level) - 1 + k]
            if cut != WHOLE:
                right |= (bins[feature] > cut) & (at == k) if level else bins[feature] > cut
        at = 2 * at + right
    return at


def margins(bins: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for tree in trees:
        values = np.array(tree.leaves) * tree.weight
        margin = margin + values[nodes(bins, tree, len(values).bit_length() - 1)]
    return margin


def slopes(label: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree is fitted to: the labels (-1 and 1) for the first, then the falling slope of the loss."""
    if first:
        return label.astype(float)
    with np.errstate(over="ignore"):
        return 4.0 * label / (1.0 + np.exp(2.0 * label * margin))


def joint(sizes: Sequence[int]) -> list[list[int]]:
    """The features in groups that have few combinations of bins together, the largest features first."""
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        for group in groups:
            if np.prod([sizes[g] for g in group]) * sizes[f] <= JOINT_BINS:
                group.append(f)
                break
        else:
            groups.append([f])
    return groups


def unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for bins, label, margin in zip(*[batch.column(c) for c in ("bins", "label", "margin")]):
        rows = np.frombuffer(margin.as_buffer(), np.float64)
        yield np.frombuffer(bins.as_buffer(), np.uint8).reshape(width, len(rows)), np.frombuffer(label.as_buffer(), np.int8), rows


def packed(bins: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    parts = [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, margin)]
    return pa.record_batch(parts, names=["bins", "label", "margin"])


def packer(thresholds: Sequence[np.ndarray]) -> Callable:
    """Turns rows (features and label) into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(bins, label):
            return packed(np.ascontiguousarray(bins), label, np.zeros(len(label)))

        bins, label = np.zeros((len(thresholds), 0), np.uint8), np.zeros(0, np.int8)
        for batch in batches:
            *values, known = [plain(c) for c in batch.columns]
            if not np.isin(known, (0.0, 1.0)).all():
                raise ValueError("labels have to be 0 or 1")
            bins = np.concatenate([bins, binned(values, thresholds)], axis=1)
            label = np.concatenate([label, (2 * known - 1).astype(np.int8)])
            while len(label) >= BLOCK_ROWS:
                yield block(bins[:, :BLOCK_ROWS], label[:BLOCK_ROWS])
                bins, label = bins[:, BLOCK_ROWS:], label[BLOCK_ROWS:]
        if len(label):
            yield block(bins, label)

    return run


def updater(width: int, trees: Sequence[Tree]) -> Callable:
    """The blocks with the margins that ``trees`` lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bins, label, margin in unpacked(batch, width):
                yield packed(bins, label, margins(bins, margin, trees))

    return run


def counter(sizes: Sequence[int], trees: Sequence[Tree], grown: Tree, level: int, first: bool) -> Callable:
    """Rows and summed slopes per node of a level, feature and bin: one result for each task."""
    groups, count = joint(sizes), 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = [(count, *[sizes[f] for f in group]) for group in groups]
        totals = [np.zeros((2, int(np.prod(shape)))) for shape in shapes]
        for batch in batches:
            for bins, label, margin in unpacked(batch, len(sizes)):
                slope = slopes(label, margins(bins, margin, trees), first)
                node = nodes(bins, grown, level).astype(np.int64)
                for group, total in zip(groups, totals):
                    cell = bins[group[0]].astype(np.uint16)
                    for f in group[1:]:
                        cell = cell * np.uint16(sizes[f]) + bins[f]
                    cell = node * (total.shape[1] // count) + cell if level else cell
                    total[0] += np.bincount(cell, minlength=total.shape[1])
                    total[1] += np.bincount(cell, slope, total.shape[1])
        out = np.zeros((2, count, len(sizes), max(sizes)))
        for group, total, shape in zip(groups, totals, shapes):
            whole = total.reshape(2, *shape)
            for i, f in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != i)
                out[:, :, f, : sizes[f]] = whole.sum(axis=others)
        yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    return run


# ---- growing ------------------------------------------------------------------------------------------------------


def drawn(inputs: DataFrame, rows: int, seed: int) -> DataFrame:
    """The rows that ``GBTClassifier`` draws for its thresholds: about ``SAMPLE_ROWS``, or all if there are no more.

    The draw is that of an RDD of the JVM, so that thresholds are the classifier's.
    """
    if rows <= SAMPLE_ROWS:
        return inputs
    spark = inputs.sparkSession
    first = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    some = inputs._jdf.toJavaRDD().sample(False, SAMPLE_ROWS / rows, first)
    return DataFrame(spark._jsparkSession.createDataFrame(some, inputs._jdf.schema()), spark)


def thresholds_of(values: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Middles between neighbouring values: all of them if they are few, else those that divide the rows most evenly.

    ``rows`` is the size of the table and the sum of all weights, which are 1 by default. A sample counts as of its expected
    size, what is missing there as zeros, which is how ``GBTClassifier`` counts.
    """
    expected = float(min(rows, SAMPLE_ROWS))
    known, n = np.unique(values[values != 0], return_counts=True)
    if weights is not None:
        n = np.bincount(np.searchsorted(known, values[values != 0]), weights[values != 0], len(known))
    zeros = expected - n.sum()
    if zeros > np.finfo(float).eps * 100 * expected:
        at = np.searchsorted(known, 0.0)
        known, n = np.insert(known, at, 0.0), np.insert(n.astype(float), at, zeros)
    middles = (known[:-1] + known[1:]) / 2.0
    wanted = min(BINS, rows) - 1
    if len(middles) <= wanted:
        return middles
    stride = expected / (wanted + 1)
    upto, target, found = np.cumsum(n), stride, []
    for i in range(1, len(known)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def divided(sums: np.ndarray, sizes: Sequence[int]) -> tuple[list[int], list[int], np.ndarray]:
    """For each node the feature and bin whose division lowers the variance most, and the mean slope of both sides.

    A node that no division improves keeps its rows, and its mean on both sides.
    """
    features, cuts, means = [], [], []
    for n, s in zip(sums[0], sums[1]):
        rows, total = n[0].sum(), s[0].sum()
        best, found = 0.0, (0, WHOLE)
        own = total / rows if rows else 0.0
        both = (own, own)
        for f, size in enumerate(sizes):
            left, left_sum = np.cumsum(n[f, : size - 1]), np.cumsum(s[f, : size - 1])
            right, right_sum = rows - left, total - left_sum
            allowed = (left > 0) & (right > 0)
            if not allowed.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                low, high = left_sum / left, right_sum / right
                # Means that differ by rounding only are equal, so that nodes of equal slopes are left whole.
                apart = np.where(np.abs(low - high) > ROUNDING * (np.abs(low) + np.abs(high)), low - high, 0.0)
                gain = np.where(allowed, left * right * apart**2, 0.0) / rows**2
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found, both = gain[at], (f, at), (left_sum[at] / left[at], right_sum[at] / right[at])
        features.append(found[0])
        cuts.append(found[1])
        means.append(both)
    return features, cuts, np.array(means)


def grown(blocks: DataFrame, sizes: Sequence[int], trees: Sequence[Tree], depth: int, first: bool, weight: float) -> Tree:
    """The next tree; ``trees`` are those that the margins of the blocks do not hold yet. One pass for each level."""
    tree = Tree((), (), (), weight)
    for level in range(depth):
        run = counter(sizes, trees, tree, level, first)
        parts = blocks.mapInArrow(run, "sums binary").collect()
        sums = sum(np.frombuffer(p.sums, np.float64) for p in parts).reshape(2, 1 << level, len(sizes), max(sizes))
        features, cuts, means = divided(sums, sizes)
        if level:  # a node without rows holds what its parent gave it
            empty = sums[0, :, 0].sum(axis=1) == 0
            means[empty] = np.array(tree.leaves)[empty, None]
        tree = replace(tree, features=(*tree.features, *features), cuts=(*tree.cuts, *cuts), leaves=tuple(means.reshape(-1).tolist()))
    return tree


def kept(blocks: DataFrame) -> DataFrame:
    """The blocks, written to the shared folder and read from there into memory, or onto disk where they do not fit."""
    spark, path = blocks.sparkSession, scratch_dir(blocks.sparkSession, "boosting")
    blocks.write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path).persist()


def fit(train: DataFrame, label: str, cols: Sequence[str], rounds: int, depth: int, step: float, seed: int) -> Boosted:
    """Boosted trees on ``cols``; labels are 0 and 1, and a null or NaN anywhere is an error."""
    spark, cols = train.sparkSession, tuple(cols)
    ship(spark)
    inputs = train.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    rows = inputs.count()
    if not rows:
        raise ValueError("there are no rows to learn from")
    sample = drawn(inputs, rows, seed).toArrow()
    thresholds = tuple(thresholds_of(plain(sample.column(f"x{i}").combine_chunks()), rows) for i in range(len(cols)))
    sizes = [len(t) + 1 for t in thresholds]

    # Blocks are spread over all cores whatever the files of the rows; one holds at most BLOCK_ROWS rows.
    parts = max(1, min(rows // BLOCK_ROWS, 2 * spark.sparkContext.defaultParallelism))
    blocks = kept(inputs.mapInArrow(packer(thresholds), BLOCKS).repartition(parts))
    trees: list[Tree] = []
    applied = 0
    try:
        for m in range(rounds):
            if m and m % KEEP_ROUNDS == 0:
                before, blocks = blocks, kept(blocks.mapInArrow(updater(len(cols), trees[applied:]), BLOCKS))
                before.unpersist()
                applied = m
            trees.append(grown(blocks, sizes, trees[applied:], depth, m == 0, step if m else 1.0))
    finally:
        blocks.unpersist()
    return Boosted(cols, thresholds, tuple(trees))
