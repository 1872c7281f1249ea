"""A text quality classifier: naive Bayes features under a linear support vector machine.

A text becomes a set of hashed n-grams: its words and marks, pairs of neighbours, and pairs and triples of their shapes
(kind and length of a token, and whether it repeats the one before), which say something about texts in any language. An
n-gram present counts with its log-count ratio: how much more often texts of one class hold it than those of the other. On
these values a linear model with hinge loss is fitted by dual coordinate descent.

The fit uses at most ``MOST_ROWS`` labelled rows, those with the smallest hash of their id; that bound is what allows one
task to fit. Scoring reads every text in full. Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import in_rows, store

MOST_ROWS = 6000
DIMENSIONS = 1 << 18
SHAPES = 64
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+|\n+")
MOST_CACHED = 400_000
_last = np.zeros(DIMENSIONS, dtype=np.int32)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shape_of(token: bytes) -> int:
    """A number under ``SHAPES`` - 2 for the kind and length of a token."""
    size = min(len(token), 8).bit_length() if len(token) < 16 else 5  # 1, 2, 3, 3, 4.. 5
    if token[:1] == b"\n":
        return 1 + min(len(token), 3)
    if token.isdigit():
        return 8 + size
    if token.isalnum() or token[0] > 127:
        kind = 0 if token.islower() or token[0] > 127 else 1 if token.isupper() and len(token) > 1 else 2
        return 16 + kind * 8 + min(size + (len(token) > 10), 7)
    mark = b".,;:!?'\"()-".find(token) + 1 if len(token) == 1 else 0
    return 42 + mark if mark else 56 + min(len(token), 4)


_known: dict[bytes, int] = {}


def number_of(token: bytes) -> int:
    """A 64-bit number of a token: 58 bits of a hash, then its shape. Short ones are remembered per worker."""
    hashed = zlib.crc32(token) << 26 ^ zlib.crc32(token, 0x5BD1E995)
    found = (hashed << 6 | shape_of(token)) & 0xFFFFFFFFFFFFFFFF
    if len(token) <= 48:
        if len(_known) >= MOST_CACHED:
            _known.clear()
        _known[token] = found
    return found


def features(text: str | None) -> np.ndarray:
    """The n-grams of a text as distinct numbers under ``DIMENSIONS``; a text without tokens has one of its own."""
    tokens = TOKEN.findall(text.encode()) if text else []
    if not tokens:
        return np.zeros(1, dtype=np.int32)
    found = list(map(_known.get, tokens))
    if None in found:
        found = [number_of(t) if n is None else n for t, n in zip(tokens, found)]
    numbers = np.array(found, dtype=np.uint64)
    words, shapes = numbers >> np.uint64(6), (numbers & np.uint64(63)).astype(np.int64)
    shapes[1:][words[1:] == words[:-1]] = SHAPES - 1  # the same token again
    room = DIMENSIONS - SHAPES**2 - SHAPES**3 // 2 - 1
    two = shapes[:-1] * SHAPES + shapes[1:]
    grams = np.concatenate(
        [
            (words % np.uint64(room)).astype(np.int64) + 1,
            ((words[:-1] * _A ^ words[1:] * _B) % np.uint64(room)).astype(np.int64) + 1,
            two + (room + 1),
            (two[:-1] * SHAPES + shapes[2:]) // 2 + (room + 1 + SHAPES**2),
        ]
    )
    where = np.arange(len(grams), dtype=np.int32)
    _last[grams] = where  # of equal grams one place remains
    return grams[_last[grams] == where].astype(np.int32)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from the fit: crc32 of its id as text, modulo 3, is 1; without an id it is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 2.0

    def score(self, text: str | None) -> float:
        found = features(text)
        margin = float(self.weights[found].sum()) / np.sqrt(len(found)) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """ln of how much likelier class 1 holds an n-gram than class 0, from counts of texts."""
    counts = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels) if y == label]
        held = np.bincount(np.concatenate(own), minlength=DIMENSIONS) if own else np.zeros(DIMENSIONS)
        counts.append(smooth + held)
    return np.log((counts[0] / counts[0].sum()) / (counts[1] / counts[1].sum()))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, passes: int = 20, seed: int = 7) -> Model:
    """Hinge loss with squared norm, by dual coordinate descent over the rows in random order.

    Values are ratios divided by the root of the number of n-grams, so that long texts do not outweigh short ones. With
    one class only, every text gets its side.
    """
    present = set(labels.tolist())
    if len(present) < 2:
        side = 1.0 if 1 in present or not present else -1.0
        return Model(np.zeros(DIMENSIONS), side)
    ratios = log_count_ratios(rows, labels)
    signs = np.where(labels == 1, 1.0, -1.0)
    values = [ratios[r] / np.sqrt(len(r)) for r in rows]
    squares = np.array([v @ v for v in values]) + 1.0
    weights, bias, dual = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for i in draw.permutation(len(rows)).tolist():
            slope = signs[i] * (float((values[i] * weights[rows[i]]).sum()) + bias) - 1.0
            new = min(max(dual[i] - slope / squares[i], 0.0), cost)
            step = (new - dual[i]) * signs[i]
            if step:
                dual[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                most = max(most, abs(step))
        if most < 1e-2 * cost:
            break
    return Model(weights * ratios, bias)


def sample(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents that are not held out, by the hash of their ids.

    The ids are bounded by ``most`` and broadcast; only their texts are moved. Of several labels of an id the smallest counts,
    of several rows of an id the one whose text has the smallest hash, so copies cannot raise the number of rows.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    keyed = picked.select("doc_id", F.struct(F.xxhash64("doc_id", "text").alias("key"), "text", "label").alias("row"))
    return keyed.groupBy("doc_id").agg(F.min("row").alias("row")).select("row.*")


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Fits the classifier; texts become n-grams in parallel, and one task fits them in order of their hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, label in in_rows(batches, "key", "text", "label"):
            own = features(text).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([int(label)]), pa.array([own], pa.binary())], names=["key", "label", "own"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((key, label, own) for key, label, own in in_rows(batches, "key", "label", "own"))
        rows = [np.frombuffer(own, dtype=np.int32) for _, _, own in found]
        model = fit(rows, np.array([label for _, label, _ in found], dtype=np.int64))
        at = np.flatnonzero(model.weights)
        places, values = [-1, *at.tolist()], [model.bias, *model.weights[at].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(values, pa.float64())], names=["at", "weight"])

    counted = sample(docs, labels, most).mapInArrow(count, "key long, label long, own binary")
    table = store(counted.repartition(1).mapInArrow(learn, "at long, weight double"), "quality-model").toArrow()
    at, weight = table["at"].to_numpy(), table["weight"].to_numpy()
    weights = np.zeros(DIMENSIONS, dtype=np.float32)
    weights[at[at >= 0]] = weight[at >= 0]
    own = weight[at < 0]
    return Model(weights, float(own[0]) if len(own) else 1.0)


def with_score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """Adds the score of every whole text, 0 to 1; null texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn(out, score(F.col(text)))
