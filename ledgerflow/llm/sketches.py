"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is a set of paragraph digests: its lines, long ones cut at places that the text itself decides. A sketch deals each
digest to three cells, which hold a count, a sum of digests and a sum of check values. Sketches of two versions are
subtracted cell by cell: what both hold cancels, and peeling cells that hold one digest recovers what only one of them
holds. When cells remain, the difference was too large for the sketch, and larger ones with other hashes are tried until
all is recovered; so likenesses are exact. The fingerprint is the smallest sketch, of ``CELLS`` cells for any text.

Neighbouring documents in the order of ids are brought together by ranges of ids; only the last text of a range is copied.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import in_rows
from ledgerflow.plans.splits import BUCKET, find_splits, with_bucket

CELLS = 24
GROWTH = 4
LONGEST = 32
RANGE_ROWS = 4000
GROUP_BYTES = 1 << 20
_B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_CUT_MASK = np.uint32(3)


def paragraphs(text: str) -> list[bytes]:
    """The lines of a text, cut further behind blanks that follow certain four bytes, one in four, and every ``LONGEST`` bytes."""
    body = text.encode()
    if not body:
        return []
    data = np.frombuffer(b"\0\0\0\0" + body, dtype=np.uint8)
    at = np.flatnonzero((data[4:] == 32) | (data[4:] == 10))
    before = sum(data[at + i].astype(np.uint32) << np.uint32(8 * i) for i in range(4)) if len(at) else at.astype(np.uint32)
    hashed = (before * np.uint32(0x9E3779B1)) >> np.uint32(16) & _CUT_MASK
    cuts = at[(data[at + 4] == 10) | (hashed == 0)] + 1
    edges = np.array([0, *cuts.tolist()] + ([len(body)] if not len(cuts) or cuts[-1] < len(body) else []))
    if (np.diff(edges) > LONGEST).any():
        count = -(-np.diff(edges) // LONGEST)
        row = np.repeat(np.arange(len(count)), count)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        edges = np.concatenate((edges[row] + inner * LONGEST, edges[-1:]))
    bounds = edges.tolist()
    return [body[a:b] for a, b in zip(bounds, bounds[1:])]


def digests(text: str | None) -> np.ndarray:
    """A distinct 64-bit digest per paragraph; the n-th copy of a paragraph has one of its own."""
    pieces = paragraphs(text) if text else []
    found = [xxhash.xxh64_intdigest(p) for p in pieces]
    if len(set(found)) < len(found):
        seen: Counter = Counter()
        for i, piece in enumerate(pieces):
            if seen[piece]:
                found[i] = xxhash.xxh64_intdigest(piece, seen[piece])
            seen[piece] += 1
        found = list(dict.fromkeys(found))
    return np.array(found, dtype=np.uint64)


def scatter(keys: np.ndarray, seed: int) -> np.ndarray:
    """Other 64-bit numbers for digests, one for each seed."""
    z = keys + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * _B
    z = (z ^ (z >> np.uint64(27))) * _C
    return z ^ (z >> np.uint64(31))


def places(keys: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """The three cells of each digest, one in each third of the sketch: shape (3, n)."""
    third = np.uint64(cells // 3)
    return np.stack([(scatter(keys, 4 * seed + j) % third).astype(np.int64) + j * (cells // 3) for j in range(3)])


class Sketches:
    """One sketch of ``cells`` cells for each of ``n`` owners."""

    def __init__(self, n: int, cells: int, seed: int):
        self.cells, self.seed = cells, seed
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.keys = np.zeros(n * cells, dtype=np.uint64)
        self.checks = np.zeros(n * cells, dtype=np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> np.ndarray:
        """Adds digests to their owners' sketches, or takes them out; returns the cells touched."""
        signs = np.broadcast_to(np.asarray(sign, dtype=np.int64), keys.shape)
        own, check = signs.astype(np.uint64), scatter(keys, 4 * self.seed + 3)
        touched = (places(keys, self.cells, self.seed) + owner * self.cells).ravel()
        np.add.at(self.count, touched, np.tile(signs, 3))
        np.add.at(self.keys, touched, np.tile(keys * own, 3))
        np.add.at(self.checks, touched, np.tile(check * own, 3))
        return touched

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells, self.seed)
        out.count, out.keys, out.checks = self.count - other.count, self.keys - other.keys, self.checks - other.checks
        return out

    def text(self, n: int) -> str:
        """The sketch of owner ``n`` as text."""
        own = slice(n * self.cells, (n + 1) * self.cells)
        parts = (self.count[own].astype("<i4"), self.keys[own].astype("<u8"), self.checks[own].astype("<u4"))
        return base64.b64encode(b"".join(p.tobytes() for p in parts)).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties the sketches as far as it goes: (owner, digest, sign) of what was recovered, and which owners are done."""
        owners, keys, signs = [], [], []
        at = np.arange(len(self.count))
        while len(at):
            at = at[np.abs(self.count[at]) == 1]
            sign = self.count[at]
            own = sign.astype(np.uint64)
            key = self.keys[at] * own
            pure = self.checks[at] * own == scatter(key, 4 * self.seed + 3)
            at, key, sign = at[pure], key[pure], sign[pure]
            if not len(at):
                break
            # A digest may stand alone in several of its cells; it is taken once.
            order = np.lexsort((key, at // self.cells))
            owner, key, sign = (at // self.cells)[order], key[order], sign[order]
            first = np.concatenate(([True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])))
            owner, key, sign = owner[first], key[first], sign[first]
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            at = np.unique(self.add(owner, key, -sign))
        n = len(self.count) // self.cells
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        done = ~left.reshape(n, self.cells).any(axis=1) if n else np.zeros(0, dtype=bool)
        none = np.zeros(0, dtype=np.int64)
        return (
            np.concatenate([none, *owners]),
            np.concatenate([none.astype(np.uint64), *keys]),
            np.concatenate([none, *signs]),
            done,
        )


def sketch(sets: list[np.ndarray], cells: int = CELLS, seed: int = 0) -> Sketches:
    out = Sketches(len(sets), cells, seed)
    if sets:
        out.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets))
    return out


def differences(
    old: list[np.ndarray], new: list[np.ndarray], cells: int = CELLS, first: Sketches | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(only in old, only in new) of each pair of digest sets, recovered from sketches, larger ones until all are.

    ``first`` are the differences of the smallest sketches, if they are there already.
    """
    out: list = [None] * len(old)
    waiting, seed = list(range(len(old))), 0
    while waiting:
        # No sketch needs more than eight cells per digest; beyond that only the hashes change.
        groups: dict[int, list[int]] = {}
        for n in waiting:
            most = max(CELLS, 8 * (len(old[n]) + len(new[n])))
            groups.setdefault(min(cells, 3 * (1 << (most // 3).bit_length())), []).append(n)
        waiting = []
        for size, members in groups.items():
            if first is None or seed:
                both = sketch([old[n] for n in members], size, seed).minus(sketch([new[n] for n in members], size, seed))
            else:
                both = first
            owner, key, sign, done = both.peel()
            order = np.argsort(owner, kind="stable")
            owner, key, sign = owner[order], key[order], sign[order]
            edges = np.searchsorted(owner, np.arange(len(members) + 1))
            for i, n in enumerate(members):
                if done[i]:
                    keys, signs = key[edges[i] : edges[i + 1]], sign[edges[i] : edges[i + 1]]
                    out[n] = (keys[signs > 0], keys[signs < 0])
                else:
                    waiting.append(n)
        cells, seed = cells * GROWTH, seed + 1
    return out


def likeness(old: np.ndarray, new: np.ndarray, gone: np.ndarray) -> float:
    """The share of common digests among all, given those only the old set has."""
    common = len(old) - len(gone)
    every = len(new) + len(gone)
    return common / every if every else 1.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one, or all of it."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def in_order(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, bucket, ahead) laid out so that each document follows the next smaller id within its bucket.

    Ids and the hashes of their texts are cut into ranges by sampled cut points, so an id with very many texts is divided; the
    rows of a range are sorted ascending, null ids first. The largest of a range goes to the next range as well (``ahead``),
    that of the last to the first. Each range is a partition of its own.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    splits = find_splits(rows, [], ["doc_id", "hash"], rows_per_task=range_rows)
    placed = with_bucket(rows, splits) if splits.cuts else rows.withColumn(BUCKET, F.lit(0))
    tops = placed.groupBy(BUCKET).agg(F.max(F.struct("doc_id", "hash")).alias("top")).sort(BUCKET).collect()
    if not tops:
        return placed.select("doc_id", "text", F.col(BUCKET).alias("bucket"), F.lit(False).alias("ahead"))
    # One row per range: as many as there are cut points.
    following = [(r["top"]["doc_id"], r["top"]["hash"], tops[(i + 1) % len(tops)][BUCKET]) for i, r in enumerate(tops)]
    table = docs.sparkSession.createDataFrame(following, "top long, top_hash long, to int")
    last = placed["doc_id"].eqNullSafe(table["top"]) & (placed["hash"] == table["top_hash"])
    copies = placed.join(F.broadcast(table), last).select("doc_id", "text", "hash", F.col("to").alias("bucket"), F.lit(True).alias("ahead"))
    # Rows that repeat the largest one are one and the same to the next range.
    copies = copies.dropDuplicates(["bucket"])
    own = placed.select("doc_id", "text", "hash", F.col(BUCKET).cast("int").alias("bucket"), F.lit(False).alias("ahead"))
    spread = own.unionByName(copies).repartitionById(max(r[BUCKET] for r in tops) + 1, F.col("bucket"))
    return spread.sortWithinPartitions("bucket", F.desc("ahead"), F.asc_nulls_first("doc_id"), "hash", "text").drop("hash")


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("n_paragraphs", T.LongType()),
        T.StructField("n_changed", T.LongType()),
    ]
)


def against_next(docs: DataFrame, cells: int = CELLS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The fingerprint of every text and of its edited form, and their likenesses; see ``RESULT``.

    The next document is that with the next smaller id, after the smallest the one with the largest; rows without an id
    come last, equal ids stand in the order of their texts' hashes. Null texts are empty. A single row follows itself.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, texts: list[str], nexts: list[str], sets: list[np.ndarray], next_sets: list[np.ndarray]) -> pa.RecordBatch:
            changed = [edited(t, n) for t, n in zip(texts, nexts)]
            own = [digests(c) if c != t else s for c, t, s in zip(changed, texts, sets)]
            now, then = sketch(sets, cells), sketch(own, cells)
            to_edited, to_next = differences(sets, own, cells, now.minus(then)), differences(sets, next_sets, cells)
            rows = [
                (
                    ids[i],
                    len(texts[i]),
                    hashlib.sha256(changed[i].encode()).hexdigest(),
                    now.text(i),
                    then.text(i),
                    likeness(sets[i], own[i], to_edited[i][0]),
                    likeness(sets[i], next_sets[i], to_next[i][0]),
                    len(sets[i]),
                    len(to_edited[i][0]) + len(to_edited[i][1]),
                )
                for i in range(len(ids))
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=RESULT.names)

        # Each bucket begins with the row ahead of it, so the row before is the next document throughout.
        before, before_set = "", np.zeros(0, dtype=np.uint64)
        held: tuple[list, ...] = ([], [], [], [], [])
        size = 0
        for doc_id, text, ahead in in_rows(batches, "doc_id", "text", "ahead"):
            found = digests(text)
            if not ahead:
                for column, value in zip(held, (doc_id, text, before, found, before_set)):
                    column.append(value)
                size += len(text)
                if size >= GROUP_BYTES:
                    yield done(*held)
                    held, size = ([], [], [], [], []), 0
            before, before_set = text, found
        if held[0]:
            yield done(*held)

    return in_order(docs, range_rows).mapInArrow(compare, RESULT)
