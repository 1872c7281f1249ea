"""SimHash near-duplicates: 64-bit fingerprints, compared bit-sliced inside blocks of equal bits.

The bits are cut into ``radius + 3`` ranges, and every three of them are a key: fingerprints at a distance of at most
``radius`` agree in full on at least one key (for a radius of two, ten keys of about 38 bits). Each distinct fingerprint goes
once into the bucket of each key, so 10^9 unrelated ones meet some 2 * 10^7 times, 10^10 some 2 * 10^9 times. Inside buckets the fingerprints are stored vertically, a
packed plane per bit, and lane i is compared with lane i + s for one shift s after the other: a plane XORed with its shift
adds one bit to the distances of 64 pairs per word, held in carry-save counters. A word whose pairs all exceed the
radius is given up, so most stop after a few planes. One pass serves thousands of small buckets at once.

A bucket of more than ``TILE`` members is cut into tiles and every two tiles meet in a task. A task returns a spanning
forest of the links it found, never pairs, and components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import store
from ledgerflow.llm.components import components

BITS = 64
EQUAL, MOST_RADIUS = 3, 4
TILE = 4096
LANES = 1 << 16
SEED = 42
PART = 1 << 16  # shingles whose bits are counted at once
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
FOREST = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words (ASCII white space between, A-Z lower-cased); one hash if there are fewer words."""
    words = text.encode().lower().split() if text else []
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - width]
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())]
    return np.array(found, dtype=np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint as a signed 64-bit number: a bit is set when it is set in over half the hashes; 0 without words."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), PART):
        part = hashes[at : at + PART].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, out: str = "fingerprint", text: str = "text", width: int = 3) -> DataFrame:
    """Adds the fingerprint of every text (null: as if empty) as a long."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return docs.withColumn(out, of(F.col(text)))


def masks(radius: int) -> list[int]:
    """The bits of each key, as signed numbers: every ``equal`` of ``radius + equal`` ranges of bits.

    ``radius`` bits lie in at most that many ranges, so close values agree in all bits of at least one key. Beyond a radius of
    ``MOST_RADIUS`` the keys would be too many, and single ranges are taken.
    """
    equal = EQUAL if radius <= MOST_RADIUS else 1
    edges = [round(i * BITS / (radius + equal)) for i in range(radius + equal + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    found = [sum(chosen) for chosen in combinations(parts, equal)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def planes_of(values: np.ndarray) -> np.ndarray:
    """The bits of ``values`` stored vertically: row j holds bit j of all of them, 64 to a word, with a word to spare."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    room = (len(values) // 64 + 2) * 64
    lanes = np.zeros((BITS, room), dtype=np.uint8)
    lanes[:, : len(values)] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def shifted(plane: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
    """For the given words of a packed plane, the lanes ``by`` places on."""
    skip, bits = divmod(by, 64)
    last = len(plane) - 1
    low = plane[np.minimum(words + skip, last)]
    if not bits:
        return low
    high = plane[np.minimum(words + skip + 1, last)]
    return (low >> np.uint64(bits)) | (high << np.uint64(64 - bits))


def close_lanes(planes: np.ndarray, live: np.ndarray, by: int, radius: int) -> np.ndarray:
    """The lanes i among the ``live`` (packed mask) whose value is within ``radius`` bits of that of lane i + ``by``.

    Distances are counted bit by bit in ``radius.bit_length()`` planes of counters; ``gone`` marks pairs beyond the radius.
    """
    words = np.flatnonzero(live)
    gone = ~live[words]
    counters = [np.zeros(len(words), dtype=np.uint64) for _ in range((radius + 1).bit_length())]
    for bit in range(BITS):
        carry = planes[bit][words] ^ shifted(planes[bit], words, by)
        for n, counter in enumerate(counters):
            counters[n], carry = counter ^ carry, counter & carry
        over = np.full(len(words), FULL)
        for n, counter in enumerate(counters):
            over &= counter if (radius + 1) >> n & 1 else ~counter
        gone |= over  # a distance that reaches radius + 1 passes through that very count
        if bit % 4 == 3:
            alive = gone != FULL
            if not alive.all():
                words, gone, counters = words[alive], gone[alive], [c[alive] for c in counters]
                if not len(words):
                    break
    if not len(words):
        return words
    hits = np.unpackbits((~gone).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(hits)
    return words[row] * 64 + lane


def forest(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (value, root) among ``values``, which stand bucket after bucket; ``sizes`` are the buckets' sizes."""
    order = np.argsort(-sizes, kind="stable")
    starts = np.cumsum(sizes) - sizes
    sizes, starts = sizes[order], starts[order]
    values = values[np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)])]
    left = np.repeat(sizes, sizes) - (np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    planes, root = planes_of(values), np.arange(len(values))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    room = planes.shape[1] * 64
    for by in range(1, int(sizes[0]) if len(sizes) else 0):
        last = int(sizes[sizes > by].sum())
        lanes = np.zeros(room, dtype=np.uint8)
        lanes[:last] = left[:last] > by
        live = np.packbits(lanes, bitorder="little").view("<u8")
        found = close_lanes(planes, live, by, radius)
        fresh = found[root[found] != root[found + by]]
        for i in fresh.tolist():
            a, b = top(i), top(i + by)
            root[max(a, b)] = min(a, b)
        if len(fresh):
            while True:
                higher = root[root]
                if (higher == root).all():
                    break
                root = higher
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def links(prints: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect exactly those distinct values of ``fingerprint`` that chains of close ones connect."""
    value = F.col("fingerprint")
    blocks = [F.struct(F.lit(n).alias("block"), value.bitwiseAND(F.lit(mask).cast("long")).alias("bits")) for n, mask in enumerate(masks(radius))]
    rows = prints.select("fingerprint").distinct().select("fingerprint", F.inline(F.array(*blocks)))
    sizes = rows.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cut = F.ceil(F.col("n") / tile).cast("int")
    placed = rows.join(sizes, ["block", "bits"]).select("*", cut.alias("cuts"), F.pmod(F.xxhash64("fingerprint"), cut).cast("int").alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    met = placed.select("fingerprint", "block", "bits", "own", other)
    met = met.select("fingerprint", "block", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    bucket = ["block", "bits", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[np.ndarray]) -> pa.RecordBatch:
            keys = np.concatenate(held, axis=1)
            edges = np.flatnonzero(np.any(keys[1:, 1:] != keys[1:, :-1], axis=0)) + 1
            bounds = np.concatenate(([0], edges, [keys.shape[1]]))
            a, b = forest(keys[0].view(np.uint64), np.diff(bounds), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held, count = [], 0
        for batch in batches:
            part = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            if not part.shape[1]:
                continue
            held.append(part)
            count += part.shape[1]
            if count >= LANES:
                whole = np.concatenate(held, axis=1)
                edges = np.flatnonzero(np.any(whole[1:, 1:] != whole[1:, :-1], axis=0)) + 1
                cut_at = int(edges[-1]) if len(edges) else 0
                if cut_at:
                    yield done([whole[:, :cut_at]])
                held, count = [whole[:, cut_at:]], whole.shape[1] - cut_at
        if held:
            yield done(held)

    spread = met.repartition(*bucket).sortWithinPartitions(*bucket, "fingerprint").select("fingerprint", *bucket)
    return spread.mapInArrow(compare, FOREST).distinct()


def rooted(nodes: DataFrame, radius: int, tile: int) -> DataFrame:
    """``nodes`` with distinct fingerprints and the ``root`` that chains of close ones share."""
    joined = components(links(nodes, radius, tile))
    return nodes.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint as a long, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id among the rows that chains of close fingerprints connect; null only where none
    of them has an id. Null and empty texts have fingerprint 0 and are linked like any other; repeated rows come out repeated.
    Rows with equal fingerprints meet in a sum only, so the number of copies does not matter.
    """
    rows = store(with_fingerprint(docs.select("doc_id", "text"), width=width).select("doc_id", "fingerprint"), "fingerprints")
    nodes = store(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    found = rooted(nodes, radius, tile)
    least = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = found.join(least, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def first_rows(docs: DataFrame, key: list[str], width: int = 3, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(``key``, rows): the smallest key of each component of near-duplicates, and the number of rows with that key.

    ``key`` tells rows with different texts apart, also where they share an id.
    """
    rows = with_fingerprint(docs.select(*key, "text"), width=width).select(*key, "fingerprint")
    counted = rows.groupBy("fingerprint", *key).agg(F.count(F.lit(1)).alias("rows"))
    nodes = store(counted.groupBy("fingerprint").agg(F.min(F.struct(*key, "rows")).alias("first")), "fingerprint-nodes")
    return rooted(nodes, radius, tile).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
