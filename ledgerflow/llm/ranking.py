"""Ranked lexical search by dense blocked multiplication.

Items are the queries, all documents are ranked for each. A score is a sum over the item's terms of a whole weight times a whole
impact, so it can be summed in floating point without error as long as no partial sum passes 2^53:

* documents are read once per shard of items; for each one the counts of the shard's terms are stored, with its length,
* the totals and document frequencies follow from these rows, and with them weights and impacts,
* in each task, tiles of documents times tiles of the vocabulary are filled with impacts and multiplied (BLAS, float64) with tiles
  of the vocabulary times the items. A vocabulary tile is as narrow as 2^53 over the largest weight and impact asks for;
  tiles are added up as 64-bit integers,
* a task keeps the best documents of each item: everything at or above the k-th score so far is a candidate, so equal scores
  are settled by the document's id and not by the tile that held it,
* Spark ranks what the tasks kept, in two steps, so that no task meets more than its share of one item's candidates.

Items are taken in shards of at most ``SHARD_ITEMS`` and about ``SHARD_BYTES`` of text, which bounds what is broadcast: a
shard's vocabulary and its item tiles. Counts of terms that no item of the shard holds are never kept.

Null and wordless texts match nothing; they count neither as documents nor as items. Rows of items that repeat are one item,
rows of documents that repeat are documents each. A null document id ranks after all others with its score. An item of any
length and a text of any length are used whole. Without items or documents there are no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import in_rows, store, words_of

TOP = 50
SHARD_ITEMS, SHARD_BYTES = 4096, 8 << 20
# Sides of the tiles: documents, terms, items. The three matrices stay below 32 MB together.
DOC_TILE, TERM_TILE, ITEM_TILE = 512, 4096, 256
EXACT = 1 << 53
# The largest impact is below this: (1000000000 * tf) div (1000 * tf + 20 * m) with m of 50 and more.
MOST_IMPACT = 1_000_000
# Terms whose lengths or counts would overflow 64 bits in the product with 10^9 do not occur: texts have below 2^31 bytes.
SALTS = 64

FOUND = T.StructType(
    [
        T.StructField("item", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)
COUNTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def weight(documents: int, holding: int) -> int:
    """The whole weight of a term."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, middles: np.ndarray) -> np.ndarray:
    """The whole impacts of terms that occur ``counts`` times in documents of length ``middles``."""
    return (1_000_000_000 * counts) // (1000 * counts + 20 * middles)


def middle(n: int, documents: int, length: int) -> int:
    """A document's length against the average, 100 on average."""
    return 100 - 50 + (50 * n * documents) // length


class Tiles:
    """The items of a shard as tiles of weights over the terms of the items of the tile only."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, term_tile: int = TERM_TILE, item_tile: int = ITEM_TILE):
        heaviest = max(1, int(np.abs(weights).max(initial=1)))
        self.width = max(1, min(term_tile, EXACT // (heaviest * MOST_IMPACT) - 1))
        self.blocks = []
        # Items with common first terms stand together, so that tiles share their vocabulary.
        order = sorted(range(len(items)), key=lambda n: items[n][:3].tolist())
        for first in range(0, len(items), item_tile):
            own = np.array(order[first : first + item_tile])
            terms = np.unique(np.concatenate([items[n] for n in own]))
            parts = []
            for at in range(0, len(terms), self.width):
                part = terms[at : at + self.width]
                table = np.zeros((len(part), len(own)))
                for column, n in enumerate(own):
                    held = items[n][(items[n] >= part[0]) & (items[n] <= part[-1])]
                    table[np.searchsorted(part, held), column] = weights[held]
                parts.append((part, table))
            self.blocks.append((own, parts))


class Best:
    """The best documents of some items so far: everything that may still be among the first ``top``."""

    def __init__(self, size: int, top: int):
        self.top, self.size = top, size
        self.bar = np.ones(size, dtype=np.int64)
        self.kept = [np.empty(0, dtype=np.int64)] * 3  # item, score, document
        self.fresh: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """Scores of documents (rows) for the items (columns)."""
        row, item = np.nonzero(scores >= self.bar)
        if len(row):
            self.fresh.append([item, scores[row, item], docs[row]])
            self.waiting += len(row)
            if self.waiting > 4 * self.top * self.size:
                self.prune()

    def prune(self) -> None:
        item, score, doc = (np.concatenate(c) for c in zip(self.kept, *self.fresh))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.bar[item[last]] = score[last]
        self.kept = [c[rank < self.top] for c in (item, score, doc)]
        self.fresh, self.waiting = [], 0


class Vocabulary:
    """The terms of a shard of items, numbered, and each item's own."""

    def __init__(self, texts: list[str]):
        own = [sorted(set(words_of(t))) for t in texts]
        self.numbers = {w: n for n, w in enumerate(sorted({w for words in own for w in words}))}
        self.items = [np.array([self.numbers[w] for w in words], dtype=np.int64) for words in own]


def count_terms(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term: its length and its counts of the vocabulary's terms."""
    numbers = docs.sparkSession.sparkContext.broadcast(vocabulary.numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, size = numbers.value, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=COUNTED.names)

        for doc_id, text in in_rows(batches, "doc_id", "text"):
            words = words_of(text)
            if not words:
                continue
            held = Counter(map(known.get, words))
            held.pop(None, None)
            terms, counts = np.fromiter(held.keys(), "<i4", len(held)), np.fromiter(held.values(), "<i4", len(held))
            rows.append((doc_id, len(words), terms.tobytes(), counts.tobytes()))
            size += 8 * len(held) + 16
            if size > 4 << 20:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, COUNTED)


def shard_numbers(items: DataFrame, shard_items: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """The distinct items that have words, dealt by hash into shards."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).filter("text IS NOT NULL").distinct()
    rows = store(rows, "ranked-items")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    shards = max(1, math.ceil(total["n"] / shard_items), math.ceil(total["size"] / shard_bytes))
    return rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))), shards if total["n"] else 0


def best_documents(docs: DataFrame, counted: DataFrame, vocabulary: Vocabulary, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): for each item what every task found to be among its best."""
    totals = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("length")).first()
    documents, length = totals["n"], totals["length"]
    if not documents:
        return docs.sparkSession.createDataFrame([], FOUND)

    terms_known = len(vocabulary.numbers)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms_known, dtype=np.int64)
        for batch in batches:
            for terms in batch.column(0):
                held[np.frombuffer(terms.as_py(), "<i4")] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["term", "n"])

    summed = counted.select("terms").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = np.zeros(max(1, len(vocabulary.numbers)), dtype=np.int64)
    for row in summed.collect():  # one number per term of the shard
        weights[row["term"]] = weight(documents, row["n"])
    shared = docs.sparkSession.sparkContext.broadcast(Tiles(vocabulary.items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        best = [Best(len(own), top) for own, _ in tiles.blocks]
        missing = np.iinfo(np.int64).max  # null ids come last among equals

        def score(rows: list[tuple]) -> None:
            sizes = [len(r[2]) // 4 for r in rows]
            row = np.repeat(np.arange(len(rows)), sizes)
            term = np.frombuffer(b"".join(r[2] for r in rows), "<i4").astype(np.int64)
            count = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
            middles = np.array([middle(r[1], documents, length) for r in rows], dtype=np.int64)
            value = impacts(count, middles[row])
            ids = np.array([missing if r[0] is None else r[0] for r in rows], dtype=np.int64)
            order = np.argsort(term, kind="stable")
            row, term, value = row[order], term[order], value[order]
            for (own, parts), kept in zip(tiles.blocks, best):
                sums = np.zeros((len(rows), len(own)), dtype=np.int64)
                for part, table in parts:
                    a, b = np.searchsorted(term, [part[0], part[-1] + 1])
                    at = np.searchsorted(part, term[a:b])
                    held = part[at] == term[a:b]
                    if not held.any():
                        continue
                    dense = np.zeros((len(rows), len(part)))
                    dense[row[a:b][held], at[held]] = value[a:b][held]
                    sums += (dense @ table).astype(np.int64)
                kept.add(sums, ids)

        waiting: list[tuple] = []
        for found in in_rows(batches, *COUNTED.names):
            if found[2]:
                waiting.append(found)
            if len(waiting) == DOC_TILE:
                score(waiting)
                waiting = []
        if waiting:
            score(waiting)
        for (own, _), kept in zip(tiles.blocks, best):
            kept.prune()
            item, points, doc = kept.kept
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[item], pa.int64()), pa.array(doc, pa.int64(), mask=doc == missing), pa.array(points, pa.int64())],
                names=FOUND.names,
            )

    return counted.mapInArrow(search, FOUND)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each item with their rank; each item's candidates are thinned out in ``SALTS`` parts first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", "salt").orderBy(*order)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    thin = salted.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank", "salt")
    whole = Window.partitionBy("item").orderBy(*order)
    return thin.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, shard_items: int = SHARD_ITEMS, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item; ``docs`` has doc_id and text, ``items`` item_id and text."""
    spark = docs.sparkSession
    rows, shards = shard_numbers(items, shard_items, shard_bytes)
    out = None
    for n in range(shards):
        own = [(r["item_id"], r["text"]) for r in rows.filter(F.col("shard") == n).sort("item_id", "text").collect()]
        vocabulary = Vocabulary([t for _, t in own])
        if not vocabulary.numbers:
            continue
        counted = store(count_terms(docs, vocabulary), "term-counts")
        best = ranked(best_documents(docs, counted, vocabulary, top), top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(own)], "item long, item_id long")
        part = best.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
        if shards > 1:
            part = store(part, "ranked")  # a shard is finished, and its tables released, before the next one
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
