"""Benchmark decontamination: a BM25 index of test items, searched with every passage of every text.

Test items are the indexed documents and training passages the queries, cut from whole texts as windows twice as long as
the longest item of a length class, half overlapping, so that an item stands in one window in full. An item's impacts are
divided by the score it gives itself: 1 is a passage with all its words, and ``threshold`` is a share of that. Retrieval
is exhaustive above the threshold:

* for all windows of a text at once, areas of items are bounded by the sums of the words' largest impacts there,
* blocks of neighbouring items are bounded by the sums of the block maxima of the window's distinct words,
* block-max WAND moves cursors over the postings, skips to the item whose bounds can reach the threshold, passes over blocks
  that cannot, and scores the items that remain.

What is retrieved is verified. An item is held when the passage has enough of the shingles of its question and of its
answer, or enough of the shingles of the whole item, or the whole item but for a few words that were replaced, left out or put
in; a few such words break most shingles. Item and passage are aligned for that: one word counts for items of ``WIDTH`` words
and more, two from 30 words on, one more for every ``PER_EDIT``. What is not retrieved, since the changed words carry half of
the item's score, stays unseen. The shares of the question and of the answer are reported either way.

Items are taken in shards of at most ``SHARD_ITEMS`` and about ``SHARD_BYTES``; their IDFs come from all items. Each shard is one
pass over the texts, which is finished and stored, and its broadcast released, before the next shard is built. Broadcast is
bounded by a shard's texts and, in each length class, ``AREAS`` numbers of four bytes for each word of the class.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import aside, in_rows, store, words_of

K1, B = 1.2, 0.75
WIDTH = 5
BLOCK = 2
AREAS = 64
CHUNKS = 1024
SHARD_ITEMS = 20_000
SHARD_BYTES = 8 << 20
THRESHOLD = 0.5
QUESTION, ANSWER, WHOLE = 0.8, 0.5, 0.8
PER_EDIT = 15
LEAST_CLASS = 32
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

HIT = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()),
        T.StructField("answer_overlap", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)
_HITS = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("score", pa.float64()),
            ("question_overlap", pa.float64()),
            ("answer_overlap", pa.float64()),
            ("first_word", pa.int64()),
            ("n_words", pa.int64()),
        ]
    )
)


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item: the last sentence answers the others; of a single sentence, the last third."""
    parts = [w for w in (words_of(s) for s in _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    whole = parts[0] if parts else []
    at = len(whole) - len(whole) // 3
    return whole[:at], whole[at:]


def shingles(words: Sequence, width: int) -> set[tuple]:
    """The distinct runs of ``width`` words; of fewer words the one run there is."""
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def edits(words: Sequence, passage: Sequence) -> int:
    """The fewest words to replace, leave out or put in so that ``words`` stand in a row somewhere in ``passage``.

    One pass over the passage; the column of the alignment table is kept as the bits of two numbers, where it rises and falls.
    """
    size = len(words)
    if not size:
        return 0
    places: dict = defaultdict(int)
    for n, word in enumerate(words):
        places[word] |= 1 << n
    every, last = (1 << size) - 1, 1 << (size - 1)
    rises, falls, now = every, 0, size
    best = now
    for word in passage:
        same = places.get(word, 0)
        steady = same | falls
        diagonal = (((same & rises) + rises) ^ rises) | same
        up, down = falls | (~(diagonal | rises) & every), rises & diagonal
        now += (1 if up & last else 0) - (1 if down & last else 0)
        best = min(best, now)
        up, down = (up << 1) & every, (down << 1) & every
        rises, falls = down | (~(steady | up) & every), up & steady
    return best


def edits_allowed(size: int) -> int:
    """How many words an item of ``size`` words may differ from its copy by: one, and one for every ``PER_EDIT`` words."""
    return max(1, size // PER_EDIT) if size >= WIDTH else 0


class Postings:
    """The index of items of one length class: impacts by term, block maxima, and what verification needs."""

    def __init__(self, items: list[tuple[int | None, str]], numbers: dict[bytes, int], idf: np.ndarray, average: float, length: int):
        self.ids = [i for i, _ in items]
        self.length = length
        self.parts, self.words = [], []
        found: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for n, (_, text) in enumerate(items):
            counts = Counter(numbers[w] for w in words_of(text))
            size = sum(counts.values())
            own = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * size / average)) for t, c in counts.items()}
            total = sum(own.values())
            for t, value in own.items():
                found[t].append((n, value / total))
            self.words.append([numbers[w] for w in words_of(text)])
            self.parts.append(tuple(shingles([numbers[w] for w in part], WIDTH) for part in question_and_answer(text)))
        self.lists = {t: ([n for n, _ in p], [v for _, v in p]) for t, p in found.items()}
        self.upper = np.zeros(len(numbers) + 1)
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for t, (places, values) in self.lists.items():
            self.upper[t] = max(values)
            most: dict[int, float] = {}
            for n, v in zip(places, values):
                most[n // BLOCK] = max(most.get(n // BLOCK, 0.0), v)
            self.blocks[t] = (np.array(list(most)), np.array(list(most.values())))
        self.n_blocks = (len(items) + BLOCK - 1) // BLOCK
        # The same maxima over at most ``AREAS`` areas of blocks, for all terms in one table; the last row is for other words.
        wide = (self.n_blocks + AREAS - 1) // AREAS
        # Only words of this class have a row. Bounds are rounded up to single precision.
        self.rows = np.full(len(numbers) + 1, len(self.blocks), dtype=np.int32)
        self.areas = np.zeros((len(self.blocks) + 1, (self.n_blocks + wide - 1) // wide), dtype=np.float32)
        for row, (t, (places, values)) in enumerate(self.blocks.items()):
            self.rows[t] = row
            np.maximum.at(self.areas[row], places // wide, np.nextafter(values.astype(np.float32), np.float32(np.inf)))

    def promising(self, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
        """(from, to) of the windows of a text that an area bound lets reach the threshold.

        A window is two neighbouring chunks of ``length`` words; its bound is the sum of the bounds of their distinct words.
        """
        terms = self.rows[terms]
        known, chunks = len(self.areas), max(1, -(-len(terms) // self.length))
        for first in range(0, chunks, CHUNKS):
            last = min(chunks, first + CHUNKS + 1)
            part = terms[first * self.length : last * self.length]
            keys = np.unique(np.arange(len(part)) // self.length * known + part)
            sums = np.concatenate((np.zeros((1, self.areas.shape[1])), np.cumsum(self.areas[keys % known], axis=0, dtype=np.float64)))
            edges = np.searchsorted(keys // known, np.arange(last - first + 1))
            bound = sums[edges[1:]] - sums[edges[:-1]]
            if len(bound) > 1:
                bound = bound[:-1] + bound[1:]
            for k in np.flatnonzero(bound.max(axis=1) >= threshold).tolist():
                start = (first + k) * self.length
                yield start, min(start + 2 * self.length, len(terms))
            if last == chunks:
                return

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that the distinct ``terms`` score at ``threshold`` or more, by block-max WAND."""
        held = [t for t in terms if t in self.lists]
        if not held:
            return []
        places, most = zip(*(self.blocks[t] for t in held))
        bound = np.bincount(np.concatenate(places), weights=np.concatenate(most), minlength=self.n_blocks)
        if bound.max() < threshold:
            return []
        # One cursor per term: [item it stands at, position, items, impacts, largest impact].
        cursors = [[self.lists[t][0][0], 0, *self.lists[t], float(self.upper[t])] for t in held]
        out = []

        def move(cursor: list, to: int) -> None:
            cursor[1] = bisect_left(cursor[2], to, cursor[1])
            cursor[0] = cursor[2][cursor[1]] if cursor[1] < len(cursor[2]) else len(self.ids)

        while True:
            cursors.sort(key=lambda c: c[0])
            reached, pivot = 0.0, -1
            for n, cursor in enumerate(cursors):
                reached += cursor[4]
                if reached >= threshold:
                    pivot = n
                    break
            if pivot < 0 or cursors[pivot][0] >= len(self.ids):
                return out
            item = cursors[pivot][0]
            if bound[item // BLOCK] < threshold:
                to = (item // BLOCK + 1) * BLOCK
                for cursor in cursors:
                    if cursor[0] < to:
                        move(cursor, to)
            elif cursors[0][0] == item:
                at = [c for c in cursors if c[0] == item]
                score = sum(c[3][c[1]] for c in at)
                if score >= threshold:
                    out.append((item, score))
                for cursor in at:
                    move(cursor, item + 1)
            else:
                for cursor in cursors[:pivot]:
                    if cursor[0] < item:
                        move(cursor, item)


class Index:
    """One shard of items: its vocabulary and the postings of each length class."""

    def __init__(self, items: list[tuple[int | None, str]], idf: dict[bytes, float], average: float, last: bool = True):
        self.last = last
        classes = defaultdict(list)
        # Items that share their commonest words stand together, in one language mostly: bounds of blocks are then tight.
        items = sorted(items, key=lambda item: sorted(set(words_of(item[1])), key=lambda w: (idf[w], w))[:3])
        for item in items:
            size = len(words_of(item[1]))
            if size:
                classes[max(LEAST_CLASS, 1 << (size - 1).bit_length())].append(item)
        self.numbers = {w: n for n, w in enumerate(sorted({w for _, t in items for w in words_of(t)}))}
        rates = np.array([idf[w] for w in self.numbers] or [0.0])
        self.classes = [Postings(own, self.numbers, rates, average, length) for length, own in sorted(classes.items())]

    def search(
        self, text: str | None, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER, whole: float = WHOLE
    ) -> list[dict]:
        """The verified items of a whole text, each with its best passage."""
        words = words_of(text)
        unknown = len(self.numbers)
        terms = np.array([self.numbers.get(w, unknown) for w in words], dtype=np.int64)
        best: dict[int, tuple] = {}
        for n, postings in enumerate(self.classes):
            for start, end in postings.promising(terms, threshold - 1e-6):
                own = terms[start:end].tolist()
                found = postings.retrieve([t for t in set(own) if t != unknown], threshold - 1e-9)
                by_width: dict[int, set] = {}

                def share(part: set) -> float:
                    width = len(next(iter(part))) if part else 0
                    if width not in by_width:
                        by_width[width] = shingles(own, width) if width else set()
                    return len(part & by_width[width]) / len(part) if part else 1.0

                for item, score in found:
                    shares = [share(part) for part in postings.parts[item]]
                    words = postings.words[item]
                    if (
                        (shares[0] >= question and shares[1] >= answer)
                        or share(shingles(words, WIDTH)) >= whole
                        or (len(words) >= WIDTH and edits(words, own) <= edits_allowed(len(words)))
                    ):
                        hit = (sum(shares), score, -start, shares, len(own))
                        if (n, item) not in best or hit[:3] > best[n, item][:3]:
                            best[n, item] = hit
        out = []
        for (n, item), (_, score, first, shares, size) in sorted(best.items()):
            out.append(dict(zip(HIT.names, (self.classes[n].ids[item], min(1.0, score), *shares, -first, size))))
        return out


def build(items: DataFrame, item_id: str = "item_id", text: str = "text", shard_items: int = SHARD_ITEMS) -> Iterator[Index]:
    """The shards of the index of ``items``, one at a time. Null and wordless items are left out, repeated rows count once."""
    rows = store(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text IS NOT NULL").distinct(), "test-items")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (body,) in in_rows(batches, "text"):
            words = words_of(body)
            own = sorted(set(words))
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([len(words)] + [0] * (len(own) - 1), pa.int64())], names=["word", "size"])

    counted = store(rows.select("text").mapInArrow(count, "word binary, size long").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "test-words")
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    size = counted.agg(F.sum("size")).first()[0] or 0
    total = totals["rows"]
    shards = max(1, math.ceil(total / shard_items), math.ceil((totals["bytes"] or 0) / SHARD_BYTES))
    average = max(1.0, size / max(1, total))
    for n in range(shards):
        # Texts of one shard only are gathered, so is the part of the vocabulary they hold.
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == n)
        texts = [(r["item_id"], r["text"]) for r in own.sort("item_id", "text").collect()]
        vocabulary = {w for _, t in texts for w in words_of(t)}
        if not vocabulary:
            continue
        mine = own.select("text").mapInArrow(count, "word binary, size long").select("word").distinct()
        idf = {bytes(r["word"]): math.log(1 + (total - r["n"] + 0.5) / (r["n"] + 0.5)) for r in counted.join(mine, "word", "left_semi").collect()}
        yield Index(texts, idf, average, last=n == shards - 1)


def with_hits(docs: DataFrame, index: Index, out: str = "hits", text: str = "text", shared: Broadcast | None = None) -> DataFrame:
    """Adds the verified items of every whole text as an array, empty for clean and for null texts.

    A column called ``out`` is replaced. ``shared`` is the index as it was broadcast, if the caller means to release it.
    """
    shared = shared or docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(T.ArrayType(HIT))
    def search(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.search(t.as_py()) for t in texts], _HITS)

    return docs.withColumn(out, search(F.col(text)))


def one_shard(docs: DataFrame, index: Index, result: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``result`` of the documents with their hits; unless the shard is the last one, stored and the broadcast released."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    found = result(with_hits(docs, index, "hits", shared=shared))
    if not index.last:
        found = store(found, "contamination")
        shared.destroy()
    return found


def leaks(docs: DataFrame, items: DataFrame, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per (doc_id, item_id) of a text that holds a test item, with its score, overlaps and best passage.

    Rows of ``docs`` that repeat give rows that repeat. No items or no texts give no rows.
    """
    found = None
    for index in build(items, shard_items=shard_items):
        part = one_shard(docs.select("doc_id", "text"), index, lambda hits: hits.select("doc_id", F.inline("hits")))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], T.StructType([docs.schema["doc_id"], *HIT.fields]))
    return found


def clean(docs: DataFrame, items: DataFrame, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """The rows of ``docs`` whose text holds no test item; other columns may have any name."""
    left, back = aside(docs, "text")
    for index in build(items, shard_items=shard_items):
        left = one_shard(left, index, lambda hits: hits.filter(F.size("hits") == 0).drop("hits"))
    return back(left)
