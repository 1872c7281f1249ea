"""Packing documents into token sequences of a fixed length by patterns fitted to the length histogram.

Texts become token ids, documents longer than a sequence are cut into full pieces and one remainder. What is left to pack
is a histogram of at most ``capacity`` lengths. Patterns of up to three lengths that fill a sequence exactly are enumerated;
how often to repeat each is fitted to the histogram by non-negative least squares. The repeat counts are rounded and
clipped to what is there, and the residual is packed best-fit decreasing, whole runs of equal lengths at a time. All of that works on the histogram, whatever the number of documents.

Pieces then find their places in parallel: each is numbered among the pieces of its length (per task, shifted by the
counts of earlier tasks) and the number falls into a run of one pattern. No task sorts a length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import in_rows, store

CAPACITY = 1024
END = 2
MOST_CACHED = 300_000
LONG_CHUNK = 48
ROUNDS = 600
SPARE = (1e-4, 1e-3)
SHARES = (1.0, 0.95, 0.8, 0.6, 0.4, 0.2, 0.1)  # of the fitted counts to use; a residual like the whole packs better than a lopsided one
FLUSH = 4 << 20
# Fixed value: the pattern by which byte-level BPE files without one of their own cut a text.
WORDS_AND_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ]
)
PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


class Encoder:
    """Ids of a byte-level BPE tokenizer file as little-endian unsigned 32-bit bytes; special tokens in a text are plain text.

    Its pre-tokenizer never joins what stands on both sides of a single space into one token, and the space goes with what
    follows. So a text is cut at such spaces, and a word met before is looked up. A space between other white space is
    no such place. New words are encoded one by one: where the vocabulary is numbered in merge order, as checked here, by a
    table of ranks taken from the same file, which costs a tenth of a call to the tokenizer for a word.
    """

    _isolated = re.compile(r"(?<=\S) (?=\S)")
    _tangled = re.compile(r"\s \s")
    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.ranked = self._by_rank(path)

    @staticmethod
    def _by_rank(path: str):
        """The same tokenizer as a table of ranks; None when the file is of another kind."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if model["type"] != "BPE" or not plain or spec.get("normalizer"):
            return None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merged = [model["vocab"][a + b] for a, b in pairs]
        byte_of = {c: n for n, c in enumerate(byte_letters())}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in word): n for word, n in model["vocab"].items() if word not in special}
        if merged != sorted(merged) or len(ranks) != 256 + len(merged) or (merged and max(ranks[bytes([i])] for i in range(256)) > merged[0]):
            return None
        return tiktoken.Encoding("file", pat_str=WORDS_AND_SPACES, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per worker and file."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _encode(self, chunk: str) -> bytes:
        if self.ranked is not None:
            return array("I", self.ranked.encode_ordinary(chunk)).tobytes()
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        pieces = self._isolated.split(text) if self._tangled.search(text) else text.split(" ")
        first, known = pieces.pop(0), self.known
        found = list(map(known.get, pieces))
        if None in found:
            got = {p: self._encode(" " + p) for p in set(pieces) if p not in known}
            found = [got[p] if b is None else b for p, b in zip(pieces, found)]
            if len(known) + len(got) > MOST_CACHED:
                known.clear()
            known.update((p, b) for p, b in got.items() if len(p) <= LONG_CHUNK)
        return (self._encode(first) if first else b"") + b"".join(found)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    rest = iter(range(256, 512))
    return [chr(n) if n in prints else chr(next(rest)) for n in range(256)]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: all are full but the first."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text; null is empty), stored. A text is encoded whole, then ``end`` follows."""
    closing = np.array([end], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, counts = Encoder.of(tokenizer), TaskContext.get().partitionId(), Counter()
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=PIECES.names)

        for doc_id, text in in_rows(batches, "doc_id", "text"):
            ids = encoder.ids(text or "") + closing
            for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                own = ids[4 * start : 4 * (start + length)]
                rows.append((doc_id, n, start, length, own, zlib.crc32(own), part, counts[length]))
                counts[length] += 1
                held += len(own)
                if held >= FLUSH:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return store(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES), "pieces", "zstd")


@dataclass(frozen=True)
class Run:
    """``count`` sequences that all hold pieces of these lengths."""

    lengths: tuple[int, ...]
    count: int


def patterns(present: np.ndarray, capacity: int) -> np.ndarray:
    """All triples of present lengths, largest first, that sum up to ``capacity``; 0 stands for no piece."""
    lengths = np.concatenate(([0], present[present <= capacity]))
    has = np.zeros(capacity + 1, dtype=bool)
    has[lengths] = True
    a, b = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
    c = capacity - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    fits = has[c]
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def fit(triples: np.ndarray, histogram: np.ndarray, spare: float = 0.0, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts of the patterns whose lengths come closest to the histogram in weighted squares.

    ``spare`` charges patterns of three pieces, which use up the short ones that the residual needs to fill gaps.
    Accelerated projected gradient; the columns hold at most three lengths each, so a round is a few sums over the patterns.
    """
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0.0

    def lengths_of(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(k, weights=x, minlength=size) for k in triples.T)
        out[0] = 0.0
        return out

    # A length in few patterns, as the long ones are, counts the more; with these weights no eigenvalue exceeds 3.
    weight = 1.0 / np.maximum(lengths_of(np.ones(len(triples))), 1.0)
    weight[0] = 0.0
    charge = spare * target.max() * (triples[:, 2] > 0)
    x = ahead = np.zeros(len(triples))
    pace = 1.0
    for _ in range(rounds):
        slope = weight * (lengths_of(ahead) - target)
        nearer = np.maximum(ahead - (slope[triples[:, 0]] + slope[triples[:, 1]] + slope[triples[:, 2]] + charge) / 3, 0.0)
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, x, pace = nearer + (pace - 1) / following * (nearer - x), nearer, following
    return x


def rounded(counts: np.ndarray) -> np.ndarray:
    """Whole counts whose running sums stay within one of those of ``counts``; the patterns stand in order of length."""
    return np.diff(np.floor(np.cumsum(counts) + 0.5), prepend=0.0).astype(np.int64)


def best_fit(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing on a histogram: each length goes into the fullest open sequences it fits, many at a time."""
    open_at: dict[int, list[Run]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r, runs in open_at.items() if r >= length and runs), default=0)
            if not room:
                each = min(capacity // length, left)
                fresh, left = left // each, left % each
                open_at[capacity - each * length].append(Run((length,) * each, fresh))
                continue
            run = open_at[room].pop()
            each = min(room // length, left)
            used = min(run.count, left // each)
            if used < run.count:
                open_at[room].append(Run(run.lengths, run.count - used))
            open_at[room - each * length].append(Run(run.lengths + (length,) * each, used))
            left -= used * each
    return [run for runs in open_at.values() for run in runs]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Sequences for all pieces of a histogram of lengths: the fewest that any of ``SPARE`` and ``SHARES`` gives."""
    left = {k: v for k, v in histogram.items() if v}
    full = [Run((capacity,), left.pop(capacity))] if capacity in left else []
    triples = patterns(np.array(sorted(left), dtype=np.int64), capacity)
    if not len(triples):
        return full + best_fit(left, capacity)
    dense = np.zeros(capacity + 1)
    dense[list(left)] = list(left.values())
    fits = [fit(triples, dense, spare) for spare in SPARE]
    found = [by_patterns(triples, rounded(counts * share), left, capacity) for counts in fits for share in SHARES]
    return full + min(found, key=lambda runs: sum(r.count for r in runs))


def by_patterns(triples: np.ndarray, counts: np.ndarray, histogram: dict[int, int], capacity: int) -> list[Run]:
    """The patterns as often as ``counts`` says and the pieces last, then the residual by best fit."""
    left, runs = dict(histogram), []
    for at in np.flatnonzero(counts).tolist():
        need = Counter(k for k in triples[at].tolist() if k)
        times = min(int(counts[at]), min(left[k] // n for k, n in need.items()))
        if times:
            runs.append(Run(tuple(sorted(need.elements(), reverse=True)), times))
            for k, n in need.items():
                left[k] -= n * times
    return runs + best_fit({k: v for k, v in left.items() if v}, capacity)


def slots(runs: list[Run]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length (first number, first sequence, how many per sequence, first offset) of the runs that hold it."""
    found, used, sequence = defaultdict(list), Counter(), 0
    for run in runs:
        at = 0
        for length, each in Counter(run.lengths).items():
            found[length].append((used[length], sequence, each, at))
            used[length] += each * run.count
            at += each * length
        sequence += run.count
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in found.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    Null and empty texts are one id long. Repeated rows are packed as often as they occur. An empty table gives no rows.
    """
    cut_up = pieces(docs, tokenizer, capacity, end)
    counts = store(cut_up.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, capacity))

    @F.arrow_udf(PLACE)
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        size, rank = lengths.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        for length in np.unique(size).tolist():
            own = np.flatnonzero(size == length)
            first, base, each, at = table[length]
            run = np.searchsorted(first, rank[own], side="right") - 1
            k = rank[own] - first[run]
            sequence[own] = base[run] + k // each[run]
            offset[own] = at[run] + k % each[run] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=PLACE.names)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = cut_up.join(starts, ["part", "length"]).withColumn("_at", place("length", F.col("_before") + F.col("nth")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "_at.sequence_id", "_at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences; each holds ``capacity`` ids at most."""
    entry = F.struct("offset", "ids")
    joined = F.aggregate(F.sort_array(F.collect_list(entry)), F.lit(b""), lambda a, e: F.concat(a, e["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
