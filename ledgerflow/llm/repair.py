"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

A row is reduced to one symbol: the first letter of its role, whether its text breaks off, or that it must go (blank, or said
before). Edits keep a row, change its role, delete it or insert an empty row. What a row may do to the grammar's four states
is a matrix of (cost, audit) in the algebra of minimum and plus; a conversation is the product of its rows' matrices. Of equal
costs the audit that sorts first counts; none of them begins with another one, since a further insertion costs more, so
choosing early is choosing right.

Sequences share their work by Re-Pair: the pair of symbols that stands most often in all sequences of a batch becomes a rule,
until no pair is worth one. Each rule's matrix is the product of two others, evaluated once, bottom-up; audits are ropes that
share their parts. What is left of each sequence is multiplied last. Equal sequences are evaluated once.

How the work is spread: rows that repeat are counted before they move. Rows are then range partitioned by conversation and
turn, so that a conversation of any length spreads over many tasks, and what was said in an earlier turn is found by grouping
hashes (MD5), not texts; its marks are sorted in front of the rows they belong to. Each task writes chunks of at most
``CHUNK_ROWS`` rows and ``CHUNK_BYTES`` of text; a chunk's matrix holds whatever comes before it. A conversation that one chunk
holds is finished in the task that reads it. Of the others the matrices are multiplied in order and the texts pass by in
order, streamed: an audit and a SHA-256 for a conversation cannot be cut up, so this step meets all chunks of a conversation
in one task, but holds one chunk and at most four audits, of a byte for each row, at a time.

Nulls count as one blank, wherever they stand; a null ``conv_id`` is a conversation of its own and stays null in the result.
Rows of equal turn are ordered by role, then by the text's MD5, so rows that repeat stand next to each other. An empty role has
no initial. Texts are used whole. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerflow.llm.common import in_rows, store

CHUNK_ROWS, CHUNK_BYTES = 4096, 4 << 20
# A batch of sequences shares one grammar.
BATCH_SYMBOLS = 1 << 18
RULES_PER_SYMBOL = 1000
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
# Fixed: white space is \x20 and \x09 to \x0D, sentences end in one of these.
BLANKS, ENDS = "\t\n\x0b\x0c\r ", ".!?"

# States of the grammar: nothing yet, after s, after u, after a. Steps by role initial.
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
FINAL = (0, 3)
GONE = ord("x")

CHUNK = T.StructType(
    [
        T.StructField("conv", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("symbols", T.BinaryType()),
        T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("first_turn", T.LongType()),
        T.StructField("last_turn", T.LongType()),
        T.StructField("turns", T.LongType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
    ]
)
ROW = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
ANSWER = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("gaps", T.LongType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ]
)

# ---- ropes: "" or one letter, or (left, right, length). Parts are shared, never changed.


def length(rope) -> int:
    return rope[2] if type(rope) is tuple else len(rope)


def joined(left, right):
    if left == "":
        return right
    return left if right == "" else (left, right, length(left) + length(right))


def letters(rope) -> str:
    out, stack = [], [rope]
    while stack:
        top = stack.pop()
        if type(top) is tuple:
            stack += (top[1], top[0])
        else:
            out.append(top)
    return "".join(out)


def before(a, b) -> bool:
    """Whether rope ``a`` sorts before rope ``b``; parts that are the same object are passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        n, m = length(x), length(y)
        if type(x) is tuple and (n >= m or type(y) is not tuple):
            left += (x[1], x[0])
            right.append(y)
        elif type(y) is tuple:
            right += (y[1], y[0])
            left.append(x)
        elif x == y:
            continue
        elif len(x) == len(y):
            return x < y
        else:
            k = min(n, m)
            if x[:k] != y[:k]:
                return x[:k] < y[:k]
            if n > k:
                left.append(x[k:])
            elif m > k:
                right.append(y[k:])
    return bool([r for r in right if length(r)]) and not [r for r in left if length(r)]


# ---- matrices: {(from, to): (cost, rope)}


def better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and before(new[1], old[1]))


def times(a: dict, b: dict) -> dict:
    """The product: the cheapest way through any state between, the audit that sorts first of equal ones."""
    out: dict = {}
    for (i, k), (cost, rope) in a.items():
        for (k2, j), (more, rest) in b.items():
            if k2 != k:
                continue
            old = out.get((i, j))
            if old is None or cost + more <= old[0]:
                new = (cost + more, joined(rope, rest))
                if better(new, old):
                    out[i, j] = new
    return out


def insertions() -> dict:
    """What inserted rows alone can do; the cheapest way never comes back to a state."""
    one = {step: (INSERT, "I") for role in "ua" for step in STEPS[role]}
    all_ways = {(s, s): (0, "") for s in range(4)}
    for _ in range(3):
        found = times(all_ways, one)
        all_ways = all_ways | {k: v for k, v in found.items() if better(v, all_ways.get(k))}
    return all_ways


INSERTIONS = insertions()


def symbol_matrix(symbol: int) -> dict:
    """One row, followed by any insertions."""
    found = {(s, s): (DELETE, "D") for s in range(4)}
    if symbol != GONE:
        name = chr(symbol)
        more = TRUNCATED if name.isupper() else 0
        ways = [(step, (REROLE + more, "R")) for role in "ua" for step in STEPS[role]]
        ways += [(step, (KEEP + more, "K")) for step in STEPS.get(name.lower(), ())]
        for step, way in ways:
            if better(way, found.get(step)):
                found[step] = way
    return times(found, INSERTIONS)


def grammar(sequences: list[bytes]) -> tuple[list[np.ndarray], dict[int, tuple[int, int]]]:
    """Re-Pair over all sequences at once: what is left of them and the rules, each one of older symbols.

    A rule spares a product for each of its places and costs a pass over the symbols, so pairs that stand less often than once
    in ``RULES_PER_SYMBOL`` symbols get none.
    """
    line = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64), -1) for s in sequences])
    rules: dict[int, tuple[int, int]] = {}
    fresh = 256
    while len(line) > 1:
        inner = (line[:-1] >= 0) & (line[1:] >= 0)
        pairs, counts = np.unique(line[:-1][inner] * (1 << 31) + line[1:][inner], return_counts=True)
        if not len(pairs) or counts.max() < max(2, len(line) // RULES_PER_SYMBOL):
            break
        pair = int(pairs[counts.argmax()])
        a, b = pair >> 31, pair & ((1 << 31) - 1)
        at = np.flatnonzero((line[:-1] == a) & (line[1:] == b))
        if a == b:  # of a run of equal symbols every second place counts
            starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            run = np.repeat(at[starts], np.diff(np.append(starts, len(at))))
            at = at[(at - run) % 2 == 0]
        rules[fresh] = (a, b)
        line[at] = fresh
        line = np.delete(line, at + 1)
        fresh += 1
    ends = np.flatnonzero(line == -1)
    return [line[a:b] for a, b in zip(np.append(0, ends[:-1] + 1), ends)], rules


def matrices(sequences: Iterable[bytes]) -> dict[bytes, dict]:
    """The matrix of each distinct sequence; an empty one changes nothing."""
    distinct = list(dict.fromkeys(sequences))
    if not distinct:
        return {}
    left, rules = grammar(distinct)
    known = {int(s): symbol_matrix(int(s)) for s in np.unique(np.frombuffer(b"".join(distinct), np.uint8))}
    for name, (a, b) in rules.items():  # rules name older symbols only
        known[name] = times(known[a], known[b])
    out = {}
    for sequence, rest in zip(distinct, left):
        found = {(s, s): (0, "") for s in range(4)}
        for n, symbol in enumerate(rest.tolist()):
            found = known[symbol] if n == 0 else times(found, known[symbol])
        out[sequence] = found
    return out


class Way:
    """The cheapest ways from the start to each state over the chunks so far, audits as chains of the chunks' audits."""

    def __init__(self):
        self.best = {j: (cost, (None, letters(rope))) for (i, j), (cost, rope) in INSERTIONS.items() if i == 0}

    @staticmethod
    def first(a: tuple, b: tuple) -> bool:
        """Whether chain ``a`` sorts before chain ``b``, both over the same chunks."""
        ours, theirs = [], []
        while a is not b and a is not None:
            ours.append(a[1])
            theirs.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(ours)) < "".join(reversed(theirs))

    def pass_chunk(self, matrix: dict) -> None:
        best: dict = {}
        for (i, j), (more, text) in matrix.items():
            if i not in self.best:
                continue
            cost, chain = self.best[i]
            new = (cost + more, (chain, text))
            old = best.get(j)
            if old is None or new[0] < old[0] or (new[0] == old[0] and self.first(new[1], old[1])):
                best[j] = new
        self.best = best

    def end(self) -> tuple[int, str]:
        found = []
        for state in FINAL:
            if state in self.best:
                cost, chain = self.best[state]
                parts = []
                while chain is not None:
                    parts.append(chain[1])
                    chain = chain[0]
                found.append((cost, "".join(reversed(parts))))
        return min(found)


# ---- Spark


def prepared(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) with blanks for nulls; ``copies`` 0 marks a row that only names its conversation."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"),
        blank("text").alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Prepared rows with known damage, chosen by the checksum of ``conv:turn``: for tests and measurements."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    marked = rows.withColumn("fate", F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20)
    fate = F.col("fate")
    text = F.when(fate == 0, None).when(fate == 1, F.lit("")).when(fate == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(fate == 0, None).when(fate == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(fate == 0, 0).when(fate == 3, F.col("copies") * 2).otherwise(F.col("copies"))
    return marked.select("conv", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct prepared rows with their number, in order within and across partitions.

    A row that only marks that its role and text were said in an earlier turn (``kind`` 0) stands in front of the row it marks.
    """
    keys = ["conv", "turn", "role", "hash"]
    narrow = rows.filter("copies > 0").select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("hash"))
    turn = F.struct("turn")
    said = narrow.groupBy("conv", "role", "hash").agg(F.min(turn).alias("first"), F.max(turn).alias("last")).filter(F.col("first") != F.col("last"))
    said = said.select(*(F.col(c).alias(f"said_{c}") for c in ("conv", "role", "hash")), "first")
    same = F.col("conv").eqNullSafe(F.col("said_conv")) & (F.col("role") == F.col("said_role")) & (F.col("hash") == F.col("said_hash"))
    marks = narrow.distinct().join(said, same).filter(turn > F.col("first"))
    marks = marks.select(*keys, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    own = counted.select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("hash"), F.lit(1).alias("kind"), "text", "copies")
    by = [F.asc_nulls_first(c) for c in keys]
    # Equal keys stay together, so a mark and its row are never parted.
    return marks.unionByName(own).repartitionByRange(*by).sortWithinPartitions(*by, "kind")


def symbol_of(role: str, text: str, again: bool) -> tuple[int, str]:
    """(symbol, first fault) of a row."""
    body = text.rstrip(BLANKS)
    if not body:
        return GONE, "blank"
    if again:
        return GONE, "duplicate"
    name = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (ord(name), "") if body[-1] in ENDS else (ord(name.upper()), "truncated")


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def table(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), to_arrow_schema(schema).types)], names=schema.names)


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Stretches of conversations, bounded in rows and bytes; ``whole`` ones are all there is of a conversation.

    Rows that must go carry no text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ready, ready_bytes = [], 0
        # Of the first and the last conversation of a partition more may stand in its neighbours.
        own, size, now, began, cut_up = [], 0, None, True, False

        def done(whole: bool) -> tuple:
            symbols, faults, roles, texts, found = zip(*own) if own else ((), (), (), (), ())
            real = [n for n, s in enumerate(symbols) if s is not None]
            turns = sorted({found[n] for n in real} - {None})
            return (
                now,
                part,
                seq,
                whole,
                bytes(symbols[n] for n in real),
                [roles[n] for n in real],
                [texts[n] for n in real],
                turns[0] if turns else None,
                turns[-1] if turns else None,
                len(turns),
                *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                illegal_pairs([roles[n][:1] for n in real]),
            )

        marked = None
        for conv, turn, role, key, kind, text, copies in in_rows(batches, "conv", "turn", "role", "hash", "kind", "text", "copies"):
            if kind == 0:
                marked = (conv, turn, role, key)
                continue
            if own and now != conv:
                ready.append(done(not began and not cut_up))
                seq, ready_bytes, own, size, began, cut_up = seq + 1, ready_bytes + size, [], 0, False, False
            now = conv
            if copies == 0:
                own.append((None, "", None, None, None))
                continue
            symbol, fault = symbol_of(role, text, marked == (conv, turn, role, key))
            repeated = (GONE, "blank" if fault == "blank" else "duplicate", role, None, turn)
            for n in range(copies):
                if len(own) >= chunk_rows or size >= chunk_bytes:
                    ready.append(done(False))
                    seq, ready_bytes, own, size, cut_up = seq + 1, ready_bytes + size, [], 0, True
                own.append(repeated if n else (symbol, fault, role, None if symbol == GONE else text, turn))
                size += 64 + (len(text) if n == 0 and symbol != GONE else 0)
                if ready_bytes >= chunk_bytes or len(ready) >= 4096:
                    yield table(ready, CHUNK)
                    ready, ready_bytes = [], 0
        if own:
            ready.append(done(False))
        if ready:
            yield table(ready, CHUNK)

    return store(rows.mapInArrow(cut, CHUNK), "chunks", "zstd")


class Repaired:
    """Applies an audit to rows as they pass by; what comes out is hashed, and kept as rows if asked for."""

    def __init__(self, audit: str, keep: bool = False):
        self.audit, self.at, self.state = audit, 0, 0
        self.hash, self.position = hashlib.sha256(), 0
        self.rows: list[tuple] | None = [] if keep else None

    def out(self, edit: str, initial: str, role: str, text: str) -> None:
        self.hash.update(("\n" if self.position else "").encode() + f"{role}:{text}".encode())
        if self.rows is not None:
            self.rows.append((self.position, edit, role, text))
        self.position += 1
        self.state = dict(STEPS[initial])[self.state]

    def due(self) -> tuple[str, str]:
        """What a row that is put in or changes its role becomes here."""
        return ("a", "assistant") if self.state == 2 else ("u", "user")

    def insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.out("I", *self.due(), "")
            self.at += 1

    def row(self, role: str, text: str | None) -> None:
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.out("K", role[0], role, text)
        elif edit == "R":
            self.out("R", *self.due(), text)

    def digest(self) -> str:
        return self.hash.hexdigest()


class Conversation:
    """What is known of a conversation while its chunks pass by: all matrices first, then all rows."""

    def __init__(self, conv: int | None, keep: bool):
        self.conv, self.keep = conv, keep
        self.way, self.repaired = Way(), None
        self.low = self.high = self.tail = None
        self.turns, self.counts = 0, [0, 0, 0, 0]

    def read(self, roles: list, texts: list, first: int | None, last: int | None, turns: int, *counts: int) -> None:
        if self.repaired is None:
            self.cost, audit = self.way.end()
            self.repaired = Repaired(audit, self.keep)
        for role, text in zip(roles, texts):
            self.repaired.row(role, text)
        if first is not None:
            self.turns += turns - (self.high == first)
            self.low, self.high = (first if self.low is None else self.low), last
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        if roles:
            if self.tail is not None:
                self.counts[3] += illegal_pairs([self.tail, roles[0][:1]])
            self.tail = roles[-1][:1]

    def taken(self) -> list[tuple]:
        """The rows that came out since the last call."""
        out, self.repaired.rows = [(self.conv, *r) for r in self.repaired.rows], []
        return out

    def answer(self) -> tuple:
        self.repaired.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts, self.cost, self.repaired.audit, self.repaired.digest())


FIGURES = ("roles", "texts", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")


def batches_of(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    ready, size = [], 0
    for row in rows:
        ready.append(row)
        size += 128 + sum(len(v) for v in row if isinstance(v, str))
        if size >= CHUNK_BYTES:
            yield table(ready, schema)
            ready, size = [], 0
    if ready:
        yield table(ready, schema)


def grouped(rows: Iterator[tuple], symbols: int) -> Iterator[list[tuple]]:
    """Rows in batches that share a grammar; the first value of a row are its symbols."""
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += len(row[0]) + 1
        if size >= BATCH_SYMBOLS:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


def solved(found: DataFrame, keep: bool) -> DataFrame:
    """The result of chunks that hold whole conversations; nothing moves."""
    schema = ROW if keep else ANSWER

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in grouped(in_rows(batches, "symbols", "conv", *FIGURES), BATCH_SYMBOLS):
                known = {}
                for sequence, matrix in matrices(r[0] for r in batch).items():
                    known[sequence] = {k: (cost, letters(rope)) for k, (cost, rope) in matrix.items()}
                for sequence, conv, *figures in batch:
                    own = Conversation(conv, keep)
                    own.way.pass_chunk(known[sequence])
                    own.read(*figures)
                    answer = own.answer()
                    yield from own.taken() if keep else (answer,)

        yield from batches_of(rows(), schema)

    return found.select("symbols", "conv", *FIGURES).mapInArrow(work, schema)


def chunk_matrices(found: DataFrame) -> DataFrame:
    """(conv, part, seq, costs, audits): the matrix of each chunk, 16 entries by state from and to, null where there is no way."""
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("conv", "part", "seq")]
        + [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(in_rows(batches, "symbols", "conv", "part", "seq"), BATCH_SYMBOLS):
            known = {}
            for sequence, matrix in matrices(r[0] for r in batch).items():
                entries = [matrix.get((i, j)) for i in range(4) for j in range(4)]
                known[sequence] = ([e and e[0] for e in entries], [letters(e[1]) if e else None for e in entries])
            yield from batches_of(((*r[1:], *known[r[0]]) for r in batch), schema)

    return found.select("conv", "part", "seq", "symbols").mapInArrow(work, schema)


def streamed(found: DataFrame, keep: bool) -> DataFrame:
    """The result of conversations of many chunks: matrices first, then rows, both in order."""
    schema = ROW if keep else ANSWER
    types = {f.name: f.dataType for f in CHUNK.fields}
    none = F.lit(None)
    first = chunk_matrices(found).select(
        "conv", F.lit(0).alias("kind"), "part", "seq", "costs", "audits", *(none.cast(types[c]).alias(c) for c in FIGURES)
    )
    second = found.select(
        "conv", F.lit(1).alias("kind"), "part", "seq", none.cast("array<bigint>").alias("costs"), none.cast("array<string>").alias("audits"), *FIGURES
    )
    both = first.unionByName(second).repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "kind", "part", "seq")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, own in groupby(in_rows(batches, "conv", "kind", "costs", "audits", *FIGURES), key=lambda r: r[0]):
                now = Conversation(conv, keep)
                for _, kind, costs, audits, *figures in own:
                    if kind == 0:
                        now.way.pass_chunk({(n // 4, n % 4): (c, a) for n, (c, a) in enumerate(zip(costs, audits)) if c is not None})
                        continue
                    now.read(*figures)
                    if keep:
                        yield from now.taken()
                answer = now.answer()
                yield from now.taken() if keep else (answer,)

        yield from batches_of(rows(), schema)

    return both.mapInArrow(work, schema)


def solve(rows: DataFrame, keep: bool, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    found = chunks(ordered(rows), chunk_rows, chunk_bytes)
    return solved(found.filter("whole"), keep).unionByName(streamed(found.filter("NOT whole"), keep))


def audits(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``prepared`` rows: faults, cost, audit and the SHA-256 of its repaired ``role:text`` lines.

    ``audit`` has one letter per edit: K keep, R change the role, D delete, I insert.
    """
    return solve(rows, False, chunk_rows, chunk_bytes)


def repaired(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The repaired conversations of ``prepared`` rows: (conv_id, position, edit, role, text), one row per row that is left."""
    return solve(rows, True, chunk_rows, chunk_bytes)
