"""Removal of byte strings that occur more than once, by anchors chosen by content and grouped names.

Every window of ``least`` bytes has to be told apart from, or matched with, all others. Distributed prefix doubling shuffles a
row per byte and round, by estimate some forty times the input here (not measured). This is not that method: no pairs of position
and rank are sorted and nothing is reranked. Doubling is only how a task names overlapping strings; Spark groups by content, up
to four times, names of anchors, runs, cells and windows:

1. Names of 8, 16, 32, ... bytes are built from pairs inside a task. Among the positions in a window, that with the
   smallest name of ``k`` bytes is its anchor, so equal windows have equal anchors at equal distances. An anchor serves a
   run of neighbouring windows; there is one for about 70 bytes.
2. Spark counts anchors' names. Anchors with a unique name leave with all their windows.
3. The others are regrouped by the name of everything their run covers: equal runs are repeats. Where runs with one
   anchor's name differ, they are divided.
4. Divided runs go on as cells of a few windows, named by the bytes that all these windows share (unique: none of them
   repeats) and by all their bytes (repeated: all of them do), and what is left as single windows of ``least`` bytes.

Each round works on distinct strings with their number of places, so a passage copied into a third of all documents is one
row per round; what a round decides is joined back to the places. Names are two 64-bit numbers. A bitmap of fixed size
keeps rows that cannot matter out of the shuffles; the joins behind it are exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import aside, in_rows, store, text_key

LEAST = 200
POSITION_BITS = 20
SEGMENT = 1 << (POSITION_BITS - 1)
MAP_BITS = 1 << 26
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
KEY = ["_id", "_text"]
PLACES = [*KEY, "s0", "s1"]


class Sizes:
    """Lengths that follow from ``least``: cells of windows, names of ``block`` bytes and anchors of ``k``."""

    def __init__(self, least: int):
        if not 16 <= least < SEGMENT // 4:
            raise ValueError("the least length must lie between 16 and a quarter of a segment")
        self.least, self.cell = least, max(1, least // 12)
        self.block = 1 << ((least - self.cell + 1).bit_length() - 1)
        self.k = self.block // 2


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A name for pairs of names."""
    z = x * _A
    z ^= z >> np.uint64(32)
    z += y
    z *= _B
    z ^= z >> np.uint64(29)
    return z


def names_up_to(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """The names of all strings of 8, 16, ... ``length`` bytes, doubled from pairs; by length, an entry per position."""
    count = max(0, len(data) - 7)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    first = np.empty(count, dtype=np.uint64)
    for o in range(min(8, count)):
        own = first[o::8]
        own[:] = padded[o : o + 8 * len(own)].view("<u8")
    first *= _C
    first ^= first >> np.uint64(31)
    found, size = {8: first}, 8
    while size < length:
        now = found[size]
        found[2 * size] = mix(now[:-size], now[size:]) if len(now) > size else now[:0]
        size *= 2
    return found


def name_pairs(block: np.ndarray, size: int, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two-number names of strings of one to four blocks' length, from the names of four blocks that cover them."""
    rest = lengths - size
    a, b = block[starts], block[starts + rest // 3]
    c, d = block[starts + rest * 2 // 3], block[starts + rest]
    return mix(a, b), mix(c, d) + lengths.astype(np.uint64)


def anchors(data: np.ndarray, valid: np.ndarray, names: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of the runs of valid windows that share an anchor.

    The smallest name wins, of equals the first: a rule on the window's content alone.
    """
    span = sizes.least - sizes.k + 1
    order = (names >> np.uint64(POSITION_BITS + 1) << np.uint64(POSITION_BITS)).astype(np.int64) | np.arange(len(names))
    width = 1
    while 2 * width <= span:
        order = np.minimum(order[:-width], order[width:])
        width *= 2
    if width < span:
        order = np.minimum(order[: len(order) - (span - width)], order[span - width :])
    best = np.where(valid, order & ((1 << POSITION_BITS) - 1), -1)
    edges = np.flatnonzero(np.diff(best)) + 1
    first = np.concatenate(([0], edges))
    last = np.concatenate((edges, [len(best)])) - 1
    real = best[first] >= 0
    return best[first][real], first[real], last[real]


def segments(rows: Iterator[tuple], sizes: Sizes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts gathered into buffers: (bytes, valid window starts, id, text key and own start of each place's segment).

    A long text is cut into segments of window starts, each with the bytes that its last window needs.
    """
    parts, keys, held = [], [], 0

    def done():
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        owner = np.repeat(np.arange(len(parts)), lengths)
        where = np.arange(len(data))
        valid = (where + sizes.least <= ends[owner])[: max(0, len(data) - sizes.least + 1)]
        ids, texts, bases = (np.array(c, dtype=np.int64) for c in zip(*keys))
        return data, valid, ids[owner], texts[owner], where - (ends - lengths)[owner] + bases[owner]

    for row_id, row_text, text in rows:
        body = text.encode() if text else b""
        for at in range(0, len(body) - sizes.least + 1, SEGMENT):
            part = body[at : at + SEGMENT + sizes.least - 1]
            if held + len(part) >= 2 * SEGMENT:
                yield done()
                parts, keys, held = [], [], 0
            parts.append(part)
            keys.append((row_id, row_text, at))
            held += len(part)
            if held >= SEGMENT:
                yield done()
                parts, keys, held = [], [], 0
    if parts:
        yield done()


def bitmap(keys: DataFrame, column: str, bits: int = MAP_BITS) -> np.ndarray:
    """A bitmap of hashed values: a value whose bit is not set is not among them. ``bits`` / 8 bytes, whatever the table."""
    bit = F.col(column).bitwiseAND(bits - 1)
    words = keys.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _batch(names: Sequence[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=list(names))


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def anchor_names(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """The anchors' names, one row per anchor; copies inside a task come with their number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, valid, _, _, _ in segments(in_rows(batches, *KEY, "text"), sizes):
            names = names_up_to(data, sizes.k)[sizes.k]
            at, _, _ = anchors(data, valid, names, sizes)
            own, n = np.unique(names[at], return_counts=True)
            yield _batch(["name", "n"], own, n)

    return docs.mapInArrow(find, _longs("name", "n"))


def runs(docs: DataFrame, sizes: Sizes, repeated: np.ndarray) -> DataFrame:
    """The runs of windows whose anchor's name may occur again: names of the anchor (c) and the run (f), place and anchor."""
    columns = ["c", "f1", "f2", "n", *PLACES, "anchor"]
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, valid, ids, texts, own in segments(in_rows(batches, *KEY, "text"), sizes):
            names = names_up_to(data, sizes.block)
            at, first, last = anchors(data, valid, names[sizes.k], sizes)
            keep = may_hold(shared.value, names[sizes.k][at])
            at, first, last = at[keep], first[keep], last[keep]
            if not len(at):
                continue
            f1, f2 = name_pairs(names[sizes.block], sizes.block, first, last - first + sizes.least)
            # Equal bytes around differently placed anchors are no equal runs.
            f2 = mix(f2, (at - first).astype(np.uint64))
            yield _batch(columns, names[sizes.k][at], f1, f2, np.ones(len(at), dtype=np.int64), ids[first], texts[first], own[first], own[last], own[at])

    return docs.mapInArrow(find, _longs(*columns))


def settle(items: DataFrame, payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One round of regrouping. ``items``: a name c of what all their windows share, f1, f2 of all their bytes, places n.

    Items whose full name occurs again are done: all their windows repeat. Where items share c but not f1, f2, one item of
    each full name stays open, with the number of its places. All others are unique and leave. Unlike strings that
    happen to share c stay open for nothing; only equal f1, f2 count as equal.
    """
    full = ["c", "f1", "f2"]
    kinds = store(items.groupBy(*full).agg(F.sum("n").alias("n"), F.min(F.struct(*payload)).alias("at")), "repeats-kinds")
    done = items.join(kinds.filter("n > 1").select(*full), full, "left_semi")
    mixed = kinds.groupBy("c").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    still = kinds.join(mixed, "c", "left_semi").select("n", "at.*")
    return done.select(*PLACES), still


def spans_of(still: DataFrame, docs: DataFrame, sizes: Sizes) -> DataFrame:
    """The open runs with the bytes they cover, stored. Only texts that may hold one are moved."""
    per_text = still.groupBy(*KEY).agg(F.collect_list(F.struct("s0", "s1", "anchor", "n")).alias("runs"))
    wanted = bitmap(per_text.select(F.xxhash64(*KEY).alias("k")), "k")
    texts = maybe(docs, wanted).select(*KEY, "text").join(per_text, KEY)
    schema = T.StructType([*_longs(*PLACES, "anchor", "n").fields, T.StructField("bytes", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row_id, row_text, text, found in in_rows(batches, *KEY, "text", "runs"):
            body, first = text.encode(), [r["s0"] for r in found]
            last = [r["s1"] for r in found]
            many = len(found)
            columns = [[row_id] * many, [row_text] * many, first, last, [r["anchor"] for r in found], [r["n"] for r in found]]
            pieces = [body[a : b + sizes.least] for a, b in zip(first, last)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(pieces, pa.binary())], names=schema.names)

    # Equal rows of a table have one key; each run is wanted once.
    return store(texts.mapInArrow(cut, schema).dropDuplicates(PLACES), "repeats-spans")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with a ``bytes`` column in parts of bounded size: (part, all bytes, start of each row's bytes)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            pieces = part.column(part.schema.get_field_index("bytes")).to_pylist()
            lengths = np.array([len(p) for p in pieces], dtype=np.int64)
            yield part, np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum(lengths) - lengths


def _column(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(part.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The whole numbers from ``first`` to ``last`` of each row: (row, number)."""
    count = last - first + 1
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def cells(spans: DataFrame, sizes: Sizes) -> DataFrame:
    """Open runs divided into cells of neighbouring distances to the anchor."""
    columns = ["c", "f1", "f2", "n", *PLACES, "span"]

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offset in _spans(batches):
            s0, s1, anchor = (_column(part, c) for c in ("s0", "s1", "anchor"))
            names = names_up_to(data, sizes.block)
            row, cell = _spread((anchor - s1) // sizes.cell, (anchor - s0) // sizes.cell)
            near = np.maximum(cell * sizes.cell, (anchor - s1)[row])
            far = np.minimum(cell * sizes.cell + sizes.cell - 1, (anchor - s0)[row])
            first, last = anchor[row] - far, anchor[row] - near
            here = offset[row] - s0[row]
            core = anchor[row] - cell * sizes.cell
            c = mix(*name_pairs(names[sizes.block], sizes.block, here + core, np.full(len(row), sizes.least - sizes.cell + 1)))
            f1, f2 = name_pairs(names[sizes.block], sizes.block, here + first, last - first + sizes.least)
            f2 = mix(f2, (anchor[row] - first).astype(np.uint64))
            c = mix(c, cell.astype(np.uint64))
            n, ids, texts = (_column(part, c)[row] for c in ("n", *KEY))
            yield _batch(columns, c, f1, f2, n, ids, texts, first, last, s0[row])

    return store(spans.mapInArrow(divide, _longs(*columns)), "repeats-cells")


def windows(still: DataFrame, spans: DataFrame, sizes: Sizes) -> DataFrame:
    """The single windows of open cells that repeat."""
    columns = ["f1", "f2", "n", *KEY, "s0"]
    texts = spans.select(*KEY, F.col("s0").alias("span"), "bytes")
    joined = still.join(texts, [*KEY, "span"])

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offset in _spans(batches):
            names = names_up_to(data, sizes.block)
            row, at = _spread(_column(part, "s0"), _column(part, "s1"))
            f1, f2 = name_pairs(names[sizes.block], sizes.block, offset[row] + at - _column(part, "span")[row], np.full(len(row), sizes.least))
            n, ids, texts = (_column(part, c)[row] for c in ("n", *KEY))
            yield _batch(columns, f1, f2, n, ids, texts, at)

    found = store(joined.mapInArrow(divide, _longs(*columns)), "repeats-windows")
    again = found.groupBy("f1", "f2").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    return found.join(again, ["f1", "f2"], "left_semi").select(*KEY, "s0", F.col("s0").alias("s1"))


def repeated_windows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(_id, _text, s0, s1): for each row key the ranges of starts of ``least``-byte strings that also start elsewhere."""
    sizes = Sizes(least)
    keyed = docs.select(*text_key(), "text").filter(F.octet_length("text") >= least)
    names = anchor_names(keyed, sizes).groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1")
    items = store(runs(keyed, sizes, bitmap(names, "name")), "repeats-runs")
    done, still = settle(items, [*PLACES, "anchor"])
    spans = spans_of(still, keyed, sizes)
    done_cells, still_cells = settle(cells(spans, sizes), [*PLACES, "span"])
    return done.unionByName(done_cells).unionByName(windows(still_cells, spans, sizes))


def maybe(docs: DataFrame, bits: np.ndarray, outside: bool = False) -> DataFrame:
    """The rows whose key may be (``outside``: is certainly not) among those of the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf(T.BooleanType())
    def among(keys: pa.Array) -> pa.Array:
        return pa.array(may_hold(shared.value, keys.to_numpy(zero_copy_only=False)) != outside)

    return docs.filter(among(F.xxhash64(*KEY)))


CUT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])


def merged(starts: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes [from, to) that windows with these first and last starts cover."""
    out: list[list[int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + least)
        else:
            out.append([a, b + least])
    return [(a, b) for a, b in out]


def whole(spans: list[tuple[int, int]], body: bytes) -> list[tuple[int, int]]:
    """Spans widened to whole UTF-8 characters; those that then touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        while a > 0 and body[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(body) and body[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            a, _ = out.pop()
        out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, least: int = LEAST, whole_characters: bool = False) -> DataFrame:
    """``docs`` (doc_id, text and any others) with a column ``_cut``: kept (bytes), n_removed and n_spans.

    Every byte is removed that lies in a string of ``least`` bytes which starts at another place too, in the same text or
    any other; repeated rows count as other places. With ``whole_characters`` the rest of a character that loses a byte goes
    too. Null texts are empty. Texts that lose nothing are not moved. Other columns may have any name; one called ``_cut`` is
    replaced.
    """
    docs, back = aside(docs, "doc_id", "text")
    found = store(repeated_windows(docs, least), "repeats-found")
    per_text = found.groupBy(*KEY).agg(F.collect_set(F.struct("s0", "s1")).alias("_starts"))
    wanted = bitmap(per_text.select(F.xxhash64(*KEY).alias("k")), "k")
    keyed = docs.withColumns({c: e for c, e in zip(KEY, text_key())})

    @F.arrow_udf(CUT)
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for text, places in zip(texts, starts):
            body, at, kept, removed = (text.as_py() or "").encode(), 0, [], 0
            spans = merged([(p["s0"], p["s1"]) for p in places.as_py() or []], least)
            if whole_characters:
                spans = whole(spans, body)
            for a, b in spans:
                kept.append(body[at:a])
                removed, at = removed + b - a, b
            kept.append(body[at:])
            out.append({"kept": b"".join(kept), "n_removed": removed, "n_spans": len(spans)})
        return pa.array(out, pa.struct([("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]))

    touched = maybe(keyed, wanted)
    some = touched.join(per_text, KEY, "left").withColumn("_cut", cut("text", "_starts")).select(*docs.columns, "_cut")
    zero = F.lit(0).cast("long")
    intact = F.struct(F.coalesce("text", F.lit("")).cast("binary").alias("kept"), zero.alias("n_removed"), zero.alias("n_spans"))
    others = maybe(keyed, wanted, outside=True).withColumn("_cut", intact).select(*docs.columns, "_cut")
    return back(some.unionByName(others), "_cut")
