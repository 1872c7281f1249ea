import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerflow.llm import repair

WHITE = "\t\n\x0b\x0c\r "
TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("conv", T.StringType()),
        T.StructField("copies", T.StringType()),
    ]
)


def plain_damage(rows):
    """conversation -> rows (turn, role, text) after damage."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fate == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if fate == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults, every=False):
    """(cost, audit, repaired lines) by a search over all edits in order of (cost, audit so far); ``every`` way, or the first to a place."""
    ahead = {0: "su", 1: "u", 2: "a", 3: "u"}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, 0, ())], set()
    best = None
    while queue:
        cost, audit, at, state, lines = heapq.heappop(queue)
        if best and cost > best[0]:
            break
        if (at, state) in done and not every:
            continue
        done.add((at, state))
        if at == len(rows) and state in (0, 3) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, lines)
        for initial in ahead[state]:
            if initial in names:
                heapq.heappush(queue, (cost + 5, audit + "I", at, step[state, initial], (*lines, names[initial] + ":")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state, lines))
            if faults[at] in ("", "truncated"):
                more = 5 * (faults[at] == "truncated")
                if role[:1] and role[:1] in ahead[state]:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, step[state, role[:1]], (*lines, f"{role}:{text}")))
                for initial in ahead[state]:
                    if initial in names:
                        heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, step[state, initial], (*lines, f"{names[initial]}:{text}")))
    return best


def plain(rows):
    """Everything op11 returns, by conversation."""
    out = {}
    for conv, own in plain_damage(rows).items():
        faults = faults_of(own)
        cost, audit, lines = cheapest(own, faults)
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def made_up(seed, conversations=60, longest=12):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
    texts = ["yes.", "no", "", " ", None, "why? ", "é!\n", "ok.", "a b c", "\x0b", " ", "x." * 50]
    out = []
    for conv in [*range(conversations), None]:
        for _ in range(draw.randint(1, longest)):
            role = draw.choice(roles[:2]) if draw.random() < 0.6 else draw.choice(roles)
            out.append((conv, draw.choice([None, *range(15)]), role, draw.choice(texts)))
    out += out[:5]  # rows that repeat
    out += [(7, 3, "user", "again.")] * 40
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "n") for r in rows], TURNS)


def as_found(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suao"), st.sampled_from(["x", "y.", ""])), max_size=9), st.integers(1, 4))
def test_matrices_against_search(own, cut):
    rows = [(n, {"o": "tool", "s": "sys", "u": "user", "a": "assistant"}[r], t + (f"{n}." if t == "y." else f" {n}" if t else "")) for n, (r, t) in enumerate(own)]
    faults = faults_of(rows)
    symbols = bytes(repair.symbol_of(r, t, False)[0] for _, r, t in rows)
    parts = [symbols[k : k + cut] for k in range(0, len(symbols), cut)]
    known = repair.matrices(parts)
    way = repair.Way()
    for part in parts:
        way.pass_chunk({k: (c, repair.letters(rope)) for k, (c, rope) in known[part].items()})
    assert way.end() == cheapest(rows, faults)[:2]
    if len(rows) <= 3:
        assert way.end() == cheapest(rows, faults, every=True)[:2]


def test_rules_give_back_their_sequences():
    draw = random.Random(3)
    sequences = [bytes(draw.choice(b"uaxU") for _ in range(draw.randint(0, 30))) for _ in range(200)] + [b"u" * 77, b"ua" * 50, b""]
    left, rules = repair.grammar(sequences)
    assert rules

    def spelled(symbol):
        return bytes([symbol]) if symbol < 256 else b"".join(spelled(s) for s in rules[symbol])

    assert [b"".join(spelled(s) for s in rest.tolist()) for rest in left] == sequences
    assert sum(map(len, left)) < sum(map(len, sequences)) / 2


def test_rope_order():
    draw = random.Random(4)

    def rope(depth):
        return repair.joined(rope(depth - 1), rope(depth - 1)) if depth and draw.random() < 0.8 else draw.choice(["K", "D", "", "RI"])

    ropes = [rope(4) for _ in range(80)]
    for a in ropes:
        for b in ropes:
            assert repair.before(a, b) == (repair.letters(a) < repair.letters(b))


@pytest.mark.parametrize("chunk_rows,chunk_bytes", [(4096, 4 << 20), (3, 4 << 20), (1, 1)])
def test_conversations_against_search(spark, chunk_rows, chunk_bytes):
    rows = made_up(11)
    found = repair.audits(repair.damaged(repair.prepared(frame(spark, rows).repartition(5))), chunk_rows, chunk_bytes)
    assert found.schema == repair.ANSWER
    assert as_found(found) == plain(rows)


def test_conversations_that_lose_all_rows_stay(spark):
    gone = next(n for n in range(10**4) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    got = as_found(repair.audits(repair.damaged(repair.prepared(frame(spark, [(gone, 0, "user", "hi.")])))))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows_are_what_was_hashed(spark):
    rows = repair.prepared(frame(spark, made_up(5, 25)))
    digests = {r.conv_id: (r.repaired_sha256, r.audit) for r in repair.audits(rows, 4).collect()}
    lines = defaultdict(list)
    for r in sorted(repair.repaired(rows, 4).collect(), key=lambda r: r.position):
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append((r.edit, f"{r.role}:{r.text}"))
    for conv, (digest, audit) in digests.items():
        assert hashlib.sha256("\n".join(x for _, x in lines[conv]).encode()).hexdigest() == digest
        assert "".join(e for e, _ in lines[conv]) == audit.replace("D", "")


def test_one_very_long_conversation(spark):
    """A conversation over many partitions and chunks, with rows of equal turn and text."""
    draw = random.Random(8)
    rows = [(1, draw.randint(0, 900), draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", f"{n}.", f"{n}"])) for n in range(2500)]
    rows += [(2, 0, "user", "x.")] * 500
    found = repair.audits(repair.damaged(repair.prepared(frame(spark, rows).repartition(9))), 100)
    assert as_found(found) == plain(rows)


def test_empty_table(spark):
    rows = repair.damaged(repair.prepared(frame(spark, [])))
    assert repair.audits(rows).collect() == [] and repair.repaired(rows).collect() == []
