"""The registered queries and the pipeline against brute-force versions on whole small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerflow.llm import quality, sketches, warc
from ledgerflow.llm.common import words_of
from ledgerflow.llm.queries import ORACLES, QUERIES
from tests.compare import rows as as_rows
from tests.llm.test_licenses import plain_words
from tests.llm.test_packing import plain_ids
from tests.llm.test_pieces import plain as plain_pieces
from tests.llm.test_repair import plain as plain_repairs
from tests.llm.test_repeats import plain as plain_repeats
from tests.llm.test_simhash import plain_fingerprint, roots


@pytest.fixture(scope="module")
def table(small):
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(table):
    return dict(table.execute("SELECT doc_id, text FROM documents").fetchall())


def run(spark, small, name):
    return [r.asDict() for r in QUERIES[name](spark, small).collect()]


def test_all_are_registered():
    known = queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)} and "pipeline" in known
    assert set(QUERIES) <= set(known) and set(ORACLES) <= set(oracle_sql())
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, small, table, name):
    df = QUERIES[name](spark, small)
    found = table.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert as_rows(df.columns, [tuple(r) for r in df.collect()]) == as_rows(names, found.fetchall())


def runs_of(words, width):
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def share_held(part, words):
    """The share of a part's runs of five words (of a shorter part the one run there is) that stand in a text."""
    own = runs_of(part, min(5, len(part))) if part else set()
    return len(own & runs_of(words, min(5, len(part)))) / len(own) if own else 1.0


def distance_in(words, text):
    """Words to replace, leave out or put in so that ``words`` stand somewhere in ``text``."""
    row = [0] * (len(text) + 1)
    for n, word in enumerate(words, 1):
        now = [n]
        for k, other in enumerate(text, 1):
            now.append(min(row[k - 1] + (word != other), row[k] + 1, now[-1] + 1))
        row = now
    return min(row)


def leaks_of(texts, items):
    """Pairs of a document and an item that its words hold, by any of the three rules."""
    parts = {}
    for item, text in items:
        sentences = [w for w in (words_of(s) for s in re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
        whole = [w for s in sentences for w in s]
        cut = len(whole) - (len(sentences[-1]) if len(sentences) > 1 else len(whole) // 3)
        parts[item] = (whole[:cut], whole[cut:], whole)
    found = set()
    for doc_id, text in texts.items():
        words = words_of(text)
        known = set(words)
        for item, (question, answer, whole) in parts.items():
            if sum(w in known for w in whole) < 0.6 * len(whole):
                continue
            allowed = max(1, len(whole) // 15) if len(whole) >= 5 else 0
            if (
                (share_held(question, words) >= 0.8 and share_held(answer, words) >= 0.5)
                or share_held(whole, words) >= 0.8
                or (sum(w in known for w in whole) >= len(whole) - allowed and distance_in(whole, words) <= allowed)
            ):
                found.add((doc_id, item))
    return found


def test_op1(spark, small, table, texts):
    items = table.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = run(spark, small, "op1_contamination")
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks_of(texts, items) and got
    assert all(0.5 <= r["score"] <= 1 for r in got)


def pieces_of(texts):
    out = Counter()
    for doc_id, text in texts:
        ids = plain_ids(text or "") + b"\x02\0\0\0"
        n = len(ids) // 4
        first = n % 1024 or 1024
        edges = [0, n] if n <= 1024 else [0, *range(first, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            out[doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])] += 1
    return out


def places_fit(got):
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_op2(spark, small, texts):
    got = run(spark, small, "op2_packing")
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces_of(texts.items())
    assert places_fit(got) <= sum(r["length"] for r in got) / 1024 * 1.02 + 1


CONTRACT_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def contract_places(text):
    words = plain_words(text)
    return sorted((i, label) for p, label in CONTRACT_PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


def test_op3_counts_the_contracts_phrase(spark, tmp_path):
    texts = {1: "The MIT license, under the MIT license. Under the MIT License", 2: "the MIT license", 3: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in run(spark, str(tmp_path), "op3_licenses")}
    assert [got[1][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")] == [11, 2, 3, 7, "mit", "mit"]
    assert [got[2][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")] == [3, 0, None, None, "", "mit"]
    assert [got[3][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")] == [0, 0, None, None, "", ""]


def test_op3(spark, small, texts):
    got = run(spark, small, "op3_licenses")
    assert len(got) == len(texts)
    for r in got:
        places = contract_places(texts[r["doc_id"]])
        labels = sorted({label for _, label in places})
        assert (r["n_words"], r["n_base"]) == (len(plain_words(texts[r["doc_id"]])), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(labels) and set(labels) <= set(filter(None, r["labels"].split(",")))
        assert r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1


def groups_of(texts):
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    links = [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    return {ids[i]: (f"{prints[i]:016x}", ids[r]) for i, r in enumerate(roots(len(ids), links))}


def test_op4(spark, small, texts):
    got = run(spark, small, "op4_simhash")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == groups_of(texts) and len(got) == len(texts)


def test_op6(spark, small, texts):
    got = run(spark, small, "op6_repeats")
    ids = sorted(texts)
    expected = {i: (len((texts[i] or "").encode()), *w) for i, w in zip(ids, plain_repeats([texts[i] for i in ids], 200))}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == expected
    assert len(got) == len(texts)


def tokens_of(text):
    """Runs of letters, digits and bytes beyond ASCII; runs of marks; runs of line ends."""

    def kind(byte):
        if byte > 127 or chr(byte).isalnum():
            return "word"
        return "line" if byte == 10 else "" if byte in b" \t\r\x0b\x0c" else "mark"

    return [bytes(run) for k, run in groupby((text or "").encode(), kind) if k]


def plain_shape(token):
    size = 5 if len(token) > 15 else [0, 1, 2, 2, 3, 3, 3, 3, 4][min(len(token), 8)]
    if token.startswith(b"\n"):
        return 1 + min(len(token), 3)
    if all(48 <= b <= 57 for b in token):
        return 8 + size
    letters = [b for b in token if 65 <= b <= 90 or 97 <= b <= 122]
    if token[0] > 127 or token.isalnum():
        lower = token[0] > 127 or (letters and all(b >= 97 for b in letters))
        upper = letters and all(b <= 90 for b in letters) and len(token) > 1
        return 16 + (0 if lower else 8 if upper else 16) + min(size + (len(token) > 10), 7)
    if len(token) == 1 and token in b".,;:!?'\"()-":
        return 42 + 1 + b".,;:!?'\"()-".index(token)
    return 56 + min(len(token), 4)


def plain_grams(text):
    """The distinct numbers of words, pairs of words, and pairs and triples of shapes."""
    tokens = tokens_of(text)
    if not tokens:
        return {0}
    whole = [((zlib.crc32(t) << 26 ^ zlib.crc32(t, 0x5BD1E995)) << 6 | plain_shape(t)) % 2**64 for t in tokens]
    words = [w >> 6 for w in whole]
    shapes = [63 if n and words[n] == words[n - 1] else whole[n] & 63 for n in range(len(whole))]
    room = (1 << 18) - 64**2 - 64**3 // 2 - 1
    found = {w % room + 1 for w in words}
    found |= {((a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F) % 2**64) % room + 1 for a, b in zip(words, words[1:])}
    found |= {room + 1 + a * 64 + b for a, b in zip(shapes, shapes[1:])}
    return found | {room + 1 + 64**2 + ((a * 64 + b) * 64 + c) // 2 for a, b, c in zip(shapes, shapes[1:], shapes[2:])}


def plain_scores(spark, texts, marks):
    """Naive Bayes support vectors in plain Python: ratios from counts of texts, then coordinate descent on the dual."""
    usable = [(i, texts[i], y) for i, y in marks.items() if y in (0, 1) and i in texts and zlib.crc32(str(i).encode()) % 3 != 1]
    frame = spark.createDataFrame(usable, "doc_id long, text string, label int")
    order = {r.doc_id: r.key for r in frame.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).collect()}
    rows = [(sorted(plain_grams(t)), 1.0 if y else -1.0) for i, t, y in sorted(usable, key=lambda u: order[u[0]])]
    held = {side: Counter(g for grams, s in rows if s == side for g in grams) for side in (1.0, -1.0)}
    total = {side: (1 << 18) + sum(c.values()) for side, c in held.items()}
    ratio = {g: math.log((1 + held[1.0][g]) / total[1.0]) - math.log((1 + held[-1.0][g]) / total[-1.0]) for c in held.values() for g in c}
    weights, bias, dual = dict.fromkeys(ratio, 0.0), 0.0, [0.0] * len(rows)
    draw = np.random.default_rng(7)
    for _ in range(20):
        most = 0.0
        for n in draw.permutation(len(rows)).tolist():
            grams, side = rows[n]
            values = {g: ratio[g] / math.sqrt(len(grams)) for g in grams}
            slope = side * (sum(v * weights[g] for g, v in values.items()) + bias) - 1
            new = min(max(dual[n] - slope / (sum(v * v for v in values.values()) + 1), 0.0), 1.0)
            step, dual[n] = (new - dual[n]) * side, new
            for g, v in values.items():
                weights[g] += step * v
            bias, most = bias + step, max(most, abs(step))
        if most < 1e-2:
            break
    out = {}
    for i, text in texts.items():
        grams = plain_grams(text)
        margin = sum(weights[g] * ratio[g] for g in grams if g in ratio) / math.sqrt(len(grams)) + bias
        out[i] = 1 / (1 + math.exp(-2 * margin))
    return out


def test_op7(spark, small, texts, table):
    got = run(spark, small, "op7_quality")
    assert len(got) == len(texts)
    marks = dict(table.execute("SELECT doc_id, quality FROM labels").fetchall())
    plain = plain_scores(spark, texts, marks)
    assert all(abs(r["score"] - plain[r["doc_id"]]) < 1e-4 for r in got)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    judged = [r for r in got if r["held_out"] and r["doc_id"] in marks]
    assert sum(r["predicted"] == marks[r["doc_id"]] for r in judged) >= 0.9 * len(judged)


def test_op9(spark, small, texts):
    got = run(spark, small, "op9_shards")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    sizes = Counter()
    for r in got:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        sizes[r["shard"]] += r["size"]
    for n in range(16):
        own = sorted(r["slot"] for r in got if r["shard"] == n)
        assert own == list(range(len(own)))
    assert max(sizes.values()) <= max(sum(sizes.values()) / 16 * 1.05, max(r["size"] for r in got))


def test_op10(spark, small, texts):
    got = {r["doc_id"]: r for r in run(spark, small, "op10_sketches")}
    order = sorted(texts, reverse=True)
    assert set(got) == set(order)
    for n, doc_id in enumerate(order):
        text, following = texts[doc_id] or "", texts[order[(n + 1) % len(order)]] or ""
        k, r = len(text) // 3, got[doc_id]
        changed = text[: len(text) - k] + following[:k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        for other, near in ((changed, r["near_edited"]), (following, r["near_next"])):
            a, b = (set(sketches.digests(t).tolist()) for t in (text, other))
            assert near == (len(a & b) / len(a | b) if a | b else 1.0)
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == changed)
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.35 > 0.1 > np.mean([r["near_next"] for r in got.values()])


def test_op11(spark, small, table):
    got = run(spark, small, "op11_repair")
    expected = plain_repairs(table.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    assert {r["conv_id"]: tuple(r.values())[1:] for r in got} == expected and len(got) == len(expected)


def test_op13(spark, small, texts):
    got = run(spark, small, "op13_pieces")
    assert len(got) == len(texts)
    for r in got:
        ids, decoded = plain_pieces(texts[r["doc_id"]])
        digests = [hashlib.sha256(v).hexdigest() for v in (ids, decoded.encode())]
        assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids) // 4, *digests]


def test_op5_reads_what_the_splits_give(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    whole = warc.round_trip(pages, 1000)
    cut = warc.round_trip(pages, 1000, split_bytes=5000)
    key = lambda df: sorted(map(tuple, df.select("record_id", "record_type", "payload_bytes", F.sha1("payload")).collect()), key=str)
    assert key(whole) == key(cut)


def test_pipeline(spark, small, table, texts):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    found = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, small)
        found.append({r.doc_id: r.text for r in docs.collect()} if n < 4 else [r.asDict() for r in docs.collect()])
        if n < 4:
            assert docs.columns == columns and len(found[-1]) == docs.count()
            assert all(r.n_chars == len(r.text) for r in docs.collect())
            docs = spark.createDataFrame(docs.collect(), docs.schema)

    model = quality.train(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    good = {i: t for i, t in texts.items() if model.score(t) >= 0.5}
    assert found[0] == good and 0 < len(good) < len(texts)
    single = {i: t for i, t in good.items() if groups_of(good)[i][1] == i}
    assert found[1] == single and len(single) < len(good)

    ids = sorted(single)
    plain = plain_repeats([single[i] for i in ids], 200)
    for i, (removed, _, _) in zip(ids, plain):
        assert (removed == 0) == (found[2][i] == single[i])
        # Up to three more bytes go with each end of a removed run.
        left = len(single[i].encode()) - removed
        assert left - 6 * 50 <= len(found[2][i].encode()) <= left
    assert any(removed for removed, *_ in plain)

    items = table.execute("SELECT item_id, text FROM benchmark").fetchall()
    dirty = {d for d, _ in leaks_of(found[2], items)}
    assert found[3] == {i: t for i, t in found[2].items() if i not in dirty}
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found[4]) == pieces_of(found[3].items())
    places_fit(found[4])
    again = [r.asDict() for r in corpus_pipeline.run(spark, small).collect()]
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in again) == Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in found[4])


def test_pipeline_stages_bear_all_cases(spark, small):
    """Null ids and texts, repeated rows and empty tables; columns stay."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    long = " ".join(f"w{i} some more words to make it long" for i in range(60))
    odd = [(None, None), (None, ""), (None, long), (None, long), (10**6, None), (10**6 + 1, "x"), (10**6 + 1, "x"), (10**6 + 2, long + " é")]
    odd = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in odd], docs.schema)
    for part in (odd, docs.limit(30).unionByName(odd), docs.limit(0)):
        now = part
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, small)
            assert now.columns == docs.columns, name
            now = spark.createDataFrame(now.collect(), docs.schema)
        assert now.count() <= part.count()
        assert corpus_pipeline.packed(spark, now, small).count() >= now.count()
    kept = corpus_pipeline.one_of_each(spark, odd, small).collect()
    assert Counter((r.doc_id, r.text) for r in kept)[(10**6 + 1, "x")] == 1
    assert sum((r.text or "").startswith("w0") for r in kept) == 1 and next(r for r in kept if (r.text or "").startswith("w0")).doc_id is not None


def test_pipeline_keeps_columns_of_any_name_and_type(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = ("_score", "_own", "_row", "_id", "_text", "_cut", "_starts", "_hits", "score", "own", "row", "hits", "given0", "fingerprint", "a b.c")
    wide = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names])
    wide = wide.withColumns({"tags": F.create_map(F.lit("k"), F.col("doc_id")), "list": F.array("doc_id")})
    expected = {r.doc_id: tuple(r)[5:] for r in wide.collect()}
    now, plain = wide, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now, plain = stage(spark, now, small), stage(spark, plain, small)
        rows = now.collect()
        assert now.columns == wide.columns and now.schema[-2].dataType == wide.schema[-2].dataType, name
        assert all(tuple(r)[5:] == expected[r.doc_id] for r in rows), name
        assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in plain.collect()), name
        now, plain = spark.createDataFrame(rows, wide.schema), spark.createDataFrame(plain.collect(), docs.schema)
    assert corpus_pipeline.packed(spark, now, small).count() >= now.count()
