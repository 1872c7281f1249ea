import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import sketches
from tests.llm.data import docs, none, rows, texts


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_paragraphs_are_the_text():
    for text in [*texts(), "x" * 1000, "\n" * 50, "é" * 77 + " b"]:
        parts = sketches.paragraphs(text or "")
        assert b"".join(parts) == (text or "").encode() and all(0 < len(p) <= sketches.LONGEST for p in parts)


def test_an_edit_changes_paragraphs_around_it():
    draw = random.Random(2)
    text = " ".join("".join(draw.choice("abcdefg") for _ in range(5)) for _ in range(400))
    before, after = sketches.digests(text), sketches.digests(text[:900] + " new words " + text[900:])
    assert jaccard(before, after) > 0.85


def test_copies_of_a_paragraph_count():
    assert len(sketches.digests("same\n" * 9)) == 9 and len(sketches.digests("")) == len(sketches.digests(None)) == 0
    assert jaccard(sketches.digests("same\n" * 9), sketches.digests("same\n" * 6)) == 6 / 9


def test_differences_are_recovered():
    draw = np.random.default_rng(1)
    old, new = [], []
    for n in (0, 1, 3, 40, 500, 5000):
        for gone, come in ((0, 0), (1, 0), (0, 2), (n // 2, 3), (n, n), (n, 0)):
            keys = draw.integers(0, 2**64, size=n + come, dtype=np.uint64)
            old.append(keys[:n])
            new.append(keys[gone:])
    found = sketches.differences(old, new)
    for a, b, (gone, come) in zip(old, new, found):
        assert set(gone.tolist()) == set(a.tolist()) - set(b.tolist()) and set(come.tolist()) == set(b.tolist()) - set(a.tolist())
        assert sketches.likeness(a, b, gone) == jaccard(a, b)


def test_small_sketches_fail_and_are_retried():
    keys = np.arange(1, 400, dtype=np.uint64)
    both = sketches.sketch([keys[:200]]).minus(sketches.sketch([keys[200:]]))
    assert not both.peel()[3].any()
    gone, come = sketches.differences([keys[:200]], [keys[200:]])[0]
    assert len(gone) == 200 and len(come) == 199


def expected(table):
    order = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for n, (doc_id, text, *_) in enumerate(order):
        following = order[(n + 1) % len(order)][1] or ""
        text = text or ""
        k = len(text) // 3
        changed = text[: len(text) - k] + following[:k]
        near = [jaccard(sketches.digests(text), sketches.digests(t)) for t in (changed, following)]
        out[doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), *near)
    return out


def test_against_the_next_document(spark):
    table = list({r[0]: r for r in rows() if r[0] is not None}.values()) + [(None, "no id at all", *[None] * 8)]
    df = spark.createDataFrame(table, docs(spark).schema).repartition(7)
    for range_rows in (4000, 5):
        got = sketches.against_next(df, range_rows=range_rows).collect()
        assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == expected(table) and len(got) == len(table)
    prints = {}
    for r in got:
        text = next(t for d, t, *_ in table if d == r.doc_id) or ""
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_repeated_ids_nulls_and_single_rows(spark):
    got = sketches.against_next(docs(spark), range_rows=9).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = sketches.against_next(docs(spark).filter("doc_id = 3").limit(1)).first()
    assert one.near_next == 1.0


def test_no_documents(spark):
    assert sketches.against_next(none(spark)).count() == 0


def test_a_hot_id_is_divided(spark):
    """Half of the rows have one id: ranges stay even, and the result is that of one range."""
    rows = spark.range(8000).select(
        F.when(F.col("id") % 2 == 0, F.lit(77)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("line "), F.col("id").cast("string")).alias("text")
    )
    laid = sketches.in_order(rows.repartition(6), 200)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) >= 8000 and max(sizes) <= 600
    some = rows.filter("doc_id < 400 OR doc_id = 77 AND text LIKE '%1'")
    cut, whole = (sorted(map(tuple, sketches.against_next(some.repartition(4), range_rows=k).collect()), key=str) for k in (60, 10**6))
    assert cut == whole and len(cut) > 400
