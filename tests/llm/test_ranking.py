import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from ledgerflow.llm import ranking
from tests.llm.data import docs, none, rows

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def plain_ranks(texts, items, top=50):
    """Rows (item_id, rank, doc_id, score) of ``texts`` (doc_id, text) for distinct ``items`` (item_id, text), in whole numbers."""
    held = [(d, Counter(plain_terms(t))) for d, t in texts]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in set(items):
        own = set(plain_terms(text))
        found = []
        for doc, counts, n in held:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = 0
            for w in own & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * counts[w]) // (1000 * counts[w] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=str)


def some_items(seed=2, n=12):
    draw = random.Random(seed)
    bodies = [r[1] for r in rows() if r[1]]
    out = []
    for k in range(n):
        words = draw.choice(bodies).split() or ["zz"]
        out.append((k, " ".join(draw.choice(words) for _ in range(draw.randint(1, 30)))))
    out += [(n, None), (n + 1, ""), (n + 2, " .. "), (None, out[0][1]), (0, out[1][1]), out[2], out[2], (n + 3, "nowhere unheard")]
    return out


def item_frame(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], ITEMS)


def test_ranks_against_brute_force(spark):
    items = some_items()
    expected = plain_ranks([(r[0], r[1]) for r in rows()], [i for i in items if plain_terms(i[1])], 7)
    assert len({e[0] for e in expected}) > 5
    for args in ({}, {"shard_items": 3}, {"shard_bytes": 200}):
        found = ranking.search(docs(spark).repartition(5), item_frame(spark, items), 7, **args)
        assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_many_equal_scores(spark):
    """Copies over all partitions: the smallest ids count, however they are dealt."""
    texts = [(n, "same words here") for n in random.Random(1).sample(range(10**6), 3000)] + [(-5, "other"), (None, "same words here")]
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    found = ranking.search(table, item_frame(spark, [(1, "words"), (2, "other same")]))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_ranks(texts, [(1, "words"), (2, "other same")])


def test_tiles_are_exact():
    draw = np.random.default_rng(5)
    weights = draw.integers(1, 25_000, 60)
    items = [np.sort(draw.choice(60, draw.integers(1, 50), replace=False)) for _ in range(11)]
    dense = draw.integers(0, 1_000_000, (40, 60)) * (draw.random((40, 60)) < 0.3)
    ids = draw.integers(0, 9, 40)
    plain = np.array([[sum(int(weights[t]) * int(row[t]) for t in item) for item in items] for row in dense.tolist()])
    for term_tile, item_tile in ((4096, 256), (7, 3), (1, 1)):
        tiles = ranking.Tiles(items, weights, term_tile, item_tile)
        assert tiles.width == min(term_tile, ranking.EXACT // (int(weights.max()) * ranking.MOST_IMPACT) - 1)
        seen = np.zeros_like(plain)
        for own, parts in tiles.blocks:
            for part, table in parts:
                seen[:, own] += (dense[:, part].astype(float) @ table).astype(np.int64)
        assert (seen == plain).all()
    best = ranking.Best(len(items), 4)
    for k in range(0, 40, 3):
        best.add(plain[k : k + 3] // 10**9, ids[k : k + 3])
        if k % 2:
            best.prune()
    best.prune()
    found = sorted(zip(*(c.tolist() for c in best.kept)))
    every = [sorted((-s // 1, d) for s, d in zip((plain[:, n] // 10**9).tolist(), ids.tolist()) if s > 0)[:4] for n in range(len(items))]
    assert found == sorted((n, -s, d) for n, own in enumerate(every) for s, d in own)


def test_wide_weights_make_narrow_tiles():
    tiles = ranking.Tiles([np.arange(10)], np.full(10, 1 << 31))
    assert tiles.width * (1 << 31) * ranking.MOST_IMPACT < ranking.EXACT and len(tiles.blocks[0][1]) > 1


def test_empty_tables(spark):
    items = item_frame(spark, some_items())
    assert ranking.search(none(spark), items).collect() == []
    assert ranking.search(docs(spark), items.limit(0)).collect() == []
    assert ranking.search(docs(spark), item_frame(spark, [(1, None), (2, "")])).collect() == []
