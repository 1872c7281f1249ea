import re

import numpy as np
import xxhash

import corpus_pipeline
from ledgerflow.llm import simhash
from ledgerflow.llm.components import components
from tests.llm.data import docs, none, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(n, edges):
    """The smallest node each node can reach."""
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def close_values(seed, bases=20, each=40, most=4):
    draw = np.random.default_rng(seed)
    found = set()
    for base in draw.integers(0, 2**64, size=bases, dtype=np.uint64).tolist():
        for _ in range(each):
            value = base
            for bit in draw.integers(0, 64, size=int(draw.integers(0, most))).tolist():
                value ^= 1 << bit
            found.add(value)
    values = np.array(sorted(found), dtype=np.uint64)
    draw.shuffle(values)
    return values


def all_links(values, radius):
    v = [int(x) for x in values]
    return [(i, j) for i in range(len(v)) for j in range(i) if (v[i] ^ v[j]).bit_count() <= radius]


def test_fingerprints():
    for _, text, *_ in rows():
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_large_texts_are_counted_in_parts(monkeypatch):
    text = rows()[-4][1]
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART", 100)
    assert simhash.fingerprint(text) == whole == (plain_fingerprint(text) ^ 1 << 63) - (1 << 63)


def test_sliced_comparison_finds_every_link():
    for radius in (0, 1, 2, 3, 5):
        values = close_values(radius)
        sizes = np.array([200, 1, 3, len(values) - 204])
        at = {int(x): i for i, x in enumerate(values)}
        a, b = simhash.forest(values.copy(), sizes, radius)
        ends = np.cumsum(sizes)
        bucket = np.searchsorted(ends, np.arange(len(values)), side="right")
        expected = [(i, j) for i, j in all_links(values, radius) if bucket[i] == bucket[j]]
        assert roots(len(values), expected) == roots(len(values), [(at[int(x)], at[int(y)]) for x, y in zip(a, b)])


def test_links_of_buckets_and_tiles(spark):
    values = close_values(9, bases=6, each=60)
    signed = values.view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    at = {v: i for i, v in enumerate(signed)}
    expected = roots(len(values), all_links(values, 2))
    for tile in (4096, 7):
        found = simhash.links(table, 2, tile).collect()
        assert roots(len(values), [(at[r.a], at[r.b]) for r in found]) == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = roots(201, edges)
    assert found == {i: r for i, r in enumerate(expected) if r != i}


def test_near_duplicates_of_all_cases(spark):
    found = simhash.near_duplicates(docs(spark)).collect()
    table = rows()
    values = [plain_fingerprint(t) for _, t, *_ in table]
    edges = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    root = roots(len(values), edges)
    least = {}
    for (doc_id, *_), r in zip(table, root):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    expected = [(d, (v ^ 1 << 63) - (1 << 63), least.get(r)) for (d, *_), v, r in zip(table, values, root)]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_no_documents(spark):
    assert simhash.near_duplicates(none(spark)).count() == 0


def test_rows_that_share_an_id_stay_with_their_own_groups(spark, tmp_path):
    a, near, b, c = (" ".join(f"{x}{i}" for i in range(300)) for x in ("a", "a", "b", "c"))
    near = near.replace("a299", "a299 ").upper()  # other bytes, the same words
    schema = "doc_id long, text string, lang string"
    table = [(5, a, "x"), (5, b, "x"), (3, near, "x"), (7, c, "x"), (7, c, "x"), (7, c, "y"), (8, b, "x"), (None, c, "x"), (9, None, None), (9, "", None)]
    results = set()
    for order in (table, table[::-1], table[3:] + table[:3]):
        kept = corpus_pipeline.one_of_each(spark, spark.createDataFrame(order, schema).repartition(len(results) + 3), str(tmp_path))
        results.add(tuple(sorted((r.doc_id, r.text or "", r.text is None, r.lang or "") for r in kept.collect())))
    assert len(results) == 1
    assert [(i, t) for i, t, *_ in results.pop()] == [(3, near), (5, b), (7, c), (9, "")]
    pair = spark.createDataFrame([(5, a, "x"), (5, b, "x")], schema)
    assert {r.text for r in corpus_pipeline.one_of_each(spark, pair, str(tmp_path)).collect()} == {a, b}


def test_keys_hold_every_close_pair_and_few_others():
    """Every way to change two bits leaves a key as it was; a million unrelated fingerprints hardly meet."""
    for radius in (0, 1, 2, 3, 5):
        keys = [m & (1 << 64) - 1 for m in simhash.masks(radius)]
        draw = np.random.default_rng(radius)
        pairs = [(a, b) for a in range(64) for b in range(a)] if radius == 2 else [draw.choice(64, radius, replace=False).tolist() for _ in range(500)]
        assert all(any(not sum(1 << int(b) for b in bits) & key for key in keys) for bits in pairs)
    keys = [np.uint64(m & (1 << 64) - 1) for m in simhash.masks(2)]
    assert len(keys) == 10
    values = np.random.default_rng(1).integers(0, 2**64, size=10**6, dtype=np.uint64)
    met = [np.unique(values & key, return_counts=True)[1] for key in keys]
    assert sum(int((n * (n - 1) // 2).sum()) for n in met) < 1000
