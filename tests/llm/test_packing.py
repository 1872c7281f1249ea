import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerflow.llm import packing
from tests.llm.data import docs, none, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1'é \n\t 　\x1c.!<|>s", max_size=40))
def test_ids_are_the_tokenizers(text):
    encoder = packing.Encoder.of(PATH)
    assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_ids_of_odd_texts():
    encoder = packing.Encoder.of(PATH)
    for text in ["a   b", " \n \n x", "it's  don't", "x <|endoftext|> y", "é" * 3000, "a b " * 2000, "\u0085 x", "  \n\n  b  \n"]:
        assert encoder.ids(text) == plain_ids(text)


def test_only_the_first_piece_is_short():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def held(runs):
    found = Counter()
    for run in runs:
        for length in run.lengths:
            found[length] += run.count
    return found


def test_plans_hold_all_pieces_in_few_sequences():
    draw = random.Random(1)
    for n, most in ((0, 9), (1, 1024), (40, 1024), (3000, 1024), (5000, 300)):
        histogram = Counter(draw.randint(1, most) for _ in range(n))
        runs = packing.plan(histogram, 1024)
        assert held(runs) == histogram and all(sum(r.lengths) <= 1024 for r in runs)
        least = math.ceil(sum(k * v for k, v in histogram.items()) / 1024)
        best = sum(r.count for r in packing.best_fit(dict(histogram), 1024))
        assert sum(r.count for r in runs) <= max(least, best) * 1.005 + 1


def test_fit_finds_an_exact_cover():
    triples = packing.patterns(np.array([200, 400, 600]), 1000)
    assert sorted(map(tuple, triples.tolist())) == [(400, 400, 200), (600, 200, 200), (600, 400, 0)]
    histogram = np.zeros(1001)
    histogram[[200, 400, 600]] = [7, 46, 42]  # 3, 2 and 40 times the patterns above
    counts = packing.fit(triples, histogram)
    reached = sum(np.bincount(k, weights=counts, minlength=1001) for k in triples.T)
    assert np.abs(reached[1:] - histogram[1:]).max() < 0.2


def test_pieces_and_places(spark):
    capacity = 64
    packed = packing.pack(docs(spark), PATH, capacity)
    found = packed.collect()
    expected = Counter()
    for doc_id, text, *_ in rows():
        ids = plain_ids(text or "") + b"\x02\0\0\0"
        for n, (start, length) in enumerate(packing.cut(len(ids) // 4, capacity)):
            own = ids[4 * start : 4 * (start + length)]
            expected[doc_id, n, start, length, own, zlib.crc32(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in found) == expected
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= math.ceil(sum(r.length for r in found) / capacity) * 1.1 + 1
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert whole == {k: b"".join(p for _, _, p in sorted(v)) for k, v in by.items()}


def test_no_documents(spark):
    assert packing.pack(none(spark), PATH).count() == 0
