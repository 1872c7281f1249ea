import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import repeats
from tests.llm.data import docs, none, rows


def plain(texts, least):
    """(bytes removed, runs removed, hash of the rest) of every text, from the positions of all strings."""
    bodies, seen = [(t or "").encode() for t in texts], Counter()
    for body in bodies:
        seen.update(body[i : i + least] for i in range(len(body) - least + 1))
    out = []
    for body in bodies:
        gone = np.zeros(len(body) + 1, dtype=bool)
        for i in range(len(body) - least + 1):
            if seen[body[i : i + least]] > 1:
                gone[i : i + least] = True
        starts = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(body) else 0
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def mixed(seed):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcé ") for _ in range(draw.randint(0, 400))) for _ in range(12)]
    found = []
    for _ in range(50):
        text = "".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 60)))
        for _ in range(draw.randint(0, 4)):
            part = draw.choice(base)
            at = draw.randint(0, max(0, len(part) - 1))
            text += part[at : at + draw.randint(0, 200)] + "".join(draw.choice("xyz") for _ in range(draw.randint(0, 3)))
        found.append(text)
    return found + [None, "", "a" * 500, "ab" * 300, found[3], found[3], "abc" * 100 + "é" * 100]


def compare(spark, texts, least):
    table = spark.createDataFrame([(i % 40 if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = repeats.remove_repeats(table, least).select("text", "_cut.n_removed", "_cut.n_spans", F.sha2("_cut.kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter((t, *w) for t, w in zip(texts, plain(texts, least)))
    return got


@pytest.mark.parametrize("least", [16, 33, 100])
def test_equal_to_all_positions(spark, least):
    assert any(r.n_removed for r in compare(spark, mixed(least), least))


def test_a_passage_in_most_texts(spark):
    draw = random.Random(2)
    passage = "".join(draw.choice("abcdefghij ") for _ in range(150))
    compare(spark, [f"{i} {draw.random()} {passage[i % 3 :]} {draw.random()}" for i in range(150)], 60)


def test_segments_do_not_matter(monkeypatch):
    """Long texts are read in segments; the windows and their anchors are the same."""
    sizes = repeats.Sizes(40)
    body = "".join(random.Random(4).choice("abc") for _ in range(3000))

    def windows():
        found = {}
        for data, valid, _, _, own in repeats.segments(iter([(1, 2, body), (1, 3, "x" * 90)]), sizes):
            names = repeats.names_up_to(data, sizes.k)[sizes.k]
            for at, first, last in zip(*repeats.anchors(data, valid, names, sizes)):
                for i in range(first, last + 1):
                    found[int(own[i]), data[i : i + 40].tobytes()] = int(own[at])
        return found

    whole = windows()
    assert len({k[1] for k in whole}) == len({body[i : i + 40] for i in range(2961)}) + 1
    monkeypatch.setattr(repeats, "SEGMENT", 200)
    assert windows() == whole


def test_names_tell_strings_apart():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=4000)), dtype=np.uint8)
    for size, names in repeats.names_up_to(data, 64).items():
        strings = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
        assert len(names) == len(strings) and len(set(names.tolist())) == len(set(strings))
        assert len(set(zip(names.tolist(), strings))) == len(set(strings))


def test_whole_characters():
    body = "aéb€c".encode()
    assert repeats.whole([(2, 3)], body) == [(1, 3)] and repeats.whole([(0, 2), (3, 5)], body) == [(0, 7)]
    assert repeats.merged([(0, 1), (5, 5), (3, 3)], 2) == [(0, 7)] and repeats.merged([(0, 0), (3, 3)], 2) == [(0, 2), (3, 5)]


def test_all_cases_and_other_columns(spark):
    table = docs(spark)
    out = repeats.remove_repeats(table, 200)
    assert out.columns == [*table.columns, "_cut"]
    texts = [r[1] for r in rows()]
    got = out.select("text", "_cut.n_removed", "_cut.n_spans", F.sha2("_cut.kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter((t, *w) for t, w in zip(texts, plain(texts, 200)))
    clean = repeats.remove_repeats(table, 200, whole_characters=True).select("_cut.kept").collect()
    assert all(bytes(r.kept).decode("utf-8") is not None for r in clean)


def test_no_documents(spark):
    assert repeats.remove_repeats(none(spark)).count() == 0
