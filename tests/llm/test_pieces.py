import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import pieces
from tests.llm.data import docs, none, rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def plain(text):
    """(ids, decoded text) as the library gives them."""
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return np.array(ids, dtype="<u4").tobytes(), LIBRARY.decode(ids)


def same(text):
    assert pieces.Model.of(PATH).encoded(text) == plain(text)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinorst  \n▁-=*/é梦\U0001f600\x00\x85　"), max_size=60))
def test_ids_are_the_librarys(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_characters(text):
    same(text)


def test_ids_of_rows_of_pieces():
    draw = random.Random(3)
    known = list(pieces.Model.of(PATH).ids)
    for _ in range(4000):
        same("".join(draw.choice(known) for _ in range(draw.randint(0, 8))))


def test_long_words_and_runs():
    for text in ("a" * 20000, " " * 5000, "ab" * 9000 + " x", "梦" * 3000, "-" * 7001, "\n" * 400, " ▁ ▁▁ ", "x" + " " * 40 + "y"):
        same(text)


def test_backtracking_alone():
    """Without the shortcut for rows of longest pieces."""
    model, draw = pieces.Model.of(PATH), random.Random(9)
    turned_back = 0
    for _ in range(3000):
        word = "▁" + "".join(draw.choice("aeinorsthld") for _ in range(draw.randint(1, 25)))
        ids = model.backtracked(word)
        assert [1, *ids, 2] == LIBRARY.encode(word[1:], add_bos=True, add_eos=True)
        turned_back += ids != [piece[2] for _, piece in model.automaton.iter_long(word)]
    assert turned_back > 300


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=10))
def test_decoding_of_any_ids(ids):
    assert pieces.Model.of(PATH).decode(ids) == LIBRARY.decode(ids)


def test_full_caches(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 5)
    model = pieces.Model(PATH)
    for r in rows():
        assert model.encoded(r[1]) == plain(r[1])
    assert len(model.words) <= 3 and len(model.pairs) <= 5


def test_frequent_words_outlast_those_that_come_once(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 8)
    model, computed = pieces.Model(PATH), []
    merged = model.merged
    monkeypatch.setattr(model, "merged", lambda word: computed.append(word) or merged(word))
    for n in range(40):
        text = f"often w{n}"
        assert model.encoded(text) == plain(text)
        assert len(model.words) + len(model.words.old) <= 8
    assert computed.count("▁often") == 1 and len(computed) == 41


def test_table(spark):
    table = docs(spark)
    found = pieces.with_pieces(table.repartition(3), PATH, "fingerprint")
    assert found.columns == table.columns
    got = sorted((r.doc_id, r.text, bytes(r.fingerprint.ids), r.fingerprint.decoded, r.score) for r in found.collect() if r.doc_id is not None and r.text)
    assert got == sorted((r[0], r[1], *plain(r[1]), r[5]) for r in rows() if r[0] is not None and r[1])
    assert {bytes(r.fingerprint.ids) for r in found.collect() if not r.text} == {plain("")[0]}
    assert pieces.with_pieces(none(spark), PATH).collect() == []


def test_other_kinds_of_models_are_refused():
    class Other:
        def normalize(self, text):
            return text.strip()

    with pytest.raises(ValueError, match="as they are"):
        pieces.Model.of(PATH).check(Other())
