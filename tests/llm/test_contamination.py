import math
import random
from collections import Counter

import numpy as np

from ledgerflow.llm import contamination
from ledgerflow.llm.common import words_of
from tests.llm.data import docs, none


def made(n=60, seed=4):
    """Items over a small vocabulary, so that words are shared."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(250)]
    weights = [1 / (i + 1) for i in range(len(words))]
    sentence = lambda k: " ".join(draw.choices(words, weights, k=k))
    items = [(i, f"{sentence(draw.randint(6, 40))}. {sentence(draw.randint(3, 14))}.") for i in range(n)]
    return items, sentence, draw


def index_of(items):
    seen = Counter(w for _, t in items for w in set(words_of(t)))
    average = sum(len(words_of(t)) for _, t in items) / len(items)
    return contamination.Index(items, {w: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for w, n in seen.items()}, average)


def test_retrieval_finds_all_above_the_threshold():
    items, sentence, draw = made()
    index = index_of(items)
    found = 0
    for postings in index.classes:
        for _ in range(150):
            text = sentence(draw.randint(1, 60)) + " " + draw.choice(items)[1][: draw.randint(0, 200)]
            terms = sorted({index.numbers[w] for w in words_of(text) if w in index.numbers})
            scores = Counter()
            for t in terms:
                for n, v in zip(*postings.lists.get(t, ((), ()))):
                    scores[n] += v
            for threshold in (0.1, 0.3, 0.6, 0.95):
                expected = {n for n, v in scores.items() if v >= threshold}
                got = dict(postings.retrieve(terms, threshold))
                assert set(got) == expected and all(abs(got[n] - scores[n]) < 1e-9 for n in got)
                found += len(got)
    assert found > 1000


def test_bounds_of_windows_hold():
    items, sentence, draw = made()
    index = index_of(items)
    text = " ".join(sentence(30) if draw.random() < 0.8 else draw.choice(items)[1] for _ in range(120))
    terms = np.array([index.numbers.get(w, len(index.numbers)) for w in words_of(text)])
    for postings in index.classes:
        windows = [(s, min(s + 2 * postings.length, len(terms))) for s in range(0, max(1, len(terms) - postings.length), postings.length)]
        for threshold in (0.2, 0.5, 0.9):
            kept = set(postings.promising(terms, threshold))
            for window in windows:
                if window not in kept:
                    assert not postings.retrieve(sorted(set(terms[slice(*window)].tolist()) - {len(index.numbers)}), threshold)


def test_long_texts_are_read_in_chunks(monkeypatch):
    items, sentence, draw = made()
    index = index_of(items)
    text = " ".join(sentence(30) if draw.random() < 0.9 else draw.choice(items)[1] for _ in range(300))
    whole = index.search(text)
    monkeypatch.setattr(contamination, "CHUNKS", 3)
    assert index.search(text) == whole and whole


def test_question_and_answer():
    assert contamination.question_and_answer("What is it? A thing.") == ([b"what", b"is", b"it"], [b"a", b"thing"])
    assert contamination.question_and_answer("one two three four") == ([b"one", b"two", b"three"], [b"four"])
    assert contamination.question_and_answer("") == ([], [])


def test_planted_items_are_found_and_verified(spark):
    items, sentence, draw = made()
    table, expected = [], set()
    for i in range(120):
        text = sentence(draw.randint(5, 400))
        if i % 3 == 0:
            item, body = draw.choice(items)
            expected.add((i, item))
            text = f"{text} {body.upper() if i % 2 else body.replace(' ', '  ')} {sentence(draw.randint(0, 200))}"
        if i % 3 == 1:  # the question alone, or the words in another order, are no leak
            body = words_of(draw.choice(items)[1])
            draw.shuffle(body)
            text += " " + b" ".join(body).decode()
        table.append((i, text, "x"))
    got = contamination.leaks(spark.createDataFrame(table, "doc_id long, text string, score string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= expected
    # Whatever else is reported is in the text as well.
    for r in got:
        question, answer = contamination.question_and_answer(dict(items)[r.item_id])
        words = words_of(table[r.doc_id][1])
        for part, least in ((question, 0.8), (answer, 0.5)):
            width = min(5, len(part))
            own = contamination.shingles(part, 5)
            assert len(own & {tuple(words[k : k + width]) for k in range(len(words))}) / len(own) >= least


def held(words, text):
    """Brute force: 0.8 of the item's shingles stand in the text, or the item but for one word, and one for every 15 words."""
    own, width = contamination.shingles(words, 5), min(5, len(words))
    if len(own & {tuple(text[k : k + width]) for k in range(len(text) - width + 1)}) / len(own) >= 0.8:
        return True
    row = [0] * (len(text) + 1)
    for n, word in enumerate(words, 1):
        now = [n]
        for k, other in enumerate(text, 1):
            now.append(min(row[k - 1] + (word != other), row[k] + 1, now[-1] + 1))
        row = now
    return len(words) >= 5 and min(row) <= max(1, len(words) // 15)


def test_every_edit_of_one_word_is_found():
    draw = random.Random(9)
    name = lambda: "".join(draw.choice("abcdefghij") for _ in range(7))
    items = [(i, f"{' '.join(name() for _ in range(n))}. {' '.join(name() for _ in range(a))}.") for i, (n, a) in enumerate([(3, 2), (4, 3), (9, 5), (12, 7), (20, 9), (45, 4)])]
    index = index_of(items)
    for item, text in items:
        words = words_of(text)
        before, after = [[name().encode() for _ in range(draw.randint(0, 70))] for _ in range(2)]
        for k in range(len(words)):
            for edit in (words[:k] + [b"other"] + words[k + 1 :], words[:k] + words[k + 1 :], words[:k] + [b"other"] + words[k:]):
                body = before + edit + after
                assert held(words, body)
                assert [h["item_id"] for h in index.search(b" ".join(body).decode())] == [item], (item, k)


def test_edits_agree_with_brute_force():
    items, sentence, draw = made(40, seed=6)
    index, seen = index_of(items), Counter()
    for _ in range(600):
        item, text = draw.choice(items)
        words = words_of(text)
        for _ in range(draw.randint(1, 6)):
            k = draw.randrange(len(words))
            words[k : k + draw.randint(0, 1)] = draw.choice([[], [b"other"]])
        body = words_of(sentence(draw.randint(1, 40))) + words + words_of(sentence(draw.randint(1, 40)))
        question, answer = (contamination.shingles(p, 5) for p in contamination.question_and_answer(text))
        runs = lambda part: {tuple(body[k : k + len(next(iter(part)))]) for k in range(len(body))}
        parts = len(question & runs(question)) / len(question) >= 0.8 and len(answer & runs(answer)) / len(answer) >= 0.5
        expected = parts or held(words_of(text), body)
        assert (item in [h["item_id"] for h in index.search(b" ".join(body).decode())]) == expected
        seen[parts, expected] += 1
    assert min(seen[True, True], seen[False, True], seen[False, False]) > 20


def test_shards_find_the_same(spark):
    items, sentence, draw = made(30)
    table = spark.createDataFrame([(i, f"{sentence(50)} {draw.choice(items)[1]} {sentence(20)}") for i in range(40)], "doc_id long, text string")
    rows = spark.createDataFrame(items, "item_id long, text string")
    one = {(r["_id"], h["item_id"]) for index in contamination.build(rows) for r in contamination.with_hits(table.withColumnRenamed("doc_id", "_id"), index).collect() for h in r["hits"]}
    shards = list(contamination.build(rows, shard_items=7))
    many = {(r["_id"], h["item_id"]) for index in shards for r in contamination.with_hits(table.withColumnRenamed("doc_id", "_id"), index).collect() for h in r["hits"]}
    assert len(shards) > 3 and one == many and len(one) >= 40


def test_all_cases(spark):
    table = docs(spark)
    long = table.filter("length(text) > 5000").first().text
    items = [(1, None), (2, ""), (3, " .\n"), (4, "Word"), (None, "no id but many words that stand nowhere else"), (5, long), (5, long)]
    items = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in contamination.leaks(table, items).collect()}
    assert (49, 4) in got and (50, 5) in got and all(i in (4, 5) for _, i in got)
    left = contamination.clean(table, items)
    assert left.columns == table.columns and left.count() == table.count() - len({d for d, _ in got})
    assert contamination.leaks(table, items.limit(0)).count() == 0
    assert contamination.leaks(none(spark), items).count() == 0 and contamination.clean(none(spark), items).count() == 0


def test_two_changed_words_in_a_long_item_are_found():
    """Two words replaced, left out or put in, items of 30 words and more, filler around them."""
    items, sentence, draw = made(80, 9)
    long = [(i, t) for i, t in items if len(words_of(t)) >= 30]
    index, found, trials = index_of(items), 0, 0
    assert len(long) > 10
    for item, text in long * 6:
        words = [w.decode() for w in words_of(text)]
        for _ in range(2):
            at = draw.randrange(len(words))
            kind = draw.choice("rdi")
            words[at : at + (kind != "i")] = [] if kind == "d" else ["unheard" + str(draw.randrange(99))]
        hits = index.search(" ".join([sentence(20), *words, sentence(20)]))
        found, trials = found + (item in {h["item_id"] for h in hits}), trials + 1
    assert found >= 0.9 * trials


def test_shards_one_after_the_other(spark):
    items, sentence, draw = made(30, 3)
    texts = [(n, sentence(40) + " " + draw.choice(items)[1] if n % 3 else sentence(60)) for n in range(60)]
    table = spark.createDataFrame([(n, t, "h", "x") for n, t in texts], "doc_id long, text string, hits string, _hits string")
    bank = spark.createDataFrame(items, "item_id long, text string")
    whole, parts = (contamination.leaks(table, bank, shard_items=k).select("doc_id", "item_id").collect() for k in (1000, 7))
    assert sorted(whole) == sorted(parts) and len(whole) >= 40
    kept = contamination.clean(table, bank, shard_items=7)
    assert kept.columns == table.columns and {tuple(r)[2:] for r in kept.collect()} == {("h", "x")}
    assert {r.doc_id for r in kept.collect()} == {n for n, _ in texts} - {r.doc_id for r in whole}
