import math
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerflow.llm import licenses
from ledgerflow.llm.common import words_of
from tests.llm.data import docs, none

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_places(text):
    words = plain_words(text)
    return sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


TEXTS = [
    "Released under the MIT License.",
    "the MIT license the mit License, THE MIT LICENSE!",
    "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU General Public License but no version",
    "mit license", "the mit  license" * 2, "cc by", None, "", "x" * 100000, "the " * 30000 + "mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction",
    "Über die MIT License. éthe mit license",
]


def index_of(texts):
    seen = Counter(w for t in texts for w in set(words_of(t)))
    return licenses.Index({w: math.log((len(texts) + 1) / (seen[w] + 0.5)) for w in licenses.vocabulary()})


def test_words_are_the_contracts():
    for text in [*TEXTS, "É-Ñ_a1\x7fb c　d", "A.B;C"]:
        assert [w.decode() for w in words_of(text)] == plain_words(text)


def test_base_places_are_all_found():
    index = index_of(TEXTS)
    for text in TEXTS:
        found = index.find(text)
        assert found["n_words"] == len(plain_words(text))
        assert sorted((p["first"], p["label"]) for p in found["places"] if p["base"]) == base_places(text)
        assert 0 <= found["score"] <= 1


def test_common_words_make_no_difference():
    """Whatever the IDFs, and so whatever word is looked up, the places are the same."""
    flat = licenses.Index({w: 1.0 for w in licenses.vocabulary()})
    upside = licenses.Index({w: float(len(w)) for w in licenses.vocabulary()})
    for text in TEXTS:
        assert flat.find(text)["places"] == upside.find(text)["places"] == index_of(TEXTS).find(text)["places"]


def test_notices_need_their_key_phrases():
    index = index_of(TEXTS)
    labels = lambda t: {p["label"] for p in index.find(t)["places"]}
    assert labels(TEXTS[3]) == {"gpl-3"} and labels(TEXTS[4]) == set() and labels(TEXTS[12]) == {"mit"}
    assert index.find(TEXTS[4])["score"] < 1 <= index.find(TEXTS[0])["score"]


def test_counts_cover_all_rows_and_cases(spark):
    table = docs(spark).select("doc_id", "text", "score").unionByName(
        spark.createDataFrame([(1000 + i, t, "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    )
    counts = licenses.file_counts(table, licenses.vocabulary())
    everything = [r.text for r in table.select("text").collect()]
    assert counts[b"mit"] == sum(b"mit" in words_of(t) for t in everything)
    found = licenses.scan(table, licenses.build(table)).select("text", "license.n_words", F.size("license.places").alias("n")).collect()
    assert len(found) == len(everything)
    assert all(r.n_words == len(plain_words(r.text)) for r in found)
    assert sum(r.n > 0 for r in found) == sum(bool(index_of(everything).find(t)["places"]) for t in everything)


def test_no_documents(spark):
    assert licenses.scan(none(spark), licenses.build(none(spark))).count() == 0


NOTES = {
    "SPDX-License-Identifier: GPL-2.0-or-later": {"gpl-2-or-later"},
    "SPDX-License-Identifier: GPL-3.0-only": {"gpl-3-only"},
    "// SPDX-License-Identifier: BSD-2-Clause": {"bsd-2"},
    "SPDX-License-Identifier: MIT": {"mit"},
    "SPDX-License-Identifier: LGPL-2.1-only": {"lgpl-2.1"},
    "the identifier of an spdx license is mit": set(),
    "Altered source versions must be plainly marked as such, and must not be\nmisrepresented as being the original software.": {"zlib"},
    "Altered source versions must be plainly marked.": set(),
    "Eclipse Public License v. 2.0": {"epl-2"},
    "Eclipse Public License v. 1.0": set(),
    "Neither the name nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.": {"bsd-3"},
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": {"mpl-2"},
    "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version.": {"gpl-3", "gpl-3-or-later"},
    "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3": {"agpl", "agpl-3"},
    "the GNU General Public License version 2 only": {"gpl-2", "gpl-2-only"},
}


def test_versions_and_short_names(spark):
    """Notices of further licences and near misses between versions."""
    table = spark.createDataFrame(list(enumerate(NOTES)), "doc_id long, text string")
    found = {r.doc_id: {p.label for p in r.license.places} for r in licenses.scan(table, licenses.build(table)).collect()}
    assert [(text, found[n]) for n, text in enumerate(NOTES)] == list(NOTES.items())
