"""Licence notices by a positional index of rare words.

Templates are short notices with mandatory key phrases. Two passes over the texts: the first counts in how many files each
template word occurs, the second looks the notices up. The index holds, for each template word, where it stands in which
template. Of each key phrase the word with the highest IDF is the one looked up; a file that lacks it cannot hold
the phrase, so common words are never searched and nothing is missed. A hit aligns the file with the template; the other
words are intersected at the same relative position, and the key phrases must stand in full, the second one up to ``SLACK``
words off its place.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import in_rows, words_of

SLACK = 4


@dataclass(frozen=True)
class Template:
    """A notice; the whole notice is the key phrase if none are named. ``base`` marks those whose every place counts."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The base phrases and their labels.
BASE = (
    Template("mit", "the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)

# Common notices, shortened to the words that tell them apart.
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
        ("apache license version 2", "in compliance with the license"),
    ),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template(
        "gpl-3",
        "under the terms of the gnu general public license as published by the free software foundation either version 3",
        ("gnu general public license", "either version 3"),
    ),
    Template(
        "gpl-2",
        "under the terms of the gnu general public license as published by the free software foundation either version 2",
        ("gnu general public license", "either version 2"),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "the following conditions are met"),
    ),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify and or distribute this software", "is hereby granted"),
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc0", "cc0 1 0 universal"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
)

# What tells versions and further licences apart.
VERSIONS = (
    Template(
        "bsd-3",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("to endorse or promote products derived from this software", "without specific prior written permission"),
    ),
    Template("gpl-2-or-later", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
             ("gnu general public license", "either version 2 of the license or at your option any later version")),
    Template("gpl-3-or-later", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
             ("gnu general public license", "either version 3 of the license or at your option any later version")),
    Template("gpl-2-only", "gnu general public license version 2 only", ("gnu general public license", "version 2 only")),
    Template("gpl-3-only", "gnu general public license version 3 only", ("gnu general public license", "version 3 only")),
    Template("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1",
             ("gnu lesser general public license", "either version 2 1")),
    Template("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3",
             ("gnu lesser general public license", "either version 3")),
    Template("agpl-3", "gnu affero general public license as published by the free software foundation either version 3",
             ("gnu affero general public license", "either version 3")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("this source code form is subject to the terms", "mozilla public license v 2 0")),
    Template("epl-2", "eclipse public license v 2 0", ("eclipse public license v 2",)),
    Template("epl-2", "eclipse public license version 2 0", ("eclipse public license version 2",)),
    Template("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
             ("altered source versions must be plainly marked as such", "must not be misrepresented as being the original software")),
    Template("bsl-1", "boost software license version 1 0", ("boost software license version 1",)),
    Template("wtfpl", "do what the fuck you want to public license"),
)

# Short names as they stand after "SPDX-License-Identifier:", by label; two names that begin alike need their ends.
SHORT_NAMES = {
    "mit": ("mit",),
    "apache-2": ("apache 2 0",),
    "bsd-2": ("bsd 2 clause",),
    "bsd-3": ("bsd 3 clause",),
    "gpl-2-only": ("gpl 2 0 only",),
    "gpl-2-or-later": ("gpl 2 0 or later",),
    "gpl-3-only": ("gpl 3 0 only",),
    "gpl-3-or-later": ("gpl 3 0 or later",),
    "lgpl-2.1": ("lgpl 2 1 only", "lgpl 2 1 or later"),
    "lgpl-3": ("lgpl 3 0 only", "lgpl 3 0 or later"),
    "agpl-3": ("agpl 3 0 only", "agpl 3 0 or later"),
    "mpl-2": ("mpl 2 0",),
    "epl-2": ("epl 2 0",),
    "isc": ("isc",),
    "zlib": ("zlib",),
    "bsl-1": ("bsl 1 0",),
    "unlicense": ("unlicense",),
    "cc0": ("cc0 1 0",),
    "cc-by": ("cc by 4 0",),
    "cc-by-sa": ("cc by sa 4 0",),
}
SPDX = tuple(Template(label, f"spdx license identifier {name}") for label, names in SHORT_NAMES.items() for name in names)
TEMPLATES = BASE + NOTICES + VERSIONS + SPDX

PLACE = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("base", T.BooleanType()),
    ]
)
FOUND = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("places", T.ArrayType(PLACE))]
)
_PLACE = pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("coverage", pa.float64()), ("base", pa.bool_())])
_FOUND = pa.struct([("n_words", pa.int64()), ("score", pa.float64()), ("places", pa.list_(_PLACE))])


def vocabulary(templates: Sequence[Template] = TEMPLATES) -> list[bytes]:
    return sorted({w for t in templates for w in words_of(t.text)})


def file_counts(docs: DataFrame, words: Sequence[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many of all rows each of the words occurs; one row per word reaches the driver."""
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for (body,) in in_rows(batches, text):
            seen.update(wanted.intersection(words_of(body)))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in rows.collect()}
    return {w: found.get(w, 0) for w in words}


class Index:
    """The templates' words by position, and which word of each template's rarest key phrase is looked up.

    Which one that is follows from the IDFs and decides how much is searched, not what is found.
    """

    def __init__(self, idf: Mapping[bytes, float], templates: Sequence[Template] = TEMPLATES, slack: int = SLACK):
        self.templates, self.slack, self.idf = templates, slack, idf
        self.words = [words_of(t.text) for t in templates]
        self.keys = [[(self._at(n, words_of(k)), words_of(k)) for k in t.keys or (t.text,)] for n, t in enumerate(templates)]
        if any(len(keys) > 2 for keys in self.keys):
            raise ValueError("a template has one or two key phrases")
        # word -> (template, key phrase, position in the template)
        self.postings: dict[bytes, list[tuple[int, int, int]]] = defaultdict(list)
        for n, keys in enumerate(self.keys):
            spots = [(k, i, w) for k, (_, words) in enumerate(keys) for i, w in enumerate(words)]
            k, i, word = max(spots, key=lambda s: (idf[s[2]], -s[0], -s[1]))
            self.postings[word].append((n, k, keys[k][0] + i))
        self.probes = frozenset(self.postings)

    def _at(self, n: int, key: list[bytes]) -> int:
        words = self.words[n]
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)

    def _stands(self, n: int, k: int, start: int, words: list[bytes]) -> bool:
        """Whether a key phrase stands at its place when the template starts at ``start``."""
        at, key = self.keys[n][k]
        return start + at >= 0 and words[start + at : start + at + len(key)] == key

    def _coverage(self, n: int, start: int, words: list[bytes]) -> float:
        """The share of a template's words that stand at their relative positions."""
        template = self.words[n]
        return sum(start + j >= 0 and words[start + j : start + j + 1] == [w] for j, w in enumerate(template)) / len(template)

    def _verified(self, n: int, k: int, start: int, words: list[bytes]) -> Iterator[tuple[int, float]]:
        """(start, coverage) of the notices of which key phrase ``k`` stands at ``start``.

        The start is that of the first key phrase; the second may be ``slack`` words off. Words that were put in or left
        out between them shift the rest, so the better of both alignments counts.
        """
        if not self._stands(n, k, start, words):
            return
        if len(self.keys[n]) == 1:
            yield start, self._coverage(n, start, words)
            return
        near = range(-self.slack, self.slack + 1)
        for first in [start] if k == 0 else [start + d for d in near if self._stands(n, 0, start + d, words)]:
            others = [first + d for d in near if self._stands(n, 1, first + d, words)]
            if others:
                yield first, max(self._coverage(n, s, words) for s in (first, *others))

    def find(self, text: str | None) -> dict:
        """The notices of a file: number of words, places of verified notices, and the best coverage of them (none: 0)."""
        words = words_of(text)
        hits = self.probes.intersection(words)
        places = set()
        if hits:
            at: dict[bytes, list[int]] = {w: [] for w in hits}
            for i, w in enumerate(words):
                if w in hits:
                    at[w].append(i)
            for word in sorted(hits, key=lambda w: (-self.idf[w], w)):
                for n, k, q in self.postings[word]:
                    for p in at[word]:
                        for start, coverage in self._verified(n, k, p - q, words):
                            places.add((self.templates[n].label, max(0, start), len(self.words[n]), coverage, self.templates[n].base))
        keys = ("label", "first", "words", "coverage", "base")
        found = [dict(zip(keys, p)) for p in sorted(places)]
        return {"n_words": len(words), "score": max((p["coverage"] for p in found), default=0.0), "places": found}


def build(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> Index:
    """The index with IDFs from all rows of ``docs``."""
    counts, total = file_counts(docs, vocabulary(templates), text), docs.count()
    return Index({w: math.log((total + 1) / (n + 0.5)) for w, n in counts.items()}, templates)


def scan(docs: DataFrame, index: Index, out: str = "license", text: str = "text") -> DataFrame:
    """Adds a column with what ``Index.find`` says of every whole text; null and empty texts have no words."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(FOUND)
    def look(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.find(t.as_py()) for t in texts], _FOUND)

    return docs.withColumn(out, look(F.col(text)))
