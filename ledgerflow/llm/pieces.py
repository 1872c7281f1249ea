"""Encoding into the pieces of a merge-type (BPE) SentencePiece model, and decoding.

The library merges the best-scored pair of neighbouring symbols, the leftmost of equals, until no pair is a piece. The same
ids are found here without a queue of merges, by backtracking:

* an Aho-Corasick automaton of all pieces gives the pieces that begin at each character, the longest first,
* a piece may follow another if merging the two pieces' characters anew gives these two pieces; a sequence of which all
  neighbours pass is the one that the merges lead to,
* a character from which no piece leads on is marked in a bit field and never entered again: a prefix has one encoding at
  most, so the mark holds however the place was reached.

No piece has a blank after another character, so texts fall into words that cannot merge with each other; words are encoded
once for each worker while the cache has room. Characters that are no piece stand alone and become their UTF-8 bytes.
Only the vocabulary is read with the library.

Null counts as empty. An empty text has only the ids of begin and end. Rows that repeat are encoded as often as they occur,
ids and other columns may be null or have any name, an empty table gives an empty one. Texts are encoded whole; a word of any
length costs work in proportion to its length.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = "▁"
# Entries of the caches of a worker, for words in two halves; full pairs start anew. Longer words are not kept.
WORDS, PAIRS, LONGEST = 1 << 19, 1 << 19, 64
# Ids are below this; two of them make one number.
SHIFT = 1 << 31
NEVER = float("-inf")

ENCODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])


def packed(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """word, with spaces for blanks -> (ids, decoded text), computed when first asked for.

    A full half becomes the old one, and a word asked for again moves over: frequent words outlast those that come once.
    """

    def __init__(self, model: Model):
        self.model = model
        self.old: dict[str, tuple[bytes, str]] = {}

    def __missing__(self, word: str) -> tuple[bytes, str]:
        found = self.old.get(word)
        if found is None:
            ids = self.model.merged(word.replace(" ", BLANK))
            shown = self.model.surface(ids)
            found = (packed(ids), word if shown == word else shown)  # mostly the word itself, kept once
        if len(word) <= LONGEST:
            if 2 * len(self) >= WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


class Model:
    """A model's vocabulary, the automaton of its pieces and what a worker remembers."""

    def __init__(self, path: str):
        read = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(read.get_piece_size())
        self.begin, self.end, self.unknown = read.bos_id(), read.eos_id(), read.unk_id()
        self.bytes = {read.id_to_piece(i): i for i in every if read.is_byte(i)}
        special = {i for i in every if read.is_control(i) or read.is_unknown(i) or read.is_byte(i)}
        self.ids = {read.id_to_piece(i): i for i in every if i not in special}
        self.scores = {p: read.get_score(i) for p, i in self.ids.items()}
        self.check(read)
        self.shown: list[str | int] = [""] * len(every)  # text of a piece; a byte piece is its byte
        for piece, i in self.ids.items():
            self.shown[i] = piece.replace(BLANK, " ")
        for piece, i in self.bytes.items():
            self.shown[i] = int(piece[1:-1], 16)
        if self.unknown >= 0:
            self.shown[self.unknown] = " ⁇ "
        self.byte_ids = [self.bytes[f"<0x{b:02X}>"] for b in range(256)] if self.bytes else None
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), piece, i))
        self.automaton.make_automaton()
        self.size, self.shorter = [0] * len(every), [None] * len(every)
        for piece, i in self.ids.items():
            begins = (self.ids.get(piece[:n]) for n in range(len(piece) - 1, 0, -1))
            # The longest other piece that this one begins with.
            self.size[i], self.shorter[i] = len(piece), next((b for b in begins if b is not None), None)
        # Words begin with blanks, and lines stand alone where no piece holds a line end.
        alone = "" if any("\n" in p for p in self.ids) else "\n"
        self.word = re.compile(f" +[^ {alone}]*|[^ {alone}]+" + (f"|{alone}+" if alone else ""))
        self.words = Words(self)
        self.texts = {i: p for p, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}  # by left id * SHIFT + right id
        self.alone: dict[int, bool] = {}

    def check(self, read: sentencepiece.SentencePieceProcessor) -> None:
        """Refuses models with rules that this encoder does not have."""
        probe = "Aﬁ  　é "
        if read.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("only models that leave texts as they are and put a blank in front are read")
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("pieces with a blank after another character are not read")
        if any(read.is_unused(i) for i in self.ids.values()):
            raise ValueError("models with unused pieces are not read")

    @staticmethod
    @lru_cache(maxsize=4)
    def of(path: str) -> Model:
        return Model(path)

    def remerge(self, text: str) -> list[str]:
        """What merging the characters of a short text leads to."""
        parts, score = list(text), self.scores.get
        # The score of each part with the next one; only those beside a merge change.
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)  # the leftmost of equals
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def reachable(self, piece: int) -> bool:
        """Whether the merges ever lead to a piece."""
        found = self.alone.get(piece)
        if found is None:
            text = self.texts[piece]
            found = self.alone[piece] = self.remerge(text) == [text]
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces stay as they are when their characters are merged anew; remembered in ``pairs``."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        a, b = self.texts[left], self.texts[right]
        found = self.pairs[left * SHIFT + right] = self.remerge(a + b) == [a, b]
        return found

    def merged(self, word: str) -> list[int]:
        """The ids of a word: the longest pieces in a row if all neighbours pass, by backtracking otherwise."""
        out, before, size, known = [], None, 0, self.pairs.get
        for _, (length, _, piece) in self.automaton.iter_long(word):
            if before is None:
                passes = self.reachable(piece)
            else:
                passes = known(before * SHIFT + piece)
                if passes is None:
                    passes = self.compatible(before, piece)
            if not passes:
                break
            size, before = size + length, piece
            out.append(piece)
        return out if size == len(word) else self.backtracked(word)

    def backtracked(self, word: str) -> list[int]:
        """The ids of a word, by backtracking over the pieces that begin at each character, the longest first."""
        size, known, shorter, sizes = len(word), self.pairs.get, self.shorter, self.size
        longest: list[int | None] = [None] * (size + 1)
        for last, (length, _, piece) in self.automaton.iter(word):
            longest[last + 1 - length] = piece  # shorter ones come first
        failed = bytearray(size // 8 + 1)
        # One entry per piece taken: where it begins and its id.
        taken: list[tuple[int, int | None]] = []
        place, before = 0, None
        piece = longest[0]
        while place < size:
            if piece is None:
                taken.append((place, None))  # a character that is no piece
                place, before = place + 1, None
                piece = longest[place]
                continue
            while piece is not None:
                end = place + sizes[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before is None:
                        passes = self.reachable(piece)
                    else:
                        passes = known(before * SHIFT + piece)
                        if passes is None:
                            passes = self.compatible(before, piece)
                    if passes:
                        taken.append((place, piece))
                        place, before = end, piece
                        piece = longest[place]
                        break
                piece = shorter[piece]
            else:
                # No piece leads on from here, so the one before gives way to a shorter one, if there is any.
                while piece is None:
                    failed[place >> 3] |= 1 << (place & 7)
                    place, gone = taken.pop()
                    piece = shorter[gone]
                before = taken[-1][1] if taken else None
        out: list[int] = []
        for begin, piece in taken:
            if piece is not None:
                out.append(piece)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in word[begin].encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def surface(self, ids: Iterable[int]) -> str:
        """The text of ids without regard to what begins the text; runs of bytes are read as UTF-8."""
        shown_all = [self.shown[i] for i in ids]
        if int not in map(type, shown_all):
            return "".join(shown_all)
        out: list[str] = []
        run = bytearray()
        for shown in shown_all:
            if isinstance(shown, int):
                run.append(shown)
                continue
            if run:
                out.append(readable(run))
                run = bytearray()
            out.append(shown)
        if run:
            out.append(readable(run))
        return "".join(out)

    def encoded(self, text: str | None) -> tuple[bytes, str]:
        """(ids between begin and end as little-endian 32-bit numbers, the text that they decode to)."""
        begin, end = packed([self.begin]), packed([self.end])
        if not text:
            return begin + end, ""
        ids, shown = zip(*map(self.words.__getitem__, self.word.findall(" " + text.replace(BLANK, " "))))
        return begin + b"".join(ids) + end, "".join(shown)[1:]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of any ids; special ids show nothing, and the blank put in front is taken off again."""
        own = [i for i in ids if self.shown[i] != ""]
        found = self.surface(own)
        return found[1:] if own and isinstance(self.shown[own[0]], str) and own[0] != self.unknown and found.startswith(" ") else found


def readable(run: bytearray) -> str:
    """Bytes as UTF-8, one replacement character for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(run[at : at + size]).decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def with_pieces(docs: DataFrame, model: str, out: str = "pieces", text: str | Column = "text") -> DataFrame:
    """Adds ``out``, a struct of ``ids`` (binary, little-endian unsigned 32-bit numbers, begin and end included) and the
    ``decoded`` text. A column of that name is replaced; all others stay as they are."""

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        known = Model.of(model)
        found = [known.encoded(t.as_py()) for t in texts]
        ids, decoded = pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())
        return pa.StructArray.from_arrays([ids, decoded], names=ENCODED.names)

    return docs.withColumn(out, encode(F.col(text) if isinstance(text, str) else text))
