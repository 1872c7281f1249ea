"""Quotation linking: from mail-like messages with quoted lines to reply-ordered conversations without quotes.

A line's quote level is the number of ``>`` at its start. Neighbouring quoted lines of one level are a passage; the lines
without a mark are the message's own text. Passages are normalised and hashed, and looked up among the hashes of the own
texts of all earlier messages of the same scope, whole, then line by line. The shallowest passage that is found names the
message replied to. Pointers are then doubled until every message knows the first of its thread and its depth.

Only DataFrame functions are used. A hash is one row however many messages hold it, and threads are numbered in pieces, so
no key or conversation has to fit into one task; what is grouped by message is bounded by the message's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import SMALLEST, aside, store
from ledgerflow.plans.splits import cumulate, find_splits

MARKS = r"^((?:[ \t]*>)+)"
BEFORE = r"^(?:[ \t]*>)+[ \t]?"
# After each line end; CR LF is one.
AFTER_LINE = r"(?<=\n)|(?<=\r)(?!\n)"
LINE_END = r"(?:\r\n|\r|\n)\z"
# A line that looks like a quote, perhaps escaped already, and an escaped one.
LIKE_QUOTE = r"^(\\*[ \t]*>)"
ESCAPED = r"^\\(\\*[ \t]*>)"


def normal(text: Column) -> Column:
    """A text in lower case with single blanks."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def hashed(text: Column) -> Column:
    """128 bits of a normalised text as text; null for an empty one, which says nothing."""
    return F.when(F.length(text) > 0, F.md5(text.cast("binary")))


def parsed(messages: DataFrame, text: str = "text", escaped: bool = False) -> DataFrame:
    """Adds ``own`` (the text without quotes) and ``passages`` (level, text) in the order they stand.

    Own lines keep their line ends. ``escaped`` texts have a backslash before lines that are no quotes but look like one, which
    is taken off again (``as_mail``). Columns called ``own`` and ``passages`` are replaced; no name may start with ``_``.
    """
    lines = F.split(F.coalesce(F.col(text), F.lit("")), AFTER_LINE, -1)
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", ""))
    body = lambda x: F.regexp_replace(F.regexp_replace(x, BEFORE, ""), LINE_END, "")
    plain = lambda x: F.regexp_replace(body(x), ESCAPED, "$1") if escaped else body(x)
    end = lambda x: F.regexp_extract(x, LINE_END, 0)
    marked = F.transform(lines, lambda x: F.struct(level(x).alias("level"), plain(x).alias("body"), end(x).alias("end")))
    numbers = F.sequence(F.lit(0), F.size("_lines") - 1)
    # Places where the level changes; a passage reaches from one to the next.
    starts = F.filter(numbers, lambda i: (i == 0) | (F.get("_lines", i)["level"] != F.get("_lines", i - 1)["level"]))
    bodies = lambda a, b: F.array_join(F.transform(F.slice("_lines", a + 1, b - a), lambda x: x["body"]), "\n")
    passage = lambda s, n: F.struct(
        F.get("_lines", s)["level"].alias("level"), bodies(s, F.coalesce(F.get("_starts", n + 1), F.size("_lines"))).alias("text")
    )
    # The last own line's end only parts it from a quote.
    mine = F.filter("_lines", lambda x: x["level"] == 0)
    ended = lambda x, n: F.concat(x["body"], F.when(n < F.size("_mine") - 1, x["end"]).otherwise(F.lit("")))
    return (
        messages.withColumn("_lines", marked)
        .withColumns({"_starts": starts, "_mine": mine})
        .withColumn("own", F.array_join(F.transform("_mine", ended), ""))
        .withColumn("passages", F.filter(F.transform("_starts", passage), lambda p: p["level"] > 0))
        .drop("_lines", "_starts", "_mine")
    )


def line_hashes(text: Column) -> Column:
    """The hashes of a text's lines, without those of blank ones."""
    return F.filter(F.transform(F.split(text, "\r\n|\r|\n"), lambda x: hashed(normal(x))), lambda h: h.isNotNull())


def parents(messages: DataFrame) -> DataFrame:
    """(scope, place, parent) of the messages that quote an earlier one of their scope.

    A passage is looked up whole, first among whole own texts, then among their lines; the lines of a passage that is not
    found so are looked up in their order. Of messages with the same text the earliest counts. Of a message's passages the
    shallowest one found decides, of those the first way of these to find one, then the latest message.
    """
    entire = hashed(normal(F.col("own")))
    others = F.transform(F.array_distinct(line_hashes(F.col("own"))), lambda h: F.struct(h.alias("hash"), F.lit(False).alias("entire")))
    keys = F.array_append(others, F.struct(entire.alias("hash"), F.lit(True).alias("entire")))
    originals = messages.select("scope", "place", F.inline(keys)).filter("hash IS NOT NULL")
    earliest = originals.groupBy("scope", "hash").agg(F.min(F.when(F.col("entire"), F.col("place"))).alias("whole"), F.min("place").alias("any"))
    earliest = store(earliest, "quoted-hashes")
    best = F.min(F.struct("level", "rank", F.bitwise_not("parent").alias("back"))).alias("best")

    wanted = F.transform("passages", lambda p: F.struct(p["level"].alias("level"), hashed(normal(p["text"])).alias("hash")))
    asked = store(messages.select("scope", "place", F.inline(wanted)).filter("hash IS NOT NULL").distinct(), "quoted-passages")
    early = F.coalesce(F.col("whole") < F.col("place"), F.lit(False))
    found = asked.join(earliest, ["scope", "hash"]).withColumns(
        {"rank": F.when(early, 0).otherwise(1), "parent": F.when(early, F.col("whole")).otherwise(F.col("any"))}
    )
    found = store(found.filter("parent < place").groupBy("scope", "place").agg(best), "quoted-whole")

    # Only messages with a passage above all that are found whole look up lines, and only of such passages.
    top = asked.groupBy("scope", "place").agg(F.min("level").alias("top"))
    open_ = top.join(found, ["scope", "place"], "left").filter("best IS NULL OR top < best.level")
    open_ = store(open_.select("scope", "place", F.col("best.level").alias("below")), "quoted-open")
    if not open_.isEmpty():
        left = messages.select("scope", "place", "passages").join(open_, ["scope", "place"])
        left = left.select("scope", "place", "below", F.inline("passages")).filter("below IS NULL OR level < below")
        lines = left.select("scope", "place", "level", F.posexplode(line_hashes(F.col("text"))).alias("n", "hash"))
        lines = lines.groupBy("scope", "place", "level", "hash").agg((F.min("n") + 2).alias("rank"))
        more = lines.join(earliest, ["scope", "hash"]).withColumnRenamed("any", "parent").filter("parent < place")
        found = found.unionByName(more.groupBy("scope", "place").agg(best)).groupBy("scope", "place").agg(F.min("best").alias("best"))
    return found.select("scope", "place", F.bitwise_not("best.back").alias("parent"))


def threads(nodes: DataFrame) -> DataFrame:
    """(scope, place, parent, root, depth) for nodes with distinct (scope, place) and a parent or null, by pointer doubling.

    A node is settled once it points to a root. In each round only the others look up what they point to, and what that
    points to becomes theirs.
    """
    top = F.col("parent").isNull()
    first = nodes.select(
        "scope", "place", "parent", F.coalesce("parent", "place").alias("root"), F.when(top, 0).otherwise(1).alias("depth"), top.alias("settled")
    )
    now = store(first, "threads")
    while not now.filter("NOT settled").isEmpty():
        target = now.select(*[F.col(c).alias(f"_{c}") for c in ("scope", "place", "root", "depth", "settled")])
        moving = now.filter("NOT settled").join(target, (F.col("scope") == F.col("_scope")) & (F.col("root") == F.col("_place")))
        moved = moving.select(
            "scope", "place", "parent", F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_settled").alias("settled")
        )
        now = store(now.filter("settled").unionByName(moved), "threads")
    return now.drop("settled")


def conversations(
    messages: DataFrame, scope: str, place: str, text: str = "text", rows_per_task: int | None = None, escaped: bool = False
) -> DataFrame:
    """``messages`` with parent, root, depth, position, own and n_quotes.

    ``scope`` names where quotes are looked up, such as a mailbox; ``place`` orders messages in time within it. A thread is
    a root with all replies to it and to each other; ``position`` counts its messages from 0 by depth, then time, so each
    follows the one it answers. Columns of ``messages`` with these names are replaced. Null scopes and places are one of their own, before all others. Messages at one place share
    parent, root and depth and are numbered in the order of their own texts. Null texts are empty and quote nothing.
    """
    # The caller's columns get names of their own, so that none of them meets a name used here.
    mine = {c: f"_in{n}" for n, c in enumerate(messages.columns)}
    least, inner = F.lit(SMALLEST), messages.withColumnsRenamed(mine)
    keyed = inner.withColumns({k: F.coalesce(F.col(mine[c]).cast("long"), least) for k, c in (("scope", scope), ("place", place))})
    split = store(parsed(keyed, mine[text], escaped), "messages")
    known = split.select("scope", "place").distinct().join(parents(split), ["scope", "place"], "left")
    tree = threads(known)
    placed = split.withColumn("n_quotes", F.size("passages")).drop("passages").join(tree, ["scope", "place"])
    placed = placed.withColumn("_own", F.md5(F.col("own").cast("binary")))
    splits = find_splits(placed, ["scope", "root"], ["depth", "place", "_own"], rows_per_task=rows_per_task)
    numbered = cumulate(placed, splits, {"position": F.lit(1).cast("long")})
    named = lambda c: F.when(F.col(c) != least, F.col(c)).alias(c)
    kept = [F.col(i).alias(c) for c, i in mine.items() if c not in ("parent", "root", "depth", "position", "own", "n_quotes")]
    return numbered.select(*kept, named("parent"), named("root"), "depth", (F.col("position") - 1).alias("position"), "own", "n_quotes")


def escaped_lines(text: Column, mark: str) -> Column:
    """A text with a mark before each line, and a backslash before the lines that look like quotes."""
    line = lambda x: F.concat(F.lit(mark), F.regexp_replace(x, LIKE_QUOTE, "\\\\$1"))
    return F.array_join(F.transform(F.split(text, AFTER_LINE, -1), line), "")


def as_mail(turns: DataFrame, scope: str, place: str, text: str = "text") -> DataFrame:
    """Turns of conversations as mail: each quotes the turn before (``> ``) and the one before that (``>> ``) in full.

    ``place`` counts turns by one. Turns are matched by number, so no conversation is gathered; of repeated rows of a turn
    the smallest text is quoted, a turn whose texts are null is not. Lines of a turn that look like quotes get a backslash, so
    that nothing of a turn is taken for a quote (``escaped``). Other columns may have any name.
    """
    rows, back = aside(turns, scope, place, text)
    names = {scope: "scope_", place: "place_", text: "text_"}
    rows = rows.withColumnsRenamed(names)
    said = rows.groupBy(F.col("scope_").alias("of"), F.col("place_").alias("at")).agg(F.min("text_").alias("said"))
    for far in (1, 2):
        earlier = said.withColumnsRenamed({"said": f"said{far}"})
        rows = rows.join(earlier, (F.col("scope_") == F.col("of")) & (F.col("place_") - far == F.col("at")), "left").drop("of", "at")
    own = escaped_lines(F.coalesce("text_", F.lit("")), "")
    body = F.concat_ws("\n", escaped_lines(F.col("said2"), ">> "), escaped_lines(F.col("said1"), "> "), own)
    return back(rows.withColumn("text_", body).drop("said1", "said2").withColumnsRenamed({v: k for k, v in names.items()}))
