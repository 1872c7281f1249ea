from collections import Counter

import duckdb
from pyspark.sql import functions as F

from ledgerflow.llm import quotes
from ledgerflow.llm.queries import ORACLES, QUERIES
from tests.compare import rows as as_rows

SCHEMA = "box long, sent long, text string, own string, scope string, depth string"


def table(spark, messages, box=1):
    return spark.createDataFrame([(box, i, t, "o", "s", "d") for i, t in messages], SCHEMA)


def linked(df, **more):
    got = quotes.conversations(df, "box", "sent", **more).collect()
    return {r.sent: r for r in got}


def test_levels_and_passages(spark):
    text = "Hi\n> a\n>> b\n> >  c\n>d\n  > e\nown >\n\n>>> f\n> "
    got = quotes.parsed(spark.createDataFrame([(text,)], "text string")).first()
    assert got.own == "Hi\nown >\n"
    assert [(p.level, p.text) for p in got.passages] == [(1, "a"), (2, "b\n c"), (1, "d\ne"), (3, "f"), (1, "")]


def test_threads_are_found_from_quotes(spark):
    """Replies to different messages, nested quotes, quotes of a part, and in other case and spacing."""
    got = linked(
        table(
            spark,
            [
                (0, "First question\nwith two lines"),
                (1, "> first   QUESTION\n> with two lines\nAn answer"),
                (2, ">> First question\n>> with two lines\n> An answer\nThanks"),
                (3, "> First question\nOnly its first line"),
                (4, "Another thread"),
                (5, "intro\n> Another thread\nmiddle\n> unknown\nend"),
                (6, "> nothing we know\nalone"),
                (7, ">> An answer\nquoted at the second level only"),
            ],
        )
    )
    assert {k: r.parent for k, r in got.items()} == {0: None, 1: 0, 2: 1, 3: 0, 4: None, 5: 4, 6: None, 7: 1}
    assert {k: (r.root, r.depth) for k, r in got.items()} == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 1), 4: (4, 0), 5: (4, 1), 6: (6, 0), 7: (0, 2)}
    assert [k for k, r in sorted(got.items(), key=lambda x: (x[1].root, x[1].position))] == [0, 1, 3, 2, 7, 4, 5, 6]
    assert got[5].own == "intro\nmiddle\nend" and got[5].n_quotes == 2 and got[2].own == "Thanks"


def test_only_earlier_messages_of_the_scope_are_answered(spark):
    both = table(spark, [(0, "> later\nx"), (1, "later"), (2, "> only elsewhere\ny")]).unionByName(table(spark, [(0, "only elsewhere")], 2))
    got = quotes.conversations(both, "box", "sent").collect()
    assert all(r.parent is None for r in got) and len(got) == 4


def test_copies_answer_the_earliest(spark):
    messages = [(i, "Same words") for i in range(50)] + [(50 + i, "> same words\nreply %d" % i) for i in range(30)]
    got = linked(table(spark, messages), rows_per_task=7)
    assert all(got[50 + i].parent == 0 for i in range(30))
    assert sorted(got[50 + i].position for i in range(30)) == list(range(1, 31))


def test_long_chains(spark):
    messages = [(0, "message 0")] + [(i, f"> message {i - 1}\nmessage {i}") for i in range(1, 150)]
    got = linked(table(spark, messages), rows_per_task=11)
    assert all((r.root, r.depth, r.position) == (0, i, i) for i, r in got.items())


def test_all_cases(spark):
    long = "\n".join(f"line {i}" for i in range(20000))
    messages = [(1, None), (2, ""), (3, "\n\n"), (4, ">"), (5, "> "), (6, long), (7, "\n".join("> " + x for x in long.split("\n")) + "\nyes"), (7, "again"), (7, "again"), (None, "no place"), (8, "> no place\nit is earlier")]
    got = quotes.conversations(table(spark, messages), "box", "sent").collect()
    assert len(got) == len(messages)
    assert Counter((r.sent, r.parent) for r in got if r.parent is not None) == {(7, 6): 3}
    assert {r.sent: r.depth for r in got}[8] == 1
    assert {r.own for r in got if r.sent == 7} == {"yes", "again"} and set(got[0].asDict()) >= {"scope", "position", "own"}
    nulls = quotes.conversations(table(spark, [(1, "a"), (2, "> a\nb")], None), "box", "sent").collect()
    assert {r.sent: r.parent for r in nulls} == {1: None, 2: 1} and all(r.box is None for r in nulls)


def test_mail_quotes_whole_turns(spark):
    turns = spark.createDataFrame([(1, 0, "a\n\nb\n"), (1, 1, "c"), (1, 2, None), (1, 2, "x"), (2, 1, "d")], "conv long, turn long, text string")
    got = {(r.conv, r.turn, r.text) for r in quotes.as_mail(turns, "conv", "turn").collect()}
    assert got == {(1, 0, "a\n\nb\n"), (1, 1, "> a\n> \n> b\n> \nc"), (1, 2, ">> a\n>> \n>> b\n>> \n> c\n"), (1, 2, ">> a\n>> \n>> b\n>> \n> c\nx"), (2, 1, "d")}


def test_no_python_on_the_way(spark, capsys):
    quotes.conversations(quotes.as_mail(table(spark, [(0, "a"), (1, "b")]), "box", "sent"), "box", "sent").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_messages(spark):
    assert quotes.conversations(spark.createDataFrame([], SCHEMA), "box", "sent").count() == 0
    assert quotes.as_mail(spark.createDataFrame([], SCHEMA), "box", "sent").filter(F.lit(True)).count() == 0


def test_any_line_of_a_partial_quote_is_found(spark):
    got = linked(
        table(
            spark,
            [
                (0, "First line\nSecond line\nThird line"),
                (1, "> First line, edited\n> Second line\n> Third line\nreply"),
                (2, "> Somebody wrote:\n>\n> third LINE\nreply two"),
                (3, ">> First line\n>> Second line\n>> Third line\n> cut off\n> reply two\nreply three"),
                (4, "> nothing\n> of this\n>> reply\nreply four"),
            ],
        )
    )
    assert {k: r.parent for k, r in got.items()} == {0: None, 1: 0, 2: 0, 3: 2, 4: 1}


def test_whole_originals_come_before_those_with_such_a_line(spark):
    got = linked(table(spark, [(0, "Yes\nand more"), (1, "No"), (2, "Yes"), (3, "> Yes\nreply"), (4, "> and more\nother")]))
    assert {k: r.parent for k, r in got.items()} == {0: None, 1: None, 2: None, 3: 2, 4: 0}


ODD_TURNS = [
    (0, 0, "a\nb"), (0, 1, "a"), (0, 2, "c"),
    (1, 0, "x"), (1, 1, "> not a quote\nown\n >> also\n\\> and"), (1, 2, "reply"), (1, 3, "\\\\>x"),
    (2, 0, "a\r\nb\rc\r"), (2, 1, "y\r\n"), (2, 2, "\n"), (2, 3, "z"),
    (3, 0, "t"), (3, 1, None), (3, 2, "u"), (3, 3, "v"),
    (4, 0, "p"), (4, 1, "q"), (4, 1, "q"), (4, 2, "r"),
    (5, 0, "first LINE\nsecond"), (5, 1, "k"), (5, 2, "First  line\nedited"), (5, 3, "K "), (5, 4, ""), (5, 5, " "), (5, 6, "w"),
    (6, 0, "s"), (6, 1, "m1"), (6, 1, "m2"), (6, 2, "n"),
]


def test_odd_turns_against_sql(spark, tmp_path):
    """Lines that look like quotes, other line ends, nulls, blank and repeated turns: the query, its SQL, and no text lost."""
    turns = spark.createDataFrame([(c, t, "user", x) for c, t, x in ODD_TURNS], "conv_id long, turn long, role string, text string")
    turns.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    df = QUERIES["op8_quotes"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    found = con.execute(ORACLES["op8_quotes"])
    got = [tuple(r) for r in df.collect()]
    assert as_rows(df.columns, got) == as_rows([d[0] for d in found.description], found.fetchall())
    assert Counter((r.conv_id, r.turn, r.own) for r in df.collect()) == Counter((c, t, x or "") for c, t, x in ODD_TURNS)


def test_mail_keeps_columns_of_any_name(spark):
    names = ("_scope", "_place", "_said1", "said", "of", "at", "scope_", "given0")
    turns = spark.createDataFrame([(1, 0, "a", *names), (1, 1, "b", *names)], "conv_id long, turn long, text string, " + ", ".join(f"{n} string" for n in names))
    mail = quotes.as_mail(turns, "conv_id", "turn")
    assert mail.columns == turns.columns and all(tuple(r)[3:] == names for r in mail.collect())
    assert sorted(r.text for r in mail.collect()) == ["> a\nb", "a"]
