"""The registered queries of this folder and, where SQL can say it, the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import contamination, licenses, packing, pieces, quality, quotes, ranking, repair, repeats, shards, simhash, sketches, warc
from ledgerflow.settings import scratch_dir, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@query(
    "op5_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM w
""",
)
def _(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    back = warc.round_trip(pages, least=1000)
    answer = F.col("record_type") == "response"
    return back.select(
        F.expr("try_cast(record_id AS bigint)").alias("page_id"),
        F.when(answer, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(answer, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op9_shards")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = scratch_dir(spark, "shard-map")
    rows = shards.records(docs)
    shards.save_map(shards.first_map(spark, 16), path)
    shards.save_map(shards.rebalance(shards.load_map(spark, path), shards.slot_bytes(rows), 16), path)
    placed = shards.place(rows, shards.load_map(spark, path))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


@query("op4_simhash")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = simhash.near_duplicates(docs, width=3, radius=2)
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query("op2_packing")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024).drop("ids")


@query("op6_repeats")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    cut = repeats.remove_repeats(docs, least=200)
    return cut.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "_cut.n_removed",
        "_cut.n_spans",
        F.sha2("_cut.kept", 256).alias("kept_sha256"),
    )


# The contract's phrase for mit is one word longer than the operator's, which stays as a notice that gives the label only.
CONTRACT_BASE = (licenses.Template("mit", "under the mit license", base=True),)
LICENSES = CONTRACT_BASE + tuple(replace(t, base=False) if t.text == "the mit license" else t for t in licenses.TEMPLATES)


@query("op3_licenses")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = licenses.scan(docs, licenses.build(docs, LICENSES))
    base = F.filter("license.places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])
    named = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id",
        "license.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("license.places")).alias("labels"),
        "license.score",
    )


@query("op7_quality")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = quality.with_score(docs, model)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op1_contamination")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return contamination.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op10_sketches")
def _(spark, folder):
    return sketches.against_next(spark.read.parquet(f"{folder}/documents.parquet"))


# Each turn as mail quotes the two turns before it; what it answers is then found again from the quotes alone.
NORMAL = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"


@query(
    "op8_quotes",
    f"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS own FROM conversations),
said AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY ALL HAVING min(text) IS NOT NULL),
earliest AS (
  SELECT conv_id, {NORMAL.format("own")} AS key, min(turn) AS parent FROM m WHERE {NORMAL.format("own")} <> '' GROUP BY ALL),
asked AS (
  SELECT a.conv_id, a.turn, b.level, {NORMAL.format("q.text")} AS key
  FROM (SELECT DISTINCT conv_id, turn FROM m) a, (VALUES (1), (2)) b(level), said q
  WHERE q.conv_id = a.conv_id AND q.turn = a.turn - b.level),
quotes AS (SELECT conv_id, turn, count(*) AS n FROM asked GROUP BY ALL),
found AS (
  SELECT a.conv_id, a.turn, e.parent, row_number() OVER (PARTITION BY a.conv_id, a.turn ORDER BY a.level) AS n
  FROM asked a JOIN earliest e ON e.conv_id = a.conv_id AND e.key = a.key WHERE e.parent < a.turn),
tree AS (
  SELECT m.conv_id, m.turn, CAST(NULL AS BIGINT) AS parent, m.turn AS root, 0 AS depth
  FROM (SELECT DISTINCT conv_id, turn FROM m) m WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.conv_id = m.conv_id AND f.turn = m.turn)
  UNION ALL
  SELECT f.conv_id, f.turn, f.parent, t.root, t.depth + 1 FROM found f JOIN tree t ON f.conv_id = t.conv_id AND f.parent = t.turn
  WHERE f.n = 1)
SELECT m.conv_id, m.turn, m.role, t.parent, t.root, t.depth,
       row_number() OVER (PARTITION BY m.conv_id, t.root ORDER BY t.depth, m.turn, md5(m.own)) - 1 AS position,
       m.own, coalesce(q.n, 0)::INT AS n_quotes
FROM m JOIN tree t USING (conv_id, turn) LEFT JOIN quotes q USING (conv_id, turn)
""",
)
def _(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    mail = quotes.as_mail(turns, "conv_id", "turn")
    return quotes.conversations(mail, "conv_id", "turn", escaped=True).drop("text")


@query(
    "op12_ranking",
    """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(words))::BIGINT AS length FROM d WHERE len(words) > 0),
c AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term),
i AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT item_id, text, row_number() OVER () AS item FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)))),
scored AS (
  SELECT item, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM i JOIN c USING (term) JOIN f USING (term), s GROUP BY item, r)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
""",
)
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return ranking.search(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), top=50)


@query("op13_pieces")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        (F.octet_length("pieces.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("pieces.ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("pieces.decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


# The same edits as a walk over the rows: per state the cheapest way so far and, of equal ones, the audit that sorts first.
@query(
    "op11_repair",
    """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
fated AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
                            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS fate FROM given, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM hurt),
rows_ AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN said > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS initial FROM told),
steps(initial, a, b) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
put(a, b, cost, letters) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')),
edits AS (
  SELECT conv_id, n, s.a, s.b, 2 AS cost, 'D' AS letter FROM rows_, (VALUES (0, 0), (1, 1), (2, 2), (3, 3)) s(a, b)
  UNION ALL SELECT r.conv_id, n, a, b, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K' FROM rows_ r JOIN steps s ON s.initial = r.initial
    WHERE fault IN ('', 'truncated')
  UNION ALL SELECT conv_id, n, a, b, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R' FROM rows_, steps s
    WHERE fault IN ('', 'truncated') AND s.initial <> 's'),
moves AS (
  SELECT conv_id, n, e.a, p.b, min(struct_pack(cost := e.cost + p.cost, letters := e.letter || p.letters)) AS way
  FROM edits e JOIN put p ON p.a = e.b GROUP BY ALL),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, p.b AS state, struct_pack(cost := p.cost, letters := p.letters) AS way FROM given, put p WHERE p.a = 0
  UNION ALL
  SELECT w.conv_id, w.n + 1, m.b, min(struct_pack(cost := w.way.cost + m.way.cost, letters := w.way.letters || m.way.letters))
  FROM walk w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1 AND m.a = w.state GROUP BY w.conv_id, w.n, m.b),
sizes AS (
  SELECT conv_id, count(n) AS size, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
         count_if(fault = 'truncated') AS truncated, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM rows_) GROUP BY conv_id),
best AS (
  SELECT w.conv_id, min(w.way) AS way FROM walk w LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.n = coalesce(s.size, 0) AND w.state IN (0, 3) GROUP BY w.conv_id),
spelled AS (
  SELECT conv_id, p, letters[p] AS letter, len(replace(letters[1:p], 'I', '')) AS n, len(replace(letters[1:p], 'D', '')) AS place
  FROM (SELECT conv_id, way.letters AS letters, unnest(range(1, len(way.letters) + 1)) AS p FROM best)),
kept AS (
  SELECT s.conv_id, s.p, s.letter, s.place, r.role, r.text,
         max(CASE WHEN s.place = 1 AND s.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS system
  FROM spelled s LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.n = s.n WHERE s.letter <> 'D'),
joined AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                             CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body FROM kept GROUP BY conv_id)
SELECT b.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, b.way.cost::BIGINT AS cost, b.way.letters AS audit, sha256(coalesce(j.body, '')) AS repaired_sha256
FROM best b LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM b.conv_id
""",
)
def _(spark, folder):
    return repair.audits(repair.damaged(repair.prepared(spark.read.parquet(f"{folder}/conversations.parquet"))))
