"""Rejected records, published tables and the first alerts of a stream."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.checksums import checksums
from ledgerflow.catalog.live import FLAGS
from ledgerflow.catalog.registry import query
from ledgerflow.plans.adapter_sql import oracle
from ledgerflow.settings import MONEY, scratch_dir
from ledgerflow.sources import published, rejects
from ledgerflow.streaming import first
from ledgerflow.streaming import live as s

RECORD = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("amount", MONEY),
        T.StructField("tx_type", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)
TIMES = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
FILES = 4


def as_text(name):
    c = F.col(name)
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss") if name == "timestamp" else c.cast("string"), F.lit(""))


def damaged(good, *bad):
    """Lines of which some, chosen by their id, are replaced by others."""
    out = good
    for prime, text in zip((97, 101, 103), bad):
        out = F.when(F.col("transaction_id") % prime == 3, text).otherwise(out)
    return out.alias("value")


def csv_lines(tx):
    fields = {c: as_text(c) for c in RECORD.names}
    good = F.concat_ws(",", *fields.values())
    wrong = F.concat_ws(",", *{**fields, "amount": F.lit("n/a")}.values())
    return tx.select(damaged(good, wrong, fields["transaction_id"], F.concat(good, F.lit(",left over"))))


def json_lines(tx):
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    start = F.concat(F.lit('{"transaction_id":'), as_text("transaction_id"))
    rest = F.concat(
        F.when(F.col("tx_type").isNotNull(), F.concat(F.lit(',"tx_type":'), quoted(as_text("tx_type")))).otherwise(F.lit("")),
        F.lit(',"timestamp":'),
        quoted(as_text("timestamp")),
        F.lit("}"),
    )
    amount = F.when(F.col("amount").isNotNull(), F.concat(F.lit(',"amount":'), as_text("amount"))).otherwise(F.lit(""))
    good = F.concat(start, amount, rest)
    return tx.select(damaged(good, F.concat(start, F.lit(',"amount":"n/a"'), rest), F.concat(start, amount), F.lit("[1, 2")))


# The same lines as SQL.
CSV_SQL = """
SELECT *, concat_ws(',', transaction_id::VARCHAR, coalesce(amount::VARCHAR, ''), coalesce(tx_type, ''), strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS good,
  concat_ws(',', transaction_id::VARCHAR, 'n/a', coalesce(tx_type, ''), strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS bad_1,
  transaction_id::VARCHAR AS bad_2, good || ',left over' AS bad_3"""
JSON_SQL = """
SELECT *, '{"transaction_id":' || transaction_id AS head, coalesce(',"amount":' || amount::VARCHAR, '') AS paid,
  coalesce(',"tx_type":"' || tx_type || '"', '') || ',"timestamp":"' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') || '"}' AS rest,
  head || ',"amount":"n/a"' || rest AS bad_1, head || paid AS bad_2, '[1, 2' AS bad_3"""


def rejects_sql(lines, table):
    return f"""SELECT raw IS NOT NULL AS rejected, CASE WHEN raw IS NULL THEN transaction_id END AS transaction_id,
             CASE WHEN raw IS NULL THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN raw IS NULL THEN tx_type END AS tx_type,
             CASE WHEN raw IS NULL THEN date_trunc('second', "timestamp") END AS "timestamp", raw
      FROM (SELECT *, CASE WHEN transaction_id % 103 = 3 THEN bad_3 WHEN transaction_id % 101 = 3 THEN bad_2
                           WHEN transaction_id % 97 = 3 THEN bad_1 END AS raw FROM ({lines} FROM {table}))"""


def both(found):
    """Good and rejected records in one table."""
    good = found.good.withColumns({"rejected": F.lit(False), "raw": F.lit(None).cast("string")})
    bad = found.rejected.select(F.lit(True).alias("rejected"), F.col("raw").cast("string").alias("raw"))
    return good.unionByName(bad, allowMissingColumns=True)


def written(star, lines, label):
    path = scratch_dir(star.spark, label)
    lines.write.text(path)
    return path


@query("csv_rejects", oracle("tx_raw", rejects_sql(CSV_SQL, "tx_raw")))
def _(star):
    path, out = written(star, csv_lines(star.tx_raw), "lines"), scratch_dir(star.spark, "checked")
    return both(rejects.ingest(star.spark, path, RECORD, out, "csv", header=False, options=TIMES))


@query("jsonl_rejects", oracle("tx_raw", rejects_sql(JSON_SQL, "tx_raw")))
def _(star):
    path, out = written(star, json_lines(star.tx_raw), "lines"), scratch_dir(star.spark, "checked")
    return both(rejects.ingest(star.spark, path, RECORD, out, options=TIMES))


@query("payload_rejects", oracle("live", rejects_sql(JSON_SQL, "live")))
def _(star):
    found = rejects.payloads(json_lines(star.live).select(F.col("value").cast("binary").alias("value")), RECORD, options=TIMES)
    out = scratch_dir(star.spark, "checked")
    rejects.save(found, out)
    return both(rejects.load(star.spark, out, found.schema))


@query("reject_stream", oracle("live", rejects_sql(JSON_SQL, "live")))
def _(star):
    path, out = written(star, json_lines(star.live).repartition(FILES), "lines"), scratch_dir(star.spark, "checked")
    stream = rejects.lines(star.spark, path, RECORD, options=TIMES, stream=True, files_per_trigger=FILES // 2)
    rejects.start(stream, out, scratch_dir(star.spark, "progress"), trigger=None).awaitTermination()
    return both(rejects.load(star.spark, out, stream.schema))


@query(
    "reject_counts",
    oracle(
        "tx_raw",
        f"""SELECT count(*) AS "read", count_if(NOT rejected) AS good, count_if(rejected) AS rejected
            FROM ({rejects_sql(JSON_SQL, "tx_raw")})""",
    ),
)
def _(star):
    path, out = written(star, json_lines(star.tx_raw), "lines"), scratch_dir(star.spark, "checked")
    counts = rejects.ingest(star.spark, path, RECORD, out, options=TIMES).counts()
    return counts.agg(*[F.sum(c).alias(c) for c in ("read", "good", "rejected")])


# ---- published tables


@query(
    "published_table",
    oracle(
        "joined",
        """SELECT account_type, status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM joined
           WHERE tx_direction = 'outflow' GROUP BY ALL""",
    ),
)
def _(star):
    """A table that is written twice: readers get the second version, as a whole."""
    path = scratch_dir(star.spark, "published")
    published.publish(star.full, path, ["account_type"])
    published.publish(published.read(star.spark, path).filter("tx_direction = 'outflow'"), path, ["account_type"])
    found = published.read(star.spark, path)
    return found.groupBy("account_type", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


CHECKED = ("account_id", "account_type", "age", "amount", "balance", "category", "city", "customer_id", "merchant", "name", "status",
           "timestamp", "transaction_id", "tx_direction", "tx_type")
ROW_SQL = "concat_ws(',', " + ", ".join(f"coalesce(length(\"{c}\"::VARCHAR) || ':' || \"{c}\"::VARCHAR, 'n')" for c in CHECKED) + ")"


@query(
    "partition_checksums",
    oracle(
        "joined",
        f"""SELECT account_type, count(*) AS "rows", sum(('0x' || substr(h, 1, 15))::BIGINT)::VARCHAR AS sum_a,
              sum(('0x' || substr(h, 17, 15))::BIGINT)::VARCHAR AS sum_b, true AS intact
            FROM (SELECT account_type, md5({ROW_SQL}) AS h FROM joined) GROUP BY 1""",
    ),
)
def _(star):
    path = scratch_dir(star.spark, "published")
    published.publish(star.full.select(*CHECKED), path, ["account_type"])
    again = published.verify(star.spark, path).select(F.col("account_type").alias("_key"), "intact")
    read = checksums(published.read(star.spark, path), ["account_type"], portable=True)
    found = read.join(again, F.col("account_type").eqNullSafe(F.col("_key"))).drop("_key")
    return found.withColumns({c: F.col(c).cast("string") for c in ("sum_a", "sum_b")})


# ---- first alerts


@query(
    "first_alerts",
    oracle(
        "events_done",
        f"""SELECT row_number() OVER (ORDER BY "timestamp", transaction_id)::INTEGER AS position, transaction_id,
              CAST(amount AS DOUBLE) AS amount, {FLAGS}, "timestamp" FROM events_done WHERE is_fraud = 1
            ORDER BY "timestamp", transaction_id LIMIT 5""",
    ),
)
def _(star):
    """The alerts arrive in several micro-batches, out of order, and the query is stopped and started in between."""
    path, sink, progress = (scratch_dir(star.spark, n) for n in ("live", "sink", "progress"))
    schema = T.StructType(star.live.schema.fields)
    for part in range(2):
        star.live.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == part).repartition(FILES // 2).write.mode("append").parquet(path)
        stream = s.alert_stream(s.flag_stream(s.stream_events(star.spark, path, schema, "parquet", files_per_trigger=1)))
        first.start(first.first_rows(stream), sink, progress, trigger=None).awaitTermination()
    return first.current(star.spark, sink, stream.schema)
