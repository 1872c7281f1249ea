"""Sources, sinks and cleaning."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.catalog.registry import query
from ledgerflow.operators import clean, predicates
from ledgerflow.plans.adapter import COPY_ORDER, TX_COLUMNS
from ledgerflow.plans.adapter_sql import oracle
from ledgerflow.functions import features as f
from ledgerflow.settings import scratch_dir
from ledgerflow.sources import io

# Rows per task that force the forms for large data at every size of the tables.
FEW = 500
# Passes of few bits, so that every one of them has something to refine at every size of the tables.
NARROW = (8, 10, 46)

TX_OUT = 'transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, "timestamp", status, merchant, category'


@query("csv_scan", oracle("customers_raw", "SELECT customer_id, name, age, city FROM customers_raw"))
def _(star):
    path = scratch_dir(star.spark, "customers-csv")
    io.save_csv(star.customers_raw, path)
    schema = T.StructType(
        [
            T.StructField("customer_id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("age", T.IntegerType()),
            T.StructField("city", T.StringType()),
        ]
    )
    return io.read_csv(star.spark, path, schema)


@query(
    "csv_sink",
    oracle(
        "accounts_raw",
        "SELECT account_id, customer_id, account_type, CAST(balance AS DOUBLE) AS balance, "
        "CAST(open_date AS DATE) AS open_date, status FROM accounts_raw",
    ),
)
def _(star):
    path = scratch_dir(star.spark, "accounts-csv")
    out = star.accounts_raw.withColumn("open_date", F.to_date("open_date"))
    io.save_csv(out, path)
    return io.read_csv(star.spark, path, T.StructType(out.schema.fields))


@query(
    "jsonl_scan",
    oracle(
        "events_done",
        "SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, "
        "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\", status, city, "
        "array_to_string(fraud_flags, '; ') AS fraud_flags, is_fraud FROM events_done",
    ),
)
def _(star):
    path = scratch_dir(star.spark, "events-json")
    done = f.is_flagged(f.rule_flags(star.live))
    text = done.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    text.write.mode("overwrite").json(path)
    return io.read_events(star.spark, path, T.StructType(text.schema.fields))


@query(
    "register_views",
    oracle(
        "joined",
        """SELECT a.account_type, c.city, count(*) AS n, CAST(sum(b.amount) AS DOUBLE) AS total FROM joined b
           JOIN accounts a ON a.account_id = b.account_id JOIN customers c ON c.customer_id = a.customer_id
           JOIN featured t ON t.transaction_id = b.transaction_id GROUP BY 1, 2""",
    ),
)
def _(star):
    io.register(star.spark, star.full, f.tx_direction(star.tx), star.accounts, star.customers)
    return star.spark.sql(
        """SELECT a.account_type, c.city, count(*) AS n, sum(b.amount) AS total FROM banking_data b
           JOIN accounts a ON a.account_id = b.account_id JOIN customers c ON c.customer_id = a.customer_id
           JOIN transactions t ON t.transaction_id = b.transaction_id GROUP BY 1, 2"""
    )


PATTERN_SQL = (
    "SELECT transaction_id, name, city, CAST(amount AS DOUBLE) AS amount, status, \"timestamp\" FROM joined "
    "WHERE amount > 10000 AND status IN ('failed', 'reversed')"
)


@query("parquet_sink", oracle("joined", PATTERN_SQL))
def _(star):
    path = scratch_dir(star.spark, "suspicious")
    io.save(predicates.fraud_pattern(star.full, ordered=False), path)
    return star.spark.read.parquet(path)


FULL_OUT = f"{TX_OUT}, tx_direction, customer_id, account_type, CAST(balance AS DOUBLE) AS balance, name, city, age"


@query("partitioned_sink", oracle("joined", f"SELECT {FULL_OUT} FROM joined"))
def _(star):
    path = scratch_dir(star.spark, "full")
    io.save(star.full, path, ["account_type"])
    return star.spark.read.parquet(path)


@query(
    "partition_pruned",
    oracle(
        "joined",
        """SELECT status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM joined
           WHERE account_type = '2-HIGH' GROUP BY status""",
    ),
)
def _(star):
    path = scratch_dir(star.spark, "full")
    io.save(star.full, path, ["account_type"])
    back = star.spark.read.parquet(path).filter(F.col("account_type") == "2-HIGH")
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query("readback_verify", oracle("joined", "SELECT account_type AS key, count(*) AS n FROM joined GROUP BY 1"))
def _(star):
    path = scratch_dir(star.spark, "full")
    io.save(star.full, path, ["account_type"])
    return io.verify(star.spark, path, "account_type")


@query(
    "row_counts",
    oracle(
        "customers_raw accounts_raw tx_raw",
        """SELECT 'customers' AS "table", count(*) AS "rows", 4 AS "columns" FROM customers_raw
           UNION ALL SELECT 'accounts', count(*), 6 FROM accounts_raw
           UNION ALL SELECT 'transactions', count(*), 8 FROM tx_raw""",
    ),
)
def _(star):
    return io.row_counts(
        {"customers": star.customers_raw, "accounts": star.accounts_raw, "transactions": star.tx_raw.select(*TX_COLUMNS)}
    )


@query(
    "kafka_decode",
    oracle(
        "live",
        "SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, \"timestamp\", status, city FROM live",
    ),
)
def _(star):
    payload = star.live.select(F.to_json(F.struct("*"), io.EXACT_TIMES).cast("binary").alias("value"))
    return io.decode_payload(payload, T.StructType(star.live.schema.fields), options=io.EXACT_TIMES)


# ---- cleaning ---------------------------------------------------------------------------------------------------

NULL_KEYS = "transaction_id IS NOT NULL AND account_id IS NOT NULL AND amount IS NOT NULL AND tx_type IS NOT NULL"


@query("drop_null_keys", oracle("tx_raw", f"SELECT {TX_OUT} FROM tx_raw WHERE {NULL_KEYS}"))
def _(star):
    return clean.drop_null(star.tx_raw.select(*TX_COLUMNS), ["transaction_id", "account_id", "amount", "tx_type"])


@query(
    "fill_defaults",
    oracle(
        "customers_raw",
        "SELECT customer_id, name, coalesce(age, 0) AS age, coalesce(city, 'Unknown') AS city FROM customers_raw",
    ),
)
def _(star):
    return clean.fill(star.customers_raw, {"city": "Unknown", "age": 0})


@query(
    "keep_nonnegative",
    oracle("accounts_raw", "SELECT account_id, CAST(balance AS DOUBLE) AS balance FROM accounts_raw WHERE balance >= 0"),
)
def _(star):
    return clean.keep_nonnegative(star.accounts_raw, "balance").select("account_id", "balance")


@query("keep_positive", oracle("tx_raw", f"SELECT {TX_OUT} FROM tx_raw WHERE amount > 0"))
def _(star):
    return clean.keep_positive(star.tx_raw, "amount").select(*TX_COLUMNS)


@query(
    "dedupe",
    oracle(
        "tx_raw",
        f"""SELECT {TX_OUT} FROM tx_raw QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY
            "timestamp" NULLS FIRST, part_id NULLS FIRST, merchant NULLS FIRST, tx_raw.amount NULLS FIRST,
            status NULLS FIRST) = 1""",
    ),
)
def _(star):
    return clean.dedupe(star.tx_raw, ["transaction_id"], COPY_ORDER).select(*TX_COLUMNS)


@query(
    "parse_timestamp",
    oracle(
        "tx",
        """SELECT transaction_id, CASE WHEN transaction_id % 1000 = 7 THEN NULL ELSE "timestamp" END AS "timestamp" FROM tx""",
    ),
)
def _(star):
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    dirty = F.when(F.col("transaction_id") % 1000 == 7, "not a time").otherwise(text)
    parsed = clean.parse_ts(star.tx.select("transaction_id", dirty.alias("timestamp")))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "bad_ts",
    oracle("tx", "SELECT count_if(transaction_id % 1000 = 7) AS bad_ts FROM tx"),
)
def _(star):
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    dirty = F.when(F.col("transaction_id") % 1000 == 7, "not a time").when(F.col("transaction_id") % 1000 != 8, text)
    return clean.bad_ts(star.tx.select(dirty.alias("timestamp")))


@query("clean_customers", oracle("customers", "SELECT customer_id, name, age, city FROM customers"))
def _(star):
    return star.customers


@query(
    "clean_accounts",
    oracle(
        "accounts",
        "SELECT account_id, customer_id, account_type, CAST(balance AS DOUBLE) AS balance, open_date, status FROM accounts",
    ),
)
def _(star):
    return star.accounts


@query("clean_transactions", oracle("tx", f"SELECT {TX_OUT} FROM tx"))
def _(star):
    return star.tx_plan


@query(
    "cleaning_report",
    oracle(
        "customers accounts tx",
        """SELECT "table", "before", "after", "before" - "after" AS removed FROM (
             SELECT 'customers' AS "table", (SELECT count(*) FROM customers_raw) AS "before", (SELECT count(*) FROM customers) AS "after"
             UNION ALL SELECT 'accounts', (SELECT count(*) FROM accounts_raw), (SELECT count(*) FROM accounts)
             UNION ALL SELECT 'transactions', (SELECT count(*) FROM tx_raw), (SELECT count(*) FROM tx))""",
    ),
)
def _(star):
    raw = {"customers": star.customers_raw, "accounts": star.accounts_raw, "transactions": star.tx_raw}
    return clean.cleaning_report(raw, {"customers": star.customers, "accounts": star.accounts, "transactions": star.tx_plan})


def median_sql(col: str, source: str) -> str:
    """Median as half the sum of the two middle values."""
    return f"""(SELECT 0.5 * max(CASE WHEN rn = (n - 1) // 2 + 1 THEN v END) + 0.5 * max(CASE WHEN rn = n // 2 + 1 THEN v END)
      FROM (SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY {col}) AS rn, count(*) OVER () AS n
            FROM {source} WHERE {col} IS NOT NULL))"""


@query(
    "impute_median",
    oracle(
        "joined",
        f"""SELECT transaction_id, coalesce(CAST(age AS DOUBLE), {median_sql('age', 'joined')}) AS age,
            coalesce(CAST(balance AS DOUBLE), {median_sql('balance', 'joined')}) AS balance FROM joined""",
    ),
)
def _(star):
    return clean.impute_median(star.full, ["age", "balance"], rows=star.rows).select("transaction_id", "age", "balance")


@query(
    "impute_median_ranked",
    oracle(
        "joined",
        f"""SELECT transaction_id, coalesce(CAST(age AS DOUBLE), {median_sql('age', 'joined')}) AS age,
            coalesce(CAST(balance AS DOUBLE), {median_sql('balance', 'joined')}) AS balance FROM joined""",
    ),
)
def _(star):
    filled = clean.impute_median(star.full, ["age", "balance"], levels=NARROW)
    return filled.select("transaction_id", "age", "balance")


@query("impute_constant", oracle("joined", "SELECT transaction_id, coalesce(city, 'Unknown') AS city FROM joined"))
def _(star):
    return clean.impute_constant(star.full, "city", "Unknown").select("transaction_id", "city")


@query(
    "quality_profile",
    oracle(
        "tx_raw",
        """SELECT count(*) - count_if(amount IS NULL) - count_if(amount < 0) AS valid, count_if(amount IS NULL) AS null_amount,
             count_if(amount < 0) AS negative_amount, count_if(tx_type IS NULL) AS null_tx_type,
             count(*) - count(DISTINCT transaction_id) AS duplicates FROM tx_raw""",
    ),
)
def _(star):
    return clean.quality_profile(star.tx_raw)


@query(
    "append_batches",
    oracle(
        "tx_raw live",
        " UNION ALL ".join(
            f'SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, "timestamp", status FROM {t}'
            for t in ("tx_raw", "live")
        ),
    ),
)
def _(star):
    from ledgerflow.operators.enrich import append_batches

    cols = ("transaction_id", "account_id", "amount", "tx_type", "timestamp", "status")
    return append_batches(star.tx_raw.select(*cols), star.live.select(*reversed(cols)))




@query("csv_transactions", oracle("tx_raw", f"SELECT {TX_OUT} FROM tx_raw"))
def _(star):
    path = scratch_dir(star.spark, "transactions-csv")
    raw = star.tx_raw.select(*TX_COLUMNS)
    io.save_csv(raw, path)
    # Columns are found by name: the schema asks for them in another order.
    return io.read_csv(star.spark, path, T.StructType(sorted(raw.schema.fields, key=lambda f: f.name)))


FULL_TYPES = {
    "account_id": "bigint", "transaction_id": "bigint", "amount": "decimal(18,2)", "tx_type": "string", "timestamp": "timestamp_ntz",
    "status": "string", "merchant": "bigint", "category": "string", "tx_direction": "string", "customer_id": "bigint",
    "account_type": "string", "balance": "decimal(18,2)", "name": "string", "city": "string", "age": "int",
}


@query(
    "describe_schema",
    oracle(
        "joined",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS type, count("{c}") AS n_values, count(*) - count("{c}") AS n_nulls FROM joined"""
            for c, t in FULL_TYPES.items()
        ),
    ),
)
def _(star):
    return io.schema_profile(star.full)
