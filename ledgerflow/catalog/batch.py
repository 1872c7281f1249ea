"""Aggregations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.catalog.registry import query
from ledgerflow.functions import features as f
from ledgerflow.operators import aggregates as a
from ledgerflow.plans import pipeline
from ledgerflow.plans.adapter import COPY_ORDER
from ledgerflow.plans.adapter_sql import mean_cents, oracle, share
from ledgerflow.settings import scratch_dir
from ledgerflow.sources import io, published

@query(
    "batch_run",
    oracle(
        "joined spend",
        """SELECT 'banking_full' AS "table", count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM joined
           UNION ALL SELECT 'suspicious_transactions', count(*), CAST(sum(amount) AS DOUBLE) FROM joined
             WHERE amount > 10000 AND status IN ('failed', 'reversed')
           UNION ALL SELECT 'customer_rankings', count(*), CAST(sum(total_spend) AS DOUBLE) FROM spend""",
    ),
)
def _(star):
    out = scratch_dir(star.spark, "run")
    pipeline.run(star.spark, star.tx_raw, star.accounts_raw, star.customers_raw, out, COPY_ORDER)
    parts = []
    for table, col in (("banking_full", "amount"), ("suspicious_transactions", "amount"), ("customer_rankings", "total_spend")):
        stored = published.read(star.spark, f"{out}/{table}")
        parts.append(stored.agg(F.count(F.lit(1)).alias("n"), F.sum(col).alias("total")).withColumn("table", F.lit(table)))
    return reduce(DataFrame.unionByName, parts)


SPEND = f"""SELECT customer_id, name, city, total_transactions, CAST(total_spend AS DOUBLE) AS total_spend,
  {mean_cents('total_spend', 'total_transactions')} AS avg_tx_amount, CAST(max_single_tx AS DOUBLE) AS max_single_tx FROM spend"""


@query("spend_per_customer", oracle("spend", SPEND))
def _(star):
    return a.spend_per_customer(star.full)


@query(
    "spend_by_category",
    oracle("joined", "SELECT category, count(*) AS num_transactions, CAST(sum(amount) AS DOUBLE) AS total_amount FROM joined GROUP BY 1"),
)
def _(star):
    return a.spend_by_category(star.full)


@query(
    "spend_by_city_sql",
    oracle(
        "joined",
        f"""SELECT city, count(*) AS num_transactions, CAST(sum(amount) AS DOUBLE) AS total_spend,
            {mean_cents('sum(amount)', 'count(*)')} AS avg_amount FROM joined WHERE tx_direction = 'outflow' GROUP BY city""",
    ),
)
def _(star):
    io.register(star.spark, star.full, star.tx, star.accounts, star.customers)
    return a.spend_by_city_sql(star.spark)


@query(
    "volume_by_month",
    oracle("tx", """SELECT month("timestamp") AS month, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS total FROM tx GROUP BY 1"""),
)
def _(star):
    return a.volume_by_month(star.tx)


@query(
    "total_by_key",
    oracle(
        "joined",
        """SELECT 'category' AS dimension, category AS key, CAST(sum(amount) AS DOUBLE) AS total FROM joined
           WHERE category IS NOT NULL GROUP BY 2 UNION ALL
           SELECT 'city', city, CAST(sum(amount) AS DOUBLE) FROM joined WHERE city IS NOT NULL GROUP BY 2""",
    ),
)
def _(star):
    by_category = a.total_by(star.full, "category").withColumn("dimension", F.lit("category"))
    return by_category.unionByName(a.total_by(star.full, "city").withColumn("dimension", F.lit("city")))


def share_sql(col: str, source: str) -> str:
    pct = share("n", "CAST(sum(n) OVER () AS HUGEINT)")
    return oracle(
        source,
        f"SELECT key, n, {pct} AS pct FROM (SELECT {col} AS key, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY 1)",
    )


@query("value_share_tx_type", share_sql("tx_type", "tx_raw"))
def _(star):
    return a.value_share(star.tx_raw, "tx_type")


@query("value_share_status", share_sql("status", "tx"))
def _(star):
    return a.value_share(star.tx, "status")


@query("value_share_account_type", share_sql("account_type", "joined"))
def _(star):
    return a.value_share(star.full, "account_type")


BIN = """CASE WHEN amount > 20000 THEN 'very_large' WHEN amount > 5000 THEN 'large' WHEN amount > 500 THEN 'medium'
  WHEN amount > 0 THEN 'small' END"""


@query("value_share_amount_bin", share_sql(BIN, "tx"))
def _(star):
    return a.value_share(f.amount_bin_right(star.tx), "amount_bin")


def histogram_sql(last: str, source: str, bins: int, where: str = "TRUE") -> str:
    return oracle(
        source,
        f"""SELECT e.bin, lo + e.bin * w AS lo, lo + (e.bin + 1) * w AS hi, {last} FROM
              (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) e CROSS JOIN span
            LEFT JOIN (SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS c
                       FROM v CROSS JOIN span GROUP BY 1) g ON g.bin = e.bin""",
        v=f"SELECT CAST(amount AS DOUBLE) AS x FROM {source} WHERE amount IS NOT NULL AND {where}",
        span=f"SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w, count(*) AS total FROM v",
    )


@query("histogram", histogram_sql("coalesce(c, 0) AS n", "tx", 50))
def _(star):
    return a.histogram(star.tx, "amount", 50)


@query("histogram_density", histogram_sql("coalesce(c, 0) / (total * w) AS density", "labelled", 30, "is_fraud = 1"))
def _(star):
    labelled = f.fraud_label(star.tx, rows=star.rows)
    return a.histogram(labelled.filter("is_fraud = 1"), "amount", 30, density=True)


@query(
    "class_mean",
    oracle(
        "labelled",
        f"""SELECT {mean_cents('sum(amount)', 'count(*)')} AS mean_all,
            {mean_cents('sum(CASE WHEN is_fraud = 1 THEN amount END)', 'sum(is_fraud)')} AS mean_fraud FROM labelled""",
    ),
)
def _(star):
    return a.class_mean(f.fraud_label(star.tx, rows=star.rows))


HOURS = ", ".join(f"""count_if(hour("timestamp") = {h}) AS h{h}""" for h in range(24))


@query("activity_heatmap", oracle("tx", f"""SELECT isodow("timestamp") - 1 AS day_of_week, {HOURS} FROM tx GROUP BY 1"""))
def _(star):
    return a.activity_heatmap(star.tx)


@query(
    "suspicious_by_city",
    oracle(
        "joined",
        """SELECT city, count(*) AS n FROM joined WHERE (amount > 30000 OR status IN ('failed', 'reversed'))
           AND city IS NOT NULL GROUP BY 1""",
    ),
)
def _(star):
    return a.suspicious_by_city(star.full)


@query(
    "top_customers",
    oracle(
        "joined",
        """SELECT customer_id, CAST(total AS DOUBLE) AS amount FROM (SELECT customer_id, sum(amount) AS total FROM joined
           WHERE customer_id IS NOT NULL GROUP BY 1) ORDER BY total DESC, customer_id LIMIT 10""",
    ),
)
def _(star):
    return a.top_customers(star.full, 10)


@query(
    "fraud_by_hour",
    oracle(
        "labelled",
        """SELECT hour("timestamp") AS hour, count_if(is_fraud = 0) AS legit, count_if(is_fraud = 1) * 5 AS fraud
           FROM labelled GROUP BY 1""",
    ),
)
def _(star):
    return a.fraud_by_hour(f.fraud_label(star.tx, rows=star.rows), scale=5)


@query(
    "fraud_by_account_type",
    oracle("labelled", "SELECT account_type, count(*) AS n FROM labelled WHERE is_fraud = 1 AND account_type IS NOT NULL GROUP BY 1"),
)
def _(star):
    return a.fraud_by_account_type(f.fraud_label(star.full, rows=star.rows))


@query(
    "fraud_rate_by_city",
    oracle(
        "events_done",
        f"""SELECT city, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
            {share('sum(is_fraud)', 'count(*)')} AS fraud_rate_pct FROM events_done GROUP BY city""",
    ),
)
def _(star):
    return a.fraud_rate_by_city(f.is_flagged(f.rule_flags(star.live)))


@query(
    "volume_by_type",
    oracle("live", "SELECT tx_type, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM live GROUP BY 1"),
)
def _(star):
    return a.volume_by_type(star.live)


@query(
    "class_balance",
    oracle(
        "labelled",
        f"""SELECT is_fraud, n, {share('n', 'CAST(sum(n) OVER () AS HUGEINT)')} AS pct
            FROM (SELECT is_fraud, count(*) AS n FROM labelled GROUP BY 1)""",
    ),
)
def _(star):
    return a.class_balance(f.fraud_label(star.tx, rows=star.rows))


@query(
    "kpi_cards",
    oracle(
        "labelled",
        f"""SELECT count(*) AS total, CAST(sum(amount) AS DOUBLE) AS volume, CAST(sum(is_fraud) AS BIGINT) AS fraud,
            {share('sum(is_fraud)', 'count(*)')} AS fraud_pct, {mean_cents('sum(amount)', 'count(*)')} AS avg_amount FROM labelled""",
    ),
)
def _(star):
    return a.kpi_cards(f.fraud_label(star.tx, rows=star.rows))


@query(
    "stream_summary",
    oracle(
        "events_done",
        f"""SELECT count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS flagged, CAST(sum(amount) AS DOUBLE) AS volume,
            {share('sum(is_fraud)', 'count(*)')} AS flagged_pct FROM events_done""",
    ),
)
def _(star):
    return a.stream_summary(f.is_flagged(f.rule_flags(star.live)))


@query(
    "recent_transactions",
    oracle(
        "labelled",
        """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, tx_type, status, city,
             CASE WHEN is_fraud = 1 THEN 'FRAUD' ELSE 'LEGIT' END AS verdict
           FROM labelled ORDER BY "timestamp" DESC, transaction_id LIMIT 10""",
    ),
)
def _(star):
    return a.recent_transactions(f.fraud_label(star.full, rows=star.rows), 10)


@query("value_share_tx_type_joined", share_sql("tx_type", "joined"))
def _(star):
    return a.value_share(star.full, "tx_type")


@query(
    "stream_type_counts",
    oracle("events_done", "SELECT tx_type, count(*) AS total, count_if(is_fraud = 1) AS flagged FROM events_done GROUP BY 1"),
)
def _(star):
    return a.stream_type_counts(f.is_flagged(f.rule_flags(star.live)))


BATCH_FEATURES = """SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, "timestamp", status, merchant, category,
  tx_direction, customer_id, account_type, CAST(balance AS DOUBLE) AS balance, name, city, age,
  year("timestamp") AS year, month("timestamp") AS month, hour("timestamp") AS hour,
  dayofweek("timestamp") + 1 AS day_of_week, CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour("timestamp") BETWEEN 6 AND 11 THEN 'morning' WHEN hour("timestamp") BETWEEN 12 AND 17 THEN 'afternoon'
       WHEN hour("timestamp") BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day,
  CASE WHEN amount < 500 THEN 'small' WHEN amount < 5000 THEN 'medium' WHEN amount < 20000 THEN 'large' ELSE 'very_large' END AS amount_category,
  CASE WHEN amount > 30000 OR status = 'failed' THEN 1 ELSE 0 END AS is_suspicious FROM joined"""


def stored_run(star):
    out = scratch_dir(star.spark, "run")
    pipeline.run(star.spark, star.tx_raw, star.accounts_raw, star.customers_raw, out, COPY_ORDER)
    return out


@query("batch_full", oracle("joined", BATCH_FEATURES))
def _(star):
    # `part_id` only orders copies.
    return published.read(star.spark, f"{stored_run(star)}/banking_full").drop("part_id")


@query(
    "batch_rankings",
    oracle(
        "spend",
        f"""SELECT s.*, rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS rank_in_city,
            dense_rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS dense_rank FROM ({SPEND}) s""",
    ),
)
def _(star):
    return published.read(star.spark, f"{stored_run(star)}/customer_rankings")
