"""Windows, ranks and changes."""

from pyspark.sql import functions as F

from ledgerflow.catalog.registry import query
from ledgerflow.catalog.sources import FEW
from ledgerflow.operators import aggregates as a
from ledgerflow.operators import windows as w
from ledgerflow.plans.adapter_sql import oracle
from ledgerflow.sources import io

RANKS = """rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS rank_in_city,
  dense_rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS dense_rank"""
LAG = 'lag(amount) OVER (PARTITION BY account_id ORDER BY "timestamp", transaction_id)'
SO_FAR = 'OVER (PARTITION BY account_id ORDER BY "timestamp", transaction_id ROWS UNBOUNDED PRECEDING)'
CHANGES = f"""SELECT transaction_id, account_id, name, "timestamp", amount, prev AS prev_amount, amount - prev AS amount_change,
  CASE WHEN prev > 0 THEN CAST((200 * CAST(amount * 100 AS HUGEINT) + CAST(prev * 100 AS HUGEINT))
    // (2 * CAST(prev * 100 AS HUGEINT)) AS DOUBLE) / 100.0 END AS spike_ratio FROM (SELECT *, {LAG} AS prev FROM joined)"""


@query(
    "rank_in_city",
    oracle("spend", f"SELECT customer_id, name, city, CAST(total_spend AS DOUBLE) AS total_spend, {RANKS.split(',')[0]}, "
           f"dense_rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS dense_rank FROM spend"),
)
def _(star):
    spend = a.spend_per_customer(star.full, ordered=False)
    ranked = w.rank_in_city(spend, rows=star.rows)
    return ranked.select("customer_id", "name", "city", "total_spend", "rank_in_city", "dense_rank")


@query(
    "dense_rank",
    oracle("spend", "SELECT customer_id, city, dense_rank() OVER (PARTITION BY city ORDER BY total_spend DESC) AS dense_rank FROM spend"),
)
def _(star):
    spend = a.spend_per_customer(star.full, ordered=False)
    return w.dense_rank(spend, rows=star.rows).select("customer_id", "city", "dense_rank")


# The same rows through the forms for large data, and with nulls among the ranked values.
NULL_SPEND = "SELECT customer_id, city, CASE WHEN customer_id % 5 <> 0 THEN total_spend END AS total_spend FROM spend"


def null_ranks(star, rows_per_task):
    spend = a.spend_per_customer(star.full, ordered=False).select("customer_id", "city", "total_spend")
    some = spend.withColumn("total_spend", F.when(F.col("customer_id") % 5 != 0, F.col("total_spend")))
    ranked = w.rank_in_city(some, rows=star.rows, rows_per_task=rows_per_task)
    return ranked.select("customer_id", "city", "total_spend", "rank_in_city", "dense_rank")


NULL_RANKS = oracle(
    "spend",
    """SELECT customer_id, city, CAST(total_spend AS DOUBLE) AS total_spend,
         rank() OVER (PARTITION BY city ORDER BY total_spend DESC NULLS LAST) AS rank_in_city,
         dense_rank() OVER (PARTITION BY city ORDER BY total_spend DESC NULLS LAST) AS dense_rank FROM n""",
    n=NULL_SPEND,
)


@query("rank_in_city_nulls", NULL_RANKS)
def _(star):
    return null_ranks(star, None)


@query("rank_in_city_split", NULL_RANKS)
def _(star):
    return null_ranks(star, 20)


def few_splits(star):
    """Cut points that split even small accounts."""
    return w.account_splits(star.full, rows_per_task=FEW_PER_ACCOUNT)


FEW_PER_ACCOUNT = 3


@query("lag_amount_split", oracle("joined", f"SELECT transaction_id, account_id, CAST({LAG} AS DOUBLE) AS prev_amount FROM joined"))
def _(star):
    return w.lag_amount(star.full, few_splits(star)).select("transaction_id", "account_id", "prev_amount")


@query(
    "running_total_split",
    oracle("joined", f"SELECT transaction_id, account_id, CAST(sum(amount) {SO_FAR} AS DOUBLE) AS running_total FROM joined"),
)
def _(star):
    return w.running_total(star.full, few_splits(star)).select("transaction_id", "account_id", "running_total")


@query("lag_amount", oracle("joined", f"SELECT transaction_id, account_id, CAST({LAG} AS DOUBLE) AS prev_amount FROM joined"))
def _(star):
    return w.lag_amount(star.full, star.splits).select("transaction_id", "account_id", "prev_amount")


@query(
    "amount_change",
    oracle("joined", "SELECT transaction_id, CAST(prev_amount AS DOUBLE) AS prev_amount, CAST(amount_change AS DOUBLE) AS amount_change FROM c", c=CHANGES),
)
def _(star):
    return w.spikes(star.full, star.splits).select("transaction_id", "prev_amount", "amount_change")


@query("spike_ratio", oracle("joined", "SELECT transaction_id, spike_ratio FROM c", c=CHANGES))
def _(star):
    return w.spikes(star.full, star.splits).select("transaction_id", "spike_ratio")


@query("is_spike", oracle("joined", "SELECT transaction_id, CAST(spike_ratio > 5 AS INTEGER) AS is_spike FROM c", c=CHANGES))
def _(star):
    return w.spikes(star.full, star.splits).select("transaction_id", "is_spike")


@query(
    "running_total",
    oracle("joined", f"SELECT transaction_id, account_id, CAST(sum(amount) {SO_FAR} AS DOUBLE) AS running_total FROM joined"),
)
def _(star):
    return w.running_total(star.full, star.splits).select("transaction_id", "account_id", "running_total")


@query(
    "running_count",
    oracle("joined", f"SELECT transaction_id, account_id, count(transaction_id) {SO_FAR} AS tx_count_so_far FROM joined"),
)
def _(star):
    return w.running_count(star.full, star.splits).select("transaction_id", "account_id", "tx_count_so_far")


PERCENT = """CAST((2000 * CAST(rank() OVER (ORDER BY amount) - 1 AS HUGEINT) + count(*) OVER () - 1)
  // (2 * (count(*) OVER () - 1)) AS DOUBLE) / 10.0"""


@query(
    "percent_rank_global",
    oracle("tx", f"SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, {PERCENT} AS amount_percentile FROM tx"),
)
def _(star):
    ranked = w.percent_rank_global(star.full.select("transaction_id", "amount"), rows=star.rows)
    return ranked.select("transaction_id", "amount", "amount_percentile")


@query(
    "percentile_top",
    oracle(
        "joined",
        f"""SELECT transaction_id, name, CAST(amount AS DOUBLE) AS amount, p AS amount_percentile FROM
            (SELECT transaction_id, name, amount, {PERCENT} AS p FROM joined) r ORDER BY r.amount DESC, transaction_id LIMIT 5""",
    ),
)
def _(star):
    return w.percentile_top(star.full, 5)


@query(
    "running_and_rank_sql",
    oracle(
        "joined",
        f"""SELECT account_id, name, "timestamp", CAST(amount AS DOUBLE) AS amount, CAST(total AS DOUBLE) AS running_total,
            r AS rank_in_city FROM (SELECT account_id, name, "timestamp", amount, transaction_id, sum(amount) {SO_FAR} AS total,
            rank() OVER (PARTITION BY city ORDER BY amount DESC) AS r FROM joined) x
            ORDER BY account_id, "timestamp", transaction_id LIMIT 15""",
    ),
)
def _(star):
    io.register(star.spark, star.full, star.tx, star.accounts, star.customers)
    return w.running_and_rank_sql(star.spark, 15)


@query(
    "running_and_rank",
    oracle(
        "joined",
        f"""SELECT transaction_id, account_id, name, "timestamp", CAST(amount AS DOUBLE) AS amount,
            CAST(sum(amount) {SO_FAR} AS DOUBLE) AS running_total,
            rank() OVER (PARTITION BY city ORDER BY amount DESC) AS rank_in_city FROM joined""",
    ),
)
def _(star):
    return w.running_and_rank(star.full, star.splits, rows=star.rows)


@query(
    "running_and_rank_split",
    oracle(
        "joined",
        f"""SELECT transaction_id, account_id, name, "timestamp", CAST(amount AS DOUBLE) AS amount,
            CAST(sum(amount) {SO_FAR} AS DOUBLE) AS running_total,
            rank() OVER (PARTITION BY city ORDER BY amount DESC) AS rank_in_city FROM joined""",
    ),
)
def _(star):
    return w.running_and_rank(star.full, few_splits(star), rows=star.rows, rows_per_task=FEW)


TOP3 = f"""SELECT city, rank_in_city, name, CAST(total_spend AS DOUBLE) AS total_spend, total_transactions
  FROM (SELECT *, {RANKS} FROM spend) WHERE rank_in_city <= 3"""


@query("topn_per_group", oracle("spend", TOP3))
def top_spenders(star):
    return w.topn_per_group(a.spend_per_customer(star.full, ordered=False), 3)


@query(
    "spike_report",
    oracle(
        "joined",
        """SELECT account_id, name, "timestamp", CAST(prev_amount AS DOUBLE) AS prev_amount, CAST(amount AS DOUBLE) AS amount,
           spike_ratio FROM c WHERE spike_ratio > 5 ORDER BY spike_ratio DESC, transaction_id LIMIT 10""",
        c=CHANGES,
    ),
)
def _(star):
    return w.spike_report(star.full, 10, star.splits)
