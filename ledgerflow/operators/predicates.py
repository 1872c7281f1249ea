"""Named filters and their Spark SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.settings import RULES, Rules

PATTERN_COLUMNS = ("transaction_id", "name", "city", "amount", "status", "timestamp")


def fraud_pattern(full: DataFrame, rules: Rules = RULES, ordered: bool = True) -> DataFrame:
    """Large transactions that failed or were reversed, largest first."""
    hit = (F.col("amount") > rules.pattern_amount) & F.col("status").isin(*rules.bad_statuses)
    found = full.filter(hit).select(*PATTERN_COLUMNS)
    return found.orderBy(F.desc("amount"), "transaction_id") if ordered else found


def fraud_pattern_sql(spark: SparkSession, n: int = 8, rules: Rules = RULES) -> DataFrame:
    """The first ``n`` rows of ``fraud_pattern`` from the registered view."""
    statuses = {f"status{i}": s for i, s in enumerate(rules.bad_statuses)}
    return spark.sql(
        f"SELECT {', '.join(PATTERN_COLUMNS)} FROM banking_data "
        f"WHERE amount > :floor AND status IN ({', '.join(':' + s for s in statuses)}) "
        "ORDER BY amount DESC, transaction_id LIMIT :n",
        args={"floor": rules.pattern_amount, "n": n, **statuses},
    )


def flagged_list(df: DataFrame) -> DataFrame:
    """The flagged rows of a stream or a batch of live records."""
    return df.filter(F.col("is_fraud") == 1).select("transaction_id", "city", "amount", "tx_type", "status")
