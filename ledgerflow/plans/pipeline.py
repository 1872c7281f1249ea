"""The batch run: clean, derive, join, store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.functions import features as f
from ledgerflow.operators import aggregates, clean, enrich, predicates, windows
from ledgerflow.settings import RULES, Rules
from ledgerflow.sources import io, published


@dataclass(frozen=True)
class Tables:
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    full: DataFrame


def row_features(tx: DataFrame, rules: Rules = RULES) -> DataFrame:
    """All row features of the batch run."""
    timed = f.time_of_day(f.is_weekend(f.calendar_parts(tx)), rules=rules)
    return f.suspicious_batch(f.tx_direction(f.amount_band(timed, rules), rules), rules)


def prepare(
    tx: DataFrame, acc: DataFrame, cust: DataFrame, order: Sequence[str] = (), rules: Rules = RULES
) -> Tables:
    """Clean tables and the joined one, all lazy."""
    customers, accounts = clean.clean_customers(cust, rules), clean.clean_accounts(acc)
    transactions = row_features(clean.clean_transactions(tx, order, rules), rules)
    return Tables(customers, accounts, transactions, enrich.enrich(transactions, accounts, customers))


def run(
    spark: SparkSession, tx: DataFrame, acc: DataFrame, cust: DataFrame, out: str, order: Sequence[str] = ()
) -> Tables:
    """Stores the joined table by account type, the suspicious rows, the customer ranks and the clean small tables.

    Each is written once, and everything later, the four relations for SQL included, reads the stored copies instead of
    cleaning and joining again. Every table is published as a version of its own (``sources.published``): a run that fails
    or is repeated leaves readers with whole tables.
    """
    tables = prepare(tx, acc, cust, order)
    published.publish(tables.full, f"{out}/banking_full", ["account_type"])
    full = published.read(spark, f"{out}/banking_full")
    published.publish(predicates.fraud_pattern(full, ordered=False), f"{out}/suspicious_transactions")
    spend = aggregates.spend_per_customer(full, ordered=False)
    rows = published.find(spark, f"{out}/banking_full").rows
    published.publish(windows.rank_in_city(spend, rows=rows), f"{out}/customer_rankings")
    published.publish(tables.customers, f"{out}/customers")
    published.publish(tables.accounts, f"{out}/accounts")
    done = stored(spark, out, tables.transactions.columns)
    io.register(spark, done.full, done.transactions, done.accounts, done.customers)
    return done


def stored(spark: SparkSession, out: str, columns: Sequence[str] | None = None) -> Tables:
    """The tables of the last finished run; ``columns`` are those of the transactions, all of the joined table by default."""
    full, customers, accounts = (published.read(spark, f"{out}/{name}") for name in ("banking_full", "customers", "accounts"))
    # The joined table has every clean transaction once, with all its columns.
    return Tables(customers, accounts, full.select(*columns) if columns else full, full)


def sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """Spark SQL over the registered relations."""
    return spark.sql(text, args=args or None)
