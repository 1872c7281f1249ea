"""Joins of the three tables. No table is broadcast by hint: adaptive execution decides on measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCOUNT_COLUMNS = ("account_id", "customer_id", "account_type", "balance")
CUSTOMER_COLUMNS = ("customer_id", "name", "city", "age")


def tx_accounts(tx: DataFrame, acc: DataFrame) -> DataFrame:
    """Adds the account of each transaction; transactions without an account keep nulls."""
    return tx.join(acc.select(*ACCOUNT_COLUMNS), "account_id", "left")


def tx_customers(df: DataFrame, cust: DataFrame) -> DataFrame:
    """Adds the customer of each row by ``customer_id``."""
    return df.join(cust.select(*CUSTOMER_COLUMNS), "customer_id", "left")


def enrich(tx: DataFrame, acc: DataFrame, cust: DataFrame) -> DataFrame:
    """Transactions with their account and customer.

    Accounts and customers are joined first. Left joins associate, so the result is that of joining one after the
    other, but the transactions are shuffled once instead of twice, and the rows without an account never meet on
    a null customer key.
    """
    owners = tx_customers(acc.select(*ACCOUNT_COLUMNS), cust)
    return tx.join(owners, "account_id", "left")


def topn_names(top: DataFrame, cust: DataFrame) -> DataFrame:
    """Adds names to a top-n result; ids without a customer drop out. Spark sends the smaller side."""
    return top.join(cust.select("customer_id", "name"), "customer_id")


def filter_direction(df: DataFrame, direction: str = "outflow") -> DataFrame:
    return df.filter(F.col("tx_direction") == direction)


def append_batches(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name, duplicates kept."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def order_by(df: DataFrame, *keys: str) -> DataFrame:
    """Sorts by names; a leading minus sign means descending."""
    return df.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys])


def top_k(df: DataFrame, keys: Sequence[str], n: int, tie: str) -> DataFrame:
    """The first ``n`` rows by ``keys``, ties broken by the ``tie`` column."""
    return order_by(df, *keys, tie).limit(n)


def preview(df: DataFrame, cols: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of a projection, in a stated order."""
    return order_by(df, *order).limit(n).select(*cols)
