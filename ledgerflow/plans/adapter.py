"""The test tables as customers, accounts, transactions and live records.

The mapping exists twice: as DataFrame expressions here and as SQL text in ``plans.adapter_sql``, so that results can be
compared with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import features
from ledgerflow.operators import clean, enrich
from ledgerflow.operators.windows import account_splits
from ledgerflow.settings import MONEY, scratch_dir
from ledgerflow.sources import io

TX_COLUMNS = ("transaction_id", "account_id", "amount", "tx_type", "timestamp", "status", "merchant", "category")
# Orders the copies of a transaction id; `part_id` exists for this purpose only.
COPY_ORDER = ("timestamp", "part_id", "merchant", "amount", "status")
SUPPLIER_TYPES = ("credit", "debit", "transfer", "withdrawal", "payment")
EVENT_TYPES = {"view": "credit", "click": "debit", "signup": "transfer", "error": "withdrawal", "purchase": "payment"}

EVENT_SOURCE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def half_price(price: Column) -> Column:
    """Half of a price in whole cents, rounded down. Whole-number arithmetic; a double is slow to turn into money."""
    whole = F.floor(price * 100 + 0.5)
    return (F.shiftright(whole, 1).cast(T.DecimalType(18, 0)) * F.lit(Decimal("0.01"))).cast(MONEY)


def unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def by_share(number: Column, limits: tuple[int, int, int], below: bool) -> Column:
    """A status from a number: completed up to the first limit, then pending, failed, reversed."""
    names = ("completed", "pending", "failed")
    chosen = F
    for limit, name in zip(limits, names):
        chosen = chosen.when(number < limit if below else number <= limit, name)
    return chosen.otherwise("reversed")


# Some keys are left out of customers and accounts, and some values set to null or negated, so that missing join partners
# and dirty rows occur.


def customers_raw(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).filter(key % 89 != 0)
    return joined.select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        unless(key % 33 == 5, 18 + key % 58).cast("int").alias("age"),
        unless(key % 50 == 7, F.col("n_name")).alias("city"),
    )


def accounts_raw(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.filter(key % 97 != 0).select(
        key.alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        unless(key % 50 == 11, F.col("o_totalprice").cast(MONEY)).alias("balance"),
        F.col("o_orderdate").alias("open_date"),
        F.col("o_orderstatus").alias("status"),
    )


def transactions_raw(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    part_key = F.col("l_partkey")
    paid = half_price(F.col("l_extendedprice"))
    kind = F.element_at(F.array(*map(F.lit, SUPPLIER_TYPES)), (F.col("l_suppkey") % 5 + 1).cast("int"))
    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_orderkey").alias("account_id"),
        F.when(part_key % 50 == 3, F.lit(None).cast(MONEY)).when(part_key % 33 == 1, -paid).otherwise(paid).cast(MONEY).alias("amount"),
        unless(part_key % 50 == 13, kind).alias("tx_type"),
        F.timestamp_add("HOUR", (part_key % 24).cast("int"), F.col("l_shipdate")).alias("timestamp"),
        by_share(F.col("l_quantity"), (37, 42, 47), below=False).alias("status"),
        F.col("l_suppkey").alias("merchant"),
        F.col("p_type").alias("category"),
        part_key.alias("part_id"),
    )


def live_records(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Live records from an event frame; works on a streaming frame as well."""
    kind = F.col("event_type")
    chosen = F
    for source, target in EVENT_TYPES.items():
        chosen = chosen.when(kind == source, target)
    people = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    joined = events.join(people, events.user_id == people.c_custkey)
    return joined.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        (F.col("value") * 250).cast(MONEY).alias("amount"),
        chosen.alias("tx_type"),
        F.col("ts").alias("timestamp"),
        by_share(F.col("event_id") % 20, (15, 17, 19), below=True).alias("status"),
        F.col("n_name").alias("city"),
    )


_DONE: dict[tuple[str, str, str, str], Any] = {}


@dataclass
class Star:
    """Raw, clean and joined tables of one data folder.

    ``tx_plan`` and ``full_plan`` are lazy plans over the raw tables. ``full`` is the joined table as the batch run leaves
    it: written once per session, then read by everything that builds on it.
    """

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers_raw(self) -> DataFrame:
        return customers_raw(self.table("customer"), self.table("nation"))

    @cached_property
    def accounts_raw(self) -> DataFrame:
        return accounts_raw(self.table("orders"))

    @cached_property
    def tx_raw(self) -> DataFrame:
        return transactions_raw(self.table("lineitem"), self.table("part"))

    @cached_property
    def state(self) -> str:
        """Names, sizes and times of the folder's files as Spark lists them; another state means other data."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.folder)
        files = listing.select("path", "length", F.unix_micros("modificationTime").alias("changed"))
        return str(files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "changed").cast("decimal(20,0)"))).first())

    def once(self, name: str, make: Callable[[], Any]) -> Any:
        """The value of ``make()``, computed once per session, data folder and state of its files."""
        key = (self.spark.sparkContext.applicationId, self.folder, self.state, name)
        if key not in _DONE:
            _DONE[key] = make()
        return _DONE[key]

    def stored(self, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
        """The frame of ``plan()``, written once to the shared folder and read from there."""

        def write() -> str:
            path = scratch_dir(self.spark, name)
            io.save(plan(), path)
            return path

        return self.spark.read.parquet(self.once(name, write))

    @cached_property
    def rows(self) -> int:
        """Raw transactions: an upper bound for every cleaned or joined form, and a cheap count."""
        return self.table("lineitem").count()

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.customers_raw)

    @cached_property
    def accounts(self) -> DataFrame:
        return clean.clean_accounts(self.accounts_raw)

    @cached_property
    def tx_plan(self) -> DataFrame:
        return clean.clean_transactions(self.tx_raw, COPY_ORDER).select(*TX_COLUMNS)

    @cached_property
    def full_plan(self) -> DataFrame:
        return enrich.enrich(features.tx_direction(self.tx_plan), self.accounts, self.customers)

    @cached_property
    def full(self) -> DataFrame:
        return self.stored("full", lambda: self.full_plan)

    @cached_property
    def tx(self) -> DataFrame:
        """The clean transactions, out of the stored joined table."""
        return self.full.select(*TX_COLUMNS)

    @cached_property
    def labelled(self) -> DataFrame:
        """The clean transactions with the training label, stored as the joined table is."""
        return self.stored("labelled", lambda: features.fraud_label(self.tx, rows=self.rows))

    @cached_property
    def splits(self):
        """Cut points of the per-account windows."""
        return account_splits(self.full, rows=self.rows)

    @cached_property
    def live(self) -> DataFrame:
        return live_records(self.table("events"), self.table("customer"), self.table("nation"))

    def live_stream(self) -> DataFrame:
        events = self.spark.readStream.schema(EVENT_SOURCE).option("pathGlobFilter", "events*.parquet").parquet(self.folder)
        return live_records(events, self.table("customer"), self.table("nation"))
