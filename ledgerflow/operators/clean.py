"""Cleaning, imputation and quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans.quantiles import LEVELS, quantiles
from ledgerflow.settings import RULES, Rules


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drops a row when any of ``cols`` is null."""
    # One test per column instead of `dropna`: these reach the scan as pushed filters.
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replaces nulls by constants, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items()})


def keep_nonnegative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) >= 0)


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    The minimum is taken before the shuffle as well, so a key with very many copies sends one row per map task. The
    survivor depends on the content only, never on the layout of the data.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = [*order, *rest]
    if not payload:
        return df.dropDuplicates(list(keys))
    kept = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def parse_ts(df: DataFrame, col: str = "timestamp", fmt: str = RULES.timestamp_format) -> DataFrame:
    """Turns text into a timestamp; text that does not fit becomes null. Timestamps pass through."""
    if isinstance(df.schema[col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(fmt)))


def bad_ts(df: DataFrame, col: str = "timestamp", fmt: str = RULES.timestamp_format) -> DataFrame:
    """One row: ``bad_ts``, the values of ``col`` that hold something but no time that fits ``fmt``."""
    parsed = parse_ts(df.withColumn("_text", F.col(col)), col, fmt)
    return parsed.agg(F.count_if(F.col("_text").isNotNull() & F.col(col).isNull()).alias("bad_ts"))


def clean_customers(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    known = fill(drop_null(df, ["customer_id", "name"]), {"city": rules.unknown_city, "age": 0})
    return dedupe(keep_nonnegative(known, "age"), ["customer_id"])


def clean_accounts(df: DataFrame) -> DataFrame:
    known = fill(drop_null(df, ["account_id", "customer_id"]), {"balance": 0})
    return dedupe(keep_nonnegative(known, "balance"), ["account_id"])


def clean_transactions(df: DataFrame, order: Sequence[str] = (), rules: Rules = RULES) -> DataFrame:
    """Null keys out, non-positive amounts out, one row per id, time parsed; in this order.

    Since dirty rows go first, an id whose first copy is dirty survives through a clean copy.
    """
    valid = keep_positive(drop_null(df, ["transaction_id", "account_id", "amount", "tx_type"]), "amount")
    return parse_ts(dedupe(valid, ["transaction_id"], order), "timestamp", rules.timestamp_format)


def cleaning_report(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]) -> DataFrame:
    """(table, before, after, removed) for each table, as one plan instead of one job per count."""
    parts = []
    for name, frame in raw.items():
        before = frame.agg(F.count(F.lit(1)).alias("before"))
        after = clean[name].agg(F.count(F.lit(1)).alias("after")).scalar()
        parts.append(before.select(F.lit(name).alias("table"), "before", after.alias("after")))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("removed", F.col("before") - F.col("after"))


def impute_median(
    df: DataFrame, cols: Sequence[str], rows: int | None = None, accuracy: int | None = None, levels: Sequence[int] = LEVELS
) -> DataFrame:
    """Replaces nulls in ``cols`` by the median of the column, as doubles. Run it after the join."""
    middle = quantiles(df, {c: 0.5 for c in cols}, rows, accuracy, levels)
    return fill_from(df, middle, cols)


def fill_from(df: DataFrame, one_row: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replaces nulls in ``cols`` by the values of a one-row frame with the same column names."""
    known = df.withColumn("_fill", one_row.select(F.struct(*cols)).scalar())
    return known.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_fill.{c}")) for c in cols}).drop("_fill")


def impute_constant(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def quality_profile(tx: DataFrame) -> DataFrame:
    """(valid, null_amount, negative_amount, null_tx_type, duplicates) of raw transactions.

    Rows are counted per id first, so the duplicate count needs no distinct aggregate and no id is hot.
    """
    amount, kind = F.col("amount"), F.col("tx_type")
    per_id = tx.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(amount.isNull()).alias("no_amount"),
        F.count_if(amount < 0).alias("negative"),
        F.count_if(kind.isNull()).alias("no_type"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per_id.agg(
        total(F.col("n") - F.col("no_amount") - F.col("negative")).alias("valid"),
        total(F.col("no_amount")).alias("null_amount"),
        total(F.col("negative")).alias("negative_amount"),
        total(F.col("no_type")).alias("null_tx_type"),
        total(F.col("n") - 1).alias("duplicates"),
    )
