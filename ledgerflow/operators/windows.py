"""Ranks, previous values and running totals.

Ordered by time, rows of one account are further ordered by ``transaction_id``: times repeat, and without a second key
neither "previous" nor "so far" is defined. All windows over rows go through ``plans.splits`` and so survive an account
or a city that holds a large part of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions import features
from ledgerflow.functions.exact import rounded_ratio
from ledgerflow.plans.splits import Splits, cumulate, find_splits, previous, ranked_values, rows_below, same_key
from ledgerflow.settings import RULES, Rules

TIME_ORDER = ("timestamp", "transaction_id")


def account_splits(tx: DataFrame, rows: int | None = None, rows_per_task: int | None = None) -> Splits:
    """Cut points for the per-account windows; find them once on the raw table and pass them on."""
    return find_splits(tx, ["account_id"], TIME_ORDER, rows=rows, rows_per_task=rows_per_task)


def _with_ranks(df: DataFrame, group: list[str], value: str, rows: int | None, rows_per_task: int | None) -> DataFrame:
    """Adds ``_below`` and ``_place`` of ``value`` within the group, largest value first and nulls last, as one tie."""
    keyed = df.withColumn("_key", F.struct(F.col(value).isNull().alias("none"), (-F.col(value)).alias("value")))
    splits = find_splits(keyed, group, ["_key"], rows=rows, rows_per_task=rows_per_task)
    if splits.whole:
        order = Window.partitionBy(*group).orderBy("_key")
        ranks = {"_below": (F.rank().over(order) - 1).cast("long"), "_place": F.dense_rank().over(order).cast("long")}
        return keyed.withColumns(ranks).drop("_key")
    table = ranked_values(keyed, group, "_key", splits=splits)
    table = table.select(*[F.col(c).alias(f"_r_{c}") for c in (*group, "_key")], F.col("below").alias("_below"), F.col("place").alias("_place"))
    on = same_key(keyed, table, [(c, f"_r_{c}") for c in (*group, "_key")])
    return keyed.join(table, on, "left").drop("_key", *[f"_r_{c}" for c in (*group, "_key")])


def rank_in_city(
    spend: DataFrame, rows: int | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """Adds ``rank_in_city`` and ``dense_rank`` of each customer by spend within the city."""
    ranked = _with_ranks(spend, ["city"], "total_spend", rows, rows_per_task)
    return ranked.withColumns(
        {"rank_in_city": F.col("_below") + 1, "dense_rank": F.col("_place")}
    ).drop("_below", "_place")


def dense_rank(spend: DataFrame, rows: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """As ``rank_in_city`` with the gap-free rank only."""
    return rank_in_city(spend, rows, rows_per_task).drop("rank_in_city")


def topn_per_group(spend: DataFrame, k: int = 3, ordered: bool = True) -> DataFrame:
    """Customers ranked up to ``k`` in their city; ties can give more than ``k``.

    The rank filter is applied on the map side first, so a large city never meets in one task.
    """
    order = Window.partitionBy("city").orderBy(F.desc("total_spend"))
    top = spend.withColumn("rank_in_city", F.rank().over(order)).filter(F.col("rank_in_city") <= k)
    out = top.select("city", "rank_in_city", "name", "total_spend", "total_transactions")
    return out.orderBy("city", "rank_in_city") if ordered else out


def lag_amount(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Adds ``prev_amount``: the amount of the account's previous transaction."""
    return previous(df, splits or account_splits(df), "amount", "prev_amount")


def spikes(df: DataFrame, splits: Splits | None = None, rules: Rules = RULES) -> DataFrame:
    """Adds ``prev_amount``, ``amount_change``, ``spike_ratio`` and ``is_spike``."""
    changed = features.amount_change(lag_amount(df, splits))
    return features.is_spike(features.spike_ratio(changed), rules)


def spike_report(df: DataFrame, n: int = 10, splits: Splits | None = None, rules: Rules = RULES) -> DataFrame:
    """The ``n`` largest jumps against the previous transaction of the account."""
    hits = spikes(df, splits, rules).filter(F.col("is_spike") == 1)
    top = hits.orderBy(F.desc("spike_ratio"), "transaction_id").limit(n)
    return top.select("account_id", "name", "timestamp", "prev_amount", "amount", "spike_ratio")


def running_total(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Adds ``running_total``: the account's amounts so far."""
    return cumulate(df, splits or account_splits(df), {"running_total": F.col("amount")})


def running_count(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Adds ``tx_count_so_far``: the account's transactions so far."""
    one = F.when(F.col("transaction_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return cumulate(df, splits or account_splits(df), {"tx_count_so_far": one})


def _percentile(below: Column, others: Column) -> Column:
    """Percent rank with one decimal from the number of smaller rows and of all other rows."""
    return F.when(others > 0, rounded_ratio(below * 100, others, 1)).otherwise(F.lit(0.0))


def percent_rank_global(
    df: DataFrame, col: str = "amount", splits: Splits | None = None, rows: int | None = None, min_buckets: int = 8
) -> DataFrame:
    """Adds ``amount_percentile``: the percent rank over all rows, one decimal.

    A window without partitions would move every row into one task. Here the rows are ranked within value ranges. Where
    a single value fills a range by itself, the distinct values are ranked instead and each row looks its value up.
    Nulls rank below all values.
    """
    if splits is None:
        splits = find_splits(df, [], [col], rows=rows, min_buckets=min_buckets)
    if not splits.whole and not splits.repeated:
        others = df.agg(F.count(F.lit(1)) - 1).scalar()
        ranked = rows_below(df, splits, "_below").withColumn("_others", others)
        share = _percentile(F.col("_below"), F.col("_others"))
        return ranked.withColumn("amount_percentile", share).drop("_below", "_others")
    table = ranked_values(df, [], col, splits=splits)
    # Summed over the distinct values, so that the shuffle below `table` serves this as well.
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    table = table.withColumn("_others", counts.agg(F.sum("n") - 1).scalar())
    table = table.select(F.col(col).alias("_value"), _percentile(F.col("below"), F.col("_others")).alias("amount_percentile"))
    return df.join(table, df[col].eqNullSafe(table["_value"]), "left").drop("_value")


def percentile_top(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest amounts with their percentile.

    Only the ``n`` rows need a rank, so the rows below each of them are counted in one pass without sorting the rest.
    """
    top = df.select("transaction_id", "name", "amount").orderBy(F.desc("amount"), "transaction_id").limit(n)
    marked = df.select("amount").withColumn("_marks", top.agg(F.collect_list("amount")).scalar())
    smaller = [F.count_if(F.coalesce(F.col("amount") < F.get("_marks", F.lit(i)), F.lit(True))) for i in range(n)]
    counted = marked.agg(
        F.array(*smaller).alias("below"), (F.count(F.lit(1)) - 1).alias("others"), F.first("_marks").alias("marks")
    )
    rows = top.withColumn("_c", counted.select(F.struct("*")).scalar())
    at = (F.array_position("_c.marks", F.col("amount")) - 1).cast("int")
    rows = rows.withColumn("_below", F.get("_c.below", at))
    return rows.withColumn("amount_percentile", _percentile(F.col("_below"), F.col("_c.others"))).drop("_c", "_below")


# Marks of a report that are broadcast.
MOST_MARKS = 100_000


def _search_steps(limit: int) -> list[int]:
    """The strides of a binary search among up to ``limit`` marks."""
    return [1 << k for k in reversed(range(max(1, limit).bit_length()))]


def running_and_rank_sql(spark: SparkSession, limit: int = 15) -> DataFrame:
    """The first rows by account and time with the running total and the amount's rank in the city, in Spark SQL.

    The rows asked for are the start of their accounts, so the running total needs no other row. The rank is one more than
    the number of larger amounts in the city. For that the amounts of the head are kept per city as a sorted array of marks;
    every row finds by binary search how many marks lie below its amount and adds one to that slot of its city, and the sum
    of the slots above a mark tells how many amounts are larger. Rows meet their city's marks, not the head's rows,
    and what is shuffled is at most a count per slot.
    """
    steps = _search_steps(limit)
    # There are at most as many marks as rows are asked for; beyond some thousands Spark chooses the join.
    hint = "/*+ BROADCAST(m) */" if limit <= MOST_MARKS else ""
    # Each step's position is a column that the next step uses.
    search = ",\n".join(
        f"p{k} + CASE WHEN get(marks, p{k} + {stride - 1}) < amount THEN {stride} ELSE 0 END AS p{k + 1}" for k, stride in enumerate(steps)
    )
    return spark.sql(
        f"""
        WITH head AS (
          SELECT account_id, name, city, timestamp, transaction_id, amount
          FROM banking_data
          ORDER BY account_id, timestamp, transaction_id
          LIMIT :n
        ),
        marked AS (SELECT city, sort_array(collect_set(amount)) AS marks FROM head GROUP BY city),
        placed AS (
          SELECT {hint} b.city, m.marks, b.amount, 0 AS p0, {search}
          FROM banking_data b JOIN marked m ON b.city <=> m.city
        ),
        counted AS (SELECT city, p{len(steps)} AS slot, count(*) AS n FROM placed GROUP BY city, p{len(steps)}),
        slots AS (SELECT city, collect_list(struct(slot, n)) AS slots FROM counted GROUP BY city),
        ranked AS (SELECT *, dense_rank() OVER (PARTITION BY city ORDER BY amount NULLS LAST) AS place FROM head)
        SELECT h.account_id, h.name, h.timestamp, h.amount,
               sum(h.amount) OVER (
                 PARTITION BY h.account_id ORDER BY h.timestamp, h.transaction_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
               ) AS running_total,
               1 + CASE WHEN h.amount IS NULL THEN 0L
                        ELSE coalesce(aggregate(filter(s.slots, x -> x.slot >= h.place), 0L, (a, x) -> a + x.n), 0L) END AS rank_in_city
        FROM ranked h LEFT JOIN slots s ON s.city <=> h.city
        ORDER BY h.account_id, h.timestamp, h.transaction_id
        """,
        args={"n": limit},
    )


def running_and_rank(
    full: DataFrame, splits: Splits | None = None, rows: int | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """All rows with the running total of the account and the rank of the amount in the city."""
    running = running_total(full, splits)
    ranked = _with_ranks(running, ["city"], "amount", rows, rows_per_task)
    rank = (F.col("_below") + 1).alias("rank_in_city")
    return ranked.select("transaction_id", "account_id", "name", "timestamp", "amount", "running_total", rank)
