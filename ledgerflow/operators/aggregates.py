"""Summary queries. All of them aggregate partially before the shuffle, so a hot group costs one row per map task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exact import average_money, percent
from ledgerflow.functions.features import suspicious_dashboard
from ledgerflow.operators.enrich import filter_direction
from ledgerflow.settings import RULES, Rules

def row_count() -> Column:
    return F.count(F.lit(1))


def _sorted(df: DataFrame, ordered: bool, *keys: Column | str) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def spend_per_customer(full: DataFrame, ordered: bool = True) -> DataFrame:
    """Outgoing transactions per customer: number, sum, average and largest."""
    grouped = filter_direction(full, "outflow").groupBy("customer_id", "name", "city").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("_sum"),
        F.max("amount").alias("_max"),
    )
    out = grouped.select(
        "customer_id",
        "name",
        "city",
        "total_transactions",
        F.col("_sum").alias("total_spend"),
        average_money(F.col("_sum"), F.col("total_transactions")).alias("avg_tx_amount"),
        F.col("_max").alias("max_single_tx"),
    )
    return _sorted(out, ordered, F.desc("total_spend"), "customer_id")


def spend_by_category(full: DataFrame, ordered: bool = True) -> DataFrame:
    out = full.groupBy("category").agg(row_count().alias("num_transactions"), F.sum("amount").alias("total_amount"))
    return _sorted(out, ordered, F.desc("total_amount"), "category")


def spend_by_city_sql(spark: SparkSession) -> DataFrame:
    """Outgoing spend per city, as Spark SQL over the registered view."""
    totals = spark.sql(
        """
        SELECT city, count(*) AS num_transactions, sum(amount) AS total_spend
        FROM banking_data
        WHERE tx_direction = 'outflow'
        GROUP BY city
        """
    )
    average = average_money(F.col("total_spend"), F.col("num_transactions"))
    return totals.withColumn("avg_amount", average).orderBy(F.desc("total_spend"), "city")


def volume_by_month(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    grouped = df.groupBy(F.month(ts).alias("month"))
    return grouped.agg(F.count("transaction_id").alias("count"), F.sum("amount").alias("total"))


def total_by(df: DataFrame, key: str) -> DataFrame:
    """(key, total) over all directions; rows without a key are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.sum("amount").alias("total"))


def _with_percent(counts: DataFrame) -> DataFrame:
    """Adds ``pct``: the share of ``n`` in its total, which is a scalar subquery over the same counts."""
    whole = counts.withColumn("_all", counts.agg(F.sum("n")).scalar())
    return whole.withColumn("pct", percent(F.col("n"), F.col("_all"))).drop("_all")


def value_share(df: DataFrame, key: str) -> DataFrame:
    """(key, n, pct): how often each value occurs and its share of the rows that have a value."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(row_count().alias("n"))
    return _with_percent(counts)


def histogram(df: DataFrame, col: str, bins: int = 50, density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed: (bin, lo, hi, n) or (bin, lo, hi, density).

    Empty bins are present. A column with one value gets a range of one around it.
    """
    x = F.col(col).cast("double")
    values = df.select(x.alias("x")).filter("x is not null")
    stats = values.agg(F.min("x").alias("a"), F.max("x").alias("b"), row_count().alias("n"))
    flat = F.col("a") == F.col("b")
    span = stats.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
        F.col("n"),
    )
    ranged = values.withColumn("_span", span.select(F.struct("lo", "hi")).scalar())
    low, width = F.col("_span.lo"), F.col("_span.hi") - F.col("_span.lo")
    slot = F.least(F.floor((F.col("x") - low) * bins / width), F.lit(bins - 1)).cast("int")
    counts = ranged.groupBy(slot.alias("bin")).agg(row_count().alias("n"))
    edges = span.filter("n > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        (F.col("lo")).alias("_lo"),
        ((F.col("hi") - F.col("lo")) / bins).alias("_w"),
        F.col("n").alias("_all"),
    )
    out = edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        "_w",
        "_all",
    )
    if density:
        return out.select("bin", "lo", "hi", (F.col("n") / (F.col("_all") * F.col("_w"))).alias("density"))
    return out.select("bin", "lo", "hi", "n")


def class_mean(df: DataFrame) -> DataFrame:
    """Average amount of all rows and of the fraud rows, in whole cents."""
    fraud = F.col("is_fraud") == 1
    sums = df.agg(
        F.sum("amount").alias("s"),
        F.count("amount").alias("n"),
        F.sum(F.when(fraud, F.col("amount"))).alias("sf"),
        F.count(F.when(fraud, F.col("amount"))).alias("nf"),
    )
    return sums.select(
        average_money(F.col("s"), F.col("n")).alias("mean_all"),
        average_money(F.col("sf"), F.col("nf")).alias("mean_fraud"),
    )


def activity_heatmap(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Transactions per weekday (0 = Monday) in 24 hour columns ``h0`` .. ``h23``; one pass, no pivot discovery."""
    hour = F.hour(ts)
    cells = [F.count_if(hour == h).alias(f"h{h}") for h in range(24)]
    return df.filter(F.col(ts).isNotNull()).groupBy(F.weekday(ts).alias("day_of_week")).agg(*cells)


def suspicious_by_city(df: DataFrame, ordered: bool = True, rules: Rules = RULES) -> DataFrame:
    kept = suspicious_dashboard(df, rules).filter(F.col("city").isNotNull())
    return _sorted(kept.groupBy("city").agg(row_count().alias("n")), ordered, F.desc("n"), "city")


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the largest totals."""
    totals = df.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.sum("amount").alias("amount"))
    return totals.orderBy(F.desc("amount"), "customer_id").limit(n)


def fraud_by_hour(df: DataFrame, scale: int = 1, ts: str = "timestamp") -> DataFrame:
    """(hour, legit, fraud); ``scale`` stretches the fraud curve, as the chart does by five."""
    fraud = F.count_if(F.col("is_fraud") == 1) * F.lit(scale)
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.hour(ts).alias("hour"))
        .agg(F.count_if(F.col("is_fraud") == 0).alias("legit"), fraud.alias("fraud"))
    )


def fraud_by_account_type(df: DataFrame, ordered: bool = True) -> DataFrame:
    kept = df.filter((F.col("is_fraud") == 1) & F.col("account_type").isNotNull())
    return _sorted(kept.groupBy("account_type").agg(row_count().alias("n")), ordered, F.desc("n"), "account_type")


def fraud_rate_by_city(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Live records per city: number, flagged and flagged in percent."""
    grouped = events.groupBy("city").agg(
        row_count().alias("total"), F.sum("is_fraud").alias("fraud_count"), F.count("is_fraud").alias("_known")
    )
    out = grouped.withColumn("fraud_rate_pct", percent(F.col("fraud_count"), F.col("_known"))).drop("_known")
    return _sorted(out, ordered, F.desc("fraud_rate_pct"), "city")


def volume_by_type(events: DataFrame, ordered: bool = True) -> DataFrame:
    out = events.groupBy("tx_type").agg(row_count().alias("count"), F.sum("amount").alias("total_amount"))
    return _sorted(out, ordered, F.desc("total_amount"), "tx_type")


def class_balance(df: DataFrame) -> DataFrame:
    """(is_fraud, n, pct) of the training label."""
    counts = df.groupBy("is_fraud").agg(row_count().alias("n"))
    return _with_percent(counts)


def kpi_cards(df: DataFrame) -> DataFrame:
    """The four headline figures in one row."""
    sums = df.agg(
        row_count().alias("total"),
        F.sum("amount").alias("_sum"),
        F.count("amount").alias("_n"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud"),
    )
    return sums.select(
        "total",
        F.col("_sum").alias("volume"),
        "fraud",
        percent(F.col("fraud"), F.col("total")).alias("fraud_pct"),
        average_money(F.col("_sum"), F.col("_n")).alias("avg_amount"),
    )


def stream_summary(events: DataFrame) -> DataFrame:
    """Total, flagged, volume and flagged share of live records, in one row."""
    sums = events.agg(
        row_count().alias("total"), F.count_if(F.col("is_fraud") == 1).alias("flagged"), F.sum("amount").alias("_sum")
    )
    return sums.select(
        "total", "flagged", F.col("_sum").alias("volume"), percent(F.col("flagged"), F.col("total")).alias("flagged_pct")
    )


def stream_type_counts(events: DataFrame) -> DataFrame:
    """(tx_type, total, flagged) of live records; a null type is one of its own."""
    return events.groupBy("tx_type").agg(row_count().alias("total"), F.count_if(F.col("is_fraud") == 1).alias("flagged"))


def recent_transactions(df: DataFrame, n: int = 10, ts: str = "timestamp") -> DataFrame:
    """The newest ``n`` transactions with their verdict."""
    newest = df.orderBy(F.desc(ts), "transaction_id").limit(n)
    verdict = F.when(F.col("is_fraud") == 1, "FRAUD").otherwise("LEGIT")
    return newest.select("transaction_id", "amount", "tx_type", "status", "city", verdict.alias("verdict"))
