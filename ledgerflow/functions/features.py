"""Row features and risk flags. Every function keeps the input columns and adds the named ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans.quantiles import LEVELS, quantiles
from ledgerflow.settings import RULES, Rules


# ---- calendar ---------------------------------------------------------------------------------------------------


def calendar_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``hour``, ``day_of_week`` (1 = Sunday), ``month`` and ``year``."""
    t = F.col(ts)
    return df.withColumns({"hour": F.hour(t), "day_of_week": F.dayofweek(t), "month": F.month(t), "year": F.year(t)})


def calendar_parts_monday0(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``hour``, ``day_of_week`` (0 = Monday) and ``month``."""
    t = F.col(ts)
    return df.withColumns({"hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t)})


def month_name(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``month_name``: Jan, Feb, ..."""
    return df.withColumn("month_name", F.date_format(ts, "MMM"))


def is_weekend(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``is_weekend``: 1 on Saturday and Sunday."""
    return df.withColumn("is_weekend", F.dayofweek(ts).isin(1, 7).cast("int"))


def is_night(df: DataFrame, ts: str = "timestamp", rules: Rules = RULES) -> DataFrame:
    """Adds ``is_night``: 1 in the first hours of the day."""
    return df.withColumn("is_night", F.hour(ts).between(*rules.night_hours).cast("int"))


def time_of_day(df: DataFrame, ts: str = "timestamp", rules: Rules = RULES) -> DataFrame:
    """Adds ``time_of_day``; a missing time counts as night."""
    hour = F.hour(ts)
    part = F
    for first, last, name in rules.day_parts:
        part = part.when(hour.between(first, last), name)
    return df.withColumn("time_of_day", part.otherwise("night"))


# ---- amounts ----------------------------------------------------------------------------------------------------


def cut(
    df: DataFrame,
    col: str,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    out: str = "bin",
) -> DataFrame:
    """Adds the label of the interval that holds ``col``; values outside all intervals get null.

    ``edges`` has one more entry than ``labels``; None stands for an open end. Intervals are closed on the right,
    or on the left with ``right=False``.
    """
    value = F.col(col)
    chosen = F
    for low, high, label in zip(edges, edges[1:], labels):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value > low if right else value >= low)
        if high is not None:
            inside = inside & (value <= high if right else value < high)
        chosen = chosen.when(inside & value.isNotNull(), label)
    return df.withColumn(out, chosen.otherwise(F.lit(None).cast("string")))


def amount_band(df: DataFrame, rules: Rules = RULES, out: str = "amount_category") -> DataFrame:
    """Adds the amount band, closed on the left; a missing amount falls into the last band."""
    band = F
    for edge, name in zip(rules.band_edges, rules.band_names):
        band = band.when(F.col("amount") < edge, name)
    return df.withColumn(out, band.otherwise(rules.band_names[-1]))


def amount_bin_right(df: DataFrame, rules: Rules = RULES, out: str = "amount_bin") -> DataFrame:
    """Adds the amount band, closed on the right and starting above zero."""
    return cut(df, "amount", (0, *rules.band_edges, None), rules.band_names, right=True, out=out)


def unit_scale(df: DataFrame, col: str, factor: float, out: str | None = None) -> DataFrame:
    """Divides ``col`` by ``factor`` (thousands, millions) as a double."""
    return df.withColumn(out or col, F.col(col).cast("double") / F.lit(float(factor)))


def amount_to_balance(df: DataFrame) -> DataFrame:
    """Adds ``amount / (balance + 1)`` as a double; null for a balance of exactly -1."""
    above = F.col("balance").cast("double") + F.lit(1.0)
    ratio = F.try_divide(F.col("amount").cast("double"), above)
    return df.withColumn("amount_to_balance", ratio)


# ---- classification and rules -----------------------------------------------------------------------------------


def tx_direction(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Adds ``tx_direction``: inflow, outflow or neutral."""
    kind = F.col("tx_type")
    return df.withColumn(
        "tx_direction",
        F.when(kind.isin(*rules.inflow_types), "inflow").when(kind.isin(*rules.outflow_types), "outflow").otherwise("neutral"),
    )


def suspicious_batch(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Adds ``is_suspicious`` (0/1, or null when neither side of the rule can be decided)."""
    rule = (F.col("amount") > rules.suspicious_amount) | (F.col("status") == "failed")
    return df.withColumn("is_suspicious", rule.cast("int"))


def suspicious_dashboard(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Keeps the rows the dashboard calls suspicious."""
    return df.filter((F.col("amount") > rules.suspicious_amount) | F.col("status").isin(*rules.bad_statuses))


def fraud_label(
    df: DataFrame,
    threshold: Column | None = None,
    rules: Rules = RULES,
    ts: str = "timestamp",
    rows: int | None = None,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Adds the training label ``is_fraud`` (0/1; a rule that cannot be decided does not fire).

    ``threshold`` is the high-amount quantile; by default it is taken from ``df`` itself as a scalar subquery.
    ``rows``, an upper bound on the size of ``df`` where one is known, and ``levels`` are those of ``plans.quantiles``.
    """
    if threshold is None:
        top = quantiles(df, {"amount": rules.label_quantile}, rows, levels=levels)
        threshold = top.scalar()
    amount, status = F.col("amount"), F.col("status")
    rule = (
        ((amount > rules.label_amount) & status.isin(*rules.bad_statuses))
        | ((amount.cast("double") > threshold) & (status == "failed"))
        | (F.hour(ts).between(*rules.label_hours) & (amount > rules.label_night_amount))
    )
    return df.withColumn("is_fraud", F.coalesce(rule, F.lit(False)).cast("int"))


def live_rules(rules: Rules = RULES) -> list[tuple[str, Column]]:
    """The live rules in report order; add your own ``(name, condition)`` pairs to the list."""
    amount = F.col("amount")
    return [
        ("HIGH_AMOUNT", amount > rules.live_high_amount),
        ("FAILED_HIGH_TX", F.col("status").isin(*rules.bad_statuses) & (amount > rules.live_failed_amount)),
        ("LARGE_WITHDRAWAL", (F.col("tx_type") == "withdrawal") & (amount > rules.live_withdrawal_amount)),
    ]


def rule_flags(df: DataFrame, checks: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Adds ``fraud_flags``: the names of the rules that fire, in rule order."""
    names = [F.when(condition, F.lit(name)) for name, condition in (live_rules() if checks is None else checks)]
    flags = F.array_compact(F.array(*names)) if names else F.array().cast(T.ArrayType(T.StringType()))
    return df.withColumn("fraud_flags", flags)


def is_flagged(df: DataFrame) -> DataFrame:
    """Adds ``is_fraud``: 1 when any live rule fired."""
    return df.withColumn("is_fraud", (F.size("fraud_flags") > 0).cast("int"))


def alert_text(df: DataFrame) -> DataFrame:
    """Adds ``alert``: the flags joined by commas, or OK."""
    return df.withColumn("alert", F.when(F.size("fraud_flags") > 0, F.concat_ws(",", "fraud_flags")).otherwise("OK"))


# ---- change against the previous transaction --------------------------------------------------------------------


def amount_change(df: DataFrame) -> DataFrame:
    """Adds ``amount_change``; needs ``prev_amount``."""
    return df.withColumn("amount_change", F.col("amount") - F.col("prev_amount"))


def spike_ratio(df: DataFrame) -> DataFrame:
    """Adds ``spike_ratio`` with two decimals; null without a positive previous amount."""
    ratio = F.round(F.try_divide(F.col("amount"), F.col("prev_amount")), 2)
    return df.withColumn("spike_ratio", F.when(F.col("prev_amount") > 0, ratio))


def is_spike(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Adds ``is_spike`` (0/1, null where there is no ratio)."""
    return df.withColumn("is_spike", (F.col("spike_ratio") > rules.spike_factor).cast("int"))
