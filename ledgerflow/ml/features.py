"""The feature table of the fraud model, the split, scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions import features as f
from ledgerflow.operators.clean import impute_constant
from ledgerflow.plans.quantiles import quantiles
from ledgerflow.plans.splits import cumulate, find_splits
from ledgerflow.settings import RULES, Rules

# Fixed order of the model's inputs and their display names.
FEATURES = (
    "amount",
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_night",
    "age",
    "balance",
    "amount_to_balance",
    "tx_type_enc",
    "account_type_enc",
    "city_enc",
)
FEATURE_LABELS = (
    "Amount",
    "Hour",
    "Day of Week",
    "Month",
    "Is Weekend",
    "Is Night",
    "Customer Age",
    "Account Balance",
    "Amount/Balance Ratio",
    "TX Type",
    "Account Type",
    "City",
)
CATEGORIES = ("tx_type", "account_type", "city")
# Codes of a column are broadcast up to this many bytes.
BROADCAST_CODES = 32 << 20


def category_codes(df: DataFrame, col: str, rows: int | None = None) -> DataFrame:
    """(value, code): the sorted distinct values of the column numbered from 0; null counts as `unknown`.

    The numbering is a running count over the distinct values, so a column with very many of them is numbered in
    parallel. Grouping by one column lets the optimizer drop joins that the column does not come from.
    """
    values = df.select(F.coalesce(F.col(col).cast("string"), F.lit("unknown")).alias("value")).distinct()
    splits = find_splits(values, [], ["value"], rows=rows)
    numbered = cumulate(values, splits, {"code": F.lit(1).cast("long")})
    return numbered.withColumn("code", (F.col("code") - 1).cast("int"))


def label_encode(df: DataFrame, cols: Sequence[str], broadcast_bytes: int | None = None) -> DataFrame:
    """Adds ``<col>_enc`` for each column: the position of the value among the sorted distinct values.

    A category holds a large part of the rows, so rows should not be shuffled by it. Its codes are broadcast when their
    measured size is at most ``broadcast_bytes`` (``BROADCAST_CODES`` by default); otherwise Spark chooses the join.
    """
    limit, out = BROADCAST_CODES if broadcast_bytes is None else broadcast_bytes, df
    for c, (values, size) in _distinct_sizes(df, cols).items():
        lookup = category_codes(df, c, values).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}_enc"))
        on = F.coalesce(out[c].cast("string"), F.lit("unknown")) == lookup["_value"]
        out = out.join(F.broadcast(lookup) if size <= limit else lookup, on, "left").drop("_value")
    return out


def _distinct_sizes(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, int]]:
    """For each column the number of distinct values (null included) and the bytes of their texts, counted in one job."""
    parts = []
    for c in dict.fromkeys(cols):
        texts = df.select(F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")).distinct()
        size = F.coalesce(F.sum(F.octet_length("value") + 16), F.lit(0)).alias("bytes")
        parts.append(texts.agg(F.count(F.lit(1)).alias("n"), size).withColumn("col", F.lit(c)))
    found = {r["col"]: (r["n"], r["bytes"]) for r in reduce(DataFrame.unionByName, parts).collect()} if parts else {}
    return {c: found[c] for c in dict.fromkeys(cols)}


def feature_table(full: DataFrame, rows: int | None = None, rules: Rules = RULES) -> DataFrame:
    """(transaction_id, 12 numeric features, is_fraud) of the joined transactions.

    The quantile and the medians come from the whole set, before any split, all three in the same passes; ``rows`` is an
    upper bound on the size of ``full`` where one is known.
    """
    limits = quantiles(full, {"amount": rules.label_quantile, "age": 0.5, "balance": 0.5}, rows)
    known = full.withColumn("_limits", limits.select(F.struct("*")).scalar())
    labelled = f.fraud_label(known, F.col("_limits.amount"), rules)
    filled = labelled.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_limits.{c}")) for c in ("age", "balance")})
    named = impute_constant(filled.drop("_limits"), "city", rules.unknown_city)
    timed = f.is_night(f.is_weekend(f.calendar_parts_monday0(named)), rules=rules)
    encoded = label_encode(f.amount_to_balance(timed), CATEGORIES)
    return encoded.select("transaction_id", *[F.col(c).cast("double").alias(c) for c in FEATURES], "is_fraud")


def _place(id_col: str, seed: int) -> Column:
    """A row's place in a random order that depends on its id only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_split(
    df: DataFrame,
    label: str = "is_fraud",
    id_col: str = "transaction_id",
    frac: float = 0.8,
    seed: int = 42,
    exact: bool = False,
    last: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test). A row's side depends on the hash of its id, so the split is repeatable and needs no shuffle.

    The hash is independent of the label, so every class is split in the same proportion up to chance. ``exact`` fixes
    the sizes per class: in hash order, the last ``ceil((1 - frac) * n)`` rows of a class are test. ``last`` is what
    ``last_train_rows`` found, for callers that have stored it; otherwise each side finds it by itself.
    """
    place = _place(id_col, seed)
    if not exact:
        # Eight digits; at 1 there is no edge that long, and every row is a train row.
        low = place < format(int(frac * 16**8), "08x") if frac < 1 else F.lit(True)
        return df.filter(low), df.filter(~low)
    last = last_train_rows(df, label, id_col, frac, seed) if last is None else last
    known = df.join(F.broadcast(last), df[label].eqNullSafe(last["_label"]), "left")
    inside = F.coalesce(F.struct(place, F.col(id_col)) <= F.col("_last"), F.lit(False))
    return known.filter(inside).select(*df.columns), known.filter(~inside).select(*df.columns)


def last_train_rows(
    df: DataFrame, label: str = "is_fraud", id_col: str = "transaction_id", frac: float = 0.8, seed: int = 42
) -> DataFrame:
    """(_label, _last): place and id of the last train row of each class, one row per class.

    Hashes spread evenly, so their first five digits cut each class into a million small ranges whatever its size. Counting
    them finds the range with the border, and only that range is put in order. The rows themselves are not shuffled.
    """
    keys = df.select(F.col(label).alias("_label"), _place(id_col, seed).alias("_at"), F.col(id_col).alias("_id"))
    ranged = keys.withColumn("_range", F.substring("_at", 1, 5))
    counts = ranged.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.sum("n").over(Window.partitionBy("_label"))
    kept = size - F.ceil(F.round((1 - F.lit(frac)) * size, 6))
    border = counts.select("_label", "_range", "n", F.sum("n").over(so_far).alias("upto"), kept.alias("kept"))
    border = border.filter((F.col("upto") - F.col("n") < F.col("kept")) & (F.col("kept") <= F.col("upto")))
    wanted = border.select(
        F.col("_label").alias("_b"), F.col("_range").alias("_r"), (F.col("kept") - F.col("upto") + F.col("n")).alias("_quota")
    )
    # One row per class on the small side.
    near = ranged.join(F.broadcast(wanted), ranged["_label"].eqNullSafe(wanted["_b"]) & (ranged["_range"] == wanted["_r"]))
    nth = F.row_number().over(Window.partitionBy("_label").orderBy("_at", "_id"))
    ordered = near.withColumn("_nth", nth).filter(F.col("_nth") == F.col("_quota"))
    return ordered.select("_label", F.struct(F.col("_at"), F.col("_id")).alias("_last"))


def scaling(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with a struct (mean, deviation) per column; population deviation, 1 for a constant column."""
    return train.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0)).alias("deviation"),
            ).alias(c)
            for c in cols
        ]
    )


def standardize(train: DataFrame, *others: DataFrame, cols: Sequence[str]) -> list[DataFrame]:
    """Zero mean and unit variance, fitted on ``train`` and applied to all frames."""
    fitted = scaling(train, cols).select(F.struct(*cols))

    def scaled(df: DataFrame) -> DataFrame:
        known = df.withColumn("_fit", fitted.scalar())
        return known.withColumns(
            {c: (F.col(c) - F.col(f"_fit.{c}.mean")) / F.col(f"_fit.{c}.deviation") for c in cols}
        ).drop("_fit")

    return [scaled(df) for df in (train, *others)]


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Adds ``weight``: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = counts.withColumn("_all", totals).select(
        F.col(label).alias("_label"),
        (F.col("_all.n").cast("double") / (F.col("_all.k") * F.col("_n")).cast("double")).alias("weight"),
    )
    # One row per class.
    return df.join(F.broadcast(weights), df[label].eqNullSafe(weights["_label"]), "left").drop("_label")


def explain_sample(test: DataFrame, fraud: int = 3, legit: int = 2, id_col: str = "transaction_id") -> DataFrame:
    """The first fraud and the first legitimate rows by id. The rank filter runs before the shuffle."""
    order = Window.partitionBy("is_fraud").orderBy(id_col)
    nth = test.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= max(fraud, legit))
    wanted = F.when(F.col("is_fraud") == 1, F.lit(fraud)).otherwise(F.lit(legit))
    return nth.filter(F.col("_nth") <= wanted).drop("_nth")
