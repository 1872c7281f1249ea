"""Classification metrics as aggregations over any frame with a label, a prediction and a score."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans.splits import Splits, ranked_values

LABEL, PREDICTION, SCORE = "is_fraud", "prediction", "probability"
# Products of two row counts need more than a long.
COUNT = T.DecimalType(38, 0)


def _ratio(part: Column, whole: Column, missing: float | None = 0.0) -> Column:
    """Quotient of two counts as a double, ``missing`` when there is nothing to divide by."""
    value = part.cast("double") / F.when(whole != 0, whole).cast("double")
    return value if missing is None else F.coalesce(value, F.lit(missing))


def _cells(scored: DataFrame) -> DataFrame:
    """One row with the four counts ``n00`` .. ``n11`` (label, prediction); the whole base of the class metrics."""
    return scored.agg(
        *[F.count_if((F.col(LABEL) == a) & (F.col(PREDICTION) == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)]
    )


def _right() -> Column:
    return F.col("n00") + F.col("n11")


def _total() -> Column:
    return F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")


def _support(c: int) -> Column:
    return F.col(f"n{c}0") + F.col(f"n{c}1")


def _rates(c: int) -> dict[str, Column]:
    """Precision, recall and F1 of a class; 0 where there is nothing to divide by."""
    hit = F.col(f"n{c}{c}")
    precision = _ratio(hit, F.col(f"n0{c}") + F.col(f"n1{c}"))
    recall = _ratio(hit, _support(c))
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return {"precision": precision, "recall": recall, "f1": f1}


def accuracy(scored: DataFrame) -> DataFrame:
    """One row: share of correct predictions."""
    return _cells(scored).select(_ratio(_right(), _total(), None).alias("accuracy"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """(label, prediction, n): all four cells, empty ones with 0."""
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n{a}{b}").alias("n"))
        for a in (0, 1)
        for b in (0, 1)
    ]
    return _cells(scored).select(F.inline(F.array(*cells)))


def classification_report(scored: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) for both classes, accuracy, macro and weighted averages. One pass."""
    rates = {c: _rates(c) for c in (0, 1)}
    names = ("precision", "recall", "f1")

    def line(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), *[values[n].alias(n) for n in names], support.alias("support"))

    macro = {n: (rates[0][n] + rates[1][n]) / 2 for n in names}
    weighted = {n: _ratio(rates[0][n] * _support(0) + rates[1][n] * _support(1), _total()) for n in names}
    share = _ratio(_right(), _total())
    lines = [
        line("Legitimate", rates[0], _support(0)),
        line("Fraud", rates[1], _support(1)),
        line("accuracy", {n: share for n in names}, _total()),
        line("macro avg", macro, _total()),
        line("weighted avg", weighted, _total()),
    ]
    return _cells(scored).select(F.inline(F.array(*lines)))


def fraud_prf(scored: DataFrame) -> DataFrame:
    """(precision, recall, f1) of the fraud class."""
    return _cells(scored).select(*[c.alias(n) for n, c in _rates(1).items()])


def _by_score(scored: DataFrame, splits: Splits | None, rows: int | None, rows_per_task: int | None) -> DataFrame:
    """One row per distinct score, best first: positives and negatives at it and above it."""
    known = scored.select((F.lit(0.0) - F.col(SCORE)).alias("key"), F.col(LABEL).alias("y"))
    weights = {"pos": F.count_if(F.col("y") == 1), "neg": F.count_if(F.col("y") == 0)}
    return ranked_values(
        known, [], "key", rows=rows, splits=splits, weights=weights, min_buckets=8, rows_per_task=rows_per_task
    )


def roc_auc(
    scored: DataFrame, rows: int | None = None, splits: Splits | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """One row: the probability that a fraud row scores above a legitimate one, ties counting half; null for one class.

    Exact: scores are grouped, running counts are exact whole numbers and only the last division is in floating point.
    """
    groups = _by_score(scored, splits, rows, rows_per_task)
    pos, neg, above = (F.col(c).cast(COUNT) for c in ("pos", "neg", "pos_below"))
    # Twice the number of (fraud, legit) pairs in the right order: fraud rows above this score, plus half the ties.
    sums = groups.agg(
        F.sum((neg * (above * 2 + pos)).cast(COUNT)).alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    pairs = (F.col("p").cast(COUNT) * F.col("n") * 2).cast(COUNT)
    return sums.select(_ratio(F.col("won"), pairs, None).alias("auc"))


def roc_curve(
    scored: DataFrame, rows: int | None = None, splits: Splits | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score and the start (0, 0) with an infinite threshold."""
    groups = _by_score(scored, splits, rows, rows_per_task)
    counts = scored.groupBy(SCORE).agg(
        F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg")
    )
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    points = groups.withColumn("_all", totals).select(
        (F.lit(0.0) - F.col("key")).alias("threshold"),
        _ratio(F.col("neg_below") + F.col("neg"), F.col("_all.n"), None).alias("fpr"),
        _ratio(F.col("pos_below") + F.col("pos"), F.col("_all.p"), None).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def model_comparison(scored: Mapping[str, DataFrame], rows: int | None = None) -> DataFrame:
    """(model, accuracy, auc, precision, recall, f1) of each scored frame."""
    parts = []
    for name, frame in scored.items():
        cells = _cells(frame)
        rates = [c.alias(n) for n, c in _rates(1).items()]
        share = _ratio(_right(), _total(), None).alias("accuracy")
        auc = roc_auc(frame, rows=rows).scalar().alias("auc")
        parts.append(cells.select(F.lit(name).alias("model"), share, auc, *rates))
    return reduce(DataFrame.unionByName, parts)


def best_model(comparison: DataFrame, override: str | None = None) -> DataFrame:
    """The row with the largest AUC, ties by name, or the named model."""
    if override is not None:
        return comparison.filter(F.col("model") == override)
    return comparison.orderBy(F.desc_nulls_last("auc"), "model").limit(1)
