"""Contributions of linear models and the reports built on any contributions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.ml.features import FEATURE_LABELS, FEATURES


def linear_contributions(
    df: DataFrame,
    coefficients: Sequence[float],
    intercept: float = 0.0,
    means: DataFrame | None = None,
    id_col: str = "transaction_id",
    cols: Sequence[str] = FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(id, base, score, phi[n], x[n], kept columns) of a linear score: coefficient times distance from the mean.

    ``means`` is one row with the mean of each column, of ``df`` itself by default. Columns only, no Python per row.
    """
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]) if means is None else means
    known = df.withColumn("_mean", means.select(F.struct(*cols)).scalar())
    base: Column = F.lit(float(intercept))
    for c, w in zip(cols, coefficients):
        base = base + F.lit(float(w)) * F.col(f"_mean.{c}")
    phi = [F.lit(float(w)) * (F.col(c).cast("double") - F.col(f"_mean.{c}")) for c, w in zip(cols, coefficients)]
    out = known.select(
        id_col,
        *keep,
        F.array(*[F.col(c).cast("double") for c in cols]).alias("x"),
        base.alias("base"),
        F.array(*phi).alias("phi"),
    )
    return out.withColumn("score", F.aggregate("phi", F.col("base"), lambda a, p: a + p))


def global_impact(phi: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, mean_abs, above_median), largest first; one aggregation over all rows, no long form."""
    means = phi.agg(*[F.avg(F.abs(F.get("phi", F.lit(i)))).alias(f"m{i}") for i in range(len(names))])
    pairs = [F.struct(F.lit(n).alias("feature"), F.col(f"m{i}").alias("mean_abs")) for i, n in enumerate(names)]
    table = means.select(F.inline(F.array(*pairs)))
    middle = table.agg(F.median("mean_abs")).scalar()
    return table.withColumn("above_median", F.col("mean_abs") > middle).orderBy(F.desc("mean_abs"), "feature")


def _entries(names: Sequence[str], key: Callable[[Column], Column]) -> Column:
    """Array of (key, feature number, feature, value, phi) of a row; sorted, it is in the order of keys, then of features."""

    def entry(i: int, name: str) -> Column:
        phi = F.get("phi", F.lit(i))
        return F.struct(
            key(phi).alias("k"),
            F.lit(i).alias("nth"),
            F.lit(name).alias("feature"),
            F.get("x", F.lit(i)).alias("value"),
            phi.alias("phi"),
        )

    return F.array(*[entry(i, n) for i, n in enumerate(names)])


def top_contributors(
    phi: DataFrame, k: int = 6, id_col: str = "transaction_id", names: Sequence[str] = FEATURE_LABELS
) -> DataFrame:
    """(id, position, feature, value, phi): the ``k`` largest contributions of each row by size. No shuffle."""
    best = F.slice(F.sort_array(_entries(names, lambda p: -F.abs(p))), 1, k)
    rows = phi.select(id_col, F.posexplode(best).alias("position", "e"))
    return rows.select(id_col, (F.col("position") + 1).alias("position"), "e.feature", "e.value", "e.phi")


def reason_codes(
    phi: DataFrame, k: int = 3, id_col: str = "transaction_id", names: Sequence[str] = FEATURE_LABELS
) -> DataFrame:
    """(id, up[], down[]): up to ``k`` reasons that raised and ``k`` that lowered the score, as text. No shuffle."""
    raised = F.filter(F.sort_array(_entries(names, lambda p: -p)), lambda e: e.getField("phi") > 0)
    lowered = F.filter(F.sort_array(_entries(names, lambda p: p)), lambda e: e.getField("phi") < 0)

    def text(direction: str):
        pattern = f"%s %.2f {direction} the score by %.4f"
        return lambda e: F.format_string(pattern, e.getField("feature"), e.getField("value"), F.abs(e.getField("phi")))

    up, down = F.slice(raised, 1, k), F.slice(lowered, 1, k)
    return phi.select(id_col, F.transform(up, text("raises")).alias("up"), F.transform(down, text("lowers")).alias("down"))


def dependence_rows(phi: DataFrame, feature: str = "amount", names: Sequence[str] = FEATURES) -> DataFrame:
    """(value, phi, is_fraud) of one feature, for a dependence plot; ``phi`` must have kept ``is_fraud``."""
    i = list(names).index(feature)
    return phi.select(F.get("x", F.lit(i)).alias("value"), F.get("phi", F.lit(i)).alias("phi"), "is_fraud")
