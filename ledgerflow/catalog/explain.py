"""Explanations. The linear ones have an SQL twin; those of the forest are checked in the tests."""

from pyspark.sql import functions as F

from ledgerflow.catalog.model import fitted, sides, stored
from ledgerflow.catalog.registry import query
from ledgerflow.explain import report, tree
from ledgerflow.ml import features as mf
from ledgerflow.ml import train
from ledgerflow.plans.adapter_sql import PARTS, oracle

# Coefficients of an example score, one per feature.
COEFFICIENTS = (8e-5, -0.02, 0.01, 0.015, 0.1, 0.3, -0.004, -2e-6, 0.5, 0.05, 0.03, 0.007)
INTERCEPT = -1.5

NUMBERED = list(enumerate(zip(mf.FEATURES, mf.FEATURE_LABELS, COEFFICIENTS)))
PARTS["means"] = (
    "SELECT " + ", ".join(f"avg({c}) AS {c}" for c in mf.FEATURES) + " FROM feature_table",
    ("feature_table",),
)
PARTS["phi"] = (
    "SELECT t.transaction_id, t.is_fraud, "
    + ", ".join(f"CAST({w!r} AS DOUBLE) * (t.{c} - m.{c}) AS p{i}, t.{c} AS x{i}" for i, (c, _, w) in NUMBERED)
    + f", CAST({INTERCEPT!r} AS DOUBLE) + "
    + " + ".join(f"CAST({w!r} AS DOUBLE) * m.{c}" for _, (c, _, w) in NUMBERED)
    + " AS base FROM feature_table t CROSS JOIN means m",
    ("feature_table", "means"),
)
PARTS["long"] = (
    " UNION ALL ".join(
        f"SELECT transaction_id, {i} AS nth, '{c}' AS feature, '{label}' AS label, x{i} AS value, p{i} AS phi FROM phi"
        for i, (c, label, _) in NUMBERED
    ),
    ("phi",),
)


def linear(star, keep=()):
    return report.linear_contributions(stored(star), COEFFICIENTS, INTERCEPT, keep=keep)


PHI_COLUMNS = [f"phi_{c}" for c in mf.FEATURES]


@query(
    "linear_contributions",
    oracle(
        "phi",
        "SELECT transaction_id, round(base, 6) AS base, round(base + "
        + " + ".join(f"p{i}" for i, _ in NUMBERED)
        + ", 6) AS score, "
        + ", ".join(f"round(p{i}, 6) AS phi_{c}" for i, (c, _, _) in NUMBERED)
        + " FROM phi",
    ),
)
def _(star):
    out = linear(star)
    phis = [F.round(F.get("phi", F.lit(i)), 6).alias(n) for i, n in enumerate(PHI_COLUMNS)]
    return out.select("transaction_id", F.round("base", 6).alias("base"), F.round("score", 6).alias("score"), *phis)


@query(
    "global_impact",
    oracle(
        "long",
        """SELECT feature, round(m, 6) AS mean_abs, m > median(m) OVER () AS above_median
           FROM (SELECT feature, avg(abs(phi)) AS m FROM long GROUP BY 1)""",
    ),
)
def _(star):
    return report.global_impact(linear(star)).withColumn("mean_abs", F.round("mean_abs", 6))


@query(
    "top_contributors",
    oracle(
        "long",
        """SELECT transaction_id, position, label AS feature, value, round(phi, 6) AS phi FROM (
             SELECT *, CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY abs(phi) DESC, nth) AS INTEGER) AS position
             FROM long) WHERE position <= 6""",
    ),
)
def _(star):
    return report.top_contributors(linear(star), 6).withColumn("phi", F.round("phi", 6))


def reasons_sql(direction: str, test: str, order: str, out: str) -> str:
    return f"""(SELECT transaction_id, string_agg(label || ' ' || printf('%.2f', value) || ' {direction} the score by '
        || printf('%.4f', abs(phi)), '; ' ORDER BY rn) AS {out} FROM (SELECT *, row_number() OVER
        (PARTITION BY transaction_id ORDER BY {order}, nth) AS rn FROM long WHERE {test}) WHERE rn <= 3 GROUP BY 1)"""


@query(
    "reason_codes",
    oracle(
        "long",
        f"""SELECT p.transaction_id, coalesce(u.up, '') AS up, coalesce(d.down, '') AS down FROM phi p
            LEFT JOIN {reasons_sql('raises', 'phi > 0', 'phi DESC', 'up')} u ON u.transaction_id = p.transaction_id
            LEFT JOIN {reasons_sql('lowers', 'phi < 0', 'phi', 'down')} d ON d.transaction_id = p.transaction_id""",
    ),
)
def _(star):
    return report.reason_codes(linear(star), 3)


@query(
    "explain_sample",
    oracle(
        "test_set",
        """SELECT transaction_id, is_fraud FROM (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY transaction_id) AS rn
           FROM test_set) WHERE rn <= CASE WHEN is_fraud = 1 THEN 3 ELSE 2 END""",
    ),
)
def _(star):
    return mf.explain_sample(sides(star)[1], 3, 2).select("transaction_id", "is_fraud")


@query("dependence_rows", oracle("phi", "SELECT x0 AS value, round(p0, 6) AS phi, is_fraud FROM phi"))
def _(star):
    rows = report.dependence_rows(linear(star, keep=["is_fraud"]), "amount")
    return rows.withColumn("phi", F.round("phi", 6))


def forest(star, keep=()):
    model, test = fitted(star, "random_forest")
    return tree.tree_contributions(model, test, keep=keep)


@query("tree_contributions")
def _(star):
    out = forest(star)
    phis = [F.get("phi", F.lit(i)).alias(n) for i, n in enumerate(PHI_COLUMNS)]
    return out.select("transaction_id", "base", "probability", *phis)


@query("tree_reason_codes")
def _(star):
    model, test = fitted(star, "random_forest")
    return report.reason_codes(tree.tree_contributions(model, mf.explain_sample(test)), 3)


@query(
    "tree_contributions_check",
    oracle("test_set", "SELECT transaction_id, TRUE AS adds_up, TRUE AS same_probability FROM test_set"),
)
def _(star):
    """Base and contributions add up to the probability, and to the one the model itself gives."""
    model, test = fitted(star, "random_forest")
    explained = tree.tree_contributions(model, test)
    scored = train.score(model, test).select("transaction_id", F.col("probability").alias("given"))
    total = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    return explained.join(scored, "transaction_id").select(
        "transaction_id",
        (F.abs(total - F.col("probability")) < 1e-6).alias("adds_up"),
        (F.abs(F.col("probability") - F.col("given")) < 1e-6).alias("same_probability"),
    )
