"""The fraud model: features, split, scaling, training, metrics.

Metrics are checked on a score that SQL can compute as well, so that no fitting noise enters. Trained models are kept per
session and data folder, since several queries read the same one.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.catalog.features import codes_sql
from ledgerflow.catalog.registry import query
from ledgerflow.catalog.sources import median_sql
from ledgerflow.functions.exact import cents, rounded_ratio
from ledgerflow.ml import features as mf
from ledgerflow.ml import metrics, train
from ledgerflow.plans.adapter import Star
from ledgerflow.plans.adapter_sql import PARTS, oracle

PARTS["prepared"] = (
    f"""SELECT l.*, coalesce(CAST(age AS DOUBLE), {median_sql('age', 'joined')}) AS age_f,
          coalesce(CAST(balance AS DOUBLE), {median_sql('balance', 'joined')}) AS balance_f,
          coalesce(city, 'Unknown') AS city_f FROM labelled l""",
    ("labelled", "joined"),
)
PARTS["feature_table"] = (
    f"""SELECT p.transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(hour("timestamp") AS DOUBLE) AS hour,
          CAST(isodow("timestamp") - 1 AS DOUBLE) AS day_of_week, CAST(month("timestamp") AS DOUBLE) AS month,
          CASE WHEN isodow("timestamp") >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
          CASE WHEN hour("timestamp") <= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_night,
          age_f AS age, balance_f AS balance, CAST(amount AS DOUBLE) / (balance_f + 1.0) AS amount_to_balance,
          CAST(a.code AS DOUBLE) AS tx_type_enc, CAST(b.code AS DOUBLE) AS account_type_enc, CAST(c.code AS DOUBLE) AS city_enc,
          is_fraud
        FROM prepared p JOIN {codes_sql('tx_type', 'prepared')} a ON a.v = coalesce(p.tx_type, 'unknown')
        JOIN {codes_sql('account_type', 'prepared')} b ON b.v = coalesce(p.account_type, 'unknown')
        JOIN {codes_sql('city_f', 'prepared')} c ON c.v = p.city_f""",
    ("prepared",),
)
PARTS["sides"] = (
    """SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || transaction_id), transaction_id)
         <= n - (n + 4) // 5 AS in_train
       FROM feature_table JOIN (SELECT is_fraud, count(*) AS n FROM feature_table GROUP BY 1) USING (is_fraud)""",
    ("feature_table",),
)
PARTS["train_set"] = ("SELECT * FROM sides WHERE in_train", ("sides",))
PARTS["test_set"] = ("SELECT * FROM sides WHERE NOT in_train", ("sides",))

COLUMNS = ", ".join(mf.FEATURES)


def feature_table(star: Star) -> DataFrame:
    return mf.feature_table(star.full, rows=star.rows)


def stored(star: Star) -> DataFrame:
    """The feature table, written once per session and folder."""
    return star.stored("features", lambda: feature_table(star))


def sides(star: Star) -> tuple[DataFrame, DataFrame]:
    """The stored train and test rows; every class is divided exactly."""
    last = star.stored("last-train-rows", lambda: mf.last_train_rows(stored(star)))
    train_rows, test_rows = mf.stratified_split(stored(star), exact=True, last=last)
    return star.stored("train", lambda: train_rows), star.stored("test", lambda: test_rows)


@query("feature_table", oracle("feature_table", f"SELECT transaction_id, {COLUMNS}, is_fraud FROM feature_table"))
def _(star):
    return feature_table(star)


@query(
    "stratified_split",
    oracle(
        "labelled",
        """SELECT transaction_id, is_fraud, CASE WHEN md5('42:' || transaction_id) < 'cccccccc' THEN 'train' ELSE 'test' END
           AS side FROM labelled""",
    ),
)
def _(star):
    labelled = star.labelled.select("transaction_id", "is_fraud")
    a, b = mf.stratified_split(labelled)
    return a.withColumn("side", F.lit("train")).unionByName(b.withColumn("side", F.lit("test")))


@query(
    "stratified_split_exact",
    oracle(
        "labelled",
        """SELECT transaction_id, is_fraud, CASE WHEN row_number() OVER (PARTITION BY is_fraud ORDER BY
             md5('42:' || transaction_id), transaction_id) <= n - (n + 4) // 5 THEN 'train' ELSE 'test' END AS side
           FROM labelled JOIN (SELECT is_fraud, count(*) AS n FROM labelled GROUP BY 1) USING (is_fraud)""",
    ),
)
def _(star):
    labelled = star.labelled.select("transaction_id", "is_fraud")
    a, b = mf.stratified_split(labelled, exact=True)
    return a.withColumn("side", F.lit("train")).unionByName(b.withColumn("side", F.lit("test")))


FITTED_SQL = "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in mf.FEATURES) + " FROM train_set"
SCALED_SQL = ", ".join(f"round((t.{c} - m_{c}) / (CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END), 6) AS {c}" for c in mf.FEATURES)


@query(
    "standardize",
    oracle(
        "train_set test_set",
        " UNION ALL ".join(f"SELECT '{side}' AS side, t.transaction_id, {SCALED_SQL} FROM {side}_set t, fitted" for side in ("train", "test")),
        fitted=FITTED_SQL,
    ),
)
def _(star):
    a, b = mf.standardize(*sides(star), cols=mf.FEATURES)
    both = a.withColumn("side", F.lit("train")).unionByName(b.withColumn("side", F.lit("test")))
    return both.select("side", "transaction_id", *[F.round(c, 6).alias(c) for c in mf.FEATURES])


@query(
    "class_weights",
    oracle(
        "labelled",
        """SELECT transaction_id, is_fraud, CAST((SELECT count(*) FROM labelled) AS DOUBLE) /
             CAST((SELECT count(DISTINCT is_fraud) FROM labelled) * count(*) OVER (PARTITION BY is_fraud) AS DOUBLE) AS weight
           FROM labelled""",
    ),
)
def _(star):
    labelled = star.labelled.select("transaction_id", "is_fraud")
    return mf.class_weights(labelled)


# ---- metrics on scores SQL can compute ----------------------------------------------------------------------------

HALF_POINT = 2_000_000  # cents at which the amount score is one half
CUT = 0.6


def scored_by_amount(star: Star) -> DataFrame:
    labelled = star.labelled
    paid = cents(F.col("amount"))
    score = rounded_ratio(paid, paid + HALF_POINT, 4)
    out = labelled.select("transaction_id", "is_fraud", score.alias("probability"))
    return out.withColumn("prediction", (F.col("probability") >= CUT).cast("int"))


def scored_by_hour(star: Star) -> DataFrame:
    labelled = star.labelled
    score = rounded_ratio(24 - F.hour("timestamp"), F.lit(24), 4)
    out = labelled.select("transaction_id", "is_fraud", score.alias("probability"))
    return out.withColumn("prediction", (F.col("probability") >= CUT).cast("int"))


PARTS["s_amount"] = (
    f"""SELECT *, CASE WHEN probability >= {CUT} THEN 1 ELSE 0 END AS prediction FROM (
          SELECT transaction_id, is_fraud, CAST((20000 * c + c + {HALF_POINT}) // (2 * (c + {HALF_POINT})) AS DOUBLE) / 10000.0
            AS probability FROM (SELECT *, CAST(amount * 100 AS HUGEINT) AS c FROM labelled))""",
    ("labelled",),
)
PARTS["s_hour"] = (
    f"""SELECT *, CASE WHEN probability >= {CUT} THEN 1 ELSE 0 END AS prediction FROM (
          SELECT transaction_id, is_fraud, CAST((20000 * (24 - hour("timestamp")) + 24) // 48 AS DOUBLE) / 10000.0 AS probability
          FROM labelled)""",
    ("labelled",),
)


def auc_sql(table: str) -> str:
    return f"""(SELECT CAST(sum(neg * (2 * above + pos)) AS DOUBLE) / CAST(2 * CAST(sum(pos) AS HUGEINT) * sum(neg) AS DOUBLE)
      FROM (SELECT CAST(pos AS HUGEINT) AS pos, CAST(neg AS HUGEINT) AS neg,
              CAST(sum(pos) OVER (ORDER BY probability DESC) - pos AS HUGEINT) AS above
            FROM (SELECT probability, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM {table} GROUP BY 1)))"""


def accuracy_sql(table: str) -> str:
    return f"(SELECT CAST(count_if(is_fraud = prediction) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM {table})"


def class_sql(table: str) -> str:
    """Precision, recall, F1 and support of both classes."""
    per_class = " UNION ALL ".join(
        f"""SELECT {c} AS c, CAST(count_if(is_fraud = {c} AND prediction = {c}) AS DOUBLE) AS hit,
              CAST(count_if(prediction = {c}) AS DOUBLE) AS said, count_if(is_fraud = {c}) AS support FROM {table}"""
        for c in (0, 1)
    )
    return f"""SELECT c, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
      ELSE 0.0 END AS f1, support FROM (SELECT c, support, coalesce(hit / nullif(said, 0), 0) AS precision,
      coalesce(hit / nullif(CAST(support AS DOUBLE), 0), 0) AS recall FROM ({per_class}))"""


@query("accuracy", oracle("s_amount", f"SELECT {accuracy_sql('s_amount')} AS accuracy"))
def _(star):
    return metrics.accuracy(scored_by_amount(star))


@query("roc_auc", oracle("s_amount", f"SELECT {auc_sql('s_amount')} AS auc"))
def _(star):
    return metrics.roc_auc(scored_by_amount(star), rows=star.rows)


@query(
    "classification_report",
    oracle(
        "s_amount",
        f"""SELECT CASE c WHEN 1 THEN 'Fraud' ELSE 'Legitimate' END AS class, precision, recall, f1, support FROM k
            UNION ALL SELECT 'accuracy', {accuracy_sql('s_amount')}, {accuracy_sql('s_amount')}, {accuracy_sql('s_amount')},
              CAST(sum(support) AS BIGINT) FROM k
            UNION ALL SELECT 'macro avg', (max(CASE c WHEN 0 THEN precision END) + max(CASE c WHEN 1 THEN precision END)) / 2,
              (max(CASE c WHEN 0 THEN recall END) + max(CASE c WHEN 1 THEN recall END)) / 2,
              (max(CASE c WHEN 0 THEN f1 END) + max(CASE c WHEN 1 THEN f1 END)) / 2, CAST(sum(support) AS BIGINT) FROM k
            UNION ALL SELECT 'weighted avg',
              (max(CASE c WHEN 0 THEN precision * support END) + max(CASE c WHEN 1 THEN precision * support END)) / CAST(sum(support) AS DOUBLE),
              (max(CASE c WHEN 0 THEN recall * support END) + max(CASE c WHEN 1 THEN recall * support END)) / CAST(sum(support) AS DOUBLE),
              (max(CASE c WHEN 0 THEN f1 * support END) + max(CASE c WHEN 1 THEN f1 * support END)) / CAST(sum(support) AS DOUBLE),
              CAST(sum(support) AS BIGINT) FROM k""",
        k=class_sql("s_amount"),
    ),
)
def _(star):
    return metrics.classification_report(scored_by_amount(star))


@query(
    "confusion_matrix",
    oracle(
        "s_amount",
        """SELECT a AS label, b AS prediction, (SELECT count(*) FROM s_amount WHERE is_fraud = a AND s_amount.prediction = b) AS n
           FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) cells(a, b)""",
    ),
)
def _(star):
    return metrics.confusion_matrix(scored_by_amount(star))


@query(
    "roc_curve",
    oracle(
        "s_amount",
        """SELECT probability AS threshold, CAST(sum(neg) OVER (ORDER BY probability DESC) AS DOUBLE) / CAST(sum(neg) OVER () AS DOUBLE) AS fpr,
             CAST(sum(pos) OVER (ORDER BY probability DESC) AS DOUBLE) / CAST(sum(pos) OVER () AS DOUBLE) AS tpr
           FROM (SELECT probability, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM s_amount GROUP BY 1)
           UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
    ),
)
def _(star):
    return metrics.roc_curve(scored_by_amount(star), rows=star.rows)


@query("fraud_prf", oracle("s_amount", "SELECT precision, recall, f1 FROM k WHERE c = 1", k=class_sql("s_amount")))
def _(star):
    return metrics.fraud_prf(scored_by_amount(star))


COMPARISON_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS model, {accuracy_sql(table)} AS accuracy, {auc_sql(table)} AS auc, precision, recall, f1
        FROM ({class_sql(table)}) WHERE c = 1"""
    for name, table in (("amount", "s_amount"), ("hour", "s_hour"))
)


@query("model_comparison", oracle("s_amount s_hour", COMPARISON_SQL))
def _(star):
    return metrics.model_comparison({"amount": scored_by_amount(star), "hour": scored_by_hour(star)}, rows=star.rows)


@query("best_model", oracle("s_amount s_hour", f"SELECT * FROM ({COMPARISON_SQL}) ORDER BY auc DESC, model LIMIT 1"))
def _(star):
    both = {"amount": scored_by_amount(star), "hour": scored_by_hour(star)}
    return metrics.best_model(metrics.model_comparison(both, rows=star.rows))


# ---- trained models -----------------------------------------------------------------------------------------------


def fitted(star: Star, kind: str):
    """(model, test set as the model wants it); fitted once per session and folder."""
    a, b = sides(star)
    if kind == "logistic_regression":
        a, b = mf.standardize(a, b, cols=mf.FEATURES)
        scaled = a
        a = star.stored("train-scaled", lambda: scaled)
    return star.once(kind, lambda: getattr(train, kind)(a)), b


def scored_by_model(star: Star, kind: str) -> DataFrame:
    model, test = fitted(star, kind)
    return train.score(model, test).select("transaction_id", "is_fraud", "prediction", "probability")


@query("random_forest")
def _(star):
    return scored_by_model(star, "random_forest")


@query("gradient_boosting")
def _(star):
    return scored_by_model(star, "gradient_boosting")


@query("logistic_regression")
def _(star):
    return scored_by_model(star, "logistic_regression")


@query("feature_importance")
def _(star):
    model, _ = fitted(star, "random_forest")
    return train.feature_importance(model)


@query("trained_comparison")
def _(star):
    kinds = ("random_forest", "gradient_boosting", "logistic_regression")
    return metrics.model_comparison({k: scored_by_model(star, k) for k in kinds}, rows=star.rows)


# ---- what must hold for trained models, whatever the fit ------------------------------------------------------------


def check(name: str, kind: str):
    """Scored rows are the test set; probabilities are shares and decide the prediction."""
    expected = oracle("test_set", "SELECT transaction_id, is_fraud, TRUE AS in_range, TRUE AS decided FROM test_set")

    @query(name, expected)
    def _(star):
        p = F.col("probability")
        scored = scored_by_model(star, kind)
        # At exactly one half either side is right.
        decided = (p == 0.5) | (F.col("prediction") == (p > 0.5).cast("int"))
        return scored.select("transaction_id", "is_fraud", p.between(0, 1).alias("in_range"), decided.alias("decided"))


for kind in ("random_forest", "gradient_boosting", "logistic_regression"):
    check(f"{kind}_check", kind)


@query(
    "feature_importance_check",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS in_range, 1.0::DOUBLE AS total" for c in mf.FEATURES),
)
def _(star):
    model, _ = fitted(star, "random_forest")
    table = train.feature_importance(model)
    total = table.agg(F.round(F.sum("importance"), 6)).scalar()
    return table.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@query(
    "trained_comparison_check",
    oracle(
        "test_set",
        " UNION ALL ".join(
            f"SELECT '{k}' AS model, count(*) AS n, count_if(is_fraud = 1) AS fraud, TRUE AS better FROM test_set"
            for k in ("random_forest", "gradient_boosting", "logistic_regression")
        ),
    ),
)
def _(star):
    """Each model ranks the test rows better than the amount alone does."""
    kinds = ("random_forest", "gradient_boosting", "logistic_regression")
    scored = {k: scored_by_model(star, k) for k in kinds}
    test_ids = sides(star)[1].select("transaction_id")
    plain = metrics.roc_auc(scored_by_amount(star).join(test_ids, "transaction_id"), rows=star.rows).scalar()
    compared = metrics.model_comparison(scored, rows=star.rows).select("model", "auc")
    counts = [
        s.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_fraud") == 1).alias("fraud")).select(F.lit(k).alias("model"), "n", "fraud")
        for k, s in scored.items()
    ]
    return reduce(DataFrame.unionByName, counts).join(compared, "model").select("model", "n", "fraud", (F.col("auc") > plain).alias("better"))


@query(
    "logistic_regression_gradient",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS flat" for c in mf.FEATURES),
)
def _(star):
    """At the fitted coefficients the slope of the penalised loss vanishes in every direction."""
    model, _ = fitted(star, "logistic_regression")
    fit = model.stages[-1]
    rows, _ = sides(star)
    rows = mf.class_weights(mf.standardize(rows, cols=mf.FEATURES)[0])
    miss = F.col("weight") * (F.col("probability") - F.col("is_fraud"))
    scored = train.score(model, rows)
    total = F.sum("weight")
    slopes = [
        (F.sum(miss * F.col(c)) / total + F.lit(float(w) * fit.getOrDefault("regParam"))).alias(c)
        for c, w in zip(mf.FEATURES, fit.coefficients.toArray())
    ]
    wide = scored.agg(*slopes)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), (F.abs(c) < 1e-4).alias("flat")) for c in mf.FEATURES])))
