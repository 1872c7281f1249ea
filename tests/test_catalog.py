"""Every registered query against its SQL on the smallest tables, and plans of the ones that matter at scale."""

import duckdb  # noqa: F401
import pytest

from __spark_entry__ import entry
from ledgerflow.catalog import ORACLES, QUERIES
from ledgerflow.plans.adapter import Star
from tests.compare import connect, difference

# Fitting 100 trees is left to the comparison run; the models have their own tests.
TRAINED = set(QUERIES) - set(ORACLES)


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_but_the_trained_ones_has_sql():
    assert TRAINED == {
        "random_forest",
        "gradient_boosting",
        "logistic_regression",
        "feature_importance",
        "trained_comparison",
        "tree_contributions",
        "tree_reason_codes",
    }
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, small, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], small) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["city", "rank_in_city", "name", "total_spend", "total_transactions"] and df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_counts(spark, small):
    star = Star(spark, small)
    from pyspark.sql import functions as F

    row = star.full.agg(F.count(F.lit(1)), F.sum("amount"), F.count_if(F.col("customer_id").isNull()), F.count_if(F.col("city").isNull())).first()
    assert [str(v) for v in row] == ["4331", "114269719.28", "47", "107"]


def test_top_per_city_limits_before_the_shuffle(spark, small):
    text = plan(QUERIES["topn_per_group"](spark, small))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_joined_transactions_move_once_for_the_join(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = Star(spark, small)
        text = plan(star.full_plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # By account: the transactions once, the accounts for their own de-duplication and once more with their customer.
    assert text.count("Exchange hashpartitioning(account_id") == 3
    # By customer: the accounts and the de-duplicated customers; no transaction moves by customer.
    assert text.count("Exchange hashpartitioning(customer_id") == 2


def test_no_cartesian_products(spark, small):
    for name in ("percent_rank_global", "running_and_rank_sql", "percentile_top", "histogram", "roc_auc", "fraud_label"):
        text = plan(QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
