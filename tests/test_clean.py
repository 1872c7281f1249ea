from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import clean
from ledgerflow.plans.quantiles import LEVELS

TX = "transaction_id string, account_id string, amount decimal(18,2), tx_type string, timestamp string, status string"


def raw(spark):
    rows = [
        ("t1", "a1", None, "debit", "2024-01-01 00:00:00", "failed"),  # dirty first copy of t1
        ("t1", "a1", D("5"), "debit", "2024-01-02 00:00:00", "completed"),
        ("t2", "a1", D("-5"), "debit", "2024-01-01 00:00:00", "completed"),
        ("t3", "a1", D("0"), "debit", "2024-01-01 00:00:00", "completed"),
        ("t4", None, D("5"), "debit", "2024-01-01 00:00:00", "completed"),
        ("t5", "a2", D("5"), None, "2024-01-01 00:00:00", "completed"),
        ("t6", "a2", D("7"), "credit", "nonsense", None),
        ("t6", "a2", D("6"), "credit", "2024-01-03 00:00:00", "pending"),
        (None, "a2", D("6"), "credit", "2024-01-03 00:00:00", "pending"),
        (None, "a2", D("8"), "credit", "2024-01-03 00:00:00", "pending"),
    ]
    return spark.createDataFrame(rows, TX)


def test_clean_copy_survives(spark):
    kept = {r.transaction_id: r for r in clean.clean_transactions(raw(spark), ["amount"]).collect()}
    assert sorted(kept) == ["t1", "t6"]
    assert kept["t1"].amount == 5 and kept["t6"].amount == 6


def test_cleaning_twice_changes_nothing(spark):
    once = clean.clean_transactions(raw(spark), ["amount"])
    assert sorted(clean.clean_transactions(once, ["amount"]).collect()) == sorted(once.collect())


def test_bad_time_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("x",), (None,)], "timestamp string")
    assert [r.timestamp is None for r in clean.parse_ts(df).collect()] == [False, True, True]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_survivor_does_not_depend_on_layout(spark, parts):
    df = spark.range(1000).select(
        (F.col("id") % 50).alias("k"), F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("s")
    )
    expected = {r.k: r for r in df.groupBy("k").agg(F.min("v").alias("v")).collect()}
    got = clean.dedupe(df.repartition(parts), ["k"], ["v"]).collect()
    assert {r.k: r.v for r in got} == {k: r.v for k, r in expected.items()} and len(got) == 50


def test_dedupe_takes_the_minimum_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    plan = clean.dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1


def test_quality_profile_counts_null_ids_as_equal(spark):
    row = clean.quality_profile(raw(spark)).first().asDict()
    assert row == {"valid": 8, "null_amount": 1, "negative_amount": 1, "null_tx_type": 1, "duplicates": 3}


def test_quality_profile_of_nothing(spark):
    row = clean.quality_profile(raw(spark).limit(0)).first().asDict()
    assert set(row.values()) == {0}


def test_customers_and_accounts(spark):
    cust = spark.createDataFrame([(1, "A", None, None), (2, "B", -1, "X"), (3, None, 5, "X"), (1, "A", None, None)], "customer_id int, name string, age int, city string")
    assert [tuple(r) for r in clean.clean_customers(cust).collect()] == [(1, "A", 0, "Unknown")]
    acc = spark.createDataFrame([(1, 1, None), (2, 1, D("-1")), (3, None, D("1"))], "account_id int, customer_id int, balance decimal(18,2)")
    assert [tuple(r) for r in clean.clean_accounts(acc).collect()] == [(1, 1, D("0.00"))]


def test_report(spark):
    frames = {"tx": raw(spark)}
    out = clean.cleaning_report(frames, {"tx": clean.clean_transactions(raw(spark))}).first()
    assert tuple(out) == ("tx", 10, 2, 8)


@pytest.mark.parametrize("levels", [LEVELS, (13,) * 5])
def test_median(spark, levels):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 20.0), (4, 40.0), (5, 50.0)], "id int, x double")
    out = {r.id: r.x for r in clean.impute_median(df, ["x"], levels=levels).collect()}
    assert out == {1: 10.0, 2: 30.0, 3: 20.0, 4: 40.0, 5: 50.0}


def test_not_null_filters_reach_the_scan(spark, small):
    df = clean.drop_null(spark.read.parquet(f"{small}/lineitem.parquet"), ["l_orderkey", "l_partkey"])
    plan = df.select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
