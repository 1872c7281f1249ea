import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerflow import settings
from ledgerflow.functions import features as f
from ledgerflow.operators import enrich
from ledgerflow.sources import io

# A few stored records in the producer's format; flags and is_fraud are what the producer wrote.
RECORDS = [
    ("TXN_LIVE_875777", 46942.64, "withdrawal", "completed", "Luxor", ["HIGH_AMOUNT", "LARGE_WITHDRAWAL"], 1),
    ("TXN_LIVE_464916", 19665.86, "credit", "failed", "Cairo", ["FAILED_HIGH_TX"], 1),
    ("TXN_LIVE_844968", 16721.75, "withdrawal", "completed", "Giza", [], 0),
]


def write_json(folder):
    os.makedirs(folder)
    for i, (key, amount, kind, status, city, flags, fraud) in enumerate(RECORDS):
        record = {
            "transaction_id": key,
            "account_id": f"ACC_{i:05d}",
            "amount": amount,
            "tx_type": kind,
            "timestamp": "2026-05-07 21:55:37",
            "status": status,
            "city": city,
            "category": "fuel",
            "is_suspicious": 0,
            "fraud_flags": flags,
            "is_fraud": fraud,
            "not_in_schema": True,
        }
        with open(f"{folder}/batch_{i}.json", "w") as out:
            out.write(json.dumps(record) + "\n")
    return str(folder)


def test_json_lines_and_recomputed_flags(spark, tmp_path):
    events = io.read_events(spark, write_json(tmp_path / "in"), settings.EVENTS)
    assert events.count() == 3 and "not_in_schema" not in events.columns
    assert events.agg(F.sum("amount")).first()[0] == D("83330.25")
    again = f.is_flagged(f.rule_flags(events.drop("fraud_flags", "is_fraud")))
    stored = {r.transaction_id: (r.fraud_flags, r.is_fraud) for r in events.collect()}
    assert {r.transaction_id: (r.fraud_flags, r.is_fraud) for r in again.collect()} == stored


def test_payload_decoding(spark, tmp_path):
    folder = write_json(tmp_path / "in")
    as_bytes = spark.read.text(folder).select(F.col("value").cast("binary").alias("value"))
    out = io.decode_payload(as_bytes, settings.EVENTS)
    assert out.schema == settings.EVENTS
    assert sorted(out.collect()) == sorted(io.read_events(spark, folder, settings.EVENTS).collect())


def test_csv_with_stated_types(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        "customer_id,name,age,city,join_date,email,phone\n"
        "CUST_0001,Ann,58.0,Cairo,2023-03-30,a@example.net,1\nCUST_0002,Bob,,,2025-03-01,b@example.net,2\n"
    )
    df = io.read_csv(spark, str(path), settings.CUSTOMERS)
    assert df.schema == settings.CUSTOMERS
    assert [(r.age, r.city) for r in df.orderBy("customer_id").collect()] == [(58.0, "Cairo"), (None, None)]
    assert dict(io.read_csv(spark, str(path), infer=True).dtypes)["join_date"] == "date"
    out = str(tmp_path / "out")
    io.save_csv(df, out)
    assert sorted(io.read_csv(spark, out, settings.CUSTOMERS).collect()) == sorted(df.collect())


def test_partitions_with_a_null_key(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).withColumn("kind", F.when(F.col("id") % 4 > 0, F.concat(F.lit("k"), F.col("id") % 4)))
    io.save(df, path, ["kind"])
    assert "kind=__HIVE_DEFAULT_PARTITION__" in os.listdir(path)
    assert {r.key: r.n for r in io.verify(spark, path, "kind").collect()} == {None: 25, "k1": 25, "k2": 25, "k3": 25}
    back = spark.read.parquet(path).filter("kind = 'k1'")
    assert "PartitionFilters: [isnotnull(kind" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 25


def test_overwrite(spark, tmp_path):
    path = str(tmp_path / "o")
    io.save(spark.range(5), path)
    io.save(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_schema_report_and_counts(spark):
    df = spark.range(3).withColumn("x", F.lit("a"))
    assert [tuple(r) for r in io.describe_schema(df).collect()] == [("id", "bigint", False), ("x", "string", False)]
    counts = io.row_counts({"a": df, "b": spark.range(0)}).collect()
    assert sorted(tuple(r) for r in counts) == [("a", 3, 2), ("b", 0, 1)]


def test_batches_and_top(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("x", 1), ("y", 0)], "s string, i int")
    all_rows = enrich.append_batches(a, b, a)
    assert sorted(tuple(r) for r in all_rows.collect()) == [(0, "y"), (1, "x"), (1, "x"), (1, "x")]
    assert [r.s for r in enrich.top_k(b, ["-i"], 1, "s").collect()] == ["x"]
    assert [r.s for r in enrich.preview(b, ["s"], 2, ["i"]).collect()] == ["y", "x"]


def test_scratch_folder_follows_the_session(spark):
    assert settings.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("order", ["left", "right"])
def test_enrich_equals_one_join_after_the_other(spark, order):
    tx = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 9), (5, None)], "transaction_id int, account_id int")
    acc = spark.createDataFrame([(1, 7, "s", 1.0), (2, None, "c", 2.0), (3, 8, "c", 2.0)], "account_id int, customer_id int, account_type string, balance double")
    cust = spark.createDataFrame([(7, "A", "X", 30)], "customer_id int, name string, city string, age int")
    one = enrich.tx_customers(enrich.tx_accounts(tx, acc), cust)
    both = enrich.enrich(tx, acc, cust).select(one.columns)
    assert sorted(map(str, both.collect())) == sorted(map(str, one.collect())) and both.count() == 5


def test_hot_account_is_split_in_the_join(spark):
    """Two thirds of the rows on one account: adaptive execution must split that shuffle partition."""
    settings_now = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for key, value in settings_now.items():
        spark.conf.set(key, value)
    try:
        i = F.col("id")
        tx = spark.range(0, 100000, 1, 8).select(
            i.alias("transaction_id"), F.when(i % 3 != 0, F.lit(5)).otherwise(i % 1000).alias("account_id"), (i % 100).alias("amount")
        )
        acc = spark.range(1000).select(
            i.alias("account_id"), (i % 100).alias("customer_id"), F.lit("s").alias("account_type"), F.lit(1.0).alias("balance")
        )
        cust = spark.range(100).select(i.alias("customer_id"), F.lit("n").alias("name"), F.lit("c").alias("city"), F.lit(3).alias("age"))
        full = enrich.enrich(tx, acc, cust)
        assert len(full.collect()) == 100000
        assert "SortMergeJoin(skew=true)" in full._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings_now:
            spark.conf.unset(key)


def test_partitioned_writes_are_rebalanced(spark):
    text = spark.range(10).withColumn("k", F.lit(1)).hint("rebalance", "k")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text
