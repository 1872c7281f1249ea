"""What must not depend on the size of the data, and storage."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.ml import features as mf
from ledgerflow.operators import clean, windows
from ledgerflow.plans.adapter import Star
from ledgerflow.settings import ship
from ledgerflow.sources import io


@pytest.fixture(scope="module")
def spend(spark):
    i = F.col("id")
    return spark.range(400).select(
        i.alias("customer_id"),
        F.concat(F.lit("n"), i).alias("name"),
        F.when(i % 3 != 0, "big").when(i % 30 != 0, "small").alias("city"),
        F.when(i % 7 != 0, (i % 23).cast("decimal(18,2)")).alias("total_spend"),
    )


def test_null_ranks_do_not_depend_on_size(spend):
    whole = windows.rank_in_city(spend)
    split = windows.rank_in_city(spend, rows_per_task=20)
    assert whole.dtypes == split.dtypes
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
    assert whole.filter("rank_in_city IS NULL OR dense_rank IS NULL").isEmpty()


def test_running_totals_have_one_type(spark):
    tx = spark.range(500).select(
        F.col("id").alias("transaction_id"),
        (F.col("id") % 2).alias("account_id"),
        F.col("id").cast("decimal(18,2)").alias("amount"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("timestamp"),
    )
    whole = windows.running_total(tx)
    split = windows.running_total(tx, windows.account_splits(tx, rows_per_task=20))
    assert whole.schema["running_total"].dataType == split.schema["running_total"].dataType == T.DecimalType(28, 2)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))


def test_a_split_can_take_everything(spark):
    rows = spark.range(1000).select(F.col("id").alias("transaction_id"), (F.col("id") % 2).alias("is_fraud"))
    train, test = mf.stratified_split(rows, frac=1.0)
    assert train.count() == 1000 and test.isEmpty()
    train, test = mf.stratified_split(rows, frac=0.0)
    assert train.isEmpty() and test.count() == 1000


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("city,extra,customer_id\nRome,x,1\n,y,2\n")
    schema = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("city", T.StringType())])
    assert [tuple(r) for r in io.read_csv(spark, str(path), schema).collect()] == [(1, "Rome"), (2, None)]
    with pytest.raises(ValueError, match="name"):
        io.read_csv(spark, str(path), T.StructType([T.StructField("name", T.StringType())]))


def test_bad_times_are_counted(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00",), ("x",), (None,), ("",)], "timestamp string")
    assert clean.bad_ts(rows).first().bad_ts == 2


def test_stored_tables_follow_the_folder(spark, small, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()  # the given folder may be read-only, the copy is not
    for name in os.listdir(small):
        shutil.copyfile(f"{small}/{name}", folder / name)
    before = Star(spark, str(folder)).full.count()
    orders = spark.read.parquet(f"{folder}/lineitem.parquet").filter("l_orderkey % 2 = 0").toPandas()
    orders.to_parquet(folder / "lineitem.parquet", coerce_timestamps="us")
    os.utime(folder / "lineitem.parquet")
    after = Star(spark, str(folder)).full.count()
    assert 0 < after < before


def test_statuses_are_pushed_into_the_scan(spark, small):
    from ledgerflow.operators import predicates

    star = Star(spark, small)
    io.register(spark, star.full, star.tx, star.accounts, star.customers)
    plan = predicates.fraud_pattern_sql(spark)._jdf.queryExecution().executedPlan().toString()
    assert "In(status, [failed,reversed])" in plan


def test_leaf_tables_are_made_once(spark, monkeypatch):
    import numpy as np

    from ledgerflow.explain import tree

    monkeypatch.setattr(tree, "FEW_ROWS", 0)
    leaf = tree.Tree(*map(np.array, ([1, -1, -1], [2, -1, -1], [0, 0, 0], [0.5, 0.0, 0.0], [4.0, 1.0, 3.0], [0.25, 1.0, 0.0])))
    first = tree.contributions([leaf], np.array([[0.0], [1.0]]))
    kept = leaf.tables[1]
    again = tree.contributions([leaf], np.array([[0.0], [1.0]]))
    assert leaf.tables[1] is kept and (first == again).all() and abs(first[0, 0] - 0.75) < 1e-12


def test_too_many_nodes_are_refused(spark, monkeypatch):
    from ledgerflow.explain import tree

    monkeypatch.setattr(tree, "MOST_NODES", 1)
    with pytest.raises(ValueError, match="nodes"):
        tree.read_trees(spark.range(2))


def test_the_package_is_shipped_once(spark):
    ship(spark)
    ship(spark)
    files = [f for f in spark.sparkContext.listFiles if f.endswith("ledgerflow.zip")] if hasattr(spark.sparkContext, "listFiles") else [1]
    assert len(files) == 1
