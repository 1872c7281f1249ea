"""The split windows against the built-in ones, with a key that holds most of the rows."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.ml import features as mf
from ledgerflow.operators import windows as w
from ledgerflow.plans.quantiles import LEVELS, order_key, quantiles, value_of
from ledgerflow.plans.splits import FEW_CUTS, MAX_BUCKETS, cumulate, find_splits, ranked_values


@pytest.fixture(scope="module")
def skewed(spark):
    """Account 0 holds two thirds of the rows, one account is null, times repeat, amounts tie."""
    i = F.col("id")
    df = spark.range(3000).select(
        i.alias("transaction_id"),
        F.when(i % 3 != 0, F.lit(0)).when(i % 30 == 0, F.lit(None)).otherwise(i % 20).alias("account_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("t0"),
        (F.pmod(F.xxhash64("id"), F.lit(40))).cast("int").alias("day"),
        (F.pmod(F.hash("id"), F.lit(200)) + 1).cast("decimal(18,2)").alias("amount"),
        F.when(i % 5 < 3, "big").when(i % 5 == 3, "small").alias("city"),
        F.concat(F.lit("n"), i).alias("name"),
    )
    df = df.withColumn("timestamp", F.timestamp_add("DAY", "day", "t0")).drop("t0").repartition(5)
    return df.cache()


def per_account():
    return Window.partitionBy("account_id").orderBy("timestamp", "transaction_id")


def rows(df, *cols):
    return sorted((tuple(str(v) for v in r) for r in df.select("transaction_id", *cols).collect()))


def test_hot_account_is_split_and_others_are_not(skewed):
    splits = w.account_splits(skewed, rows_per_task=100)
    assert {c.account_id for c in splits.cuts} == {0} and len(splits.cuts) > 5
    assert w.account_splits(skewed).whole


@pytest.mark.parametrize("rows_per_task", [None, 700, 100, 20])
def test_running_sums(skewed, rows_per_task):
    splits = w.account_splits(skewed, rows_per_task=rows_per_task)
    frame = per_account().rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.withColumns({"running_total": F.sum("amount").over(frame), "tx_count_so_far": F.count("transaction_id").over(frame)})
    got = w.running_count(w.running_total(skewed, splits), splits)
    assert rows(got, "running_total", "tx_count_so_far") == rows(expected, "running_total", "tx_count_so_far")


@pytest.mark.parametrize("rows_per_task", [None, 700, 100, 20])
def test_previous(skewed, rows_per_task):
    splits = w.account_splits(skewed, rows_per_task=rows_per_task)
    expected = skewed.withColumn("prev_amount", F.lag("amount").over(per_account()))
    assert rows(w.lag_amount(skewed, splits), "prev_amount") == rows(expected, "prev_amount")


def test_layout_does_not_matter(skewed):
    splits = w.account_splits(skewed, rows_per_task=50)
    assert rows(w.lag_amount(skewed.repartition(9), splits), "prev_amount") == rows(w.lag_amount(skewed.coalesce(1), splits), "prev_amount")


def test_running_sum_of_nulls(spark):
    df = spark.range(400).select(F.lit(1).alias("g"), "id", F.when(F.col("id") >= 300, F.col("id")).alias("v"))
    splits = find_splits(df, ["g"], ["id"], rows_per_task=40)
    frame = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    a = cumulate(df, splits, {"s": F.col("v")}).orderBy("id").select("id", "s").collect()
    assert not splits.whole and a == df.withColumn("s", F.sum("v").over(frame)).orderBy("id").select("id", "s").collect()


@pytest.mark.parametrize("rows_per_task", [None, 100])
def test_ranks_in_a_hot_city(skewed, rows_per_task):
    order = Window.partitionBy("city").orderBy(F.desc("total_spend"))
    spend = skewed.withColumn("total_spend", F.col("amount"))
    expected = spend.withColumns({"rank_in_city": F.rank().over(order), "dense_rank": F.dense_rank().over(order)})
    got = w.rank_in_city(spend, rows_per_task=rows_per_task)
    assert rows(got, "rank_in_city", "dense_rank") == rows(expected, "rank_in_city", "dense_rank")


def test_running_and_rank(skewed):
    frame = per_account().rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("city").orderBy(F.desc("amount"))
    expected = skewed.withColumns({"running_total": F.sum("amount").over(frame), "rank_in_city": F.rank().over(order)})
    got = w.running_and_rank(skewed, w.account_splits(skewed, rows_per_task=100), rows_per_task=100)
    assert rows(got, "running_total", "rank_in_city") == rows(expected, "running_total", "rank_in_city")


@pytest.mark.parametrize("buckets", [1, 8, 64, 180])
def test_percent_rank(skewed, buckets):
    expected = skewed.withColumn("p", F.percent_rank().over(Window.orderBy("amount")))
    got = w.percent_rank_global(skewed, min_buckets=buckets).select("transaction_id", "amount_percentile")
    both = got.join(expected.select("transaction_id", "p"), "transaction_id")
    assert both.filter(F.abs(F.col("amount_percentile") - F.col("p") * 100) > 0.0500001).count() == 0
    assert got.count() == 3000


@pytest.mark.parametrize("hot, buckets", [(False, 16), (True, 16), (False, 300)])
def test_percent_rank_with_and_without_a_hot_value(spark, hot, buckets):
    value = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.xxhash64("id")) if hot else F.xxhash64("id")
    df = spark.range(4000).select(F.col("id").alias("transaction_id"), F.when(F.col("id") != 7, value).alias("amount"))
    splits = find_splits(df, [], ["amount"], min_buckets=buckets)
    assert splits.repeated == hot and not splits.whole
    assert (len(splits.cuts) > FEW_CUTS) == (buckets == 300)
    expected = df.withColumn("p", F.percent_rank().over(Window.orderBy("amount"))).select("transaction_id", "p")
    both = w.percent_rank_global(df, splits=splits).join(expected, "transaction_id")
    assert both.filter(F.abs(F.col("amount_percentile") - F.col("p") * 100) > 0.0500001).count() == 0 and both.count() == 4000


def test_percent_rank_moves_no_rows_to_one_task(skewed):
    plan = w.percent_rank_global(skewed)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if "Exchange SinglePartition" in line:
            assert "transaction_id" not in line
    assert "Window [percent_rank" not in plan


def test_percentile_top(skewed):
    top = w.percentile_top(skewed, 5).collect()
    all_rows = w.percent_rank_global(skewed).select("transaction_id", "amount_percentile").collect()
    known = {r.transaction_id: r.amount_percentile for r in all_rows}
    assert len(top) == 5 and all(known[r.transaction_id] == r.amount_percentile for r in top)


def test_ranked_values_count_everything(skewed):
    table = ranked_values(skewed, [], "amount", min_buckets=16)
    last = table.orderBy(F.desc("amount")).first()
    assert last.below + last.n == 3000 and last.place == table.count()


@pytest.mark.parametrize("p", [0.0, 0.5, 0.98, 1.0])
def test_quantile_by_radix(skewed, p):
    expected = skewed.agg(F.percentile(F.col("amount").cast("double"), F.lit(p)).alias("q")).first().q
    for levels in (LEVELS, (16,) * 4, (1, 63)):
        assert quantiles(skewed, {"amount": p}, levels=levels).first().amount == pytest.approx(expected, abs=1e-9)


ODD = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1.0, 1.0 - 2**-53, 1.0 + 2**-52, 2.0**1023, 1.7976931348623157e308, math.inf, -math.inf, 0.1, -0.1, 1e15, 3.0]


def test_order_keys_of_doubles(spark):
    draw = random.Random(4)
    values = ODD + [math.ldexp(draw.uniform(-1, 1), draw.randint(-1080, 1020)) for _ in range(2000)]
    values += [math.nextafter(2.0**k, side) for k in range(-1073, 1023, 7) for side in (0.0, math.inf)]
    df = spark.createDataFrame([(v,) for v in [*values, math.nan]], "v double")
    key = order_key(F.col("v"), T.DoubleType())
    rows = df.select("v", key.alias("k"), value_of(key, T.DoubleType()).alias("back")).collect()
    assert all(r.back == r.v or (math.isnan(r.v) and math.isnan(r.back)) for r in rows)
    assert max(rows, key=lambda r: r.k).k == next(r.k for r in rows if math.isnan(r.v))
    known = sorted((r for r in rows if not math.isnan(r.v)), key=lambda r: r.v)
    assert all((a.k < b.k) == (a.v < b.v) and (a.k == b.k) == (a.v == b.v) for a, b in zip(known, known[1:]))


def test_quantiles_of_several_kinds(spark):
    draw = random.Random(5)
    rows = []
    for n in range(700):
        rows.append((draw.choice([None, draw.gauss(0, 1e-3), draw.gauss(0, 1e12), 0.0]), draw.choice([None, 2**62, -(2**62), n]), Decimal(draw.randint(-10**6, 10**6)) / 100, None, float(n % 7)))
    df = spark.createDataFrame(rows, "a double, b long, c decimal(18,2), d double, e float").repartition(5)
    for p in (0.0, 0.25, 0.5, 0.98, 1.0):
        exact = df.agg(*[F.percentile(F.col(c).cast("double"), F.lit(p)).alias(c) for c in df.columns]).first()
        for levels in (LEVELS, (16,) * 4):
            got = quantiles(df, {c: p for c in df.columns}, levels=levels).first()
            assert got.d is None and [got[c] for c in "abce"] == pytest.approx([exact[c] for c in "abce"], rel=1e-12)


def test_selection_starts_no_job(skewed):
    from ledgerflow.functions.features import fraud_label
    from ledgerflow.operators.clean import impute_median

    context = skewed.sparkSession.sparkContext
    context.setJobGroup("selection", "plans only")
    try:
        quantiles(skewed, {"amount": 0.5})
        impute_median(skewed, ["amount"])
        fraud_label(skewed.withColumn("status", F.lit("failed")))
        assert not context.statusTracker().getJobIdsForGroup("selection")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_without_rows(skewed):
    got = quantiles(skewed.limit(0), {"amount": 0.5, "transaction_id": 0.98}).collect()
    assert [tuple(r) for r in got] == [(None, None)]


def test_cut_points_are_bounded(skewed):
    splits = find_splits(skewed, [], ["transaction_id"], rows_per_task=1)
    assert len(splits.cuts) <= MAX_BUCKETS + 1


def test_empty_input(skewed):
    none = skewed.limit(0)
    assert w.percent_rank_global(none).count() == 0
    assert w.running_total(none).count() == 0
    assert quantiles(none, {"amount": 0.5}).first().amount is None


def test_quantile_passes_count_rows_without_lambdas(spark):
    """Each of the four passes reads the rows once, and nothing that is done for each row is left to a lambda."""
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) / 7 AS a", "CASE WHEN id % 3 > 0 THEN id END AS b", "CAST(NULL AS DOUBLE) AS c")
    found = quantiles(df, {"a": 0.98, "b": 0.5, "c": 0.5})
    exact = df.agg(F.percentile("a", F.lit(0.98)), F.percentile("b", F.lit(0.5))).first()
    assert [found.first()[i] for i in (0, 1)] == pytest.approx(list(exact)) and found.first()[2] is None
    assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()


def test_stored_border_gives_the_same_split(spark):
    """With the border found once, neither side looks for it again."""
    df = spark.range(500).selectExpr("id AS transaction_id", "CAST(id % 7 = 0 AS INT) AS is_fraud")
    last = mf.last_train_rows(df).cache()
    last.count()
    for known, own in zip(mf.stratified_split(df, exact=True, last=last), mf.stratified_split(df, exact=True)):
        assert sorted(known.collect()) == sorted(own.collect())
        assert "Window" not in known.select("transaction_id")._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
