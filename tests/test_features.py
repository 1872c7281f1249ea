from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import features as f
from ledgerflow.functions.exact import average_money, percent, rounded_ratio

D = Decimal


def amounts(spark, *values):
    rows = [(i, None if v is None else D(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, amount decimal(18,2)")


def column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_both_binnings_differ_at_the_edges(spark):
    df = amounts(spark, "499.99", "500.00", "500.01", "5000", "20000", "20000.01", "0", None, "-1")
    left = column(f.amount_band(df), "amount_category")
    assert left == ["small", "medium", "medium", "large", "very_large", "very_large", "small", "very_large", "small"]
    right = column(f.amount_bin_right(df), "amount_bin")
    assert right == ["small", "small", "medium", "medium", "large", "very_large", None, None, None]


def test_cut_closed_on_the_left(spark):
    df = amounts(spark, "0", "1", "2", "3", None)
    out = f.cut(df, "amount", [0, 1, 3], ["a", "b"], right=False)
    assert column(out, "bin") == ["a", "b", "b", None, None]


def times(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", F.expr("cast(t as timestamp_ntz)").alias("timestamp"))


def test_day_parts(spark):
    hours = [5, 6, 11, 12, 17, 18, 21, 22]
    df = times(spark, *[f"2024-03-01 {h:02d}:30:00" for h in hours], None)
    expected = ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night"]
    assert column(f.time_of_day(df), "time_of_day") == expected
    assert column(f.is_night(df), "is_night") == [1, 0, 0, 0, 0, 0, 0, 0, None]


def test_calendar(spark):
    df = times(spark, "2024-03-02 23:00:00", "2024-03-03 00:00:00", "2024-03-04 01:00:00")  # Saturday to Monday
    assert column(f.calendar_parts(df), "day_of_week") == [7, 1, 2]
    assert column(f.calendar_parts_monday0(df), "day_of_week") == [5, 6, 0]
    assert column(f.is_weekend(df), "is_weekend") == [1, 1, 0]
    assert column(f.month_name(df), "month_name") == ["Mar"] * 3


def test_three_valued_suspicion(spark):
    df = spark.createDataFrame(
        [(0, D("30000.01"), None), (1, D("1"), None), (2, None, "failed"), (3, None, "pending"), (4, D("30000"), "reversed")],
        "id int, amount decimal(18,2), status string",
    )
    assert column(f.suspicious_batch(df), "is_suspicious") == [1, None, 1, None, 0]
    assert [r.id for r in f.suspicious_dashboard(df).orderBy("id").collect()] == [0, 2, 4]


def test_fraud_label_rules(spark):
    rows = [
        (0, D("30000.01"), "failed", "2024-01-01 12:00:00"),
        (1, D("30000"), "failed", "2024-01-01 12:00:00"),
        (2, D("20000.01"), "completed", "2024-01-01 01:00:00"),
        (3, D("20000.01"), "completed", "2024-01-01 04:59:59"),
        (4, D("20000"), "completed", "2024-01-01 02:00:00"),
        (5, D("20000.01"), "completed", "2024-01-01 00:59:59"),
        (6, D("20000.01"), "completed", "2024-01-01 05:00:00"),
        (7, D("25000"), "failed", None),
        (8, D("25000"), None, None),
    ]
    df = spark.createDataFrame(rows, "id int, amount decimal(18,2), status string, t string")
    df = df.withColumn("timestamp", F.expr("cast(t as timestamp_ntz)"))
    assert column(f.fraud_label(df, F.lit(29000.0)), "is_fraud") == [1, 1, 1, 1, 0, 0, 0, 0, 0]
    assert column(f.fraud_label(df, F.lit(24000.0)), "is_fraud") == [1, 1, 1, 1, 0, 0, 0, 1, 0]


LIVE = [
    # amount, type, status, flags
    ("46942.64", "withdrawal", "completed", ["HIGH_AMOUNT", "LARGE_WITHDRAWAL"]),
    ("19665.86", "credit", "failed", ["FAILED_HIGH_TX"]),
    ("16721.75", "withdrawal", "completed", []),
    ("40000.00", "debit", "reversed", ["FAILED_HIGH_TX"]),
    ("40000.01", "debit", "pending", ["HIGH_AMOUNT"]),
    ("10000.00", "debit", "failed", []),
    ("30000.00", "withdrawal", "completed", []),
    ("50000.00", "withdrawal", "reversed", ["HIGH_AMOUNT", "FAILED_HIGH_TX", "LARGE_WITHDRAWAL"]),
]


def live(spark):
    rows = [(i, D(a), t, s) for i, (a, t, s, _) in enumerate(LIVE)]
    return spark.createDataFrame(rows, "id int, amount decimal(18,2), tx_type string, status string")


def test_live_rules(spark):
    done = f.alert_text(f.is_flagged(f.rule_flags(live(spark))))
    assert column(done, "fraud_flags") == [flags for *_, flags in LIVE]
    assert column(done, "is_fraud") == [int(bool(flags)) for *_, flags in LIVE]
    assert column(done, "alert") == [",".join(flags) or "OK" for *_, flags in LIVE]


def test_own_rules(spark):
    rules = [*f.live_rules(), ("CREDIT", F.col("tx_type") == "credit")]
    assert column(f.rule_flags(live(spark), rules), "fraud_flags")[1] == ["FAILED_HIGH_TX", "CREDIT"]
    assert column(f.rule_flags(live(spark), []), "fraud_flags")[0] == []


def test_changes(spark):
    rows = [(0, D("10"), None), (1, D("10.05"), D("2")), (2, D("10"), D("0")), (3, D("1"), D("8"))]
    df = spark.createDataFrame(rows, "id int, amount decimal(18,2), prev_amount decimal(18,2)")
    out = f.is_spike(f.spike_ratio(f.amount_change(df)))
    assert column(out, "amount_change") == [None, D("8.05"), D("10.00"), D("-7.00")]
    assert column(out, "spike_ratio") == [None, D("5.03"), None, D("0.13")]
    assert column(out, "is_spike") == [None, 1, None, 0]


@pytest.mark.parametrize("a, b, digits, expected", [(1, 8, 2, 0.13), (-1, 8, 2, -0.13), (1, 3, 4, 0.3333), (5, 0, 1, None), (7, 2, 0, 4.0)])
def test_rounded_ratio(spark, a, b, digits, expected):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    assert df.select(rounded_ratio(F.col("a"), F.col("b"), digits).alias("r")).first().r == expected


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(D("0.03"), 2), (D("-0.03"), 2), (D("2.00"), 3)], "s decimal(28,2), n long")
    assert [r.a for r in df.select(average_money(F.col("s"), F.col("n")).alias("a")).collect()] == [0.02, -0.02, 0.67]
    assert spark.range(1).select(percent(F.lit(1), F.lit(16)).alias("p")).first().p == 6.3


def test_amount_to_balance_and_scale(spark):
    df = spark.createDataFrame([(0, D("10"), D("4")), (1, D("10"), D("-1")), (2, D("10"), None)], "id int, amount decimal(18,2), balance decimal(18,2)")
    assert column(f.amount_to_balance(df), "amount_to_balance") == [2.0, None, None]
    assert column(f.unit_scale(df, "amount", 1000, "k"), "k") == [0.01] * 3
