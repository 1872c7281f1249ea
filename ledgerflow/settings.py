"""Schemas, thresholds and session settings shared by every operator."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Money is exact: cents never go through binary floating point until the very last cast.
MONEY = T.DecimalType(18, 2)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("join_date", T.DateType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("balance", MONEY),
        T.StructField("open_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("tx_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("tx_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("is_suspicious", T.IntegerType()),
        T.StructField("fraud_flags", T.ArrayType(T.StringType())),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Rules:
    """Fixed values of the business rules; pass another instance to change them."""

    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    # Amount bands: edges and names, used by both the left-closed and the right-closed binning.
    band_edges: tuple = (500, 5000, 20000)
    band_names: tuple = ("small", "medium", "large", "very_large")
    # Day parts as (first hour, last hour, name); every other hour is `night`.
    day_parts: tuple = ((6, 11, "morning"), (12, 17, "afternoon"), (18, 21, "evening"))
    night_hours: tuple = (0, 5)
    inflow_types: tuple = ("credit",)
    outflow_types: tuple = ("debit", "withdrawal", "payment")
    # Batch and dashboard suspicion rules.
    suspicious_amount: int = 30000
    bad_statuses: tuple = ("failed", "reversed")
    pattern_amount: int = 10000
    # Fraud label of the model.
    label_amount: int = 30000
    label_quantile: float = 0.98
    label_hours: tuple = (1, 4)
    label_night_amount: int = 20000
    # Live rules.
    live_high_amount: int = 40000
    live_failed_amount: int = 10000
    live_withdrawal_amount: int = 30000
    # A transaction is a spike when it is this many times the previous one.
    spike_factor: int = 5
    unknown_city: str = "Unknown"


RULES = Rules()


def session(app: str = "ledgerflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (adaptive execution, UTC, no web page)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session without executors of its own may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerflow-")
    return f"{root.rstrip('/')}/ledgerflow/{label}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, for clusters on which it is not installed.

    The archive is made on the driver and served by Spark; executors never look for it on their own disks.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="ledgerflow-")), "ledgerflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
