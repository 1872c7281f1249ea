"""Registration of queries over the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans.adapter import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Money as doubles and text lists as joined text, for comparison with other engines."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            changed[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            changed[field.name] = F.concat_ws("; ", field.name)
    return df.withColumns(changed) if changed else df


def query(name: str, sql: str | None = None):
    """Registers ``fn(star)`` under ``name``, with the SQL that must give the same rows."""

    def keep(fn: Callable[[Star], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(fn(Star(spark, folder.rstrip("/"))))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep
