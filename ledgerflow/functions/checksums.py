"""Checksums of sets of rows that do not depend on the order of the rows.

Two numbers of each row are added up over the rows: a changed, lost or doubled row changes the sums, where an exclusive or
would not see a doubled pair. Sums are whole decimals and cannot overflow. The numbers are 64-bit hashes of the row's values
and of which of them are null. The portable form, slower, can be computed by any engine: a row is written as text in which
every value is preceded by its length, and two numbers of 60 bits are cut from the MD5 of that text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUM = T.DecimalType(28, 0)


def value_text(name: str, kind: T.DataType) -> Column:
    """A value as text; ``n`` for null."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        plain = F.to_json(F.struct(c.alias("v")))
    elif isinstance(kind, T.BinaryType):
        plain = F.hex(c)
    else:
        plain = c.cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.length(plain).cast("string"), F.lit(":"), plain))


def row_text(df: DataFrame) -> Column:
    """A row as text, its columns in order of their names."""
    parts = [value_text(f.name, f.dataType) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return F.concat_ws(",", *parts) if parts else F.lit("")


def _hashable(name: str, kind: T.DataType) -> Column:
    """A value that can be hashed: maps, and what may hold one, as text."""
    c = F.col(f"`{name}`")
    return F.to_json(F.struct(c.alias("v"))) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else c


def row_numbers(df: DataFrame, portable: bool = False) -> tuple[Column, Column]:
    """The two numbers of a row."""
    if portable:
        digest = F.md5(row_text(df).cast("binary"))
        return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast(SUM) for at in (1, 17))
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    values = [_hashable(f.name, f.dataType) for f in fields]
    # The hash passes over nulls, so where they stand is hashed as well.
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{f.name}`").isNull(), F.lit("n")).otherwise(F.lit(".")) for f in fields])
    return tuple(F.xxhash64(F.lit(seed), nulls, *values).cast(SUM) for seed in (1, 2))


def sums(df: DataFrame, portable: bool = False) -> list[Column]:
    """Aggregates ``rows``, ``sum_a`` and ``sum_b`` of a frame; zeros for an empty one."""
    a, b = row_numbers(df, portable)
    zero = F.lit(0).cast(SUM)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(a), zero).cast("decimal(38,0)").alias("sum_a"),
        F.coalesce(F.sum(b), zero).cast("decimal(38,0)").alias("sum_b"),
    ]


def checksums(df: DataFrame, by: Sequence[str] = (), portable: bool = False) -> DataFrame:
    """(by..., rows, sum_a, sum_b): one row per value of ``by``, or one row."""
    return df.groupBy(*by).agg(*sums(df, portable))
