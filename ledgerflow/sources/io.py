"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True, infer: bool = False
) -> DataFrame:
    """CSV with a stated schema; ``infer=True`` reads the data once more to guess the types.

    With a header the columns are found by name, whatever their order in the file; columns outside the schema are left
    out, and one that the file lacks is an error.
    """
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.csv(path, inferSchema=infer)
    if not header:
        return reader.schema(schema).csv(path)
    known = {f.name: f for f in schema.fields}
    found = reader.csv(path).columns  # reads the first line only
    missing = [c for c in known if c not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    as_found = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in found])
    return reader.schema(as_found).csv(path, enforceSchema=False).select(*known)


def read_events(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A folder of JSON lines; fields outside the schema are ignored."""
    return spark.read.schema(schema).json(folder)


def register(
    spark: SparkSession, full: DataFrame, tx: DataFrame, acc: DataFrame, cust: DataFrame
) -> None:
    """Names the four relations for SQL."""
    views = {"banking_data": full, "transactions": tx, "accounts": acc, "customers": cust}
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def save(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Writes Parquet, optionally partitioned by columns.

    Partitioned output is clustered by an adaptive rebalance, which splits a large partition value over several tasks
    and files instead of sending it to one.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    placed = df.hint("rebalance", *partition_by)
    placed.write.mode(mode).partitionBy(*partition_by).parquet(path)


def verify(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Reads a partitioned table back: (key, n) for each partition found."""
    return spark.read.parquet(path).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def describe_schema(df: DataFrame) -> DataFrame:
    """(column, type, nullable) of a frame, one row per column."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def schema_profile(df: DataFrame) -> DataFrame:
    """(column, type, n_values, n_nulls) of a frame, one row per column, counted in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_n{i}").alias("n_values"))
        for i, f in enumerate(df.schema.fields)
    ]
    rows = counts.select("_rows", F.explode(F.array(*entries)).alias("_e"))
    return rows.select("_e.*", (F.col("_rows") - F.col("_e.n_values")).alias("n_nulls"))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) of each frame, in one plan."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# JSON options that keep microseconds.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def decode_payload(
    df: DataFrame, schema: T.StructType, col: str = "value", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Turns JSON bytes, as a message queue delivers them, into typed columns; ``options`` are those of Spark's JSON reader."""
    record = F.from_json(F.col(col).cast("string"), schema, dict(options or {}))
    return df.select(record.alias("_record")).select("_record.*")


def kafka_events(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, stream: bool = True, **options: str
) -> DataFrame:
    """Decoded records of a topic; needs the Kafka connector on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    source = reader.options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **options})
    return decode_payload(source.load(), schema)
