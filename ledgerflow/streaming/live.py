"""Live records with Structured Streaming. The rules are the batch functions, applied to a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.functions.features import is_flagged, rule_flags
from ledgerflow.operators.aggregates import fraud_rate_by_city, row_count, volume_by_type
from ledgerflow.settings import RULES, Rules
from ledgerflow.sources import published

# Results of complete mode that stay readable: the newest ones, and all of the last seconds.
KEEP, SECONDS = 16, 60.0


def stream_events(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "json", files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of files as a stream; ``files_per_trigger`` limits each micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def high_amount_stream(st: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Records above the high amount, marked with ``fraud_flag``."""
    return st.filter(F.col("amount") > rules.live_high_amount).withColumn("fraud_flag", F.lit("HIGH_AMOUNT"))


def flag_stream(st: DataFrame) -> DataFrame:
    """Adds ``fraud_flags`` and ``is_fraud`` to each record, whatever the producer stored there."""
    return is_flagged(rule_flags(st))


def alert_stream(st: DataFrame) -> DataFrame:
    """The flagged records only; needs ``fraud_flags``."""
    return st.filter(F.size("fraud_flags") > 0).select("transaction_id", "amount", "fraud_flags", "timestamp")


def running_stats(st: DataFrame) -> DataFrame:
    """Total, flagged and volume so far; complete or update mode."""
    return st.agg(row_count().alias("total"), F.count_if(F.col("is_fraud") == 1).alias("flagged"), F.sum("amount").alias("volume"))


def running_by_type(st: DataFrame) -> DataFrame:
    """Records so far per type; complete or update mode."""
    return st.groupBy("tx_type").agg(row_count().alias("count"))


def city_rate_stream(st: DataFrame) -> DataFrame:
    """Flagged share per city so far. Sorting is left to the reader of the result."""
    return fraud_rate_by_city(st, ordered=False)


def type_volume_stream(st: DataFrame) -> DataFrame:
    """Volume per type so far."""
    return volume_by_type(st, ordered=False)


def start(
    st: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = "5 seconds",
    keep: int = KEEP,
    seconds: float = SECONDS,
) -> StreamingQuery:
    """Starts a query that writes Parquet to the folder ``sink``.

    Append mode uses the file sink (exactly once). In complete mode each result is published as a version of its own, numbered
    by its batch: readers (``current``) see the result before or the one after, never a part, and a repeated micro-batch has
    no effect. Versions are never written to again; those that are neither among the newest ``keep`` nor published in the last
    ``seconds`` are removed, so the number of files stays bounded and a later reader gets an error, not other rows.
    ``trigger`` is a processing time; None works off all data and stops.
    """
    writer = st.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").start(sink)

    def replace(result: DataFrame, batch: int) -> None:
        published.publish(result, sink, version=batch, check=False)
        published.expire(result.sparkSession, sink, keep, seconds)

    return writer.foreachBatch(replace).start()


def current(spark: SparkSession, sink: str, schema: T.StructType | None = None, batch: int | None = None) -> DataFrame:
    """The newest finished result of a query in complete mode, or that of a ``batch`` that has not expired."""
    found = published.read(spark, sink, batch)
    return found if schema is None else found.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])


def finished(spark: SparkSession, sink: str) -> list[int]:
    """The batches of a query in complete mode whose results can still be read."""
    return [m.version for m in published.manifests(spark, sink)]


def stream_archive(st: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Keeps every processed record as Parquet, exactly once across restarts."""
    return start(st, path, checkpoint, "append", trigger)
