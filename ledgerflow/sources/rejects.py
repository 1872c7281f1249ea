"""Records that do not fit their schema: kept beside the good ones with their text and where they came from.

A line or payload is a good record if all of it fits the schema, and a rejected one otherwise; none is lost or turned into a
row of nulls. Records are parsed once and written once, partitioned by whether they were rejected; good and rejected rows
are then read from there, so both always stem from the same reading and add up to what was read. Blank lines are no records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.sources import io


def unused(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


@dataclass(frozen=True)
class Names:
    """The columns that stand beside those of the schema."""

    raw: str
    source: str
    rejected: str

    @classmethod
    def of(cls, schema: T.StructType) -> Names:
        return cls(*(unused(n, schema.names) for n in ("raw", "source", "rejected")))


@dataclass(frozen=True)
class Checked:
    """Records that were read: ``good`` with the columns of the schema, ``rejected`` as (source, raw)."""

    good: DataFrame
    rejected: DataFrame
    all: DataFrame

    def counts(self) -> DataFrame:
        """(source, read, good, rejected): one row per file or topic partition."""
        names = Names(*self.all.columns[-3:])
        bad = F.count_if(F.col(f"`{names.rejected}`"))
        one = F.count(F.lit(1))
        return self.all.groupBy(F.col(f"`{names.source}`").alias("source")).agg(
            one.alias("read"), (one - bad).alias("good"), bad.alias("rejected")
        )


def with_verdict(parsed: DataFrame, schema: T.StructType, names: Names, source: Column) -> DataFrame:
    """Parsed lines with their source and whether they are rejected; the text is kept of rejected ones only."""
    return parsed.select(
        *[f"`{c}`" for c in schema.names],
        F.col(f"`{names.raw}`"),
        source.alias(names.source),
        F.col(f"`{names.raw}`").isNotNull().alias(names.rejected),
    )


def reader_options(names: Names, options: Mapping[str, str] | None) -> dict[str, str]:
    return {**dict(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": names.raw}


def lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    header: bool = True,
    options: Mapping[str, str] | None = None,
    stream: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of CSV or JSON as (columns of the schema, raw, source, rejected), in batch or as a stream.

    CSV with a header is found by name, as ``io.read_csv`` finds it; a line with too few or too many values is rejected.
    A header cannot be looked up for a stream whose folder is still empty: the schema then has to follow the files.
    """
    names = Names.of(schema)
    wide = schema
    if fmt == "csv" and header and not stream:
        found = spark.read.option("header", True).csv(path).columns  # the first line only
        missing = [c for c in schema.names if c not in found]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        known = {f.name: f for f in schema.fields}
        wide = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in found])
    names = Names.of(T.StructType(wide.fields + [f for f in schema.fields if f.name not in wide.names]))
    wide = T.StructType([*wide.fields, T.StructField(names.raw, T.StringType())])
    reader = (spark.readStream if stream else spark.read).format(fmt).schema(wide).options(**reader_options(names, options))
    if fmt == "csv":
        # Only a line that is parsed in full shows whether it fits.
        reader = reader.option("header", header).option("enforceSchema", not header).option("columnPruning", False)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_verdict(reader.load(path), schema, names, F.col("_metadata.file_path"))


def payloads(
    df: DataFrame, schema: T.StructType, col: str = "value", source: Column | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON bytes, as a message queue delivers them, as (columns of the schema, raw, source, rejected).

    Null, empty and badly encoded payloads are rejected as well; ``raw`` has their bytes. Works on a stream.
    """
    names = Names.of(schema)
    wide = T.StructType([*schema.fields, T.StructField(names.raw, T.StringType())])
    bytes_ = F.col(f"`{col}`").cast("binary")
    record = F.from_json(bytes_.cast("string"), wide, reader_options(names, options))
    held = unused("record", df.columns)
    parsed = df.withColumn(held, record)
    good = (
        F.col(held).isNotNull()
        & F.col(f"{held}.`{names.raw}`").isNull()
        & F.coalesce(F.is_valid_utf8(bytes_.cast("string")), F.lit(False))
        & F.coalesce(F.length(F.trim(bytes_.cast("string"))) > 0, F.lit(False))
    )
    return parsed.select(
        *[F.when(good, F.col(f"{held}.`{c}`")).alias(c) for c in schema.names],
        F.when(~good, bytes_).alias(names.raw),
        (F.lit(None).cast("string") if source is None else source).alias(names.source),
        (~good).alias(names.rejected),
    )


def save(checked: DataFrame, path: str) -> None:
    """Writes records with their verdict, good and rejected ones apart."""
    io.save(checked, path, [checked.columns[-1]], mode="error")


def load(spark: SparkSession, path: str, written: T.StructType) -> Checked:
    """The records that ``save`` or ``start`` wrote; ``written`` is the schema of the frame that was given to them."""
    raw, source, rejected = written.names[-3:]
    every = spark.read.schema(written).parquet(path)
    good = every.filter(~F.col(f"`{rejected}`")).select(*[f"`{c}`" for c in written.names[:-3]])
    bad = every.filter(F.col(f"`{rejected}`")).select(F.col(f"`{source}`").alias("source"), F.col(f"`{raw}`").alias("raw"))
    return Checked(good, bad, every)


def ingest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str,
    fmt: str = "json",
    header: bool = True,
    options: Mapping[str, str] | None = None,
) -> Checked:
    """Reads a folder of lines, writes good and rejected records to ``out`` and returns both."""
    parsed = lines(spark, path, schema, fmt, header, options)
    save(parsed, out)
    return load(spark, out, parsed.schema)


def start(checked: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Starts a stream that writes records with their verdict, each exactly once, good and rejected ones apart.

    ``trigger`` is a processing time; None works off all data and stops.
    """
    writer = checked.writeStream.option("checkpointLocation", checkpoint).partitionBy(checked.columns[-1])
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.format("parquet").start(path)


def kafka_payloads(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, stream: bool = True, **options: str
) -> DataFrame:
    """Records of a topic with their verdict; the source is ``topic/partition/offset``. Needs the Kafka connector."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    loaded = reader.options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **options}).load()
    return payloads(loaded, schema, source=F.concat_ws("/", "topic", "partition", "offset"))
