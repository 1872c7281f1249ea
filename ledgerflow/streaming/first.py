"""The first rows of a stream in event order, however the stream is cut into micro-batches.

Rows arrive in any order, so the first ``n`` so far may still be displaced by a later micro-batch. They are kept as state:
rows are dealt by a hash into ``buckets``, and each bucket remembers its own first ``n``, so no task sees all rows and the
state has ``n * buckets`` rows whatever the length of the stream. What a bucket remembers is passed on when it changes. The
sink publishes the buckets' rows as versions (``sources.published``), and a reader takes the first ``n`` of them. State
lives in the checkpoint: a query that is started again goes on where it stopped.

Rows are ordered by ``order``, nulls last, then by their content. Rows that repeat count as often as they occur. A stream
without rows publishes nothing, and ``current`` then has no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerflow.settings import ship
from ledgerflow.sources import published
from ledgerflow.sources.io import EXACT_TIMES
from ledgerflow.streaming.live import KEEP, SECONDS

FIRST = 5
BUCKETS = 16
ORDER = ("timestamp", "transaction_id")

KEPT = T.StructType([T.StructField(c, t) for c, t in (("bucket", T.IntegerType()), ("place", T.StringType()), ("row", T.StringType()))])


def comparable(place: str) -> tuple:
    """The sort key of a place: values in turn, nulls after all others."""
    return tuple((value is None, 0 if value is None else value) for value in json.loads(place))


def place_of(df: DataFrame, order: Sequence[str]) -> Column:
    """The values a row is ordered by as JSON, ``[{"v": 1}, {}]`` for 1 and null; times become microseconds."""
    parts = []
    for name in order:
        kind = df.schema[name].dataType
        c = F.col(f"`{name}`")
        if isinstance(kind, T.TimestampNTZType):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(kind, T.DateType):
            c = F.unix_date(c)
        elif not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("string")
        parts.append(F.coalesce(F.to_json(F.struct(c.alias("v"))), F.lit("{}")))
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def merged(kept: Sequence[tuple[str, str]], fresh: Sequence[tuple[str, str]], n: int) -> list[tuple[str, str]]:
    """The first ``n`` of (place, row) pairs."""
    return sorted([*kept, *fresh], key=lambda p: (comparable(p[0]), p[1]))[:n]


def first_rows(st: DataFrame, n: int = FIRST, order: Sequence[str] = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """The first rows of each bucket of a stream, (bucket, place, row as JSON), all of a bucket whenever they change."""
    ship(st.sparkSession)
    row = F.to_json(F.struct("*"), EXACT_TIMES)
    dealt = st.select(place_of(st, order).alias("place"), row.alias("row")).withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")
    )

    def remember(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = list(zip(*state.get)) if state.exists else []
        kept = before
        for batch in batches:
            fresh = [(json.dumps([v.get("v") for v in json.loads(p)]), r) for p, r in zip(batch["place"], batch["row"])]
            kept = merged(kept, fresh, n)
        if kept != before:
            state.update(([p for p, _ in kept], [r for _, r in kept]))
            yield pd.DataFrame({"bucket": [key[0]] * len(kept), "place": [p for p, _ in kept], "row": [r for _, r in kept]})

    remembered = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in ("places", "rows")])
    return dealt.groupBy("bucket").applyInPandasWithState(remember, KEPT, remembered, "update", GroupStateTimeout.NoTimeout)


def start(
    first: DataFrame, sink: str, checkpoint: str, trigger: str | None = "5 seconds", keep: int = KEEP, seconds: float = SECONDS
) -> StreamingQuery:
    """Starts a query over ``first_rows`` that publishes the rows of all buckets whenever some of them change."""
    writer = first.writeStream.option("checkpointLocation", checkpoint).outputMode("update")
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)

    def replace(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        before = published.newest(spark, sink)
        if before is not None and before.version >= batch:
            return
        changed = changed.persist()  # a bucket's few rows
        try:
            if changed.isEmpty():
                return
            rows = changed
            if before is not None:
                others = published.read(spark, sink).join(changed.select("bucket").distinct(), "bucket", "left_anti")
                rows = others.select(*changed.columns).unionByName(changed)
            published.publish(rows.coalesce(1), sink, version=batch, check=False)
            published.expire(spark, sink, keep, seconds)
        finally:
            changed.unpersist()

    return writer.foreachBatch(replace).start()


def current(spark: SparkSession, sink: str, schema: T.StructType, n: int = FIRST, order: Sequence[str] = ORDER) -> DataFrame:
    """The first ``n`` rows so far, with ``position`` from 1, in the columns of the stream."""
    wide = T.StructType([*schema.fields, T.StructField("position", T.IntegerType())])
    if published.newest(spark, sink) is None:
        return spark.createDataFrame([], wide)
    rows = published.read(spark, sink).select(F.from_json("row", schema, EXACT_TIMES).alias("r"), "row")
    keys = [F.asc_nulls_last(f"r.`{c}`") for c in order]
    # n rows of each bucket at most.
    numbered = rows.orderBy(*keys, "row").limit(n).withColumn("position", F.row_number().over(Window.orderBy(*keys, "row")))
    return numbered.select("r.*", "position")
