"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.settings import scratch_dir

# Words as the contracts name them: ASCII letters and digits, and everything beyond ASCII. In UTF-8 no byte of a letter
# beyond ASCII is an ASCII byte, so the rule holds byte by byte.
_WORD_BYTES = bytes(
    n + 32 if 65 <= n <= 90 else n if 48 <= n <= 57 or 97 <= n <= 122 or n > 127 else 32 for n in range(256)
)
SMALLEST = -(1 << 63)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased; none for null."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def store(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps neither recompute it nor depend on an executor."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]) -> Column:
    """Equality on all pairs, null equal to null."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def text_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A row key without nulls, equal for rows with the same id and text wherever and whenever it is computed."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(SMALLEST)).alias("_id"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text).isNull(), F.col(text)).alias("_text"),
    ]


def aside(df: DataFrame, *own: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with every column but ``own`` under a name that nothing inside uses, and the way back.

    The way back takes a frame that still has these columns, gives them their names and order again and appends the columns
    named; one of the caller's with such a name is replaced.
    """
    names = {c: c if c in own else f"given{n}" for n, c in enumerate(df.columns)}

    def back(done: DataFrame, *more: str) -> DataFrame:
        kept = [F.col(f"`{names[c]}`").alias(c) for c in names if c not in more]
        return done.select(*kept, *more)

    return df.toDF(*names.values()), back


def in_rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches, one tuple at a time, so that a batch is never held a second time as Python objects."""
    for batch in batches:
        found = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in found)
