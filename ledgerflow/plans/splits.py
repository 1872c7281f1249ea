"""Ordered windows that survive a hot key.

A plain ``Window.partitionBy(account)`` puts all rows of an account into one task. Where one account may hold a third
of the data, the rows of that account have to be split. The helpers here cut the (group, order) space at sampled cut
points. Only a group that spans several cuts is split; all others run as ordinary windows. Any choice of cut points
gives the same result, they only balance the work, so sampling never touches correctness.

What reaches the driver is bounded: one row count, and at most ``MAX_BUCKETS * SAMPLE_PER_BUCKET`` sampled key tuples.
What is broadcast is bounded too: at most ``MAX_BUCKETS`` cut tuples and two rows of totals per cut.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 4_000_000
MAX_BUCKETS = 16384
SAMPLE_PER_BUCKET = 20
FEW_CUTS = 127

BUCKET = "_bucket"
_CUTS = "_cuts"


@dataclass(frozen=True)
class Splits:
    """Cut points of one (group, order) space. ``cuts`` is empty when no group needs splitting."""

    group: tuple[str, ...]
    order: tuple[str, ...]
    schema: T.StructType
    cuts: tuple[Row, ...] = ()
    repeated: bool = False  # whether one (group, order) key alone fills about a bucket

    @property
    def whole(self) -> bool:
        return not self.cuts

    @property
    def most(self) -> int:
        """The largest number of cuts in one group."""
        return max(Counter(tuple(c[: len(self.group)]) for c in self.cuts).values(), default=0)


def find_splits(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rows: int | None = None,
    rows_per_task: int | None = None,
    min_buckets: int = 1,
) -> Splits:
    """Cut points so that a split group has about ``rows_per_task`` rows per bucket.

    Order is ascending with nulls first. ``rows`` is an upper bound on the size of ``df`` if the caller knows one: a small
    bound settles the matter without a job, beyond it the rows are counted. The cut points can be taken from any frame
    with the same key columns, such as the raw table: that scan needs no join or de-duplication.
    """
    limit = rows_per_task or ROWS_PER_TASK
    keys = df.select(*group, *order)
    found = Splits(tuple(group), tuple(order), keys.schema)
    total = rows if rows is not None and rows <= limit else df.count()
    wanted = min(MAX_BUCKETS, max(min_buckets, math.ceil(total / limit)))
    if wanted <= 1 or total == 0:
        return found
    fraction = min(1.0, wanted * SAMPLE_PER_BUCKET / total)
    sample = keys.sample(fraction=fraction, seed=11).sort(*group, *order).collect()
    stride = max(1, len(sample) // wanted)
    cuts: dict[tuple, list[Row]] = {}
    picked = sample[stride - 1 :: stride]
    for row in dict.fromkeys(picked):
        cuts.setdefault(tuple(row[: len(group)]), []).append(row)
    # A group with a single cut holds less than two buckets of rows: not worth splitting.
    kept = [row for part in cuts.values() if not group or len(part) > 1 for row in part]
    return Splits(found.group, found.order, found.schema, tuple(kept), repeated=len(set(picked)) < len(picked))


def same_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality on all pairs with null equal to null, as grouping has it."""
    tests = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def _cuts_below(cuts: Column, key: Column, most: int) -> Column:
    """How many of the sorted ``cuts`` (``most`` or fewer) lie below ``key``, by binary search; 0 when there are none."""
    steps = [1 << bit for bit in reversed(range(most.bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < key, at + step).otherwise(at),
    )
    return F.when(cuts.isNotNull(), found).otherwise(F.lit(0))


def _decision(key: Column, cuts: Sequence[object], first: int = 0) -> Column:
    """The same for a few known cuts as nested comparisons, which Spark compiles; a null key lies below all cuts."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    above = _decision(key, cuts[middle + 1 :], first + middle + 1)
    return F.when(key > F.lit(cuts[middle]), above).otherwise(_decision(key, cuts[:middle], first))


def with_bucket(df: DataFrame, splits: Splits) -> DataFrame:
    """Adds the bucket number of each row within its group, and whether the group is split."""
    spark = df.sparkSession
    if not splits.group and len(splits.order) == 1 and len(splits.cuts) <= FEW_CUTS:
        known = [c[0] for c in splits.cuts if c[0] is not None]
        return df.withColumns({BUCKET: _decision(df[splits.order[0]], known), "_split": F.lit(True)})
    table = spark.createDataFrame(list(splits.cuts), splits.schema)
    entry = F.struct(*splits.order)
    key = F.struct(*[df[c] for c in splits.order])
    if not splits.group:
        cuts = table.agg(F.array_sort(F.collect_list(entry))).scalar()
        placed = df.withColumn(_CUTS, cuts)
        return placed.withColumns({BUCKET: _cuts_below(F.col(_CUTS), key, splits.most), "_split": F.lit(True)}).drop(_CUTS)
    lookup = table.groupBy(*splits.group).agg(F.array_sort(F.collect_list(entry)).alias(_CUTS))
    lookup = lookup.withColumnsRenamed({g: f"_at_{g}" for g in splits.group})
    on = same_key(df, lookup, [(g, f"_at_{g}") for g in splits.group])
    joined = df.join(F.broadcast(lookup), on, "left")
    return joined.select(
        *[df[c] for c in df.columns],
        _cuts_below(F.col(_CUTS), key, splits.most).alias(BUCKET),
        F.col(_CUTS).isNotNull().alias("_split"),
    )


def _spread(df: DataFrame, splits: Splits) -> DataFrame:
    """Rows placed by (group, bucket). Explicit, since a layout by group alone would satisfy the window as well."""
    return with_bucket(df, splits).repartition(*splits.group, BUCKET)


def _bucket_totals(placed: DataFrame, splits: Splits, totals: Mapping[str, Column]) -> DataFrame:
    """One row per bucket of the split groups: at most two per cut point."""
    return placed.filter("_split").groupBy(*splits.group, BUCKET).agg(*[c.alias(n) for n, c in totals.items()])


def _attach(rows: DataFrame, offsets: DataFrame, splits: Splits) -> DataFrame:
    renamed = offsets.withColumnsRenamed({c: f"_at_{c}" for c in (*splits.group, BUCKET)})
    on = same_key(rows, renamed, [(c, f"_at_{c}") for c in (*splits.group, BUCKET)])
    return rows.join(F.broadcast(renamed), on, "left").drop(*[f"_at_{c}" for c in (*splits.group, BUCKET)])


def cumulate(df: DataFrame, splits: Splits, measures: Mapping[str, Column], share: bool = False) -> DataFrame:
    """Adds running sums (start of group .. current row) of ``measures`` in the order of ``splits``.

    When buckets are used, ``df`` feeds both the rows and the bucket totals. With ``share`` the totals read the very
    same shuffle as the rows, which pays off when ``df`` is narrow but costly to compute. Without it they are computed
    from a column-pruned plan, which is better when ``df`` is wide and stored.
    """
    group, order = list(splits.group), [F.asc_nulls_first(c) for c in splits.order]
    if splits.whole:
        frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({name: F.sum(c).over(frame) for name, c in measures.items()})
    placed = _spread(df.withColumns({f"_m_{n}": c for n, c in measures.items()}), splits)
    frame = Window.partitionBy(*group, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumns({name: F.sum(f"_m_{name}").over(frame) for name in measures})
    before = Window.partitionBy(*group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"_t_{n}": F.sum(f"_m_{n}") for n in measures}
    if share:
        # Touching every column keeps the plan equal to that of the rows, so the shuffle is reused.
        sums["_seen"] = F.max(F.xxhash64(*placed.columns))
    totals = _bucket_totals(placed, splits, sums)
    if share:
        totals = totals.filter("_seen is not null")
    offsets = totals.select(*group, BUCKET, *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in measures])
    out = _attach(rows, offsets, splits)
    # The type of a plain sum: adding two of them would widen a decimal, and results must not depend on the size.
    kinds = df.select(*[F.sum(c).alias(n) for n, c in measures.items()]).schema
    shifted = {n: F.coalesce(F.col(n) + F.col(f"_o_{n}"), F.col(n), F.col(f"_o_{n}")).cast(kinds[n].dataType) for n in measures}
    helpers = [BUCKET, "_split", *[f"_m_{n}" for n in measures], *[f"_o_{n}" for n in measures]]
    return out.withColumns(shifted).drop(*helpers)


def rows_below(df: DataFrame, splits: Splits, out: str) -> DataFrame:
    """Adds ``out``: the number of rows with a smaller value of the one order column, over all rows.

    One shuffle of the rows by value range; the bucket sizes come from a separate count. Equal values share a bucket, so
    this is for ``splits`` that found no value filling a bucket by itself; ``ranked_values`` handles the others.
    """
    col = splits.order[0]
    inside = Window.partitionBy(BUCKET).orderBy(F.asc_nulls_first(col))
    rows = _spread(df, splits).withColumn(out, F.rank().over(inside) - 1)
    sizes = with_bucket(df.select(col), splits).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy().orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(BUCKET, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return _attach(rows, offsets, splits).withColumn(out, F.col(out) + F.col("_before")).drop(BUCKET, "_split", "_before")


def previous(df: DataFrame, splits: Splits, col: str, out: str) -> DataFrame:
    """Adds ``out``: the value of ``col`` in the row before, within the group and in the order of ``splits``."""
    group, order = list(splits.group), [F.asc_nulls_first(c) for c in splits.order]
    if splits.whole:
        return df.withColumn(out, F.lag(col, 1).over(Window.partitionBy(*group).orderBy(*order)))
    placed = _spread(df, splits)
    inside = Window.partitionBy(*group, BUCKET).orderBy(*order)
    rows = placed.withColumns({out: F.lag(col, 1).over(inside), "_nth": F.row_number().over(inside)})
    last = F.max_by(F.struct(F.col(col).alias("v")), F.struct(*splits.order))
    ends = _bucket_totals(placed, splits, {"_last": last})
    offsets = ends.select(*group, BUCKET, F.lag("_last", 1).over(Window.partitionBy(*group).orderBy(BUCKET)).alias("_end"))
    joined = _attach(rows, offsets, splits)
    return joined.withColumn(out, F.when(F.col("_nth") == 1, F.col("_end.v")).otherwise(F.col(out))).drop(
        BUCKET, "_split", "_nth", "_end"
    )


def ranked_values(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    rows: int | None = None,
    splits: Splits | None = None,
    weights: Mapping[str, Column] | None = None,
    min_buckets: int = 1,
    rows_per_task: int | None = None,
) -> DataFrame:
    """One row per distinct value of each group: ``n`` rows, ``below`` rows with a smaller value, ``place`` among the values.

    Ties collapse in the partial aggregation before anything is shuffled, so a value held by a third of the rows costs
    one row per map task. ``weights`` adds further sums per value, each with its own running ``<name>_below``.
    """
    sums = {"n": F.count(F.lit(1)), **(weights or {})}
    distinct = df.groupBy(*group, value).agg(*[c.alias(n) for n, c in sums.items()])
    if splits is None:
        splits = find_splits(df, group, [value], rows=rows, min_buckets=min_buckets, rows_per_task=rows_per_task)
    running = {f"{'' if n == 'n' else n + '_'}below": F.col(n) for n in sums}
    out = cumulate(distinct, splits, {**running, "place": F.lit(1).cast("long")}, share=True)
    return out.withColumns({r: F.col(r) - c for r, c in running.items()})
