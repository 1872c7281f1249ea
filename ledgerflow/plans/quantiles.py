"""Exact quantiles of numeric columns by radix selection: no sort and no job before the action.

Every value becomes a whole number of 64 bits that sorts as the value does. One pass counts the values and finds the range of
each column; with that, a first pass counts the leading bits of all columns at once, in one aggregate. The leading bits that
hold the wanted rank are refined by the next bits, and once more, after which all bits are known. Each pass shuffles counts,
never values; what a pass learned reaches the next one as a scalar subquery, so the plan stays lazy. A pass counts at most
2 ** bits numbers per column, whatever the values, and its counts are added up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits found by each pass, 64 together. Fewer in the first one, which counts all rows of all columns.
LEVELS = (14, 25, 25)
# Up to this many rows, if the caller knows that there are no more, the built-in percentile is the faster way.
BUILT_IN_ROWS = 1_000_000
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
MANTISSA = 1 << 52


def order_key(c: Column, kind: T.DataType) -> Column:
    """A long that sorts as the number does; null for null. NaN comes after infinity, both zeros are one."""
    if isinstance(kind, WHOLE):
        return c.cast("long")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(Decimal(10**kind.scale))).cast("long")
    x = F.abs(c.cast("double"))
    # The logarithm may be off by one next to a power of two; powers of two are exact.
    near = F.floor(F.log2(x)).cast("int")
    exponent = near - (F.pow(F.lit(2.0), near) > x).cast("int") + (F.pow(F.lit(2.0), near + 1) <= x).cast("int")
    normal = F.shiftleft((exponent + 1023).cast("long"), 52) + ((x / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(MANTISSA))).cast("long")
    small = (x / F.lit(5e-324)).cast("long")
    size = (
        F.when(F.isnan(x), F.lit(2047 * MANTISSA + 1))
        .when(x == F.lit(float("inf")), F.lit(2047 * MANTISSA))
        .when(x < F.lit(2.0**-1022), small)
        .otherwise(normal)
    )
    return F.when(c.cast("double") < 0, -size).otherwise(size)


def value_of(key: Column, kind: T.DataType) -> Column:
    """The number of an order key, as a double."""
    if isinstance(kind, WHOLE):
        return key.cast("double")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (key.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast("double")
    size = F.abs(key)
    exponent, rest = F.shiftright(size, 52), size.bitwiseAND(F.lit(MANTISSA - 1)).cast("double")
    normal = (1 + rest / float(MANTISSA)) * F.pow(F.lit(2.0), exponent - 1023)
    found = (
        F.when((exponent == 2047) & (rest > 0), F.lit(float("nan")))
        .when(exponent == 2047, F.lit(float("inf")))
        .when(exponent == 0, rest * F.lit(5e-324))
        .otherwise(normal)
    )
    return F.when(key < 0, -found).otherwise(found)


FIELDS = ("low", "high", "share", "low_key", "high_key", "known", "next")


def _ranges(keyed: DataFrame, shares: Sequence[float], levels: Sequence[int]) -> DataFrame:
    """One row ``state``: for each column its ranks and how many bits the first pass leaves out.

    The range of the keys decides how many; a range that overflows leaves out all that later passes can find.
    """
    left = sum(levels[1:])
    counted = keyed.selectExpr(*[f"{f}({c}) AS {f}_{c}" for c in keyed.columns for f in ("count", "min", "max")])
    states = []
    for i, (c, share) in enumerate(zip(keyed.columns, shares)):
        at = f"(count_{c} - 1) * {float(share)!r}D"
        bits = f"CAST(ceil(log2(try_subtract(max_{c}, min_{c}) + 2D)) AS INT) - {levels[0] - 1}"
        states.append(
            f"named_struct('low', floor({at}), 'high', ceil({at}), 'share', {at} - floor({at}), 'low_key', 0L, 'high_key', 0L, "
            f"'known', 64, 'next', least({left}, greatest(0, coalesce({bits}, {left}))))"
        )
    return counted.selectExpr(f"array({', '.join(states)}) AS state")


def _refined(keyed: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """The state with the next bits of each column's two keys; ranks become ranks among the values that share them.

    Rows give three small numbers per column. What is known of a column goes along with its counts as plain numbers, so that
    each pass names the one before it once and counts in hash tables.
    """
    rows = keyed.withColumn("_s", state.scalar())
    entries = []
    for i, c in enumerate(keyed.columns):
        own = f"_s[{i}]"
        for side, wanted in ((0, "low_key"), (1, "high_key")):
            inside = f"({own}.known = 64 OR shiftright({c}, least({own}.known, 63)) = {own}.{wanted})"
            if side == 1:  # both keys share their bits mostly, and are then counted once
                inside += f" AND {own}.known < 64 AND {own}.low_key <> {own}.high_key"
            entry = f"named_struct('c', {i}, 'side', {side}, 'bits', shiftright({c}, {own}.next))"
            entries.append(f"CASE WHEN {c} IS NOT NULL AND {inside} THEN {entry} END")
    # A null entry becomes a row of nulls; a lambda that leaves it out would not be compiled.
    found = rows.selectExpr("_s", f"inline(array({', '.join(entries)}))").filter("c IS NOT NULL")
    counted = found.groupBy("c", "side", "bits").agg(F.expr("count(1)").alias("n"), *[F.expr(f"max(_s[c].{f})").alias(f) for f in FIELDS])
    placed = counted.selectExpr("*", "sum(n) OVER (PARTITION BY c, side ORDER BY bits) - n AS before")
    is_low = "(side = 0 AND before <= low AND low < before + n)"
    is_high = "(side = CASE WHEN low_key = high_key OR known = 64 THEN 0 ELSE 1 END AND before <= high AND high < before + n)"
    picked = placed.filter(f"{is_low} OR {is_high}").groupBy("c").agg(
        F.expr(f"max(CASE WHEN {is_low} THEN low - before END)").alias("low"),
        F.expr(f"max(CASE WHEN {is_high} THEN high - before END)").alias("high"),
        F.max("share").alias("share"),
        F.expr(f"max(CASE WHEN {is_low} THEN bits END)").alias("low_key"),
        F.expr(f"max(CASE WHEN {is_high} THEN bits END)").alias("high_key"),
        F.max("next").alias("known"),
        F.expr(f"max(greatest(next - {bits}, 0))").alias("next"),
    )
    gathered = picked.selectExpr(f"map_from_entries(collect_list(struct(c, struct({', '.join(FIELDS)})))) AS m")
    return gathered.selectExpr(f"array({', '.join(f'try_element_at(m, {i})' for i in range(len(keyed.columns)))}) AS state")


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, float],
    rows: int | None = None,
    accuracy: int | None = None,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """One row with the interpolated quantile of each column as a double, nulls left out; null for a column without values.

    ``rows`` is an upper bound on the size of ``df`` where the caller knows one: up to ``BUILT_IN_ROWS`` the built-in exact
    percentile, one pass with a buffer that is small then, gives the same result sooner. ``accuracy`` asks for
    ``percentile_approx`` instead. ``levels`` are the bits found by each pass. No job runs before the action in any case.
    """
    if accuracy:
        return df.agg(*[F.percentile_approx(F.col(c).cast("double"), p, accuracy).alias(c) for c, p in wanted.items()])
    if rows is not None and rows <= BUILT_IN_ROWS:
        return df.agg(*[F.percentile(F.col(c).cast("double"), F.lit(float(p))).alias(c) for c, p in wanted.items()])
    if sum(levels) < 64:
        raise ValueError("the passes have to find 64 bits together")
    kinds = [df.schema[c].dataType for c in wanted]
    keyed = df.select(*[order_key(F.col(f"`{c}`"), kind).alias(f"k{i}") for i, (c, kind) in enumerate(zip(wanted, kinds))])
    state = _ranges(keyed, list(wanted.values()), levels)
    for bits in (*levels[1:], 0):
        state = _refined(keyed, state, bits)

    def value(i: int, kind: T.DataType) -> Column:
        own = F.get("state", F.lit(i))
        low, high = value_of(own["low_key"], kind), value_of(own["high_key"], kind)
        return F.when(own["low_key"] == own["high_key"], low).otherwise((F.lit(1.0) - own["share"]) * low + own["share"] * high)

    return state.select(*[value(i, kind).alias(c) for i, (c, kind) in enumerate(zip(wanted, kinds))])
