"""Ordered-sequence operators. Every order is total: order columns end with a unique tiebreak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MICROS = 1_000_000


def ordered(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def so_far(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """All rows up to and with the current one."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """All rows strictly before the current one."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, gap_seconds: int, ceiling: int) -> DataFrame:
    """Adds session (from 1, by key). A session ends where the next row is more than the gap later, or after ``ceiling`` rows.

    A gap starts anew, and within a gap-free run every ``ceiling`` rows make a session, so two window
    passes over one shuffle and sort do what a greedy scan does.
    """
    order = [ts, tiebreak]
    w = ordered(keys, order)
    gap = micros_between(F.lag(ts).over(w), F.col(ts)) > gap_seconds * MICROS
    run = F.sum(F.coalesce(gap, F.lit(False)).cast("int")).over(so_far(keys, order))
    df = df.withColumn("__run", run)
    first = (F.row_number().over(ordered([*keys, "__run"], order)) - 1) % ceiling == 0
    df = df.withColumn("__first", first.cast("int"))
    return df.withColumn("session", F.sum("__first").over(so_far(keys, ["__run", *order])).cast("long")).drop("__run", "__first")


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds next_<column>; rows without a successor go."""
    w = ordered(keys, order)
    out = df.withColumn("__next", F.lead(F.struct(*columns)).over(w)).where("__next is not null")
    return out.select(*df.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns])


def running_distinct(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds the distinct values up to each row, in order of first appearance.

    Only first appearances carry a value into the frame, so its array is as long as the values are many, not the rows.
    """
    first = F.row_number().over(ordered([*keys, value], order)) == 1
    df = df.withColumn("__new", F.when(first, F.col(value)))
    return df.withColumn(name, F.collect_list("__new").over(so_far(keys, order))).drop("__new")


def stint(reset: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Number of resets so far: rows of one number form a stint that begins with its reset."""
    return F.sum(F.when(reset, 1).otherwise(0)).over(so_far(keys, order)).cast("long")


def last_since_reset(value: Column, keys: Sequence[str], order: Sequence[str], stint_column: str) -> Column:
    """Last non-null value of the current stint."""
    return F.last(value, ignorenulls=True).over(so_far([*keys, stint_column], order))


def touched_since_reset(flag: Column, keys: Sequence[str], order: Sequence[str], stint_column: str) -> Column:
    return F.bool_or(flag).over(so_far([*keys, stint_column], order))


def sticky(value: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Last non-null value so far."""
    return F.last(value, ignorenulls=True).over(so_far(keys, order))


def start_end_value(start: Column, end: Column, value: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Value of the last start event unless an end event came after it."""
    state = F.when(start, F.struct(value.alias("v"))).when(end, F.struct(F.lit(None).cast("string").alias("v")))
    return F.last(state, ignorenulls=True).over(so_far(keys, order))["v"]


def forward_fill_prior(value: Column, seed: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Last non-null value strictly before the row, else the seed."""
    return F.coalesce(F.last(value, ignorenulls=True).over(before(keys, order)), seed)


def last_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The last k rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k).drop("__n")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__n", F.row_number().over(ordered(keys, order))).where("__n = 1").drop("__n")


def key_changes(value: str, order: Sequence[str], keys: Sequence[str]) -> Column:
    """True where the value differs from the row before, and on the first row."""
    return ~F.lag(value).over(ordered(keys, order)).eqNullSafe(F.col(value)) | F.lag(F.lit(1)).over(ordered(keys, order)).isNull()


def side_effects_last(df: DataFrame, keys: Sequence[str], pos: str, opens: Column, side_effect: Column) -> DataFrame:
    """Adds group and new_pos: within the group that an opening event starts, side effects follow all others."""
    df = df.withColumn("group", stint(opens, keys, [pos])).withColumn("__late", side_effect.cast("int"))
    return df.withColumn("new_pos", F.row_number().over(ordered(keys, ["group", "__late", pos])).cast("long")).drop("__late")
