"""From start and end marks to intervals, and from intervals to the ticks at which they hold.

A *tick* is a moment of interest (the beginning of a turn, a report's hour); every mark knows how many ticks came
before it, so the ticks of an interval are a range of numbers and nothing is compared with nothing: a key's
intervals don't overlap, and the rows made are those that hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators import sequence


def intervals(marks: DataFrame, keys: Sequence[str], order: Sequence[str], starts: str, tick: str, stop: str | None = None) -> DataFrame:
    """One row per start, with all its columns, level, until_tick and ended.

    An interval lasts to the next mark of its key, or to ``stop``, the ticks before something else that closes it, if that is sooner. ``ended`` is "restart", "end",
    "stop" or null (still open, until_tick null). ``level`` counts the starts since the last end.
    """
    run = "__run"
    d = marks.withColumn(run, sequence.stint(~F.col(starts), keys, order))
    d = d.withColumn("level", F.count_if(F.col(starts)).over(sequence.so_far([*keys, run], order)).cast("int"))
    d = d.withColumn("__next", F.lead(F.struct(F.col(tick).alias("tick"), F.col(starts).alias("starts"))).over(sequence.ordered(keys, order)))
    until, why = F.col("__next.tick"), F.when(F.col("__next.starts"), "restart").when(~F.col("__next.starts"), "end")
    if stop is not None:
        sooner = F.col(stop).isNotNull() & (until.isNull() | (F.col(stop) < until))
        until, why = F.when(sooner, F.col(stop)).otherwise(until), F.when(sooner, "stop").otherwise(why)
    return d.where(F.col(starts)).withColumn("until_tick", until).withColumn("ended", why).drop(run, "__next")


def at_ticks(spans: DataFrame, ticks: DataFrame, group: Sequence[str], tick: str, last: str) -> DataFrame:
    """The intervals at every tick (``tick``: 1, 2, ... within the group) at which they hold; ``last``: the column with the group's number of ticks, for open ones.

    ``ticks`` has one row per group and tick, with what is known of it; its other columns are added.
    """
    end = F.coalesce("until_tick", last)
    held = spans.where(F.col(tick) < end).withColumn("__at", F.explode(F.sequence(F.col(tick) + 1, end))).drop(tick)
    return held.withColumnRenamed("__at", tick).join(ticks, [*group, tick])


def left(duration: Column, elapsed: Column) -> Column:
    """What is left of a duration, null once it has run out or if there is none."""
    return F.when(duration > elapsed, duration - elapsed)
