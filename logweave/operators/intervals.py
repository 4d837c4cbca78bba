"""Interval inference: bounds that only tighten, budgets, boundary search, envelopes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tighten(df: DataFrame, keys: Sequence[str], lo: Column, hi: Column) -> DataFrame:
    """The greatest lower and least upper bound of each key; a lower bound above the upper is lowered to it."""
    b = df.groupBy(*keys).agg(F.max(lo).alias("__lo"), F.min(hi).alias("hi"))
    return b.withColumn("lo", F.least("__lo", "hi")).select(*keys, "lo", "hi")


def budget(df: DataFrame, keys: Sequence[str], total: float, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Lowers every upper bound to what the budget leaves beside the others' lower bounds, not below its own; skipped where the lower bounds exceed the budget."""
    spent = F.sum(lo).over(Window.partitionBy(*keys))
    capped = F.greatest(F.least(F.col(hi), F.lit(total) - (spent - F.col(lo))), F.col(lo))
    return df.withColumn(hi, F.when(spent > total, F.col(hi)).otherwise(capped))


def least_step(holds: Callable[[Column], Column], start: int, stop: int, step: int = 1) -> Column:
    """The least step for which a monotone condition holds, null if none."""
    return F.array_min(F.filter(F.sequence(F.lit(start), F.lit(stop), F.lit(step)), holds))


def greatest_step(holds: Callable[[Column], Column], start: int, stop: int, step: int = 1) -> Column:
    return F.array_max(F.filter(F.sequence(F.lit(start), F.lit(stop), F.lit(step)), holds))


def observed_range(before: Column, after: Column, ko: Column, tolerance: float = 0.9) -> tuple[Column, Column]:
    """Least and greatest true change for a rounded observation; open above if it hit the floor."""
    seen = before - after
    lo = F.greatest(F.when(ko, before).otherwise(seen) - tolerance, F.lit(0.0))
    return lo, F.when(ko, F.lit(float("inf"))).otherwise(seen + tolerance)


def render(lo: Column, hi: Column, least: float, most: float) -> Column:
    """``?``, ``= a``, ``≤ b``, ``≥ a`` or ``a–b``, by which ends are known."""
    text = lambda c: c.cast("long").cast("string")
    return (
        F.when((lo <= least) & (hi >= most), "?")
        .when(lo == hi, F.concat(F.lit("= "), text(lo)))
        .when(lo <= least, F.concat(F.lit("≤ "), text(hi)))
        .when(hi >= most, F.concat(F.lit("≥ "), text(lo)))
        .otherwise(F.concat(text(lo), F.lit("–"), text(hi)))
    )


def envelope(attackers: DataFrame, defenders: DataFrame, key: str, effect: Callable[[Column, Column], Column]) -> DataFrame:
    """Within a key, every attacker with every defender: effect at (least attack, most defence) and (most attack, least defence)."""
    j = attackers.join(defenders, key)
    return j.withColumn("effect_lo", effect(F.col("attack_lo"), F.col("defence_hi"))).withColumn("effect_hi", effect(F.col("attack_hi"), F.col("defence_lo")))


def speed_stat(base: Column, effort: Column) -> Column:
    """Level-50 stat with the best individual value, before nature: floors at every step."""
    inner = F.floor((2 * base + 31 + F.floor(effort / 4)) * 50 / 100)
    return (inner + 5).cast("long")
