"""Leakage-free splits over whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def index_terciles(df: DataFrame, group: str, value: str) -> DataFrame:
    """``low_cut`` and ``high_cut``: the values at 0-based places n // 3 and 2n // 3 of the sorted values. From counts of distinct values, not from a list of all."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(group).orderBy(value)
    upto = counts.withColumn("__upto", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__all", F.sum("__n").over(Window.partitionBy(group)))
    at = lambda k: F.min(F.when(F.col("__upto") > F.floor(F.col("__all") * k / 3), F.col(value)))
    return upto.groupBy(group).agg(F.max("__all").alias("n"), at(1).alias("low_cut"), at(2).alias("high_cut"))


def bucket(value: Column, low: Column, high: Column) -> Column:
    return F.when(value <= low, "short").when(value <= high, "medium").otherwise("long")


def stratified_split(df: DataFrame, unit: str, stratum: str, holdout: int, seed: int) -> DataFrame:
    """Adds split (holdout, train): of each stratum its rounded (half to even) proportional share, by the order of a seeded hash.

    Every stratum gives its share, so the holdout's size may differ from ``holdout`` by rounding. Rows are counted by the
    hash's leading digits; only rows with the same digits are put in order, so a stratum of any size is many tasks' work.
    Null strata are a stratum.
    """
    d = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(unit).cast("string"), F.lit("")))))
    d = d.withColumn("__b", F.left("__h", F.lit(4)))
    counts = d.groupBy(F.col(stratum).alias("__s"), F.col("__b").alias("__c")).agg(F.count("*").alias("__n"))
    sizes = counts.groupBy(F.col("__s").alias("__t")).agg(F.sum("__n").alias("__size"))
    total = sizes.agg(F.sum("__size").alias("__total"))
    quota = sizes.crossJoin(F.broadcast(total)).select("__t", F.bround(F.lit(holdout) * F.col("__size") / F.col("__total")).alias("__quota"))  # total is one row
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = counts.withColumn("__before", before).join(quota, F.col("__s").eqNullSafe(F.col("__t"))).select("__s", "__c", (F.col("__quota") - F.col("__before")).alias("__room"))
    place = F.row_number().over(Window.partitionBy(stratum, "__b").orderBy("__h", unit))
    placed = d.withColumn("__place", place).join(room, F.col(stratum).eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__c")))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], F.when(F.col("__place") <= F.col("__room"), "holdout").otherwise("train").alias("split"))
