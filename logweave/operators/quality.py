"""Checks as named expressions, reports over them, gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``trips`` is true where a row has the issue; rows outside ``applies`` don't count for its rate."""

    trips: Column
    applies: Column | None = None


def audit(df: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """check_name, n_rows, n_tripped, rate: one aggregation for all checks, unpivoted after it. A null result is no issue."""
    sums = []
    for k, c in enumerate(checks.values()):
        on = F.lit(True) if c.applies is None else F.coalesce(c.applies, F.lit(False))
        sums += [F.count_if(on).alias(f"n{k}"), F.count_if(on & F.coalesce(c.trips, F.lit(False))).alias(f"t{k}")]
    one = df.agg(*sums)
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"n{k}").alias("n_rows"), F.col(f"t{k}").alias("n_tripped")) for k, name in enumerate(checks)])
    out = one.select(F.explode(rows).alias("x")).select("x.*")
    return out.withColumn("rate", F.round(F.coalesce(F.try_divide(F.col("n_tripped"), F.col("n_rows")), F.lit(0.0)), 6))


def issues(df: DataFrame, checks: Mapping[str, Check], keep: list[str]) -> DataFrame:
    """A row for each issue of each row."""
    found = F.array_compact(F.array(*[F.when((F.lit(True) if c.applies is None else c.applies) & c.trips, F.lit(name)) for name, c in checks.items()]))
    return df.select(*keep, F.explode(found).alias("issue"))


def gate(df: DataFrame, good: Column, bad: Column, least_good: float, most_bad: float, least_rows: int) -> DataFrame:
    """One row: counts, rates and pass or halt. Too few rows halt."""
    one = df.agg(F.count("*").alias("n"), F.count_if(good).alias("n_good"), F.count_if(bad).alias("n_bad"))
    g, b = F.coalesce(F.try_divide(F.col("n_good"), F.col("n")), F.lit(0.0)), F.coalesce(F.try_divide(F.col("n_bad"), F.col("n")), F.lit(0.0))
    ok = (F.col("n") >= least_rows) & (g >= least_good) & (b <= most_bad)
    return one.select("n", "n_good", "n_bad", F.round(g, 6).alias("good_rate"), F.round(b, 6).alias("bad_rate"), F.when(ok, "pass").otherwise("halt").alias("decision"))
