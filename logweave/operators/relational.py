"""Joins, aggregations and rankings with the defaults, ties and fallbacks spelled out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlay(base: DataFrame, over: DataFrame, on: Sequence[str], defaults: Mapping[str, Column]) -> DataFrame:
    """Left join; each column of ``defaults`` is the overlay's value, else the default."""
    joined = base.join(over.select(*on, *[F.col(c).alias(f"__{c}") for c in defaults]), list(on), "left")
    for c, value in defaults.items():
        joined = joined.withColumn(c, F.coalesce(f"__{c}", value)).drop(f"__{c}")
    return joined


def priority_merge(first: DataFrame, second: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Full outer join on a unique key: the whole record of ``first`` where it has one, else that of ``second``; with its source."""
    a = first.select(on, F.struct(*columns).alias("__a"))
    b = second.select(on, F.struct(*columns).alias("__b"))
    j = a.join(b, on, "full")
    won = F.coalesce("__a", "__b")
    return j.select(on, *[won[c].alias(c) for c in columns], F.when(F.col("__a").isNotNull(), "first").otherwise("second").alias("origin"))


def without(df: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Resume: the rows whose key has not been seen."""
    return df.join(seen.select(*on).distinct(), list(on), "left_anti")


def fallback_chain(df: DataFrame, on: Sequence[tuple[DataFrame, Sequence[str], str, str]], value: str, last: Column, last_name: str) -> DataFrame:
    """Looks ``value`` up in tables one after the other: (table, keys, column, name); adds value and source of the first that has it."""
    found, names = [], []
    for k, (table, keys, column, name) in enumerate(on):
        df = df.join(table.select(*keys, F.col(column).alias(f"__v{k}")), list(keys), "left")
        found.append(F.col(f"__v{k}"))
        names.append((F.col(f"__v{k}"), name))
    source = F.lit(last_name)
    for c, name in reversed(names):
        source = F.when(c.isNotNull(), name).otherwise(source)
    df = df.withColumn("source", source).withColumn(value, F.coalesce(*found, last))
    return df.drop(*[f"__v{k}" for k in range(len(on))])


def ordered_pairs(df: DataFrame, key: str, pos: str, side: str, columns: Sequence[str]) -> DataFrame:
    """Pairs within a key, earlier before later, of different sides: an equi join with a range condition."""
    a = df.select(key, *[F.col(c).alias(f"{c}_1") for c in (pos, side, *columns)])
    b = df.select(key, *[F.col(c).alias(f"{c}_2") for c in (pos, side, *columns)])
    return a.join(b, key).where((F.col(f"{pos}_1") < F.col(f"{pos}_2")) & (F.col(f"{side}_1") != F.col(f"{side}_2")))


def nearest_match(left: DataFrame, right: DataFrame, key: str, position: str, most: float, columns: Sequence[str], tiebreak: str) -> DataFrame:
    """For each left row the right row of the key with the least distance, at most ``most``; ties by the right tiebreak. Left rows without one stay, and so do repeated ones.

    Positions are cut into cells of width ``most``, so a row meets the rows of three cells, not of its whole key. Equal
    left rows are joined once and repeated at the end, as often as they were counted.
    """
    cell = F.floor(F.col(position) / F.lit(most)).cast("long")
    distinct = left.groupBy(*left.columns).agg(F.count("*").alias("__times"))
    lhs = distinct.withColumn("__row", F.struct(*left.columns, "__times")).withColumn("__cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    rhs = right.select(key, cell.alias("__cell"), F.col(position).alias("__p"), F.col(tiebreak).alias("__t"), *[F.col(c).alias(f"near_{c}") for c in columns])
    j = lhs.join(rhs, [key, "__cell"], "left").withColumn("__d", F.abs(F.col(position) - F.col("__p")))
    near = F.struct("__d", "__t", *[f"near_{c}" for c in columns])
    best = j.groupBy("__row").agg(F.min(F.when(F.col("__d") <= most, near)).alias("__best"))
    out = best.select("__row.*", *[F.col(f"__best.near_{c}").alias(f"near_{c}") for c in columns], F.col("__best.__d").alias("distance"))
    return out.withColumn("__times", F.explode(F.array_repeat(F.lit(1), F.col("__times").cast("int")))).drop("__times")


def top_n_share(df: DataFrame, group: str, item: str, weight: str, n: int) -> DataFrame:
    """The n heaviest items of each group with their percentage of the group's total; ties by item."""
    by = df.groupBy(group, item).agg(F.sum(weight).alias("weight"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("weight"), item))
    total = F.sum("weight").over(Window.partitionBy(group))
    return by.withColumn("share_pct", F.try_divide(F.col("weight") * 100, total)).withColumn("rank", rank.cast("long")).where(F.col("rank") <= n)


def examples_per_group(df: DataFrame, group: str, order: Sequence[Column | str], n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def majority(first: Column, second: Column, name_1: str, name_2: str) -> Column:
    """Aggregate: the name whose condition holds for more rows, null on a tie."""
    a, b = F.count_if(first), F.count_if(second)
    return F.when(a > b, name_1).when(b > a, name_2)


def first_non_null(value: Column, order: Column) -> Column:
    """Aggregate: the value of the earliest row that has one."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def ordered_distinct(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """``values``: the key's distinct values by first appearance. Pre-aggregated to one row for each value."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("__o"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", value))), lambda x: x[value]).alias("values"))


def padded(values: Column, n: int, filler: str) -> Column:
    """The first n values, filled up to n."""
    return F.slice(F.concat(F.slice(values, 1, n), F.array_repeat(F.lit(filler), n)), 1, n)


def singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once: an aggregation, not a window, since the group then is the row."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.any_value(c).alias(c) for c in rest]).where("__n = 1")
    return one.select(*df.columns)


def cost(amounts: Mapping[str, float | None], tokens: Column, price_of: Column) -> Column:
    """Amount times the price of its class per million; unknown classes cost nothing."""
    price = F.lit(0.0)
    for name, p in amounts.items():
        price = F.when(price_of == name, F.lit(p)).otherwise(price)
    return tokens * price / 1e6


def capped_histogram(df: DataFrame, value: str, cap: int) -> DataFrame:
    return df.groupBy(F.least(F.col(value), F.lit(cap)).alias("bucket")).agg(F.count("*").alias("n"))


def paired(calls: DataFrame, results: DataFrame, on: Sequence[str]) -> DataFrame:
    """Calls with their results; those without a partner stay, marked."""
    a, b = calls.withColumn("__c", F.lit(True)), results.withColumn("__r", F.lit(True))
    j = a.join(b, list(on), "full")
    status = F.when(F.col("__r").isNull(), "unanswered").when(F.col("__c").isNull(), "orphan").otherwise("paired")
    return j.withColumn("status", status).drop("__c", "__r")


def first_source(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """The row of each key from the first frame that has it."""
    columns = frames[0].columns
    all_ = None
    for k, f in enumerate(frames):
        part = f.select(*columns).withColumn("__order", F.lit(k))
        all_ = part if all_ is None else all_.unionByName(part)
    best = all_.groupBy(key).agg(F.min_by(F.struct(*columns), "__order").alias("__x"))
    return best.select("__x.*")


def source_trace(rows: DataFrame, states: DataFrame, on: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Rows with the state they came from and the one after it; joined on ids, so dropped states before it shift nothing."""
    w = Window.partitionBy(*[c for c in on if c != order]).orderBy(order)
    s = states.select(*on, F.struct(*columns).alias("state")).withColumn("next_state", F.lead("state").over(w))
    return rows.join(s, list(on), "left")


def routed_results(items: DataFrame, results: DataFrame, key: str, status: str) -> DataFrame:
    """Items with the status of their result; those without one failed."""
    return items.drop(status).join(results.select(key, status), key, "left").withColumn(status, F.coalesce(status, F.lit("failed")))


def counters(parts: DataFrame, column: str) -> DataFrame:
    """counter, n: sums of map-typed counters over all rows."""
    return parts.select(F.explode(column).alias("counter", "n")).groupBy("counter").agg(F.sum("n").alias("n"))


def profile(df: DataFrame, value: str) -> DataFrame:
    """One row: n, least, median (truncated), most."""
    return df.agg(F.count("*").alias("n"), F.min(value).alias("least"), F.floor(F.median(value)).cast("long").alias("median"), F.max(value).alias("most"))


def with_drop_reason(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and counts by the first reason that holds: nothing is dropped uncounted."""
    reason = F.lit(None).cast("string")
    for name, c in reversed(reasons.items()):
        reason = F.when(F.coalesce(c, F.lit(False)), name).otherwise(reason)
    marked = df.withColumn("drop_reason", reason)
    return marked.where("drop_reason IS NULL").drop("drop_reason"), marked.where("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count("*").alias("n"))
