"""A bounded repair loop by group: judge, redo what was flagged, judge again only what has changed.

Rows belong to groups, and a verdict looks at a whole group. Each round redoes the flagged rows alone, and only groups with a row that
was redone are judged again; what passed is neither redone nor judged any more. Rows and verdicts
live in committed tables, each round as a delta (the groups that changed), so a round that was committed isn't repeated after a
crash: the loop goes on where the tables are. After the last round rows still flagged are left out, or with ``whole_groups`` their groups.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.sources.commits import Committed


class Repair:
    """``judge`` gets whole groups and returns (key columns, reason) of the rows that don't pass; ``redo`` gets those rows, with reason, and returns rows of the same columns.

    ``group`` and ``pos`` name a row, and the pair is unique. A row that ``redo`` doesn't return stays as it was; null groups and positions are values like others.
    """

    def __init__(self, spark: SparkSession, path: str, group: str, pos: str, judge: Callable[[DataFrame], DataFrame], redo: Callable[[DataFrame], DataFrame]) -> None:
        self.group, self.pos, self.judge, self.redo = group, pos, judge, redo
        self.rows, self.verdicts = Committed(spark, f"{path}/rows", group), Committed(spark, f"{path}/verdicts")

    def same(self, a: str, b: str, *columns: str) -> Column:
        """Rows of two aliased tables that agree in the columns."""
        return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns or (self.group, self.pos)])

    def flagged(self, number: int) -> DataFrame:
        """What the round's verdict was: group, pos, reason."""
        return self.verdicts.read().where(F.col("round") == number).drop("round")

    def _judged(self, rows: DataFrame, number: int) -> None:
        v = self.judge(rows).groupBy(self.group, self.pos).agg(F.min("reason").alias("reason"))
        self.verdicts.append(v.withColumn("round", F.lit(number)), "judge", number)

    def run(self, rows: DataFrame, rounds: int) -> int:
        """Runs up to ``rounds`` rounds; returns how many were needed."""
        self.rows.append(rows, "loop", 0)
        self._judged(self.rows.read(), 0)
        for number in range(1, rounds + 1):
            bad = self.flagged(number - 1)
            if bad.isEmpty():
                return number - 1
            if self.rows.last_number("loop") < number:
                old = self._group_of(self.rows.read(), bad)
                todo = old.alias("r").join(bad.alias("b"), self.same("r", "b")).select("r.*", "b.reason")
                new = self.redo(todo).select(*old.columns)
                left = old.alias("r").join(new.alias("n"), self.same("r", "n"), "left_anti")
                self.rows.replace(left.unionByName(new), "loop", number)
            self._judged(self._group_of(self.rows.read(), bad), number)
        return rounds

    def _group_of(self, rows: DataFrame, bad: DataFrame) -> DataFrame:
        """The whole groups of some rows."""
        return rows.alias("r").join(bad.alias("b"), self.same("r", "b", self.group), "left_semi")

    def result(self, whole_groups: bool = False) -> DataFrame:
        """The rows, without those that the last verdict still flags."""
        rows, bad = self.rows.read().alias("r"), self.flagged(self.verdicts.last_number("judge")).alias("b")
        return rows.join(bad, self.same("r", "b", self.group) if whole_groups else self.same("r", "b"), "left_anti")
