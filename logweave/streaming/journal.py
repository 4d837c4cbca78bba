"""Work items as an append-only journal of transitions.

A transition says that an item goes to a status. The state of an item is the fold of its transitions in order; one
that the present status doesn't allow is refused and changes nothing, so a late or repeated message does no harm.

The fold is that of a finite automaton: a run of transitions is a map from every status before it to the status after it, with the
last accepted transition and how many were accepted. Such maps compose, so an item with very many
transitions is folded in runs of ``RUN`` sequence numbers, each a group of its own, and then over the runs' maps.

:class:`Journal` keeps the transitions in a :class:`~logweave.sources.commits.Committed` table. A claim marks items as
submitted with the name of their batch and a lease, and is committed before any work is asked for; what a
batch answers is committed at once. After a crash :meth:`Journal.recover` settles what was in flight before new work is begun.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.sources.commits import Committed

#: The statuses of an item, and from which ones each can be reached.
ALLOWED = {
    "pending": ("", "submitted"),
    "submitted": ("pending",),
    "committed": ("submitted",),
    "failed": ("submitted",),
    "leak_persistent": ("committed",),
    "judge_flagged_persistent": ("committed",),
    "written": ("committed",),
}
#: Sequence numbers that are folded together first.
RUN = 256
TRANSITION = "item_id string, seq long, status string, iteration int, batch_id string, lease_until long, error string"


def folded(transitions: DataFrame, allowed: Mapping[str, Sequence[str]] | None = None, keys: Sequence[str] = ("item_id",)) -> DataFrame:
    """keys, status ("" if none was accepted), last_seq, accepted, refused: the state of every item. Of equal numbers the lesser status goes first; null statuses and numbers are refused."""
    allowed = ALLOWED if allowed is None else allowed
    names = ["", *allowed]
    code, sources = F.lit(0), F.lit(0)
    for k, (name, before) in enumerate(allowed.items(), 1):
        code = F.when(F.col("status") == name, k).otherwise(code)
        sources = F.when(F.col("status") == name, sum(1 << names.index(b) for b in before)).otherwise(sources)
    step = F.struct("seq", "status", code.alias("to"), sources.alias("sources"))
    runs = transitions.groupBy(*keys, F.floor(F.col("seq") / RUN).alias("run")).agg(F.array_sort(F.collect_list(step)).alias("steps"), F.count("*").alias("n"))

    def after(old: Column, x: Column) -> Column:
        there = F.get(F.array(*[F.lit(1 << k) for k in range(len(names))]), old["to"])
        goes = x["seq"].isNotNull() & (x["sources"].bitwiseAND(there) != 0)
        return F.when(goes, entry(x["to"], x["seq"], old["accepted"] + 1)).otherwise(old)

    def entry(to: Column, seq: Column, accepted: Column) -> Column:
        return F.struct(to.cast("int").alias("to"), seq.cast("long").alias("seq"), accepted.cast("long").alias("accepted"))

    same = F.array(*[entry(F.lit(k), F.lit(None), F.lit(0)) for k in range(len(names))])
    maps = runs.select(*keys, "run", "n", F.aggregate("steps", same, lambda acc, x: F.transform(acc, lambda old: after(old, x))).alias("map"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("run", F.lit(-1)).alias("run"), "map"))), lambda x: x["map"])
    items = maps.groupBy(*keys).agg(ordered.alias("maps"), F.sum("n").alias("n"))

    def then(state: Column, m: Column) -> Column:
        x = F.get(m, state["to"])
        return entry(x["to"], F.coalesce(x["seq"], state["seq"]), state["accepted"] + x["accepted"])

    end = F.aggregate("maps", entry(F.lit(0), F.lit(None), F.lit(0)), then)
    return items.withColumn("end", end).select(
        *keys, F.get(F.array(*map(F.lit, names)), F.col("end.to")).alias("status"), F.col("end.seq").alias("last_seq"), F.col("end.accepted").alias("accepted"), (F.col("n") - F.col("end.accepted")).alias("refused")
    )


class Journal:
    """``respond`` below gets items (item_id, iteration, batch_id) and returns (item_id, status, error): "committed", "failed", or "pending" for one more round."""

    def __init__(self, spark: SparkSession, path: str, lease_seconds: int = 3600) -> None:
        self.spark, self.lease_seconds = spark, lease_seconds
        self.table = Committed(spark, path)

    def state(self) -> DataFrame:
        """item_id, status, iteration, batch_id, lease_until, error, accepted, refused."""
        t = self.table.read()
        end = folded(t)
        rows = t.join(end.select("item_id", F.col("last_seq").alias("seq"), "status", "accepted", "refused"), ["item_id", "seq", "status"])
        rows = rows.dropDuplicates(["item_id"])  # one that was written twice under one number
        return rows.select("item_id", "status", "iteration", "batch_id", "lease_until", "error", "accepted", "refused")

    def add(self, moves: DataFrame) -> bool:
        """Commits moves (item_id, status, iteration, batch_id, lease_until, error) under the next number. False if another driver was first: read the state again."""
        number = self.table.last_number("journal") + 1
        columns = [F.lit(number).cast("long").alias("seq") if c == "seq" else F.col(c).cast(t) for c, t in (x.split() for x in TRANSITION.split(", "))]
        return self.table.append(moves.select(*columns), "journal", number)

    def open(self, items: DataFrame) -> bool:
        """Makes items (item_id) pending that the journal doesn't have."""
        items = items.select(F.col("item_id").cast("string")).where("item_id is not null").distinct()
        if self.table.versions():
            items = items.join(self.table.read().select("item_id"), "item_id", "left_anti")
        return self.add(moved(items, "pending", iteration=F.lit(0)))

    def claim(self, batch_id: str, now: int) -> DataFrame:
        """Submits all pending items in one batch, with a lease; returns them as the journal has them."""
        pending = self.state().where("status = 'pending'")
        if not self.add(moved(pending, "submitted", batch_id=F.lit(batch_id), lease_until=F.lit(now + self.lease_seconds))):
            return pending.limit(0)
        return self.batch(batch_id)

    def batch(self, batch_id: str) -> DataFrame:
        return self.state().where((F.col("status") == "submitted") & (F.col("batch_id") == batch_id)).select("item_id", "iteration", "batch_id")

    def settle(self, items: DataFrame, answers: DataFrame) -> bool:
        """Commits the answers (item_id, status, error) to submitted items; one without an answer has failed. The least of several counts."""
        got = answers.groupBy(F.col("item_id").cast("string").alias("item_id")).agg(F.min(F.struct("status", "error")).alias("got"))
        j = items.join(got, "item_id", "left")
        again = F.col("got.status") == "pending"
        error = F.when(F.col("got").isNull(), "no answer").otherwise(F.col("got.error"))
        return self.add(moved(j, F.coalesce("got.status", F.lit("failed")), iteration=F.col("iteration") + F.coalesce(again, F.lit(False)).cast("int"), error=error))

    def recover(self, now: int, answers: Callable[[DataFrame], DataFrame]) -> int:
        """Settles what earlier drivers left in flight; returns how many items that were. Leases that run are left alone.

        ``answers`` gets the batches (batch_id) and returns what is known of them (batch_id, item_id, status, error). A batch that has answers is settled by
        them; one without any goes back to pending; items submitted without a batch can't be found again and fail.
        """
        late = self.state().where((F.col("status") == "submitted") & (F.coalesce("lease_until", F.lit(0)) <= now))
        n = late.count()
        if not n:
            return 0
        known = answers(late.where("batch_id is not null").select("batch_id").distinct())
        told = known.select("batch_id").distinct().withColumn("told", F.lit(True))
        got = known.groupBy("batch_id", F.col("item_id").cast("string").alias("item_id")).agg(F.min(F.struct("status", "error")).alias("got"))
        j = late.join(told, "batch_id", "left").join(got, ["batch_id", "item_id"], "left")
        lost, orphan = F.col("told").isNull(), F.col("batch_id").isNull()
        status = F.when(orphan, "failed").when(lost, "pending").otherwise(F.coalesce("got.status", F.lit("failed")))
        error = F.when(orphan, "submitted without a batch").when(lost, F.lit(None).cast("string")).when(F.col("got").isNull(), "no answer").otherwise(F.col("got.error"))
        more = (~orphan & ~lost & (F.coalesce("got.status", F.lit("")) == "pending")).cast("int")
        self.add(moved(j, status, iteration=F.col("iteration") + more, error=error))
        return n

    def run(self, respond: Callable[[DataFrame], DataFrame], cycles: int, name: str, clock: Callable[[], int]) -> DataFrame:
        """Up to ``cycles`` rounds over all pending items, each in one batch; then those still pending fail. Returns the state."""
        for cycle in range(cycles):
            if self.state().where("status = 'pending'").isEmpty():
                break
            batch = f"{name}-{cycle}"
            items = self.claim(batch, clock())
            self.settle(items, respond(items))
        left = self.state().where("status = 'pending'")
        if not left.isEmpty():
            batch = f"{name}-over"
            self.claim(batch, clock())
            self.settle(self.batch(batch), left.select("item_id", F.lit("failed").alias("status"), F.lit("out of rounds").alias("error")))
        return self.state()


def moved(items: DataFrame, status: Column | str, **changes: Column) -> DataFrame:
    """Items with a new status; what isn't told is kept (iteration, batch_id) or null (lease_until, error)."""
    kept = {c: F.col(c) if c in items.columns else F.lit(None) for c in ("iteration", "batch_id")}
    new = kept | {"lease_until": F.lit(None), "error": F.lit(None)} | changes
    return items.select("item_id", (F.lit(status) if isinstance(status, str) else status).alias("status"), *[v.alias(k) for k, v in new.items()])
