"""Streaming counterparts: sessions with a gap and a ceiling, resumable sinks, a work-item loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logweave.sources.shared import Store

SESSION = "key string, session long, first_id long, n int, first_ts timestamp, last_ts timestamp"


def sessions(stream: DataFrame, gap_seconds: int, ceiling: int, lateness: str = "10 minutes") -> DataFrame:
    """Closed sessions of a stream (key, id, ts): more than the gap, or ``ceiling`` rows. Rows later than the watermark are dropped by it.

    State per key is its open session and the rows that the watermark hasn't passed, so a row is
    placed in order however the batches cut the stream; a timer closes what goes quiet.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session, first_id, n, first, last, waiting = state.get if state.exists else (0, -1, 0, None, None, [])
        rows = list(waiting)
        for b in batches:
            rows += list(zip((t.value // 1000 for t in b["ts"]), b["id"], strict=True))
        mark = state.getCurrentWatermarkMs() * 1000
        ready = sorted(r for r in rows if r[0] <= mark)
        waiting = [(int(t), int(i)) for t, i in rows if t > mark]
        closed = []

        def close() -> None:
            closed.append((str(key[0]), session, first_id, n, pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us")))

        for t, i in ready:
            if n and (t - last > gap_seconds * 1_000_000 or n == ceiling):
                close()
                n = 0
            if not n:
                session, first_id, first = session + 1, int(i), int(t)
            n, last = n + 1, int(t)
        if n and not waiting and mark - last > gap_seconds * 1_000_000:
            close()
            n, last = 0, None
        state.update((session, first_id, n, first, last, waiting))
        if n or waiting:
            soonest = min([w[0] for w in waiting], default=None)
            due = soonest if soonest is not None else last + gap_seconds * 1_000_000 + 1
            state.setTimeoutTimestamp(max(due // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if closed:
            yield pd.DataFrame(closed, columns=[c.split()[0] for c in SESSION.split(", ")])

    kept = "session long, first_id long, n int, first long, last long, waiting array<struct<t: long, i: long>>"
    marked = stream.select(F.col("key").cast("string").alias("key"), "id", "ts").withWatermark("ts", lateness)
    return marked.groupBy("key").applyInPandasWithState(step, SESSION, kept, "append", GroupStateTimeout.EventTimeTimeout)


def windowed_counts(stream: DataFrame, width: str, lateness: str, keys: list[str]) -> DataFrame:
    """Rows by event-time window and keys, once the watermark has passed the window."""
    return stream.withWatermark("ts", lateness).groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("n")).select("window.start", *keys, "n")


def once_by_key(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: rows whose key the table at the path hasn't yet; a repeated batch writes nothing new. It reads the table's keys in each batch; where batches repeat only as a whole, ``Committed.sink`` doesn't."""

    def write(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates(keys)
        if Store(batch.sparkSession, path).names(""):
            new = new.join(batch.sparkSession.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
        new.write.mode("append").parquet(path)

    return write


def run_items(items: DataFrame, respond: Callable[[DataFrame], DataFrame], cycles: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Work items (item_id, status, iteration) through bounded cycles: all pending ones in one bulk call each.

    ``respond`` gets the pending items and returns (item_id, status); items it doesn't return fail.
    ``keep`` stores a table between cycles. Items still pending at the end fail.
    """
    for cycle in range(cycles):
        pending = items.where("status = 'pending'")
        if pending.isEmpty():
            break
        got = respond(pending).select("item_id", F.col("status").alias("__new"))
        j = items.join(got, "item_id", "left")
        status = F.when(F.col("status") != "pending", F.col("status")).otherwise(F.coalesce("__new", F.lit("failed")))
        turn = F.col("iteration") + (F.col("status") == "pending").cast("int")
        items = keep(j.select(*[c for c in items.columns if c not in ("status", "iteration")], status.alias("status"), turn.alias("iteration")), f"cycle-{cycle}")
    return items.withColumn("status", F.when(F.col("status") == "pending", "failed").otherwise(F.col("status")))
