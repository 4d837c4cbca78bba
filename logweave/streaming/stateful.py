"""Sessions with a gap and a ceiling on Spark's state API: rows wait in a map of time slots, and timers bring them on.

Keys share hash buckets, since every call to the state costs about as much as some hundred rows. State of a bucket is one value, its keys'
open sessions, and a map from time slot to the rows of that slot that wait for the watermark. A micro-batch touches only the slots that it
has rows for; when the watermark passes the end of a slot, a timer takes that slot's rows, in order, and removes it. So what a batch
reads and writes doesn't grow with what waits, and a row is placed in order however the stream is cut into batches. A bucket has one timer
that counts: for its next slot, or to close a session that has gone quiet.

Needs the RocksDB state store (:func:`on_rocksdb`). Rows later than the watermark, and rows without a time, are dropped; a null key is a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SESSION = "key string, session long, first_id long, n int, first_ts timestamp, last_ts timestamp"
_MICROS = SESSION.replace("timestamp", "long")
CLOSED = Row(*[c.split()[0] for c in SESSION.split(", ")])
#: State of a new bucket: no keys, no timer.
NONE = ((), (), (), (), (), (), 0)
PROVIDER, PARTITIONS = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"


@contextmanager
def on_rocksdb(spark: SparkSession, rows: int | None = None) -> Iterator[None]:
    """Streams that are started within use the RocksDB state store; those of few ``rows`` in fewer partitions, since each costs a worker and a commit in every micro-batch."""
    conf = {PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    if rows is not None:
        conf[PARTITIONS] = str(min(int(spark.conf.get(PARTITIONS)), max(spark.sparkContext.defaultParallelism, rows // 100_000)))
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Sessions(StatefulProcessor):
    """Times are microseconds, slots and timers milliseconds."""

    def __init__(self, gap_seconds: int, ceiling: int, slot_seconds: int) -> None:
        self.gap, self.ceiling, self.slot = gap_seconds * 1_000_000, ceiling, slot_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # an entry for each key that has had rows; due: the bucket's timer, 0 if none
        self.open = handle.getValueState("open", "key array<string>, session array<long>, first_id array<long>, n array<int>, first array<long>, last array<long>, due long")
        self.waiting = handle.getMapState("waiting", "slot long", "ts array<long>, id array<long>, key array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        mark, came = timerValues.getCurrentWatermarkInMs(), {}
        for _, k, i, us, _ in rows:
            if us is not None and (us // 1000 // self.slot + 1) * self.slot > mark:
                came.setdefault(us // 1000 // self.slot, []).append((us, i, k))
        for slot, part in came.items():
            was = self.waiting.getValue((slot,)) or ((), (), ())
            self.waiting.updateValue((slot,), tuple([*x, *y] for x, y in zip(was, zip(*part, strict=True), strict=True)))
        if came:
            *kept, due = self.open.get() or NONE
            end = (min(came) + 1) * self.slot
            if not due or end < due:
                self.handle.registerTimer(end)
                self.open.update((*kept, end))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()  # may have passed more than this timer
        *kept, due = self.open.get() or NONE
        if due != expiredTimerInfo.getExpiryTimeInMs():
            return  # an earlier one took its place
        found = {k: list(x) for k, *x in zip(*kept, strict=True)}
        slots = sorted(s for (s,) in self.waiting.keys())
        later = [s for s in slots if (s + 1) * self.slot > now]
        for slot in [s for s in slots if (s + 1) * self.slot <= now]:
            for t, i, k in sorted(zip(*self.waiting.getValue((slot,)), strict=True), key=lambda r: r[:2]):
                x = found.setdefault(k, [0, -1, 0, 0, 0])
                session, first_id, n, first, last = x
                if n and (t - last > self.gap or n == self.ceiling):
                    yield CLOSED(k, *x)
                    n = 0
                if not n:
                    session, first_id, first = session + 1, i, t
                x[:] = session, first_id, n + 1, first, t
            self.waiting.removeKey((slot,))
        due = [(s + 1) * self.slot for s in later]
        for k, x in found.items():
            quiet = (x[4] + self.gap) // 1000 + 1
            if x[2] and now < quiet:
                due.append(quiet)
            elif x[2] and not any(s * self.slot <= quiet for s in later[:1]):  # such a slot may go on with the session
                yield CLOSED(k, *x)
                x[2] = 0
        due = min(due, default=0)
        if due:
            self.handle.registerTimer(due)
        self.open.update(([*found], *map(list, zip(*found.values(), strict=True)), due))

    def close(self) -> None:
        pass


def sessions(stream: DataFrame, gap_seconds: int, ceiling: int, lateness: str = "10 minutes", slot_seconds: int = 600, buckets: int = 1024) -> DataFrame:
    """Closed sessions of a stream (key, id, ts): more than the gap, or ``ceiling`` rows. Equal times go by id. ``buckets`` may not change between restarts."""
    # times go in and out as numbers, whatever the session's time zone
    marked = stream.select(F.col("key").cast("string").alias("key"), F.col("id").cast("long").alias("id"), F.unix_micros("ts").alias("us"), "ts").withWatermark("ts", lateness)
    marked = marked.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "*")
    out = marked.groupBy("bucket").transformWithState(Sessions(gap_seconds, ceiling, slot_seconds), _MICROS, "append", "eventTime")
    return out.select("key", "session", "first_id", "n", F.timestamp_micros("first_ts").alias("first_ts"), F.timestamp_micros("last_ts").alias("last_ts"))
