"""Streams on the state API against the batch operator: any order within the lateness, restarts from the checkpoint."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logweave.operators import sequence
from logweave.sources.commits import Committed
from logweave.streaming import stateful

START = datetime(2024, 1, 1)
SCHEMA = "key int, id long, ts timestamp"


def put(spark, folder, k, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    for f in (folder / "in").glob("part*.parquet"):
        f.rename(folder / "in" / f"x{k}-{f.name[5:]}")


def run(spark, folder, name="s"):
    """All files that are there, one in a micro-batch; sessions are committed by batch."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    table = Committed(spark, str(folder / "out"))
    with stateful.on_rocksdb(spark):
        q = stateful.sessions(stream, 1800, 3, "2 hours", 900).writeStream.foreachBatch(table.sink(name)).outputMode("append").option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return table


def test_shuffled_batches_and_a_restart_equal_the_batch_operator(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for key in (1, 2, None):
        at = 0
        for k in range(40):
            at += rng.choice([0, 5, 60, 900, 1799, 1800, 1801, 5000])
            rows.append((key, (key or 7) * 1000 + k, START + timedelta(seconds=at)))
    # each row comes up to two files late
    late = [(min(int((r[2] - START).total_seconds() // 3600) + rng.randint(0, 1), 19), r) for r in rows]
    files = [[r for k, r in late if k == n] for n in range(20)]
    for k, part in enumerate(files[:8]):
        if part:
            put(spark, tmp_path, k, part)
    run(spark, tmp_path)
    for k, part in enumerate(files[8:], 8):
        if part:
            put(spark, tmp_path, k, part)
    put(spark, tmp_path, 90, [(99, 1, START + timedelta(days=30)), (99, 2, None)])
    put(spark, tmp_path, 91, [(99, 3, START + timedelta(days=60)), (1, 4, START)])  # the last is too late
    table = run(spark, tmp_path)
    got = [(r["key"], r["session"], r["first_id"], r["n"], r["first_ts"], r["last_ts"]) for r in table.read().where("key IS NULL OR key <> '99'").collect()]
    batch = sequence.sessionize(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "id", 1800, 3)
    want = batch.groupBy("key", "session").agg(F.min_by("id", F.struct("ts", "id")).alias("first_id"), F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    assert sorted(got, key=repr) == sorted(((None if r["key"] is None else str(r["key"]), r["session"], r["first_id"], r["n"], r["a"], r["b"]) for r in want), key=repr)
    assert table.last_number("s") > 5


class Counted:
    """Stands in for the handle and its states, and counts their calls."""

    def __init__(self):
        self.calls, self.value, self.slots, self.timers = 0, None, {}, set()

    def __getattr__(self, name):
        def call(*x):
            self.calls += 1
            return {"get": lambda: self.value, "update": lambda v: setattr(self, "value", v), "getValue": lambda k: self.slots.get(k), "updateValue": self.slots.__setitem__, "keys": lambda: [*self.slots], "removeKey": self.slots.pop, "registerTimer": self.timers.add, "getValueState": lambda *_: self, "getMapState": lambda *_: self}[name](*x)

        return call


class At:
    def __init__(self, at):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at


def test_calls_to_the_state_do_not_grow_with_the_keys():
    s, h = stateful.Sessions(1800, 3, 900), Counted()
    s.init(h)
    rows = [(0, f"k{k}", 10 * k + j, j * 1_000_000, None) for k in range(500) for j in range(4)]
    assert not [*s.handleInputRows((0,), iter(rows), At(0))]
    closed = [x for at in (900_000, 10_000_000) for due in sorted(t for t in h.timers if t <= at) for x in s.handleExpiredTimer((0,), At(at), At(due))]
    assert sorted((x["key"], x["session"], x["first_id"], x["n"]) for x in closed) == sorted((f"k{k}", *x) for k in range(500) for x in ((1, 10 * k, 3), (2, 10 * k + 3, 1)))
    assert h.calls < 40 and not h.slots
