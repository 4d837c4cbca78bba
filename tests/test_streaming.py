from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logweave.operators import sequence
from logweave.streaming import sessions

START = datetime(2024, 1, 1)


def test_streamed_sessions_equal_batch(spark, tmp_path):
    rows = [(u, u * 100 + k, START + timedelta(seconds=t)) for u, times in ((1, (0, 100, 2000, 2001, 2002, 2003, 9000)), (2, (50, 60))) for k, t in enumerate(times)]
    end = [(9, 999, START + timedelta(days=3))]
    for k, part in enumerate((rows[:4] + rows[7:], rows[4:7], end, [(9, 1000, START + timedelta(days=9))])):
        spark.createDataFrame(part, "key int, id long, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in (tmp_path / "in").glob("part*.parquet"):
            f.rename(tmp_path / "in" / f"x{k}-{f.name[5:]}")
    stream = spark.readStream.schema("key int, id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = sessions.sessions(stream, 1800, 3).writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["key"], r["session"], r["first_id"], r["n"]) for r in spark.table("closed").where("key in ('1', '2')").collect())
    batch = sequence.sessionize(spark.createDataFrame(rows, "key int, id long, ts timestamp"), ["key"], "ts", "id", 1800, 3)
    want = batch.groupBy("key", "session").agg(F.min("id").alias("first"), F.count("*").alias("n")).collect()
    assert got == sorted((str(r["key"]), r["session"], r["first"], r["n"]) for r in want)


def test_sink_writes_each_key_once(spark, tmp_path):
    write = sessions.once_by_key(str(tmp_path / "out"), ["k"])
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    for batch in (a, a, spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")):
        write(batch, 0)
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "x"), (2, "y"), (3, "w")]


def test_work_items(spark, tmp_path):
    items = spark.createDataFrame([(k, "pending", 0) for k in range(6)] + [(9, "committed", 2)], "item_id int, status string, iteration int")

    def respond(p):
        done = F.when(F.col("iteration") >= F.col("item_id") % 3, "committed").otherwise("pending")
        return p.where("item_id <> 5").select("item_id", done.alias("status"))

    def keep(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    got = {r["item_id"]: (r["status"], r["iteration"]) for r in sessions.run_items(items, respond, 2, keep).collect()}
    assert got == {0: ("committed", 1), 1: ("committed", 2), 2: ("failed", 2), 3: ("committed", 1), 4: ("committed", 2), 5: ("failed", 1), 9: ("committed", 2)}
