import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logweave.operators import sequence

START = datetime(2024, 1, 1)


def greedy(times, gap, ceiling):
    out, last, size, session = [], None, 0, 0
    for t in times:
        if last is None or t - last > gap or size == ceiling:
            session, size = session + 1, 0
        size, last = size + 1, t
        out.append(session)
    return out


def test_sessionize_equals_greedy_loop(spark):
    rng, rows, want = random.Random(1), [], {}
    for user in range(20):
        t, times = 0, []
        for _ in range(rng.randint(1, 40)):
            t += rng.choice([1, 60, 1799, 1800, 1801, 4000])
            times.append(t)
        for k, s in zip(range(len(times)), greedy(times, 1800, 3), strict=True):
            rows.append((user, user * 1000 + k, START + timedelta(seconds=times[k])))
            want[user * 1000 + k] = s
    df = spark.createDataFrame(rows, "u int, id int, ts timestamp")
    got = sequence.sessionize(df, ["u"], "ts", "id", 1800, 3).collect()
    assert {r["id"]: r["session"] for r in got} == want


def test_gap_boundary_and_ceiling(spark):
    df = spark.createDataFrame([("a", k, START + timedelta(seconds=s)) for k, s in enumerate((0, 1800, 3601))] + [("b", k, START + timedelta(seconds=60 * k)) for k in range(7)], "u string, id int, ts timestamp")
    got = sequence.sessionize(df, ["u"], "ts", "id", 1800, 3).groupBy("u", "session").count().collect()
    assert sorted((r["u"], r["session"], r["count"]) for r in got) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 3), ("b", 2, 3), ("b", 3, 1)]


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([], "u string, id int, ts timestamp")
    assert sequence.sessionize(df, ["u"], "ts", "id", 10, 3).count() == 0
    df = spark.createDataFrame([(None, 1, None), (None, 2, START)], "u string, id int, ts timestamp")
    assert [r["session"] for r in sequence.sessionize(df, ["u"], "ts", "id", 10, 3).orderBy("id").collect()] == [1, 1]


def test_forward_fill_is_strictly_before(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "p int, v string").withColumn("k", F.lit(1))
    got = df.select("p", sequence.forward_fill_prior(F.col("v"), F.lit("seed"), ["k"], ["p"]).alias("f")).orderBy("p").collect()
    assert [r["f"] for r in got] == ["seed", "a", "a", "b"]


def test_stint_and_scope(spark):
    df = spark.createDataFrame([(1, "x"), (2, "reset"), (3, "y"), (4, "end"), (5, "y")], "p int, v string").withColumn("k", F.lit(1))
    df = df.withColumn("stint", sequence.stint(F.col("v") == "reset", ["k"], ["p"]))
    got = df.select("p", "stint", sequence.last_since_reset(F.when(F.col("v") == "y", F.col("p")), ["k"], ["p"], "stint").alias("l"), sequence.start_end_value(F.col("v") == "x", F.col("v") == "end", F.col("v"), ["k"], ["p"]).alias("s")).orderBy("p").collect()
    assert [r["stint"] for r in got] == [0, 1, 1, 1, 1]
    assert [r["l"] for r in got] == [None, None, 3, 3, 5]
    assert [r["s"] for r in got] == ["x", "x", "x", None, None]


def test_side_effects_follow_their_move(spark):
    df = spark.createDataFrame([(1, "move"), (2, "side"), (3, "hit"), (4, "move"), (5, "hit")], "p int, v string").withColumn("k", F.lit(1))
    got = sequence.side_effects_last(df, ["k"], "p", F.col("v") == "move", F.col("v") == "side").orderBy("new_pos").collect()
    assert [r["p"] for r in got] == [1, 3, 2, 4, 5]


def test_same_rows_for_any_partitioning(spark):
    rows = [(k % 5, k, START + timedelta(seconds=(k * 7919) % 5000)) for k in range(200)]
    df = spark.createDataFrame(rows, "u int, id int, ts timestamp")
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, sequence.sessionize(df.repartition(int(n)), ["u"], "ts", "id", 100, 3).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]
