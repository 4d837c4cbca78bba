"""Commits, the routed sink and the journal: what is seen after crashes, retries, races and repeated messages."""

import json
import random

import pytest
from pyspark.sql import functions as F

from logweave.sources import routed
from logweave.sources.commits import Committed
from logweave.streaming import journal as j
from logweave.streaming import repair


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "g string, v int")


def test_a_number_is_committed_once(spark, tmp_path):
    t = Committed(spark, str(tmp_path / "t"))
    assert t.append(frame(spark, ("a", 1)), "w", 0) and not t.append(frame(spark, ("a", 9)), "w", 0)
    assert t.append(frame(spark, ("b", 2)), "other", 0) and t.append(frame(spark, ("a", 1)), "w", 5) and not t.append(frame(spark, ("c", 3)), "w", 4)
    assert rows(t.read()) == [("a", 1), ("a", 1), ("b", 2)] and rows(t.read(1)) == [("a", 1)]
    with pytest.raises(ValueError, match="the table has"):
        t.append(spark.range(1), "w", 6)
    with pytest.raises(ValueError, match="no group"):
        t.replace(frame(spark), "w", 6)
    with pytest.raises(ValueError, match="nothing"):
        Committed(spark, str(tmp_path / "none")).read()


def test_a_crash_before_the_swap_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    t = Committed(spark, str(tmp_path / "t"), "g")
    t.append(frame(spark, ("a", 1)), "w", 0)

    def crash(self, manifest):
        raise RuntimeError("lost")

    monkeypatch.setattr(Committed, "_swap", crash)
    with pytest.raises(RuntimeError):
        t.replace(frame(spark, ("a", 2)), "w", 1)
    monkeypatch.undo()
    assert rows(t.read()) == [("a", 1)] and len(list((tmp_path / "t" / "data").glob("part=*"))) == 2
    assert t.vacuum(3600) == 0 and t.vacuum(0) == 1
    assert t.replace(frame(spark, ("a", 2)), "w", 1) and rows(t.read()) == [("a", 2)]
    assert len(list((tmp_path / "t" / "data").glob("part=*"))) == 2


def test_of_two_writers_one_is_first_and_the_other_follows(spark, tmp_path, monkeypatch):
    t, u = Committed(spark, str(tmp_path / "t")), Committed(spark, str(tmp_path / "t"))
    t.append(frame(spark, ("a", 1)), "w", 0)
    swap, races = Committed._swap, []

    def late(self, manifest):
        if not races:
            races.append(1)
            assert u.append(frame(spark, ("u", 7)), "u", 0)
        return swap(self, manifest)

    monkeypatch.setattr(Committed, "_swap", late)
    assert t.append(frame(spark, ("b", 2)), "w", 1)
    assert rows(t.read()) == [("a", 1), ("b", 2), ("u", 7)] and t.versions() == [1, 2, 3]
    # of two with one name and number only the first counts
    races.clear()
    monkeypatch.setattr(Committed, "_swap", lambda self, m: (races or (races.append(1), u.append(frame(spark, ("x", 1)), "w", 2))) and swap(self, m))
    assert not t.append(frame(spark, ("y", 1)), "w", 2)
    assert rows(t.read().where("v = 1")) == [("a", 1), ("x", 1)]


def test_groups_are_replaced_whole(spark, tmp_path):
    t = Committed(spark, str(tmp_path / "t"), "g")
    t.append(frame(spark, ("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)), "w", 0)
    t.replace(frame(spark, ("a", 10), (None, 40)), "w", 1, groups=frame(spark, ("c", 0)))
    t.append(frame(spark, ("a", 11)), "w", 2)
    want = [("a", 10), ("a", 11), ("b", 3), (None, 40)]
    assert rows(t.read()) == sorted(want, key=repr)
    t.replace(frame(spark, ("a", 12)), "w", 3)
    t.replace(frame(spark, ("b", 30)), "w", 4)
    want = sorted([("a", 12), ("b", 30), (None, 40)], key=repr)
    assert rows(t.read()) == want
    assert t.compact() and rows(t.read()) == want and len(t.manifest()["parts"]) == 1
    assert not t.append(frame(spark, ("z", 0)), "w", 4) and t.vacuum(0) >= 5 and rows(t.read()) == want


def test_routed_sink(spark, tmp_path):
    spark.dataSource.register(routed.RoutedJson)
    path = str(tmp_path / "r")
    df = spark.createDataFrame([(k, f"t{k}", None if k == 5 else k % 3 > 0) for k in range(20)], "k long, t string, ok boolean").repartition(3)
    df.write.format("routed_json").mode("append").save(path)
    read = lambda route: sorted((r["k"], r["t"]) for r in spark.read.format("routed_json").option("route", route).schema("k long, t string, more int").load(path).collect())
    dead = [k for k in range(20) if k % 3 == 0 or k == 5]
    assert [k for k, _ in read("dead")] == dead and [k for k, _ in read("good")] == [k for k in range(20) if k not in dead]
    told = spark.read.format("routed_json").load(path)
    assert {r["route"]: r["n"] for r in told.groupBy("route").agg(F.sum("rows").alias("n")).collect()} == {"good": 20 - len(dead), "dead": len(dead)}
    # a job that fails in its last rows leaves no file and nothing to see
    bad = df.withColumn("t", F.when(F.col("k") == 19, F.raise_error(F.lit("broken"))).otherwise(F.col("t")))
    before = sorted(p.name for p in (tmp_path / "r").rglob("*.jsonl"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("routed_json").mode("append").save(path)
    assert sorted(p.name for p in (tmp_path / "r").rglob("*.jsonl")) == before and len(read("good")) == 20 - len(dead)
    df.where("k < 2").write.format("routed_json").mode("append").save(path)
    assert len(read("good")) + len(read("dead")) == 22
    df.where("k = 1").write.format("routed_json").mode("overwrite").save(path)
    assert read("good") == [(1, "t1")] and read("dead") == []
    assert all(json.loads(x) for p in (tmp_path / "r").rglob("*.jsonl") for x in p.read_text().splitlines())


def fold(moves):
    """By the table of moves, one after the other."""
    status, last, accepted = "", None, 0
    for seq, to in sorted(moves, key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or "")):
        if seq is not None and to in j.ALLOWED and status in j.ALLOWED[to]:
            status, last, accepted = to, seq, accepted + 1
    return status, last, accepted, len(moves) - accepted


def test_fold_against_a_loop(spark):
    rng = random.Random(2)
    names = [*j.ALLOWED, "nonsense", None]
    data = [(f"i{k % 7}", rng.choice([rng.randrange(5000), k * 3]), rng.choice(names[:3] * 4 + names)) for k in range(3000)] + [("i1", None, "pending"), (None, 3, "pending"), ("only nulls", None, None)]
    got = {r["item_id"]: (r["status"], r["last_seq"], r["accepted"], r["refused"]) for r in j.folded(spark.createDataFrame(data, "item_id string, seq long, status string").repartition(5)).collect()}
    want = {i: fold([(s, t) for k, s, t in data if k == i]) for i in {d[0] for d in data}}
    assert got == want and min(x[2] for x in got.values()) == 0 and max(x[2] for x in got.values()) > 5


def items(spark, n):
    return spark.createDataFrame([(str(k),) for k in range(n)], "item_id string")


def respond(p):
    """Done after as many rounds as the number's last digit modulo 3; multiples of five are never answered, 7 fails."""
    k = F.col("item_id").cast("int")
    status = F.when(k == 7, "failed").when(F.col("iteration") >= k % 3, "committed").otherwise("pending")
    return p.where(k % 5 != 0).select("item_id", status.alias("status"), F.when(k == 7, "bad").alias("error"))


WANT = {k: "failed" if k % 5 == 0 or k == 7 or k % 3 > 1 else "committed" for k in range(12)}


def test_rounds(spark, tmp_path):
    w = j.Journal(spark, str(tmp_path / "j"))
    assert w.open(items(spark, 9)) and w.open(items(spark, 12))
    got = {int(r["item_id"]): r for r in w.run(respond, 2, "run", lambda: 100).collect()}
    assert {k: r["status"] for k, r in got.items()} == WANT
    assert got[0]["error"] == "no answer" and got[7]["error"] == "bad" and got[2]["error"] == "out of rounds" and got[4]["iteration"] == 1
    assert all(r["refused"] == 0 for r in got.values())
    # late and repeated messages change nothing
    w.add(spark.createDataFrame([("3", "pending", 9, None, None, None), ("7", "written", 0, None, None, None)], "item_id string, status string, iteration int, batch_id string, lease_until long, error string"))
    again = {int(r["item_id"]): r for r in w.state().collect()}
    assert again[3]["status"] == "committed" and again[3]["refused"] == 1 and again[7]["status"] == "failed"


def test_a_driver_that_dies_is_followed_by_one_that_recovers(spark, tmp_path):
    path, answered = str(tmp_path / "j"), {}

    def dies(p):
        answered["run-0"] = [(r["batch_id"], r["item_id"], "committed", None) for r in p.collect() if r["item_id"] != "3"]
        raise KeyboardInterrupt

    w = j.Journal(spark, path, lease_seconds=60)
    w.open(items(spark, 6))
    with pytest.raises(KeyboardInterrupt):
        w.run(dies, 3, "run", lambda: 1000)
    w.add(spark.createDataFrame([("x", "pending", 0, None, None, None)], j.TRANSITION.replace("seq long, ", "")))
    w.add(spark.createDataFrame([("x", "submitted", 0, None, None, None)], j.TRANSITION.replace("seq long, ", "")))
    ask = lambda b: spark.createDataFrame([a for r in b.collect() for a in answered.get(r["batch_id"], [])], "batch_id string, item_id string, status string, error string")
    n = j.Journal(spark, path, lease_seconds=60)
    assert n.recover(1030, ask) == 1  # only the one without a lease; the others' lease runs
    assert n.recover(1061, ask) == 6 and n.recover(1061, ask) == 0
    got = {r["item_id"]: (r["status"], r["error"]) for r in n.state().collect()}
    assert got == {"3": ("failed", "no answer"), "x": ("failed", "submitted without a batch")} | {str(k): ("committed", None) for k in (0, 1, 2, 4, 5)}
    # a batch of which nothing is known goes back, and is done in the next run
    n.open(items(spark, 8))
    with pytest.raises(KeyboardInterrupt):
        n.run(lambda p: (_ for _ in ()).throw(KeyboardInterrupt), 3, "second", lambda: 2000)
    assert n.recover(3000, ask) == 2
    done = n.run(lambda p: p.select("item_id", F.lit("committed").alias("status"), F.lit(None).cast("string").alias("error")), 3, "third", lambda: 3000)
    assert {r["item_id"] for r in done.where("status = 'committed'").collect()} == {"0", "1", "2", "4", "5", "6", "7"}


def test_repair_redoes_and_judges_only_what_is_flagged(spark, tmp_path):
    data = [("a", k, 0) for k in range(3)] + [("b", k, k) for k in range(3)] + [(None, 0, 1), ("c", None, 2), ("d", 0, 9)]
    seen = {"judged": [], "redone": []}

    def judge(d):
        seen["judged"].append({r["g"] for r in d.collect()})
        return d.where("v > 0").select("g", "k", F.concat(F.lit("v"), F.col("v").cast("string")).alias("reason"))

    def redo(d):
        seen["redone"].append(sorted(((r["g"], r["k"], r["reason"]) for r in d.collect()), key=repr))
        return d.where("v < 9").withColumn("v", F.col("v") - 1)

    rows_ = spark.createDataFrame(data, "g string, k int, v int")
    loop = repair.Repair(spark, str(tmp_path / "r"), "g", "k", judge, redo)
    assert loop.run(rows_, 2) == 2
    assert seen["judged"] == [{"a", "b", "c", "d", None}, {"b", "c", "d", None}, {"b", "c", "d"}]
    assert seen["redone"][1] == [("b", 2, "v1"), ("c", None, "v1"), ("d", 0, "v9")]
    assert rows(loop.result()) == sorted([("a", k, 0) for k in range(3)] + [("b", k, 0) for k in range(3)] + [(None, 0, 0), ("c", None, 0)], key=repr)
    assert {r["g"] for r in loop.result(whole_groups=True).collect()} == {"a", "b", "c", None}
    # a second driver finds all rounds done
    again = repair.Repair(spark, str(tmp_path / "r"), "g", "k", judge, lambda d: 1 / 0)
    assert again.run(rows_, 2) == 2 and rows(again.result()) == rows(loop.result())
    assert repair.Repair(spark, str(tmp_path / "s"), "g", "k", lambda d: d.where("false").select("g", "k", F.lit("x").alias("reason")), redo).run(rows_, 5) == 0
