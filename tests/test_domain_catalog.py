"""Queries without an SQL twin against plain loops, on the smallest tables."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from logweave.operators import textops
from logweave.plans import domain_catalog as d

SF = "/root/testdata/sf0.001"


def simulate(log):
    """(turn, slot): species, health, last move, revealed moves, seen species of the side; and the choices of p1's slots."""
    slots, seen, out, hits, pending = {}, defaultdict(list), {}, {}, []
    for line in log.split("\n"):
        tag, *args = line.split("|")[1:]
        m = re.match("p[12][abc]", args[0])
        slot = m[0] if m else None
        if tag == "turn":
            for s, st in slots.items():
                out[int(args[0]), s] = (st["species"], st["hp"], st["last"], ",".join(st["moves"]), ",".join(seen[s[:2]]))
            continue
        st = slots.setdefault(slot, {"species": None, "hp": 100.0, "last": None, "moves": []})
        if tag == "switch":
            name = args[1].split(",")[0]
            slots[slot] = {"species": name, "hp": 100.0, "last": None, "moves": []}
            if name not in seen[slot[:2]]:
                seen[slot[:2]].append(name)
        elif tag == "move":
            st["last"] = args[1]
            if args[1] not in st["moves"]:
                st["moves"].append(args[1])
        elif tag == "-damage":
            st["hp"] = float(args[1].split("/")[0])
    return out


def test_snapshots_against_a_loop(spark):
    logs = d.event_logs(spark, SF).collect()
    want = {(r["game_id"], *k): v for r in logs for k, v in simulate(r["log"]).items()}
    got = {(r["game_id"], r["turn"], r["slot"]): (r["species"], r["hp_percent"], r["last_move"], r["revealed"], r["seen"]) for r in d.protocol_snapshots(spark, SF).collect()}
    assert got == want and len(got) > 100


def test_labels_against_a_loop(spark):
    """Within a turn of these logs: last switch, else first move, else a pass for a line that couldn't move, else unknown."""
    logs = d.event_logs(spark, SF).collect()
    got = {(r["game_id"], r["turn"], r["slot"]): (r["action_type"], r["move"], r["switch_to"]) for r in d.turn_labels(spark, SF).collect()}
    checked = 0
    for r in logs:
        turn, did, states = 0, defaultdict(list), simulate(r["log"])
        for line in r["log"].split("\n"):
            tag, *args = line.split("|")[1:]
            if tag == "turn":
                turn = int(args[0])
            elif tag in ("move", "switch", "cant"):
                did[turn, args[0][:3]].append((tag, args[1].split(",")[0]))
        for (t, slot), state in states.items():
            if slot != "p1a":
                continue
            lines = did[t, slot]
            switches, moves = [x for k, x in lines if k == "switch"], [x for k, x in lines if k == "move"]
            if state[0] is None or state[1] <= 0:
                want = ("pass", None, None)
            elif switches:
                want = ("switch", None, switches[-1])
            elif moves:
                want = ("move", moves[0], None)
            elif lines:
                want = ("pass", None, None)
            else:
                want = (None, None, None)
            assert got[r["game_id"], t, slot] == want
            checked += 1
    assert checked > 50


def test_chunks_put_together_are_the_text(spark):
    spark.udtf.register("text_chunks", textops.TextChunks)
    spark.read.parquet(f"{SF}/documents.parquet").createOrReplaceTempView("documents_for_test")
    parts = spark.sql("SELECT doc_id, c.* FROM documents_for_test, LATERAL text_chunks(text, 700) c")
    whole = parts.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), "").alias("joined"), F.max(F.length("piece")).alias("longest"))
    j = spark.table("documents_for_test").join(whole, "doc_id")
    assert j.where("joined <> text OR longest > 700").count() == 0 and j.count() == spark.table("documents_for_test").where("text <> ''").count()


def test_fold_bounds_only_tighten(spark):
    """Bounds of an entity never widen from line to line, and stay in order."""
    rows = d.interval_fold(spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["match_id"], r["side"], r["species_key"], r["stat"]].append((r["turn_key"], r["final"], r["lo"], r["hi"]))
    assert len(by) > 1000
    for steps in by.values():
        steps.sort()
        assert all(a[2] <= a[3] for a in steps)
        assert all(b[3] <= a[3] for a, b in zip(steps, steps[1:], strict=False))
