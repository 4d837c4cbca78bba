import json

import pytest
from pyspark.sql import functions as F
from test_domain import LOG

from logweave import cli, providers
from logweave.operators import relational, textops
from logweave.sources import paged


def test_paged_source(spark):
    import sys
    from pathlib import Path

    spark.sparkContext.addPyFile(str(Path(__file__).parent / "fake_pages.py"))
    sys.path.insert(0, str(Path(__file__).parent))
    spark.dataSource.register(paged.PagedSource)
    df = spark.read.format("paged_json").options(fetch="fake_pages:fetch", url="x://h/{key}/{page}", keys="a,down,gone,b", page_size="2", field="items").load().collect()
    assert [json.loads(r["record"])["id"] for r in df if r["key"] == "a"] == [f"a-{k}" for k in range(5)]
    assert sorted((r["key"], r["error"]) for r in df if r["error"]) == [("down", "RetryLater: always"), ("gone", "ValueError: 404")]


def test_end_of_a_listing_takes_few_requests():
    for n in (0, 1, 49, 50, 51, 1000, 5000):
        asked = []
        p = paged.Pages({"url": "{key}/{page}", "page_size": "50", "keys": "k"})
        p.fetch = lambda url, n=n: (asked.append(url), list(range(n))[(int(url[2:]) - 1) * 50 :][:50])[1]
        for known in (0, min(n, 30), min(n, 100), n):
            asked.clear()
            assert p.end("k", known) == n and len(asked) <= 16


def test_paged_stream_follows_growing_listings(spark, tmp_path):
    spark.dataSource.register(paged.PagedSource)

    def run(**sizes):
        for k, n in sizes.items():
            (tmp_path / k).write_text(str(n))
        options = {"fetch": "tests.fake_pages:growing", "url": f"{tmp_path}/{{key}}/{{page}}", "keys": "a,b", "page_size": "2", "pages_per_task": "3"}
        stream = spark.readStream.format("paged_json").options(**options).load()
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
        q.stop()
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        assert all(json.loads(r["record"])["id"] == f"{r['key']}-{r['pos']}" for r in got)
        return sorted((r["key"], r["pos"]) for r in got)

    assert run(a=5, b=0) == [("a", k) for k in range(5)]
    with pytest.raises(Exception, match="away"):
        run(a=-1, b=1)
    assert run(a=17, b=3) == [("a", k) for k in range(17)] + [("b", k) for k in range(3)]  # more than a task


def test_attempts_wait_longer():
    waits, calls = [], []

    def fetch(url):
        calls.append(url)
        raise paged.RetryLater("no", 7.0 if len(calls) == 1 else None)

    with pytest.raises(paged.RetryLater):
        paged.attempt(fetch, "u", 3, waits.append)
    assert len(calls) == 3 and waits[0] == 7.0 and 2 <= waits[1] < 3


def test_providers(spark, tmp_path):
    df = spark.createDataFrame([("m", 0, "a\nfine"), ("m", 1, "b\nbad"), ("k", 0, None)], "match string, pos int, prompt string")
    out = providers.answered(df, "prompt", [providers.Echo()])
    assert {(r["match"], r["pos"]): r["answer"] for r in out.collect()} == {("m", 0): "[DRY RUN] fine", ("m", 1): "[DRY RUN] bad", ("k", 0): "[DRY RUN] "}

    class Broken:
        name = "broken"

        def answer(self, prompts):
            raise RuntimeError("down")

    assert {r["error"] for r in providers.answered(df, "prompt", [Broken()]).collect()} == {"RuntimeError: down"}
    left = providers.unflagged(out, "match", "pos", "answer", providers.Flag("bad"))
    assert sorted((r["match"], r["pos"]) for r in left.collect()) == [("k", 0), ("m", 0)]

    def keep(d, name):
        d.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    got = providers.retried(df, lambda d: providers.answered(d, "prompt", [providers.Echo()]), F.contains("answer", F.lit("bad")), 2, keep)
    assert sorted((r["match"], r["pos"], r["clean"]) for r in got.collect()) == [("k", 0, True), ("m", 0, True), ("m", 1, False)]


def test_more_joins(spark):
    a, b = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), spark.createDataFrame([(2, "b"), (3, "b")], "k int, v string")
    assert sorted(tuple(r) for r in relational.first_source([a, b], "k").collect()) == [(1, "a"), (2, "a"), (3, "b")]
    states = spark.createDataFrame([("g", 1, 10), ("g", 2, 20), ("g", 4, 40)], "g string, turn int, x int")
    r = relational.source_trace(spark.createDataFrame([("g", 2)], "g string, turn int"), states, ["g", "turn"], "turn", ["x"]).collect()[0]
    assert (r["state"]["x"], r["next_state"]["x"]) == (20, 40)
    items = spark.createDataFrame([(1, "sent"), (2, "sent")], "id int, status string")
    assert {r["id"]: r["status"] for r in relational.routed_results(items, spark.createDataFrame([(1, "ok")], "id int, status string"), "id", "status").collect()} == {1: "ok", 2: "failed"}
    c = spark.createDataFrame([({"x": 1},), ({"x": 2, "y": 5},)], "m map<string,int>")
    assert {r["counter"]: r["n"] for r in relational.counters(c, "m").collect()} == {"x": 3, "y": 5}
    assert tuple(relational.profile(spark.range(1, 5), "id").collect()[0]) == (4, 1, 2, 4)
    kept, dropped = relational.with_drop_reason(spark.range(6), {"small": F.col("id") < 2, "even": F.col("id") % 2 == 0})
    assert sorted(r["id"] for r in kept.collect()) == [3, 5] and {r["drop_reason"]: r["n"] for r in dropped.collect()} == {"small": 2, "even": 2}


def test_numbered_rules(spark):
    spark.udtf.register("rules", textops.NumberedRules)
    got = spark.sql("SELECT * FROM rules('Intro\n1. first\nmore\n2) second')").collect()
    assert [(r["rule"], r["text"]) for r in got] == [(0, "Intro"), (1, "first\nmore"), (2, "second")]


def test_command_line(spark, tmp_path):
    rows = [{"id": f"r{k}", "formatid": "f", "players": ["A", "b"], "uploadtime": k * 100, "log": LOG, "private": False} for k in range(3)]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbroken\n")
    cli.main(["parse", str(tmp_path / "raw.jsonl"), str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/matches")).select("match_id").distinct().count() == 1
    assert spark.read.parquet(str(tmp_path / "out/snapshots")).count() == 36
    assert spark.read.text(str(tmp_path / "out/dead_letters")).count() == 1
    cli.main(["parse", "--resume", str(tmp_path / "out/events"), str(tmp_path / "raw.jsonl"), str(tmp_path / "again")])
    assert spark.read.parquet(str(tmp_path / "again/events")).count() == 0
    spark.range(30).selectExpr("cast(id as string) as match_id", "'f' as format", "id as turns").write.parquet(str(tmp_path / "m.parquet"))
    cli.main(["split", "--holdout", "6", str(tmp_path / "m.parquet"), str(tmp_path / "s.json")])
    got = spark.read.json(str(tmp_path / "s.json"))
    assert got.count() == 30 and got.where("split = 'holdout'").count() == 6


def test_commands_for_rows_checks_and_usage(spark, tmp_path):
    from logweave.sources.commits import Committed

    def raw(name, ids):
        path = tmp_path / name
        path.write_text("\n".join(json.dumps({"id": f"r{k}", "formatid": "f", "players": ["A", "b"], "uploadtime": k, "log": LOG, "private": False}) for k in ids) + "\nbroken\n")
        return str(path)

    table, seen = str(tmp_path / "rows"), lambda: {r["game_id"]: r["n"] for r in Committed(spark, table, "game_id").read().groupBy("game_id").agg(F.count("*").alias("n")).collect()}
    cli.main(["rows", raw("a.jsonl", (0, 1)), table])
    first = seen()
    assert set(first) == {"r0", "r1"} and first["r0"] > 0
    (tmp_path / "held.txt").write_text("r3\n")
    cli.main(["rows", "--holdout", str(tmp_path / "held.txt"), raw("b.jsonl", (0, 1, 2, 3)), table])
    assert seen() == {f"r{k}": first["r0"] for k in range(3)}
    prompts = [r["prompt"] for r in Committed(spark, table).read().collect()]
    assert all(p.startswith("=== GAME STATE ===") for p in prompts)

    action = {"action_type": "switch", "move": None, "target": None, "tera": False, "switch_to": "X"}
    acts = [{"match_id": f"m{k}", "turn": k, "slot": "p1a", "action": action | ({"action_type": "move", "move": "Tackle"} if k else {}), "trapped": True, "choice_lock": "Protect" if k == 2 else "", "encored": "", "disabled": "", "known_moves": ["Tackle", "b", "c", "d"], "tera_used": False} for k in range(3)]
    (tmp_path / "acts.jsonl").write_text("\n".join(map(json.dumps, acts)))
    cli.main(["legality", str(tmp_path / "acts.jsonl"), str(tmp_path / "legal")])
    assert {(r["match_id"], r["issue"]) for r in spark.read.json(str(tmp_path / "legal/issues")).collect()} == {("m0", "trapped_switch"), ("m2", "choice_locked")}
    assert {r["check_name"]: r["n_tripped"] for r in spark.read.json(str(tmp_path / "legal/report")).collect()}["choice_locked"] == 1

    rows_ = [{"match_id": "a", "user": "[p1a] Foe | HP 50%\n  Hit → Foe            20.0–10.0%", "action": json.dumps({"slot_1": {"action_type": "pass"}, "slot_2": {"action_type": "move"}})}]
    (tmp_path / "cot.jsonl").write_text("\n".join(map(json.dumps, rows_)))
    cli.main(["reasoning", "--keys", "match_id", str(tmp_path / "cot.jsonl"), str(tmp_path / "cot")])
    assert {r["issue"] for r in spark.read.json(str(tmp_path / "cot/issues")).collect()} == {"matrix_ranges", "action_structure"}

    months = [{"month": m, "species": "S-1", "data": {"Spreads": {"Bold:4/0/0/0/0/0": w}, "Items": {"Orb": w, "nothing": 9.0}}} for m, w in (("2024-01", 1.0), ("2024-03", 4.0))]
    (tmp_path / "u.jsonl").write_text("\n".join(map(json.dumps, months)))
    cli.main(["usage", "--month", "2024-02", str(tmp_path / "u.jsonl"), str(tmp_path / "u")])
    assert {(r["field"], r["value"], r["usage_pct"]) for r in spark.read.json(str(tmp_path / "u")).collect()} == {("Spreads", "Bold:4/0/0/0/0/0", 100.0), ("Items", "Orb", 100.0)}
