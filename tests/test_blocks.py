"""Blocks of prompts by hand, and the packed team format as a round trip."""

import random

from pyspark.sql import functions as F

from logweave.domain import blocks
from logweave.functions import packed


def test_spread_blocks(spark):
    roster = spark.createDataFrame([("m", 0, "Big Cat"), ("m", 1, "Dog"), ("m", 2, "big-cat"), ("n", 0, "Dog"), ("o", 0, None)], "m string, pos int, species string")
    full = [("m", "bigcat", s, 0, 252) for s in blocks.STAT_NAMES]
    bounds = [("m", "bigcat", "atk", 100, 252), ("m", "bigcat", "spe", 252, 252), ("m", "bigcat", "hp", 0, 40), ("m", "bigcat", "def", 4, 12), ("n", "dog", "hp", 0, 252), ("m", "bigcat", "nonsense", 1, 2)]
    bounds += [b for b in full if b[2] in ("spa", "spd")]
    lines = blocks.spread_lines(roster, spark.createDataFrame(bounds, "m string, species_key string, stat string, lo int, hi int"), ["m"])
    told = {(r["m"], r["species"]): r["line"] for r in lines.collect()}
    assert told["m", "Big Cat"] == "  Big Cat: HP ≤ 40, Atk ≥ 100, Def 4–12, Spe = 252, others ?" and told["n", "Dog"] == "  Dog: unknown"
    assert {r["m"]: r["text"] for r in blocks.spread_block(lines, ["m"], "T", False).where("m = 'm'").collect()} == {"m": "=== T ===\n" + told["m", "Big Cat"] + "\n  Dog: unknown"}
    assert {r["m"] for r in blocks.spread_block(lines, ["m"], "T", True).collect()} == {"m"}


def test_spread_blocks_of_both_sides_fold_once(spark):
    from logweave.plans import reached_catalog

    plan = reached_catalog.spread_blocks(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("MapInArrow") == 1


def test_placeholders_sheets_and_templates(spark):
    d = spark.createDataFrame([(k,) for k in (0, 3, 4, 6)], "n int").select("n", blocks.placeholders(F.col("n"), F.lit(True)).alias("own"), blocks.placeholders(F.col("n"), F.lit(False)).alias("foe"))
    got = {r["n"]: r for r in d.collect()}
    assert [len(got[n]["own"]) for n in (0, 3, 4, 6)] == [4, 1, 0, 0] and "not sent out" in got[3]["own"][0] and "not seen" in got[3]["foe"][0]
    t = spark.createDataFrame([("Nick|FlutterMane|BoosterEnergy||Moonblast,IcyWind||||||50|,,,,,Fairy]Tauros|||||||||||",)], "p string").select(packed.sets(F.col("p")).alias("t"))
    text = t.select(blocks.system_prompt("A\n{x}{y}\n{z}", x=blocks.sheet(F.col("t"), F.array(F.lit("tauros"))), y=F.lit(None).cast("string")).alias("s")).first()["s"]
    assert text == "A\n  Flutter Mane @ Booster Energy, ability=?, tera=Fairy\n      moves: Moonblast / Icy Wind\n★ Tauros @ ?, ability=?, tera=?\n      moves: \n{z}"


def test_packed_teams(spark):
    rng = random.Random(1)
    pick = lambda *x: rng.choice(x)
    teams = []
    for _ in range(60):
        sets = []
        for _ in range(rng.randint(1, 6)):
            evs = pick("", "0,0,0,0,0,0", "252,,,,4,252", "1,2,3,4,5,6")
            sets.append("|".join([pick("Nick", "Iron Hands"), pick("", "FlutterMane", "Ogerpon-Wellspring", "Porygon2"), pick("", "LifeOrb"), pick("", "Protosynthesis"), ",".join(rng.sample(["KnockOff", "Uturn", "FakeOut", "Protect", "Spore"], rng.randint(0, 5))), pick("", "Bold"), evs, pick("", "M", "F"), pick("", ",0,,,,", "31,31,31,31,31,31"), pick("", "S"), pick("", "100", "x"), pick("", ",,,,,Fire", "255,ball,fire,G,10,Water")]))
        teams.append("]".join(sets) + pick("", "]"))
    bad = ["", None, "a|b", "Tauros|||||||||||]x|y"]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(teams + bad)], "k int, p string").select("k", packed.sets(F.col("p")).alias("t"))
    d = d.withColumn("again", packed.sets(packed.pack(F.col("t"))))
    got = {r["k"]: r for r in d.collect()}
    for k, team in enumerate(teams):
        assert got[k]["t"] == got[k]["again"]
        for s, text in zip(got[k]["t"], [x for x in team.split("]") if x], strict=True):
            f = text.split("|")
            assert s["nature"] == (f[5] or None) and s["gender"] == (f[7] or None) and s["level"] == (100 if f[10] == "100" else 50) and len(s["moves"]) == 4
            assert s["evs"] == (None if f[6] in ("", "0,0,0,0,0,0") else dict(zip(packed.STATS, [int(x or 0) for x in f[6].split(",")], strict=True)))
            assert s["ivs"] == (dict.fromkeys(packed.STATS, 31) | {"atk": 0} if f[8] == ",0,,,," else None)
            assert s["tera_type"] == (f[11].split(",")[5] if f[11] else None)
    assert got[0]["t"] is not None and all(got[len(teams) + k]["t"] is None for k in range(len(bad)))


def test_team_queries_decode_once_over_all_cores(spark):
    from logweave.plans import catalog

    for name in ("packed_teams", "team_sheets"):
        d = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        head, dealt, scan = plan.partition("RepartitionByExpression")
        assert dealt and "split" not in scan  # no filter decodes before the rows are dealt
        assert head.count("SafetyGoggles") == 1
        assert d.count() > 0


def test_transcripts_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    from logweave.plans import reached_catalog

    monkeypatch.setattr(reached_catalog, "folder", lambda s, name: str(tmp_path / name))
    reached_catalog.transcript_files(spark, "/root/testdata/sf0.01").collect()
    tasks = {p.name.split("-")[1] for p in (tmp_path / "transcripts").glob("part-*")}
    assert len(tasks) > min(2, spark.sparkContext.defaultParallelism)
