import json

from pyspark.sql import functions as F

from logweave.functions import scalars
from logweave.operators import intervals, quality, relational, split, textops
from logweave.sources import readers


def one(df):
    return df.collect()[0]


def test_budget_leaves_four_each(spark):
    rows = [("s", n, 252 if n in ("atk", "spe") else 0, 252) for n in ("hp", "atk", "def", "spa", "spd", "spe")]
    got = {r["stat"]: r["hi"] for r in intervals.budget(spark.createDataFrame(rows, "k string, stat string, lo int, hi int"), ["k"], 508).collect()}
    assert got == {"hp": 4, "def": 4, "spa": 4, "spd": 4, "atk": 252, "spe": 252}


def test_infeasible_budget_is_left_alone(spark):
    rows = [("s", n, 252, 252) for n in "abc"]
    assert {r["hi"] for r in intervals.budget(spark.createDataFrame(rows, "k string, stat string, lo int, hi int"), ["k"], 508).collect()} == {252}


def test_tighten_repairs_bounds(spark):
    df = spark.createDataFrame([("a", 5, 20), ("a", 30, 25)], "k string, x int, y int")
    assert tuple(one(intervals.tighten(df, ["k"], F.col("x"), F.col("y")).select("lo", "hi"))) == (20, 20)


def test_observed_range(spark):
    df = spark.createDataFrame([(40.0, 0.0, True), (80.0, 50.0, False)], "b double, a double, ko boolean")
    lo, hi = intervals.observed_range(F.col("b"), F.col("a"), F.col("ko"))
    got = [tuple(round(x, 6) for x in r) for r in df.select(lo, hi).collect()]
    assert got == [(39.1, float("inf")), (29.1, 30.9)]


def test_boundary_search_null_when_infeasible(spark):
    r = one(spark.range(1).select(intervals.least_step(lambda x: x * 2 >= 101, 0, 252).alias("a"), intervals.least_step(lambda x: x > 999, 0, 252).alias("b")))
    assert (r["a"], r["b"]) == (51, None)


def test_render(spark):
    df = spark.createDataFrame([(0, 252), (4, 4), (0, 8), (8, 252), (4, 12)], "lo int, hi int")
    assert [r[0] for r in df.select(intervals.render(F.col("lo"), F.col("hi"), 0, 252)).collect()] == ["?", "= 4", "≤ 8", "≥ 8", "4–12"]


def test_ko_text(spark):
    texts = ["guaranteed OHKO", "92% chance to OHKO", "guaranteed 2HKO", "41% chance to 2HKO", "no damage"]
    best, worst = textops.ko_count(F.col("value"))
    got = [tuple(r) for r in spark.createDataFrame(texts, "string").select(best, worst).collect()]
    assert got == [(1, 1), (1, 2), (2, 2), (2, 3), (None, None)]


def test_claims(spark):
    df = spark.createDataFrame([(31.9, 68.6, 35.0), (10.0, 20.0, 35.0), (40.0, 50.0, 35.0)], "lo double, hi double, hp double")
    assert [r[0] for r in df.select(textops.claim_violation(F.col("lo"), F.col("hi"), F.col("hp"))).collect()] == ["ko_not_guaranteed", "ko_impossible", None]


def test_spread_and_names(spark):
    df = spark.createDataFrame([("Modest:0/0/0/252/4/252", "Mr. Mime-é"), ("bad", None)], "s string, n string")
    got = df.select(scalars.spread(F.col("s")).alias("s"), scalars.name_key(F.col("n")).alias("n")).collect()
    assert got[0]["s"]["nature"] == "Modest" and got[0]["s"]["values"] == [0, 0, 0, 252, 4, 252] and got[0]["n"] == "mrmime"
    assert got[1]["s"] is None and got[1]["n"] is None


def test_scalar_rules(spark):
    df = spark.createDataFrame([("p1a: X", 33.35, "75%", "Ogerpon-Tera")], "slot string, x double, hp string, f string")
    r = one(df.select(scalars.slot_of(F.col("slot")), scalars.side_of(F.col("slot")), scalars.round_half_up(F.lit(0.25)), scalars.hp_value(F.col("hp"), F.lit(200)), scalars.hp_value(F.lit("120"), F.lit(200)), scalars.base_forme(F.col("f"))))
    assert tuple(r) == ("p1a", "p1", 0.3, 150.0, 120.0, "Ogerpon")


def test_majority_tie_is_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "k string, w string")
    got = df.groupBy("k").agg(relational.majority(F.col("w") == "x", F.col("w") == "y", "x", "y").alias("m")).collect()
    assert {r["k"]: r["m"] for r in got} == {"a": None, "b": "x"}


def test_fallback_reaches_the_constant(spark):
    base = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, g string")
    first, second = spark.createDataFrame([(1, 9.0)], "id int, v double"), spark.createDataFrame([("a", 5.0)], "g string, w double")
    got = relational.fallback_chain(base, [(first, ["id"], "v", "own"), (second, ["g"], "w", "group")], "value", F.lit(1.0), "constant").orderBy("id").collect()
    assert [(r["value"], r["source"]) for r in got] == [(9.0, "own"), (5.0, "group"), (1.0, "constant")]


def test_nearest_match_against_all_pairs(spark):
    left = [(k, k % 3, float((k * 37) % 101)) for k in range(40)]
    right = [(100 + k, k % 3, float((k * 53) % 97)) for k in range(30)]
    schema = "id int, g int, p double"
    got = relational.nearest_match(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "g", "p", 4.0, ["id"], "id").collect()
    for r in got:
        near = sorted((abs(r["p"] - p), i) for i, g, p in right if g == r["g"] and abs(r["p"] - p) <= 4.0)
        assert r["near_id"] == (near[0][1] if near else None)


def test_pairing_keeps_orphans(spark):
    c, r = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {x["k"]: x["status"] for x in relational.paired(c, r, ["k"]).collect()} == {1: "unanswered", 2: "paired", 3: "orphan"}


def test_index_terciles(spark):
    df = spark.createDataFrame([("g", v) for v in range(10)] + [("h", 5), ("h", 5), ("h", 7)], "g string, v int")
    got = {r["g"]: (r["low_cut"], r["high_cut"]) for r in split.index_terciles(df, "g", "v").collect()}
    assert got == {"g": (3, 6), "h": (5, 7)}


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 3)
    a = {r["id"]: r["split"] for r in split.stratified_split(df, "id", "s", 100, 42).collect()}
    b = {r["id"]: r["split"] for r in split.stratified_split(df.repartition(7), "id", "s", 100, 42).collect()}
    assert a == b and len(a) == 1000 and sum(x == "holdout" for x in a.values()) == 99


def test_gate_halts_on_few_rows(spark):
    df = spark.createDataFrame([(1,)] * 10, "q int")
    assert one(quality.gate(df, F.col("q") == 1, F.col("q") == 0, 0.9, 0.1, 50))["decision"] == "halt"
    assert one(quality.gate(df.where("q = 0"), F.col("q") == 1, F.col("q") == 0, 0.9, 0.1, 0))["n"] == 0


def test_audit_null_is_no_issue(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    got = {r["check_name"]: (r["n_rows"], r["n_tripped"]) for r in quality.audit(df, {"big": quality.Check(F.col("v") > 2), "known": quality.Check(F.col("v") > 0, F.col("v") > 2)}).collect()}
    assert got == {"big": (3, 1), "known": (1, 1)}


def test_sections_and_chunks(spark):
    spark.udtf.register("sections", textops.Sections)
    spark.udtf.register("text_chunks", textops.TextChunks)
    got = spark.sql("SELECT * FROM sections('intro\n=== A ===\none\n=== B ===\ntwo')").collect()
    assert [(r["title"], r["body"]) for r in got] == [(None, "intro"), ("A", "one"), ("B", "two")]
    text = "aaaa. bbbb. cccc. dddd"
    got = spark.sql(f"SELECT * FROM text_chunks('{text}', 10)").collect()
    assert "".join(r["piece"] for r in got) == text and all(len(r["piece"]) <= 10 for r in got)


def test_key_values_last_wins(spark):
    r = one(spark.createDataFrame([("a=1 b=2 a=3",)], "t string").select(textops.key_values(F.col("t"), "([a-z])=([0-9])").alias("m")))
    assert r["m"] == {"a": "3", "b": "2"}


def test_corrupt_rows_are_counted(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a", "n": 1}\nnot json\n{"id": "b", "n": 2}\n')
    df = readers.json_rows(spark, str(tmp_path), "id string, n int").cache()
    good, dead = readers.routed(df, F.col(readers.CORRUPT).isNull())
    assert (good.count(), dead.count()) == (2, 1)


def test_headers_and_kinds(spark):
    raw = spark.createDataFrame([("r1", "f", ["A", "b"], 5, None), ("r1", "f", ["A", "b"], 7, False), ("r2", "f", ["A"], 5, False), ("r3", "f", ["A", "b"], 5, True)], "id string, formatid string, players array<string>, uploadtime long, private boolean")
    assert [(r["id"], r["uploadtime"]) for r in readers.game_headers(raw).collect()] == [("r1", 5)]
    df = spark.createDataFrame([(json.dumps({"a": 1, "b": 2}),), (json.dumps({"a": 1}),), ("broken",)], "j string")
    assert [r[0] for r in df.select(readers.file_kind(F.col("j"), {"both": ["a", "b"], "one": ["a"]})).collect()] == ["both", "one", "unknown"]


def test_excluded_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"holdout": ["m1", "m2"]}')
    (tmp_path / "b.json").write_text('["m3"]')
    (tmp_path / "c.txt").write_text("m4\nm1\n")
    assert {r["id"] for r in readers.excluded_ids(spark, str(tmp_path)).collect()} == {"m1", "m2", "m3", "m4"}


def test_groups_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    readers.replace_groups(spark.createDataFrame([("a", 1), ("b", 2)], "g string, v int"), path, "g")
    readers.replace_groups(spark.createDataFrame([("b", 3)], "g string, v int"), path, "g")
    assert sorted((r["g"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_nearest_match_keeps_repeated_left_rows(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 9.0)], "g string, p double")
    right = spark.createDataFrame([(7, "a", 2.0)], "id int, g string, p double")
    got = sorted(map(tuple, relational.nearest_match(left, right, "g", "p", 4.0, ["id"], "id").collect()), key=repr)
    assert got == [("a", 1.0, 7, 1.0), ("a", 1.0, 7, 1.0), ("b", 9.0, None, None)]


def test_stratified_split_with_null_strata_and_one_large(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN 's' ELSE 'l' END AS s")
    got = {(r["s"], r["split"]): r["count"] for r in split.stratified_split(df, "id", "s", 301, 7).groupBy("s", "split").count().collect()}
    assert got == {(None, "holdout"): 30, (None, "train"): 270, ("s", "holdout"): 30, ("s", "train"): 270, ("l", "holdout"): 241, ("l", "train"): 2159}


def test_sections_and_rules_without_python(spark):
    import random

    rng = random.Random(4)
    bits = ["=== A ===", "=== B C ===  ", "=== ===", "==== no ====", "=== open", "1. one", "  2) two", "3.no", "0. zero", "text", "", "   ", "\tmore", "12.  twelve", "=== = ==="]
    texts_ = ["\n".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(400)] + ["", None]
    d = spark.createDataFrame(list(enumerate(texts_)), "k int, t string")
    got = d.select("k", textops.sections(F.col("t")).alias("s"), textops.numbered(F.col("t")).alias("n")).collect()
    for r in got:
        want = [(t, b) for _, t, b in textops.Sections.func().eval(texts_[r["k"]])]
        assert [(x["title"], x["body"]) for x in r["s"]] == want, texts_[r["k"]]
        rules = [(n, t) for n, t in textops.NumberedRules.func().eval(texts_[r["k"]])]
        assert [(x["rule"], x["text"]) for x in r["n"]] == [x for x in rules if x != (0, "")], texts_[r["k"]]
