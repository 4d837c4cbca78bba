import random

from pyspark.sql import functions as F

from logweave.domain import inference, protocol, series, texts, usage
from logweave.operators import quality

LOG = "\n".join([
    "|player|p1|ann", "noise", "|switch|p1a: Fluff|Flutter Mane, L50|100/100", "|switch|p1b: Inci|Incineroar, L50|100/100", "|switch|p2a: Rill|Rillaboom, L50|100/100", "|switch|p2b: Uri|Urshifu, L50|100/100", "|turn|1",
    "|move|p1a: Fluff|Moonblast|p2a: Rill", "|-crit|p2a: Rill", "|-damage|p2a: Rill|40/100", "|-enditem|p2a: Rill|Sitrus Berry|[eat]", "|-heal|p2a: Rill|65/100|[from] item: Sitrus Berry",
    "|cant|p1b: Inci|par", "|move|p2a: Rill|Heat Wave|p1a: Fluff|[spread] p1a,p1b", "|-damage|p1a: Fluff|70/100", "|-miss|p2a: Rill|p1b: Inci", "|switch|p2b: Tor|Tornadus, L50|100/100", "|-damage|p1a: Fluff|60/100|[from] psn", "|-sidestart|p1: ann|move: Tailwind", "|-weather|RainDance", "|turn|2",
    "|-terastallize|p1a: Fluff|Fairy", "|move|p1a: Fluff|Moonblast|p2a: Rill", "|-damage|p2a: Rill|0 fnt", "|faint|p2a: Rill", "|drag|p1b: Rag|Raging Bolt, L50|100/100", "|-sideend|p1: ann|move: Tailwind", "|-weather|none", "|turn|3", "|turn|3", "|win|ann",
])


def logs(spark):
    return spark.createDataFrame([("g1", LOG), ("g2", ""), ("g3", None)], "game_id string, log string")


def test_events(spark):
    e = protocol.events(logs(spark)).orderBy("event_pos").where("game_id = 'g1' AND turn > 0").collect()
    assert [r["type"] for r in e] == ["move", "item_event", "cant_move", "move", "switch", "tera", "move", "faint", "switch"]
    first = e[0]
    assert (first["move_name"], first["attacker_slot"], first["target_slots"]) == ("Moonblast", "p1a", ["p2a"])
    assert tuple(first["hits"][0]) == ("p2a", "hit", 100.0, 40.0, True, False)
    assert (e[1]["kind"], e[1]["item"]) == ("eaten", "Sitrus Berry")
    spread = e[3]
    assert spread["is_spread"] and [(h["defender_slot"], h["outcome"]) for h in spread["hits"]] == [("p1a", "hit"), ("p1b", "miss")]
    assert (e[4]["from_species"], e[4]["to_species"], e[4]["forced_by"]) == ("Urshifu", "Tornadus", None)
    assert e[6]["hits"][0]["is_ko"] and e[6]["hits"][0]["hp_before_pct"] == 65.0
    assert e[8]["forced_by"] == "drag"


def test_snapshots_and_conditions(spark):
    s = {(r["turn"], r["slot"]): r for r in protocol.snapshots(logs(spark)).collect()}
    assert s[1, "p2a"]["species"] == "Rillaboom" and s[1, "p2a"]["hp_percent"] == 100.0
    assert s[2, "p2a"]["hp_percent"] == 65.0 and s[2, "p1a"]["hp_percent"] == 60.0 and s[2, "p1a"]["revealed_moves"] == ["Moonblast"] and s[2, "p2b"]["revealed_moves"] == []
    assert s[3, "p2a"]["fainted"] and s[3, "p2a"]["side_faints"] == 1 and s[3, "p1a"]["terastallized"] and not s[2, "p1a"]["terastallized"]
    assert s[3, "p1a"]["seen_species"] == ["Flutter Mane", "Incineroar", "Raging Bolt"]
    assert len(s) == 12
    c = sorted((r["turn"], r["scope"], r["name"]) for r in protocol.conditions(logs(spark)).collect())
    assert c == [(2, "field", "RainDance"), (2, "p1", "Tailwind")]
    assert protocol.winners(logs(spark)).collect()[0]["winner"] == "ann"


def test_labels(spark):
    s = protocol.snapshots(logs(spark))
    a = {(r["turn"], r["slot"]): r["action"] for r in series.labels(s, s, protocol.events(logs(spark))).collect()}
    assert tuple(a[1, "p1a"]) == ("move", "Moonblast", "p2a", False, None)
    assert a[1, "p1b"]["action_type"] == "pass"
    assert tuple(a[2, "p1a"]) == ("move", "Moonblast", "p2a", True, None)
    assert a[2, "p1b"] is None  # dragged out before it acted
    assert {r["turn"] for r in series.clear_turns(series.labels(s, s, protocol.events(logs(spark)))).collect()} == {1}
    b = {(r["turn"], r["slot"]): r["action"] for r in series.labels(s, s, protocol.events(logs(spark)), "p2").collect()}
    assert b[1, "p2a"]["target"] == "spread" and (b[1, "p2b"]["action_type"], b[1, "p2b"]["switch_to"]) == ("switch", "Tornadus") and b[3, "p2a"]["action_type"] == "pass"


def test_winner_first_flips_everything(spark):
    df = protocol.events(logs(spark)).where("type = 'move'").withColumns({"winner": F.lit("p2"), "p1_sheet": F.lit("one"), "p2_sheet": F.lit("two")})
    r = series.winner_first(df).orderBy("event_pos").collect()[0]
    assert (r["attacker_slot"], r["target_slots"], r["hits"][0]["defender_slot"], r["p1_sheet"], r["side"]) == ("p2a", ["p1a"], "p1a", "two", "p2")
    assert series.winner_first(df.withColumn("winner", F.lit(None).cast("string"))).orderBy("event_pos").collect()[0]["attacker_slot"] == "p1a"


def test_stitch_and_series_winner(spark):
    g = spark.createDataFrame([("r1", ["A", "b"], 0), ("r2", ["B", "a"], 1800), ("r3", ["a", "b"], 3601), ("r4", ["a", "c"], 5)], "id string, players array<string>, uploadtime long")
    got = {r["id"]: r["match_id"] for r in series.stitch(g).collect()}
    assert got == {"r1": "bo3-r1", "r2": "bo3-r1", "r3": "bo3-r3", "r4": "bo3-r4"}
    w = spark.createDataFrame([("m", "p1"), ("m", "p2"), ("k", "p2"), ("k", "p2"), ("k", "p1")], "match_id string, winner string")
    assert {r["match_id"]: r["winner"] for r in series.series_winner(w).collect()} == {"m": None, "k": "p2"}


def test_fragments(spark):
    m = spark.createDataFrame([("m", [{"snapshots": [1, 2, 3]}, {"snapshots": [1, 2]}, {"snapshots": []}])], "match_id string, games array<struct<snapshots: array<int>>>")
    r = series.without_fragments(m).collect()[0]
    assert (len(r["games"]), r["dropped_fragment_games"]) == (1, 2)


def test_teams(spark):
    rows = [("g", "fluttermane", None, None, None, ["Moonblast"], 0), ("g", "Flutter Mane", "Booster Energy", None, "Fairy", ["Moonblast", "Icy Wind"], 1), ("g", "Flutter Mane", "Other", "Proto", None, None, 2)]
    got = series.reconstruct_teams(spark.createDataFrame(rows, "game_id string, species string, item string, ability string, tera_type string, moves array<string>, pos int"), ["game_id"]).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["species"], r["item"], r["ability"], r["tera_type"], r["moves"]) == ("Flutter Mane", "Booster Energy", "Proto", "Fairy", ["Moonblast", "Icy Wind", "?", "?"])


def test_legality(spark):
    schema = "id int, action struct<action_type: string, move: string, target: string, tera: boolean, switch_to: string>, trapped boolean, choice_lock string, encored string, disabled string, known_moves array<string>, tera_used boolean"
    four = ["A", "B", "C", "D"]
    rows = [
        (1, ("switch", None, None, False, "x"), True, None, None, None, four, False),
        (2, ("move", "E", "self", False, None), False, None, None, None, four, False),
        (3, ("move", "a", "self", True, None), False, "B", None, "A", four, True),
        (4, ("move", "A", "self", False, None), True, "A", "a", None, four, True),
        (5, ("pass", None, None, False, None), None, None, None, None, None, None),
    ]
    got = sorted((r["id"], r["issue"]) for r in quality.issues(spark.createDataFrame(rows, schema), series.legality_checks(), ["id"]).collect())
    assert got == [(1, "trapped_switch"), (2, "not_in_moveset"), (3, "choice_locked"), (3, "disabled"), (3, "second_tera")]


def test_trapped(spark):
    rows = [("g", 1, "p1", "p1a", "Shadow Tag", ["Ghost"], None), ("g", 1, "p2", "p2a", "x", ["Fire"], None), ("g", 1, "p2", "p2b", "x", ["Ghost"], None), ("g", 1, "p1", "p1b", "x", ["Fire"], None)]
    got = {r["slot"]: r["trapped"] for r in series.trapped(spark.createDataFrame(rows, "game_id string, turn int, side string, slot string, ability string, types array<string>, item string"), ["shadowtag"]).collect()}
    assert got == {"p1a": False, "p2a": True, "p2b": False, "p1b": False}


def test_damage_events_leave_multi_hits_out(spark):
    e = protocol.events(logs(spark))
    got = inference.damage_events(e).orderBy("event_pos").collect()
    assert [(r["attacker_slot"], r["defender_slot"], r["is_ko"]) for r in got] == [("p1a", "p2a", False), ("p2a", "p1a", False), ("p1a", "p2a", True)]
    twice = e.where("type = 'move'").withColumn("hits", F.concat("hits", "hits"))
    assert inference.damage_events(twice).count() == 0


def test_boundary_searches():
    for cut in (0, 1, 100, 252):
        assert inference.least_where(lambda v: v >= cut) == cut
        assert inference.greatest_where(lambda v: v <= cut) == cut
    assert inference.least_where(lambda v: False) is None and inference.greatest_where(lambda v: False) is None


def test_fold_brackets_the_truth(spark):
    rng, rows, true = random.Random(4), [], {("p1", "a"): {"atk": 200, "hp": 100, "def": 60}, ("p2", "b"): {"atk": 60, "hp": 252, "def": 0}}
    for k in range(30):
        side = rng.choice(["p1", "p2"])
        a, d = (("p1", "a"), ("p2", "b")) if side == "p1" else (("p2", "b"), ("p1", "a"))
        e = {"power": rng.choice([40.0, 70.0, 100.0])}
        lo, hi = inference.stand_in(e, true[a]["atk"], true[d]["hp"], true[d]["def"])
        dealt = rng.uniform(lo, hi)
        rows.append(("m", k // 4, k, *a, *d, "Physical", e["power"], 100.0, 100.0 - round(dealt, 1), False))
    schema = "match_id string, turn_key long, event_pos int, attacker_side string, attacker string, defender_side string, defender string, category string, power double, hp_before_pct double, hp_after_pct double, is_ko boolean"
    got = inference.fold(spark.createDataFrame(rows, schema)).collect()
    assert all(r["lo"] <= r["hi"] for r in got)
    final = {(r["side"], r["species_key"], r["stat"]): (r["lo"], r["hi"]) for r in got if r["final"]}
    for (side, name), stats in true.items():
        for s, v in stats.items():
            assert final[side, name, s][0] <= v <= final[side, name, s][1]
    assert any(hi - lo < 252 for lo, hi in final.values())
    before = [r for r in got if r["turn_key"] == 0 and not r["final"]]
    assert before == []


def plain_fold(rows):
    """The fold one event at a time, by linear searches."""
    state, out, match, turn = {}, [], None, None
    put = lambda at, final: out.extend((match, at, final, *k, s, v[0][s], v[1][s]) for k, v in state.items() for s in inference.STATS)
    every = range(inference.MOST + 1)
    for r in sorted(rows, key=lambda r: r[:3]):
        if r[0] != match:
            if match is not None:
                put(turn + 1, True)
            state, match, turn = {}, r[0], None
        if r[1] != turn:
            turn = r[1]
            put(turn, False)
        _, _, _, aside, aname, dside, dname, category, power, was, now, ko = r
        if category == "Status" or aside == dside:
            continue
        (al, ah), (dl, dh) = (state.setdefault(k, (dict.fromkeys(inference.STATS, 0), dict.fromkeys(inference.STATS, 252))) for k in ((aside, aname), (dside, dname)))
        off, dfn = ("atk", "def") if category == "Physical" else ("spa", "spd")
        least, most = max((was if ko else was - now) - 0.9, 0.0), float("inf") if ko else was - now + 0.9
        lo, hi = (lambda x, h, y, k=k: float(inference.stand_in({"power": power}, x, h, y)[k]) for k in (0, 1))
        first, last = (lambda test: min((v for v in every if test(v)), default=None)), (lambda test: max((v for v in every if test(v)), default=None))
        raised = [(dl, dfn, first(lambda v: lo(al[off], dh["hp"], v) <= most)), (dl, "hp", first(lambda v: lo(al[off], v, dh[dfn]) <= most)), (al, off, first(lambda v: hi(v, dl["hp"], dl[dfn]) >= least))]
        lowered = [(dh, dfn, last(lambda v: hi(ah[off], dl["hp"], v) >= least)), (dh, "hp", last(lambda v: hi(ah[off], v, dl[dfn]) >= least)), (ah, off, last(lambda v: lo(v, dh["hp"], dh[dfn]) <= most))]
        for x, s, v in raised:
            x[s] = max(x[s], v if v is not None else 0)
        for x, s, v in [] if ko else lowered:
            x[s] = min(x[s], v if v is not None else 252)
        for low, high in ((al, ah), (dl, dh)):
            spent = sum(low.values())
            for s in inference.STATS:
                if spent <= 508:
                    high[s] = max(min(high[s], 508 - (spent - low[s])), low[s])
            for s in inference.STATS:
                low[s] = min(low[s], high[s])
    put(turn + 1, True)
    return sorted(out)


def test_fold_against_a_plain_loop(spark):
    rng, rows = random.Random(12), []
    for g in range(12):
        for k in range(rng.randint(1, 25)):
            (a, d) = rng.sample(["p1", "p2"], 2) if rng.random() < 0.9 else ("p1", "p1")
            before = rng.uniform(20, 100)
            rows.append((f"g{g:02}", k // 3, k, a, rng.choice("xy"), d, rng.choice("zw"), rng.choice(["Physical", "Special", "Status"]), rng.choice([0.0, 60.0, 120.0]), before, before - rng.uniform(0, 20), rng.random() < 0.1))
    schema = "match_id string, turn_key long, event_pos int, attacker_side string, attacker string, defender_side string, defender string, category string, power double, hp_before_pct double, hp_after_pct double, is_ko boolean"
    want, df = plain_fold(rows), spark.createDataFrame(rows, schema)
    for size in ("10000", "7"):  # batches that end within a match
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = inference.fold(df).collect()
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted((r["match_id"], r["turn_key"], r["final"], r["side"], r["species_key"], r["stat"], r["lo"], r["hi"]) for r in got) == want
        assert all(r["observed"] for r in got)


def test_speed_caps(spark):
    rows = [("m", 1, 0, "p1", "fast", 100, 0, 252), ("m", 1, 1, "p2", "slow", 100, 0, 252), ("m", 2, 0, "p1", "low", 50, 0, 0), ("m", 2, 1, "p2", "mid", 50, 0, 252)]
    got = {r["species_key"]: r["hi"] for r in inference.speed_caps(spark.createDataFrame(rows, "match_id string, turn_key long, pos int, side string, species_key string, base_speed int, known_lo int, known_hi int")).collect()}
    assert got == {"slow": 252, "mid": 0}


def test_matrix_and_labels(spark):
    a = spark.createDataFrame([("g", 1, "x", "big", "Physical", 120.0, 0, 252), ("g", 1, "x", "tiny", "Physical", 5.0, 0, 252)], "game_id string, turn int, attacker string, move string, category string, power double, atk_lo int, atk_hi int")
    d = spark.createDataFrame([("g", 1, "y", 0, 252, 0, 252), ("h", 1, "z", 0, 252, 0, 252)], "game_id string, turn int, defender string, hp_lo int, hp_hi int, def_lo int, def_hi int")
    m = inference.matrix(a, d)
    shown, chip = inference.chip_free(m)
    assert [r["move"] for r in shown.collect()] == ["big"] and all(r["lo"] <= r["hi"] for r in m.collect())
    assert [r["moves"] for r in chip.collect()] == [["tiny"]]
    label = spark.createDataFrame([(1, 3), (1, 1), (2, None), (None, None)], "b int, w int").select(inference.hits_label(F.col("b"), F.col("w"))).collect()
    assert [r[0] for r in label] == ["OHKO–3HKO", "OHKO", "2HKO+", ""]


def test_usage(spark):
    raw = spark.createDataFrame([("Iron Hands", {"Spreads": {"bad": 9.0, "Adamant:252/0/0/0/0/0": 3.0, "Brave:0/0/0/0/0/4": 1.0}, "Items": {"Nothing": 5.0, "Vest": 2.0, "Belt": 0.0}})], "species string, data map<string, map<string, double>>")
    m = usage.marginals(raw)
    got = {(r["field"], r["rank"]): (r["value"], round(r["usage_pct"], 2)) for r in usage.top_shares(m, {"Spreads": 2, "Items": 3}).collect()}
    assert got == {("Spreads", 1): ("Adamant:252/0/0/0/0/0", 23.08), ("Spreads", 2): ("Brave:0/0/0/0/0/4", 7.69), ("Items", 1): ("Vest", 15.38)}
    wanted = spark.createDataFrame([("ironhands",), ("cur",), ("none",), ("strong",)], "species_key string")
    curated = spark.createDataFrame([("cur", "Calm:1/2/3/4/5/6")], "species_key string, spread string")
    base = spark.createDataFrame([("strong", 80, 130, 80, 60, 80, 95)], "species_key string, hp int, atk int, def int, spa int, spd int, spe int")
    out = {r["species_key"]: (r["spread"], r["source"]) for r in usage.spreads_with_fallback(wanted, usage.top_shares(m, {"Spreads": 1}), curated, base).collect()}
    assert out["ironhands"][1] == "usage" and out["cur"] == ("Calm:1/2/3/4/5/6", "curated") and out["none"] == ("Modest:4/0/0/252/0/252", "heuristic") and out["strong"] == ("Jolly:4/252/0/0/0/252", "heuristic")


def test_texts(spark):
    h = {r["turn"]: r["text"] for r in texts.history(protocol.events(logs(spark))).collect()}
    assert "p1a: Moonblast → p2a 100.0→40.0 crit" in h[1] and "fainted" not in h[2] and "KO" in h[2]
    s = {r["turn"]: r["text"] for r in texts.state_lines(protocol.snapshots(logs(spark))).collect()}
    assert s[2].startswith("=== GAME STATE ===\n[p1a] Flutter Mane | HP 60.0% | moves: Moonblast")
    hp = spark.createDataFrame([("[a] Flutter Mane | HP 35% | x\n[b] Iron Hands | HP 80.5%\n[a] Flutter Mane | HP 30% |",)], "t string").select(texts.on_field_hp(F.col("t"))).collect()[0][0]
    assert hp == {"fluttermane": 30.0, "ironhands": 80.5}


def test_mentions_and_claims(spark):
    spark.udtf.register("mentions", texts.Mentions)
    got = spark.sql("SELECT * FROM mentions('Rillaboom hits. rillaboom!', array('Rillaboom', 'Boom'))").collect()
    assert [(r["species"], r["start"]) for r in got] == [("Rillaboom", 0), ("Rillaboom", 16)]
    rows = [(1, 0, "x", 31.9, 68.6, 30, 35.0), (1, 5, "x", 31.9, 68.6, 30, 35.0), (2, 0, "x", 10.0, 20.0, 90, 35.0), (3, 0, "x", 10.0, 20.0, 60, 35.0)]
    c = texts.grounded_claims(spark.createDataFrame(rows, "row_id int, target_pos int, target string, lo double, hi double, ko_pos int, hp double"))
    assert sorted((r["row_id"], r["violation"]) for r in c.collect()) == [(1, "ko_not_guaranteed"), (3, "ko_impossible")]


def test_row_checks(spark):
    schema = "id int, user string, messages array<struct<role: string, content: string, tool_call_id: string, tool_calls: array<struct<id: string, type: string, function: struct<name: string, arguments: string>>>>>"
    call = lambda i, name, args="{}": (i, "function", (name, args))
    good = f"{texts.header('state')}\n{texts.header('matrix')}"
    rows = [
        (1, good, [("assistant", None, None, [call("c1", "calculate")]), ("tool", "x", "c1", None), ("assistant", None, None, [call("s", "submit_decision", '{"pre_tool_thought": "fine"}')])]),
        (2, good + " {left_over}", [("assistant", None, None, [call("c1", "calculate"), call("s", "submit_decision", '{"pre_tool_thought": "the target action is"}')])]),
        (3, "", [("assistant", None, None, [call("s", "submit_decision", '{"pre_tool_thought": "[DRY RUN] oracle"}'), call("t", "submit_decision", "{}")])]),
    ]
    got = sorted((r["id"], r["issue"]) for r in quality.issues(spark.createDataFrame(rows, schema), texts.row_checks(), ["id"]).collect())
    assert got == [(2, "calls_answered"), (2, "leak"), (2, "template_leftovers"), (3, "one_submit"), (3, "prompt_sections")]


def test_asymmetric_keeps_entities_whole_and_shuffles_a_match_once(spark):
    rows = [("m", t, 0, "p1", "a", "p2", "b", "Physical", 80.0, 100.0, 100.0 - 20 * t, False) for t in (1, 2)] + [("n", 1, 0, None, "a", "p2", None, "Special", 80.0, 100.0, 60.0, False)]
    hits = spark.createDataFrame(rows, "match_id string, turn_key long, event_pos int, attacker_side string, attacker string, defender_side string, defender string, category string, power double, hp_before_pct double, hp_after_pct double, is_ko boolean")
    known = inference.entities(hits)
    present = spark.createDataFrame([("m", t, s, k) for t in (1, 2, 3) for s in ("p1", "p2") for k in ("a", "b")] + [("n", 2, None, "a"), ("n", 2, "p2", None)], "match_id string, turn_key long, side string, species_key string")
    wide = inference.asymmetric_entities(known, present, "p1")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row for each stat is shuffled or sorted
    table = {(r["match_id"], r["turn_key"], r["final"], r["side"], r["species_key"], r["stat"]): (r["lo"], r["hi"]) for r in inference.fold(hits).collect()}
    assert {k: v for k, v in table.items() if k[2]} == {(*[r[c] for c in ("match_id", "turn_key", "final", "side", "species_key", "stat")],): (r["lo"], r["hi"]) for r in inference.fold(hits, turns=False).collect()}
    got = inference.asymmetric(known, present, "p1").collect()
    assert len(got) == 14 * len(inference.STATS)
    for r in got:
        mine = {k[1]: v for k, v in table.items() if (k[0], k[3], k[4], k[5]) == (r["match_id"], r["side"], r["species_key"], r["stat"]) and (k[2] or r["side"] != "p1")}
        told = [v for t, v in sorted(mine.items()) if r["side"] == "p1" or t <= r["turn_key"]]
        assert (r["lo"], r["hi"]) == (told[-1] if told else (0, inference.MOST)), r
        assert r["observed"] == bool(told)
