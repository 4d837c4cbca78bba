"""Timed conditions and identities against plain loops over the lines, and by hand."""

import re

from logweave.domain import conditions, identity, protocol
from logweave.operators import spans
from logweave.plans import state_catalog as s

SF = "/root/testdata/sf0.001"
CUT = {"p1": "p2", "p2": "p1"}


def walk(log):
    """(turn, scope, name, value, level, since, left, left_max) by a state machine."""
    on, out, turn, ups, moves = {}, [], 0, 0, {}
    lines = [x.split("|")[1:] for x in log.split("\n") if x.startswith("|")]
    by_turn = not any(x[0] == "upkeep" for x in lines)
    best = -1

    def start(scope, family, name, value=None):
        old = on.get((scope, family))
        on[scope, family] = {"name": name, "value": value, "level": (old["level"] if old else 0) + 1, "since": turn, "clock": ups}

    for tag, *a in lines:
        name = re.sub("^(move|item|ability): *", "", a[1] if tag in ("-sidestart", "-sideend", "-start", "-end") else a[0] if a else "").strip()
        family = "terrain" if name.endswith(" Terrain") else "perish" if name.startswith("perish") else name
        slot = a[0][:3] if a else None
        if tag == "turn":
            turn = int(a[0])
            if turn <= best:
                continue
            best = turn
            ups += by_turn
            for (scope, fam), c in on.items():
                low, high = conditions.DURATIONS.get(fam, conditions.DURATIONS.get(c["name"], (None, None)))
                layers, passed = conditions.LAYERS.get(c["name"]), ups - c["clock"]
                if high is None or layers or passed < high:
                    left = lambda n, p=passed: n - p if n is not None and n > p else None
                    out.append((turn, scope, c["name"], c["value"], layers and min(layers, c["level"]), c["since"], left(low), left(high)))
        elif tag == "upkeep":
            ups += 1
        elif tag == "-weather":
            now = on.get(("field", "weather"))
            if name == "none":
                on.pop(("field", "weather"), None)
            elif not ("[upkeep]" in a and now and now["name"] == name):
                start("field", "weather", name)
        elif tag in ("-fieldstart", "-sidestart", "-start"):
            scope = "field" if tag == "-fieldstart" else a[0][:2] if tag == "-sidestart" else slot
            value = moves.get(slot) if name == "Encore" else (a[2] if len(a) > 2 else None) if name == "Disable" else name[-1] if family == "perish" else None
            start(scope, family, name, value)
        elif tag in ("-fieldend", "-sideend", "-end"):
            scope = "field" if tag == "-fieldend" else a[0][:2] if tag == "-sideend" else slot
            if (scope, family) in on and on[scope, family]["name"] == name:
                del on[scope, family]
        elif tag == "-swapsideconditions":
            on = {(CUT.get(k, k), f): c for (k, f), c in on.items()}
        elif tag == "move":
            moves[slot] = a[1]
        elif tag in ("switch", "drag", "faint"):
            if "[from] Baton Pass" not in a:
                on = {k: c for k, c in on.items() if k[0] != slot}
                if tag != "faint":
                    moves.pop(slot, None)
    return sorted(out, key=repr)


COLUMNS = ("turn", "scope", "name", "value", "level", "since_turn", "turns_left", "turns_left_max")


def rows(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["game_id"], []).append(tuple(r[c] for c in COLUMNS))
    return {k: sorted(v, key=repr) for k, v in by.items()}


def test_conditions_against_a_loop(spark):
    for line in (s._TIMED, s._VOLATILE):
        logs = s.logs_of(spark, SF, line)
        want = {r["game_id"]: walk(r["log"]) for r in logs.collect()}
        got = rows(conditions.timed(logs))
        assert got == {k: v for k, v in want.items() if v} and sum(map(len, got.values())) > 150


def test_a_log_by_hand(spark):
    log = """|start
|switch|p1a: A|Aa, L50|100/100
|switch|p2a: B|Bb, L50|100/100
|-weather|RainDance|[from] ability: Drizzle|[of] p2a: B
|turn|1
|-sidestart|p1: x|move: Tailwind
|-sidestart|p2: y|Spikes
|-sidestart|p2: y|Spikes
|move|p1a: A|Tackle|p2a: B
|-start|p1a: A|Encore
|-start|p2a: B|confusion
|-weather|RainDance|[upkeep]
|upkeep
|switch|p2a: C|Cc, L50|100/100|[from] Baton Pass
|-fieldstart|move: Trick Room
|turn|2
|-swapsideconditions
|upkeep
|turn|3
|-weather|none
|switch|p1a: D|Dd, L50|100/100
|upkeep
|turn|4
|turn|4
|upkeep
|turn|5"""
    got = rows(conditions.timed(spark.createDataFrame([("g", log), ("none", None), ("empty", ""), ("no turns", "|-weather|Snow")], "game_id string, log string")))
    assert list(got) == ["g"] and got["g"] == walk(log)
    of = lambda t, n: [x for x in got["g"] if x[0] == t and x[2] == n]
    assert of(1, "RainDance") == [(1, "field", "RainDance", None, None, 0, 5, 8)]
    assert of(2, "RainDance") == [(2, "field", "RainDance", None, None, 0, 4, 7)] and not of(4, "RainDance")
    assert of(2, "Trick Room") == [(2, "field", "Trick Room", None, None, 1, 5, 5)]  # began after the upkeep
    assert of(2, "Tailwind") == [(2, "p1", "Tailwind", None, None, 1, 3, 3)] and of(3, "Tailwind") == [(3, "p2", "Tailwind", None, None, 1, 2, 2)] and not of(5, "Tailwind")
    assert of(2, "Spikes") == [(2, "p2", "Spikes", None, 2, 1, None, None)] and of(5, "Spikes")[0][1] == "p1"
    assert of(3, "Encore") == [(3, "p1a", "Encore", "Tackle", None, 1, 1, 1)] and not of(4, "Encore")
    assert of(3, "confusion") == [(3, "p2a", "confusion", None, None, 1, None, 3)] and not of(5, "Encore")


def test_rendering(spark):
    held = spark.createDataFrame([("g", 3, "p1", "Tailwind", None, None, 1, 1, 1), ("g", 3, "p1", "Spikes", None, 2, 1, None, None), ("g", 3, "field", "Trick Room", None, None, 2, 4, 4)], "game_id string, turn int, scope string, name string, value string, level int, since_turn int, turns_left int, turns_left_max int")
    assert {r["scope"]: r["conditions"] for r in conditions.by_scope(held).collect()} == {"p1": '{"Spikes":{"level":2},"Tailwind":{"turnsLeft":1}}', "field": '{"Trick Room":{"turnsLeft":4}}'}
    assert conditions.lines_of(held).collect()[0]["text"] == "field: Trick Room (4 turns left)\np1: Spikes x2, Tailwind (1 turn left)"


def test_intervals(spark):
    marks = spark.createDataFrame([("a", 1, True, 0), ("a", 2, True, 1), ("a", 5, False, 3), ("a", 6, False, 3), ("a", 8, True, 4), ("b", 3, False, 0), ("b", 4, True, 2)], "k string, pos int, starts boolean, tick long")
    got = {(r["k"], r["pos"]): (r["until_tick"], r["ended"], r["level"]) for r in spans.intervals(marks, ["k"], ["pos"], "starts", "tick").collect()}
    assert got == {("a", 1): (1, "restart", 1), ("a", 2): (3, "end", 2), ("a", 8): (None, None, 1), ("b", 4): (None, None, 1)}


def who(log):
    """pos: (tag, ident, shown, named, individual, looks like), by finding every stint's end first."""
    lines = [(p, *x.split("|")[1:]) for p, x in enumerate(log.split("\n"))]
    out, for_good, now = {}, {}, {}
    for p, tag, *a in lines:
        if tag == "turn":
            continue
        slot = a[0][:3]
        head = lambda x: x.split(",")[0].strip()
        nick = lambda x: x.split(":", 1)[1].strip()
        if tag in ("switch", "drag"):
            now[slot] = {"shown": None}
        st = now.setdefault(slot, {"shown": None})
        if tag in ("switch", "drag", "replace"):
            st |= {"shown": head(a[1]), "nick": nick(a[0])}
        end = next((q for q, t, *b in lines if q > p and t in ("switch", "drag") and b[0][:3] == slot), 10**9)
        begin = max([q for q, t, *b in lines if q <= p and t in ("switch", "drag") and b[0][:3] == slot], default=-1)
        off = [(q, b) for q, t, *b in lines if begin <= q < end and t == "replace" and b[0][:3] == slot]
        true = off[-1] if off else None
        who_ = nick(true[1][0]) if true else st.get("nick")
        if tag in ("-formechange", "detailschange"):
            st["here"] = head(a[1])
        if tag == "detailschange":
            for_good[slot[:2], who_] = head(a[1])
        base = head(true[1][1]) if true else st["shown"]
        named = st.get("here") or for_good.get((slot[:2], who_)) or (base if st["shown"] else None)
        if tag == "-transform" and (other := now.get(a[1][:3], {}).get("last")):
            st["looks"] = other
        st["last"] = named or st.get("last")
        ident = f"{slot}: {nick(true[1][0])}" if true and p < true[0] else a[0]
        out[p] = ("-unmasked" if tag == "replace" else tag, ident, st["shown"], named, who_, st.get("looks"))
    return out


def test_identities_against_a_loop(spark):
    logs = s.logs_of(spark, SF, s._WHO)
    got = {}
    for r in s.identity_lines(spark, SF).collect():
        got.setdefault(r["game_id"], {})[r["pos"]] = tuple(r[c] for c in ("tag", "ident", "shown", "named", "individual", "looks_like"))
    want = {r["game_id"]: who(r["log"]) for r in logs.collect()}
    # what was last seen in a slot goes on into the next stint until somebody is named
    assert {k: {p: x[:5] for p, x in v.items()} for k, v in got.items()} == {k: {p: x[:5] for p, x in v.items()} for k, v in want.items() if v}
    assert sum(x[5] is not None for v in got.values() for x in v.values()) > 50


def test_an_illusion_by_hand(spark):
    log = """|switch|p1a: Bird|Bird, L50|100/100
|switch|p2a: Foe|Foe, L50|100/100
|turn|1
|switch|p1a: Cat|Cat, L50, F|100/100
|move|p2a: Foe|Hit|p1a: Cat
|-damage|p1a: Cat|60/100
|replace|p1a: Fox|Fox-H, L50, M
|-end|p1a: Fox|Illusion
|turn|2
|switch|p1a: Bird|Bird, L50|100/100
|detailschange|p1a: Bird|Bird-Mega, L50
|-transform|p2a: Foe|p1a: Bird
|turn|3
|switch|p1a: Cat|Cat, L50, F|100/100
|switch|p1a: Bird|Bird-Mega, L50|90/100
|move|p1a: Bird|Peck|p2a: Foe
|turn|4"""
    logs = spark.createDataFrame([("g", log), ("n", None)], "game_id string, log string")
    d = {r["pos"]: r for r in identity.corrected(protocol.lines(logs)).collect()}
    assert d[3]["args"][:2] == ["p1a: Fox", "Fox-H, L50, M"] and d[3]["named"] == "Fox-H" and d[3]["shown"] == "Cat"
    assert d[5]["args"][0] == "p1a: Fox" and d[6]["tag"] == "-unmasked"
    assert d[11]["looks_like"] == "Bird-Mega" and d[15]["named"] == "Bird-Mega" and d[13]["named"] == "Cat"
    switches = [(r["from_species"], r["to_species"]) for r in protocol.events(logs, identity.corrected).where("type = 'switch' AND side = 'p1'").orderBy("event_pos").collect()]
    assert switches == [(None, "Bird"), ("Bird", "Fox-H"), ("Fox-H", "Bird"), ("Bird", "Cat"), ("Cat", "Bird-Mega")]
    snap = {(r["turn"], r["slot"]): r for r in protocol.snapshots(logs, identity.corrected).collect()}
    assert snap[2, "p1a"]["species"] == "Fox-H" and snap[2, "p1a"]["hp_percent"] == 60.0 and snap[2, "p1a"]["seen_species"] == ["Bird", "Fox-H"]
    assert {r["species"]: r["pretended"] for r in identity.individuals(logs).where("side = 'p1'").collect()} == {"Bird": [], "Cat": [], "Fox-H": ["Cat"]}
    assert next(r["aliases"] for r in identity.individuals(logs).collect() if r["individual"] == "Bird") == ["Bird", "Bird-Mega"]
    plain = {(r["turn"], r["slot"]): r["species"] for r in protocol.snapshots(logs).collect()}
    assert plain[2, "p1a"] == "Fox-H"  # the replace line itself is read there, but what was before stays
