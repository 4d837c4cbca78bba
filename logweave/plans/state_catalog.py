"""Queries of timed conditions and of identities: a user's events read as lines of a log with starts, ends, illusions and formes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.domain import conditions, identity, protocol
from logweave.functions import packed
from logweave.operators import sequence
from logweave.plans.catalog import query, spread, table

_BEGIN = "CASE WHEN event_id % 7 > 0 THEN '|upkeep' || chr(10) ELSE '' END || '|turn|' || n"
_SIDE = "CASE event_id % 3 WHEN 0 THEN 'move: Tailwind' WHEN 1 THEN 'Reflect' ELSE 'Spikes' END"
_TIMED = f"""CASE event_type WHEN 'click' THEN '|-sidestart|p' || (event_id % 2 + 1) || ': x|' || {_SIDE} WHEN 'error' THEN '|-sideend|p' || (event_id % 2 + 1) || ': x|' || {_SIDE}
WHEN 'purchase' THEN '|-weather|' || CASE event_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'RainDance' WHEN 2 THEN 'RainDance|[upkeep]' ELSE 'SunnyDay' END
WHEN 'signup' THEN CASE event_id % 5 WHEN 0 THEN '|-fieldstart|move: Trick Room' WHEN 1 THEN '|-fieldend|move: Trick Room' WHEN 2 THEN '|-fieldstart|move: Electric Terrain'
WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN '|-fieldstart|move: Grassy Terrain' ELSE '|-fieldend|move: Grassy Terrain' END ELSE '|-swapsideconditions' END ELSE {_BEGIN} END"""
_SLOT = "'p' || (event_id % 2 + 1) || 'a'"
_VOLATILE = f"""CASE event_type WHEN 'signup' THEN '|switch|' || {_SLOT} || ': x|S' || (event_id % 5) || ', L50|100/100' || CASE WHEN event_id % 3 = 0 THEN '|[from] Baton Pass' ELSE '' END
WHEN 'click' THEN '|-start|' || {_SLOT} || ': x|' || CASE event_id % 6 WHEN 0 THEN 'move: Taunt' WHEN 1 THEN 'Encore' WHEN 2 THEN 'Disable|M' || (event_id % 4) WHEN 3 THEN 'perish' || (event_id % 9 % 3 + 1) WHEN 4 THEN 'Substitute' ELSE 'confusion' END
WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN '|faint|' || {_SLOT} || ': x' ELSE '|-end|' || {_SLOT} || ': x|' || CASE event_id % 5 WHEN 0 THEN 'move: Taunt' WHEN 1 THEN 'Encore' WHEN 2 THEN 'Disable' WHEN 3 THEN 'Substitute' ELSE 'confusion' END END
WHEN 'purchase' THEN '|move|' || {_SLOT} || ': x|M' || (event_id % 5) || '|p1a: y' ELSE {_BEGIN} END"""
_WHO = f"""CASE event_type WHEN 'signup' THEN '|switch|' || {_SLOT} || ': N' || (event_id % 4) || '|S' || (event_id % 4) || ', L50|100/100'
WHEN 'purchase' THEN CASE event_id % 4 WHEN 0 THEN '|replace|' || {_SLOT} || ': Z' || (event_id % 3) || '|Zo' || (event_id % 3) || ', L50' WHEN 1 THEN '|-formechange|' || {_SLOT} || ': x|F' || (event_id % 3) || '|'
WHEN 2 THEN '|detailschange|' || {_SLOT} || ': x|D' || (event_id % 3) || ', L50' ELSE '|-transform|' || {_SLOT} || ': x|p' || (2 - event_id % 2) || 'a: y' END
WHEN 'click' THEN '|move|' || {_SLOT} || ': x|M' || (event_id % 4) || '|p1a: y' WHEN 'error' THEN '|cant|' || {_SLOT} || ': x|par' ELSE '|turn|' || n END"""


def logs_of(spark: SparkSession, sf_dir: str, line: str) -> DataFrame:
    """game_id, log: a line (or two) for each event of a user; ``n`` counts the views."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    e = e.withColumn("n", F.count_if(F.col("event_type") == "view").over(sequence.so_far(["user_id"], ["ts", "event_id"])))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", F.expr(line).alias("line")))), lambda x: x["line"])
    return e.groupBy(F.col("user_id").cast("string").alias("game_id")).agg(F.array_join(lines, "\n").alias("log"))


_CLOCK = """e0 AS (SELECT user_id, event_id, event_type, row_number() OVER w AS pos, count(*) FILTER (event_type = 'view') OVER w AS n, count(*) FILTER (event_type = 'view' AND event_id % 7 > 0) OVER w AS ups, count(*) FILTER (event_type = 'signup' AND event_id % 5 = 4) OVER w % 2 AS lane
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
e AS (SELECT * EXCLUDE (ups), CASE WHEN max(ups) OVER (PARTITION BY user_id) > 0 THEN ups ELSE n END AS clock, 'p' || (event_id % 2 + 1) AS s, 'p' || (2 - event_id % 2) AS o FROM e0)"""
# The last mark of each kind before each turn says whether it holds; no intervals here.
_HELD = """m1 AS (SELECT *, lag(CASE WHEN starts THEN name ELSE '' END) OVER (PARTITION BY user_id, scope, family ORDER BY pos) AS before FROM m0),
m2 AS (SELECT *, last_value(CASE WHEN starts THEN name END IGNORE NULLS) OVER (PARTITION BY user_id, scope, family ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM m1 WHERE NOT (told AND coalesce(before = name, false))),
m3 AS (SELECT *, count(*) FILTER (NOT starts) OVER (PARTITION BY user_id, scope, family ORDER BY pos) AS run FROM m2 WHERE starts OR family = 'weather' OR was = name),
m AS (SELECT *, count(*) FILTER (starts) OVER (PARTITION BY user_id, scope, family, run ORDER BY pos) AS level FROM m3),
h AS (SELECT t.user_id, t.n AS turn, t.clock AS now, t.lane, t.pos AS at, scope, family, arg_max({'starts': starts, 'name': name, 'value': value, 'clock': m.clock, 'n': m.n, 'level': level, 'pos': m.pos}, m.pos) AS x
FROM e t JOIN m ON m.user_id = t.user_id AND m.pos < t.pos WHERE t.event_type = 'view' GROUP BY ALL),
d AS (SELECT *, now - x.clock AS passed, CASE WHEN family IN ('weather', 'terrain', 'Reflect', 'Trick Room', 'Disable') THEN 5 WHEN family = 'Tailwind' THEN 4 WHEN family IN ('Taunt', 'Encore') THEN 3 WHEN family = 'confusion' THEN 2 END AS shorter,
CASE WHEN family IN ('weather', 'terrain', 'Reflect') THEN 8 WHEN family IN ('Trick Room', 'Disable', 'confusion') THEN 5 WHEN family = 'Tailwind' THEN 4 WHEN family IN ('Taunt', 'Encore') THEN 3 END AS longer FROM h)"""
_LEFT = "CASE WHEN shorter > passed THEN shorter - passed END::INT AS turns_left, CASE WHEN longer > passed THEN longer - passed END::INT AS turns_left_max"
_TIMED_SQL = f"""WITH {_CLOCK}, m0 AS (SELECT user_id, pos, n, clock, CASE WHEN event_type IN ('purchase', 'signup') THEN 'field' WHEN lane = 1 THEN o ELSE s END AS scope,
CASE WHEN event_type = 'purchase' THEN 'weather' WHEN event_type = 'signup' THEN CASE WHEN event_id % 5 < 2 THEN 'Trick Room' ELSE 'terrain' END ELSE CASE event_id % 3 WHEN 0 THEN 'Tailwind' WHEN 1 THEN 'Reflect' ELSE 'Spikes' END END AS family,
CASE WHEN event_type = 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 'none' WHEN 3 THEN 'SunnyDay' ELSE 'RainDance' END WHEN event_type = 'signup' THEN CASE event_id % 5 WHEN 2 THEN 'Electric Terrain' WHEN 3 THEN 'Grassy Terrain' ELSE 'Trick Room' END
ELSE CASE event_id % 3 WHEN 0 THEN 'Tailwind' WHEN 1 THEN 'Reflect' ELSE 'Spikes' END END AS name, NULL AS value,
CASE event_type WHEN 'click' THEN true WHEN 'error' THEN false WHEN 'purchase' THEN event_id % 4 > 0 ELSE event_id % 5 IN (0, 2) OR event_id % 10 = 8 END AS starts, event_type = 'purchase' AND event_id % 4 = 2 AS told
FROM e WHERE event_type IN ('click', 'error', 'purchase') OR event_type = 'signup' AND event_id % 5 < 4), {_HELD},
held AS (SELECT user_id::VARCHAR AS game_id, turn::INT AS turn, CASE WHEN scope = 'field' OR lane = 0 THEN scope WHEN scope = 'p1' THEN 'p2' ELSE 'p1' END AS scope, x.name AS name, CASE WHEN family = 'Spikes' THEN least(x.level, 3) END::INT AS level, x.n::INT AS since_turn, {_LEFT}
FROM d WHERE x.starts AND (longer IS NULL OR passed < longer))"""


@query(f"{_TIMED_SQL} SELECT * FROM held")
def timed_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions.timed(logs_of(spark, sf_dir, _TIMED)).drop("value")


@query(
    f"""{_TIMED_SQL}, c AS (SELECT *, name || CASE WHEN level > 1 THEN ' x' || level ELSE '' END || CASE WHEN turns_left IS NULL THEN '' WHEN turns_left = 1 THEN ' (1 turn left)' ELSE ' (' || turns_left || ' turns left)' END AS told,
'"' || name || '":{{' || concat_ws(',', '"level":' || level, '"turnsLeft":' || turns_left) || '}}' AS told_json FROM held)
SELECT game_id, turn, scope, '{{' || js || '}}' AS conditions, scope || ': ' || told AS told FROM (SELECT game_id, turn, scope, string_agg(told_json, ',' ORDER BY name) AS js, string_agg(told, ', ' ORDER BY told) AS told FROM c GROUP BY ALL)"""
)
def condition_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = conditions.timed(logs_of(spark, sf_dir, _TIMED))
    told = conditions.lines_of(held).select("game_id", "turn", F.explode(F.split("text", "\n")).alias("told")).withColumn("scope", F.split_part("told", F.lit(":"), F.lit(1)))
    return conditions.by_scope(held).join(told, ["game_id", "turn", "scope"])


@query(
    f"""WITH {_CLOCK}, v AS (SELECT *, s || 'a' AS slot FROM e), m0 AS (SELECT user_id, pos, n, clock, slot AS scope, name AS family, CASE WHEN name = 'perish' THEN 'perish' || (event_id % 9 % 3 + 1) ELSE name END AS name, starts, false AS told,
CASE name WHEN 'Disable' THEN CASE WHEN starts THEN 'M' || (event_id % 4) END WHEN 'perish' THEN (event_id % 9 % 3 + 1)::VARCHAR WHEN 'Encore' THEN (SELECT arg_max('M' || (b.event_id % 5), b.pos) FROM v b WHERE b.user_id = v.user_id AND b.slot = v.slot AND b.pos < v.pos AND b.event_type = 'purchase'
AND b.pos > coalesce((SELECT max(c.pos) FROM v c WHERE c.user_id = v.user_id AND c.slot = v.slot AND c.pos < v.pos AND c.event_type = 'signup' AND c.event_id % 3 > 0), 0)) END AS value
FROM (SELECT *, event_type = 'click' AS starts, CASE WHEN event_type = 'click' THEN CASE event_id % 6 WHEN 0 THEN 'Taunt' WHEN 1 THEN 'Encore' WHEN 2 THEN 'Disable' WHEN 3 THEN 'perish' WHEN 4 THEN 'Substitute' ELSE 'confusion' END
ELSE CASE event_id % 5 WHEN 0 THEN 'Taunt' WHEN 1 THEN 'Encore' WHEN 2 THEN 'Disable' WHEN 3 THEN 'Substitute' ELSE 'confusion' END END AS name FROM v WHERE event_type = 'click' OR event_type = 'error' AND event_id % 3 > 0) v), {_HELD},
g AS (SELECT d.*, (SELECT max(pos) FROM v WHERE v.user_id = d.user_id AND v.slot = d.scope AND v.pos < d.at AND (event_type = 'signup' AND event_id % 3 > 0 OR event_type = 'error' AND event_id % 3 = 0)) AS gone FROM d)
SELECT user_id::VARCHAR AS game_id, turn::INT AS turn, scope, x.name AS name, x.value AS value, x.n::INT AS since_turn, {_LEFT} FROM g WHERE x.starts AND x.pos > coalesce(gone, 0) AND (longer IS NULL OR passed < longer)"""
)
def timed_volatiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions.timed(logs_of(spark, sf_dir, _VOLATILE)).drop("level")


_WHO_SQL = """WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER w - 1 AS pos, 'p' || (event_id % 2 + 1) || 'a' AS slot, 'p' || (2 - event_id % 2) || 'a' AS other, count(*) FILTER (event_type = 'view') OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, CASE event_type WHEN 'signup' THEN 'switch' WHEN 'click' THEN 'move' WHEN 'error' THEN 'cant' WHEN 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 'replace' WHEN 1 THEN '-formechange' WHEN 2 THEN 'detailschange' ELSE '-transform' END END AS tag,
count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id, slot ORDER BY pos) AS stint FROM e WHERE event_type <> 'view'),
a AS (SELECT *, CASE tag WHEN 'switch' THEN 'N' || (event_id % 4) WHEN 'replace' THEN 'Z' || (event_id % 3) END AS nick0, CASE tag WHEN 'switch' THEN 'S' || (event_id % 4) WHEN 'replace' THEN 'Zo' || (event_id % 3) END AS sp0,
CASE tag WHEN '-formechange' THEN 'F' || (event_id % 3) WHEN 'detailschange' THEN 'D' || (event_id % 3) END AS forme FROM k),
b AS (SELECT *, last_value(nick0 IGNORE NULLS) OVER w AS nick, last_value(sp0 IGNORE NULLS) OVER w AS shown, last_value(forme IGNORE NULLS) OVER w AS here FROM a WINDOW w AS (PARTITION BY user_id, slot, stint ORDER BY pos ROWS UNBOUNDED PRECEDING)),
mask AS (SELECT user_id, slot, stint, max(pos) AS off, arg_max(nick0, pos) AS true_nick, arg_max(sp0, pos) AS true_sp FROM a WHERE tag = 'replace' GROUP BY ALL),
c AS (SELECT b.*, coalesce(true_nick, nick) AS individual, CASE WHEN shown IS NOT NULL THEN coalesce(true_sp, shown) END AS base, off, true_nick, true_sp FROM b LEFT JOIN mask USING (user_id, slot, stint)),
f AS (SELECT *, coalesce(here, last_value(CASE WHEN tag = 'detailschange' THEN forme END IGNORE NULLS) OVER (PARTITION BY user_id, left(slot, 2), individual ORDER BY pos ROWS UNBOUNDED PRECEDING), base) AS named FROM c),
tr AS (SELECT f.user_id, f.pos, f.slot, f.stint, (SELECT arg_max(g.named, g.pos) FROM f g WHERE g.user_id = f.user_id AND g.slot = f.other AND g.pos < f.pos AND g.named IS NOT NULL) AS target FROM f WHERE tag = '-transform'),
r AS (SELECT f.*, (SELECT arg_max(target, tr.pos) FROM tr WHERE tr.user_id = f.user_id AND tr.slot = f.slot AND tr.stint = f.stint AND tr.pos <= f.pos AND target IS NOT NULL) AS looks_like FROM f)"""


@query(
    f"""{_WHO_SQL} SELECT user_id::VARCHAR AS game_id, pos::INT AS pos, CASE tag WHEN 'replace' THEN '-unmasked' ELSE tag END AS tag, slot, slot || ': ' || CASE WHEN pos < off THEN true_nick ELSE coalesce(nick0, 'x') END AS ident, shown, named, individual, looks_like FROM r"""
)
def identity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = identity.corrected(protocol.lines(logs_of(spark, sf_dir, _WHO)))
    return d.where("tag <> 'turn'").select("game_id", "pos", "tag", F.substring(F.col("args")[0], 1, 3).alias("slot"), F.col("args")[0].alias("ident"), "shown", "named", "individual", "looks_like")


@query(
    f"""{_WHO_SQL}, i AS (SELECT user_id, left(slot, 2) AS side, individual, named, min(pos) AS p FROM r WHERE individual IS NOT NULL AND named IS NOT NULL GROUP BY ALL),
x AS (SELECT user_id, left(slot, 2) AS side, individual, shown, min(pos) AS p FROM r WHERE tag = 'switch' AND off IS NOT NULL AND shown <> true_sp GROUP BY ALL),
n AS (SELECT user_id, left(slot, 2) AS side, individual, count(*) FILTER (tag = 'switch') AS stints FROM r WHERE individual IS NOT NULL AND named IS NOT NULL GROUP BY ALL)
SELECT user_id::VARCHAR AS game_id, side, individual, aliases[1] AS species, array_to_string(aliases, ',') AS aliases, coalesce(array_to_string(posed, ','), '') AS pretended, stints
FROM (SELECT user_id, side, individual, list(named ORDER BY p) AS aliases FROM i GROUP BY ALL) LEFT JOIN (SELECT user_id, side, individual, list(shown ORDER BY p) AS posed FROM x GROUP BY ALL) USING (user_id, side, individual) JOIN n USING (user_id, side, individual)"""
)
def individual_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = identity.individuals(logs_of(spark, sf_dir, _WHO))
    return d.withColumn("aliases", F.array_join("aliases", ",")).withColumn("pretended", F.array_join("pretended", ","))


@query(
    f"""{_WHO_SQL}, t AS (SELECT user_id, n, min(pos) AS at FROM e WHERE event_type = 'view' GROUP BY ALL),
q AS (SELECT t.user_id, t.n, slot, arg_max(coalesce(named, ''), r.pos) AS species FROM t JOIN r ON r.user_id = t.user_id AND r.pos < t.at GROUP BY ALL),
y AS (SELECT user_id, n, side, string_agg(base, ',' ORDER BY p) AS seen FROM (SELECT t.user_id, t.n, left(slot, 2) AS side, coalesce(true_sp, sp0) AS base, min(r.pos) AS p FROM t JOIN r ON r.user_id = t.user_id AND r.pos < t.at WHERE tag = 'switch' GROUP BY ALL) GROUP BY ALL)
SELECT q.user_id::VARCHAR AS game_id, q.n::INT AS turn, slot, nullif(species, '') AS species, coalesce(seen, '') AS seen FROM q LEFT JOIN y ON y.user_id = q.user_id AND y.n = q.n AND y.side = left(q.slot, 2)"""
)
def corrected_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = protocol.snapshots(logs_of(spark, sf_dir, _WHO), identity.corrected)
    return s.select("game_id", "turn", "slot", "species", F.array_join("seen_species", ",").alias("seen"))


_PACKED = """'Nick|Mon' || (k % 3) || 'A|SafetyGoggles|Intimidate|' || CASE k % 3 WHEN 0 THEN 'KnockOff' WHEN 1 THEN 'KnockOff,FakeOut' ELSE 'KnockOff,FakeOut,Uturn,Protect,Spare' END || '|' || CASE WHEN k % 2 = 0 THEN 'Bold' ELSE '' END || '|' || CASE WHEN k % 5 = 0 THEN '4,,,,,' || (k % 7) WHEN k % 5 = 1 THEN '0,0,0,0,0,0' ELSE '' END
|| '|' || CASE WHEN k % 4 = 0 THEN 'F' ELSE '' END || '|' || CASE WHEN k % 3 = 0 THEN ',0,,,,' ELSE '' END || '||' || CASE WHEN k % 6 = 0 THEN '' ELSE CAST(k % 100 AS STRING) END || '|' || CASE WHEN k % 2 = 1 THEN ',,,,,Fire' ELSE '' END || CASE k % 4 WHEN 1 THEN ']Solo|||||||||||' WHEN 2 THEN ']broken|x' ELSE '' END"""


@query(f"""WITH p AS (SELECT p_partkey AS k FROM part), s AS (SELECT k, 1 AS place, 'Mon ' || (k % 3) || ' A' AS species, 'Safety Goggles' AS item, CASE k % 3 WHEN 0 THEN 'Knock Off,,,' WHEN 1 THEN 'Knock Off,Fake Out,,' ELSE 'Knock Off,Fake Out,Uturn,Protect' END AS moves, CASE WHEN k % 2 = 1 THEN 'Fire' END AS tera_type,
CASE WHEN k % 6 = 0 THEN 50 ELSE k % 100 END::INT AS level, CASE WHEN k % 4 = 0 THEN 'F' END AS gender, CASE WHEN k % 2 = 0 THEN 'Bold' END AS nature, CASE WHEN k % 5 = 0 THEN 4 END::INT AS hp, CASE WHEN k % 5 = 0 THEN k % 7 END::INT AS spe, CASE WHEN k % 3 = 0 THEN 0 END::INT AS atk_iv FROM p WHERE k % 4 <> 2
UNION ALL SELECT k, 2, 'Solo', '', ',,,', NULL, 50, NULL, NULL, NULL, NULL, NULL FROM p WHERE k % 4 = 1)
SELECT k AS p_partkey, place, species, item, moves, tera_type, level, gender, nature, hp, spe, atk_iv, 1 AS same FROM s""")
def packed_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded sets; ``same``: encoding and decoding once more gives the same sets."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("k")), "p_partkey").select("p_partkey", packed.decoded(F.expr(_PACKED)).alias("team"))
    p = p.withColumn("same", (packed.sets(packed.pack(F.col("team"))).cast("string") == F.col("team").cast("string")).cast("int"))
    s = p.select("p_partkey", "same", F.posexplode("team").alias("place", "s"))
    return s.select("p_partkey", (F.col("place") + 1).alias("place"), "s.species", "s.item", F.array_join("s.moves", ",").alias("moves"), "s.tera_type", "s.level", "s.gender", "s.nature", F.col("s.evs.hp").alias("hp"), F.col("s.evs.spe").alias("spe"), F.col("s.ivs.atk").alias("atk_iv"), "same")
