"""Queries of the game-log operators over the shared tables: a user's events read as a protocol log, parts and lines as stats and hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.domain import inference, protocol, series, texts, usage
from logweave.functions import scalars
from logweave.operators import intervals, quality, relational, sequence, textops
from logweave.plans.catalog import query, table

_LINE = """CASE event_type WHEN 'signup' THEN '|switch|' || slot || ': x|S' || (event_id % 5) || ', L50|100/100' WHEN 'click' THEN '|move|' || slot || ': x|M' || (event_id % 4) || '|' || other || ': y'
WHEN 'purchase' THEN '|-damage|' || other || ': y|' || (event_id % 100) || '/100' WHEN 'error' THEN '|cant|' || slot || ': x|par' ELSE '|turn|' || n END"""
_EVENT_LINES = f"""e AS (SELECT user_id, event_id, event_type, 'p' || (event_id % 2 + 1) || 'a' AS slot, 'p' || (2 - event_id % 2) || 'a' AS other, count(*) FILTER (event_type = 'view') OVER w AS n,
row_number() OVER w - 1 AS pos FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
l AS (SELECT user_id, pos, {_LINE} AS line, event_type, n FROM e)"""


_STATES = f"""{_EVENT_LINES}, ev AS (SELECT *, CASE WHEN event_type = 'purchase' THEN other ELSE slot END AS s, CASE WHEN event_type = 'signup' THEN 'S' || (event_id % 5) END AS sp, CASE WHEN event_type = 'click' THEN 'M' || (event_id % 4) END AS mv,
CASE WHEN event_type = 'signup' THEN 100.0 WHEN event_type = 'purchase' THEN (event_id % 100)::DOUBLE END AS hp, count(*) FILTER (event_type <> 'purchase') OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM e),
st AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id, s ORDER BY pos ROWS UNBOUNDED PRECEDING) AS stint, coalesce(last_value(hp IGNORE NULLS) OVER b, 100.0) AS was, last_value(sp IGNORE NULLS) OVER b AS left_sp
FROM ev WHERE event_type IN ('signup', 'click', 'purchase', 'error') WINDOW b AS (PARTITION BY user_id, s ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT user_id, n AS turn, min(pos) AS at FROM ev WHERE event_type NOT IN ('signup', 'click', 'purchase', 'error') GROUP BY 1, 2),
q AS (SELECT t.turn, st.* FROM t JOIN st ON st.user_id = t.user_id AND st.pos < t.at),
cur AS (SELECT user_id, turn, s, max(stint) AS stint, arg_max(sp, pos) FILTER (sp IS NOT NULL) AS species FROM q GROUP BY ALL),
now AS (SELECT user_id, turn, s, arg_max(hp, pos) FILTER (hp IS NOT NULL) AS hp, arg_max(mv, pos) FILTER (mv IS NOT NULL) AS last_move FROM q JOIN cur USING (user_id, turn, s, stint) GROUP BY ALL),
moves AS (SELECT user_id, turn, s, string_agg(mv, ',' ORDER BY p) AS revealed FROM (SELECT user_id, turn, s, mv, min(pos) AS p FROM q JOIN cur USING (user_id, turn, s, stint) WHERE mv IS NOT NULL GROUP BY ALL) GROUP BY ALL),
seen AS (SELECT user_id, turn, side, string_agg(sp, ',' ORDER BY p) AS seen FROM (SELECT user_id, turn, left(s, 2) AS side, sp, min(pos) AS p FROM q WHERE sp IS NOT NULL GROUP BY ALL) GROUP BY ALL),
snap AS (SELECT c.user_id::VARCHAR AS game_id, c.turn::INT AS turn, c.s AS slot, species, coalesce(hp, 100.0) AS hp_percent, coalesce(hp, 100.0) <= 0 AS fainted, last_move, coalesce(revealed, '') AS revealed, 0::INT AS side_faints, coalesce(seen, '') AS seen
FROM cur c LEFT JOIN now USING (user_id, turn, s) LEFT JOIN moves USING (user_id, turn, s) LEFT JOIN seen ON seen.user_id = c.user_id AND seen.turn = c.turn AND side = left(c.s, 2))"""
_LABELS = f"""{_STATES}, h AS (SELECT user_id, grp, list_sort(list_distinct(list(s))) AS targets FROM st WHERE event_type = 'purchase' GROUP BY ALL),
own AS (SELECT user_id::VARCHAR AS game_id, n AS turn, arg_max(sp, pos) FILTER (sp IS NOT NULL) AS sp, arg_min(mv, pos) FILTER (mv IS NOT NULL) AS mv, arg_min(coalesce(targets, []), pos) FILTER (mv IS NOT NULL) AS targets, bool_or(event_type = 'error') AS cant
FROM st LEFT JOIN h USING (user_id, grp) WHERE s = 'p1a' AND event_type <> 'purchase' GROUP BY ALL),
act AS (SELECT game_id, turn, CASE WHEN species IS NULL OR fainted THEN 'pass' WHEN sp IS NOT NULL THEN 'switch' WHEN mv IS NOT NULL THEN 'move' WHEN cant THEN 'pass' END AS kind, mv, targets, sp
FROM (SELECT DISTINCT game_id, turn FROM snap) LEFT JOIN (SELECT * FROM snap WHERE slot = 'p1a') USING (game_id, turn) LEFT JOIN own USING (game_id, turn)),
labels AS (SELECT game_id, turn, 'p1a' AS slot, kind AS action_type, CASE WHEN kind = 'move' THEN mv END AS move, CASE WHEN kind = 'move' THEN CASE len(targets) WHEN 0 THEN 'self' WHEN 1 THEN targets[1] ELSE 'spread' END END AS target, CASE WHEN kind = 'switch' THEN sp END AS switch_to FROM act
UNION ALL SELECT game_id, turn, 'p1b', 'pass', NULL, NULL, NULL FROM act)"""


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """game_id, log: one line for each event of a user."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    n = F.count_if(F.col("event_type") == "view").over(sequence.so_far(["user_id"], ["ts", "event_id"]))
    pos = F.row_number().over(sequence.ordered(["user_id"], ["ts", "event_id"]))
    odd = (F.col("event_id") % 2).cast("string")
    e = e.select("user_id", "event_type", "event_id", n.alias("n"), pos.alias("pos"), F.concat(F.lit("p"), (odd + 1).cast("int").cast("string"), F.lit("a")).alias("slot"), F.concat(F.lit("p"), (2 - odd).cast("int").cast("string"), F.lit("a")).alias("other"))
    line = F.expr(_LINE)
    return e.groupBy(F.col("user_id").cast("string").alias("game_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"]), "\n").alias("log"))


@query(f"""WITH {_EVENT_LINES} SELECT user_id::VARCHAR AS game_id, pos::INT AS pos, split_part(line, '|', 2) AS tag, n::INT AS turn,
count(*) FILTER (event_type <> 'purchase') OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS move_group FROM l""")
def protocol_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return protocol.lines(event_logs(spark, sf_dir)).select("game_id", "pos", "tag", "turn", F.col("group").alias("move_group"))


@query(f"""WITH {_EVENT_LINES} SELECT user_id::VARCHAR AS game_id, count(*) FILTER (event_type = 'click') AS moves, count(*) FILTER (event_type = 'signup') AS switches, count(*) FILTER (event_type = 'error') AS cants FROM l
WHERE event_type IN ('click', 'signup', 'error') GROUP BY 1""")
def protocol_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = protocol.events(event_logs(spark, sf_dir))
    count = lambda t: F.count_if(F.col("type") == t)
    return e.groupBy("game_id").agg(count("move").alias("moves"), count("switch").alias("switches"), count("cant_move").alias("cants"))


@query(f"""WITH {_EVENT_LINES}, g AS (SELECT *, count(*) FILTER (event_type <> 'purchase') OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM l),
m AS (SELECT user_id, grp FROM g WHERE event_type = 'click'), h AS (SELECT g.user_id, g.grp, count(*) AS n FROM g JOIN m USING (user_id, grp) WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT user_id::VARCHAR AS game_id, sum(n)::BIGINT AS hits FROM h GROUP BY 1""")
def protocol_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = protocol.events(event_logs(spark, sf_dir)).where("type = 'move' AND hits IS NOT NULL")
    return e.groupBy("game_id").agg(F.sum(F.size("hits")).alias("hits"))


@query(f"WITH {_STATES} SELECT * FROM snap")
def protocol_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = protocol.snapshots(event_logs(spark, sf_dir))
    return s.select("game_id", "turn", "slot", "species", "hp_percent", "fainted", "last_move", F.array_join("revealed_moves", ",").alias("revealed"), "side_faints", F.array_join("seen_species", ",").alias("seen"))


@query(f"WITH {_LABELS} SELECT * FROM labels")
def turn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir)
    s = protocol.snapshots(logs)
    return series.labels(s, s, protocol.events(logs)).select("game_id", "turn", "slot", "action.action_type", "action.move", "action.target", "action.switch_to")


@query(f"""WITH {_STATES}, hit AS (SELECT user_id, grp, string_agg(s || ' ' || printf('%.1f', was) || '→' || printf('%.1f', hp) || CASE WHEN hp <= 0 THEN ' KO' ELSE '' END, ', ' ORDER BY pos) AS hits FROM st WHERE event_type = 'purchase' GROUP BY ALL),
told AS (SELECT user_id, n, pos, CASE event_type WHEN 'click' THEN slot || ': ' || mv || coalesce(' → ' || hits, '') WHEN 'signup' THEN slot || ': ' || coalesce(left_sp, '–') || ' ⇒ ' || sp ELSE slot || ': can''t move (par)' END AS told FROM st LEFT JOIN hit USING (user_id, grp) WHERE event_type <> 'purchase')
SELECT user_id::VARCHAR AS game_id, n::INT AS turn, 'Turn ' || n || chr(10) || '  ' || string_agg(told, chr(10) || '  ' ORDER BY pos) AS text FROM told GROUP BY user_id, n""")
def turn_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.history(protocol.events(event_logs(spark, sf_dir)))


@query(f"WITH {_LABELS} SELECT game_id, turn, string_agg(action_type, ',' ORDER BY slot) AS actions FROM labels GROUP BY ALL HAVING count(*) = count(action_type)")
def clear_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir)
    s = protocol.snapshots(logs)
    clear = series.clear_turns(series.labels(s, s, protocol.events(logs)))
    return clear.select("game_id", "turn", F.array_join(F.transform("actions", lambda x: x["action"]["action_type"]), ",").alias("actions"))


@query(f"""WITH {_STATES} SELECT game_id, turn, '=== GAME STATE ===' || chr(10) || string_agg('[' || slot || '] ' || coalesce(species, '?') || ' | HP ' || CASE WHEN fainted THEN '0%' ELSE printf('%.1f', hp_percent) || '%' END
|| CASE WHEN revealed <> '' THEN ' | moves: ' || replace(revealed, ',', ', ') ELSE '' END, chr(10) ORDER BY slot) AS text FROM snap GROUP BY ALL""")
def state_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.state_lines(protocol.snapshots(event_logs(spark, sf_dir)))


_CONDITION = """CASE event_type WHEN 'click' THEN '|-sidestart|p' || (event_id % 2 + 1) || ': x|move: C' || (event_id % 3) WHEN 'error' THEN '|-sideend|p' || (event_id % 2 + 1) || ': x|move: C' || (event_id % 3)
WHEN 'purchase' THEN '|-weather|' || CASE WHEN event_id % 3 = 0 THEN 'none' ELSE 'W' || (event_id % 3) END WHEN 'signup' THEN '|-fieldstart|move: F' || (event_id % 2) ELSE '|turn|' || n END"""


@query("""WITH e AS (SELECT *, count(*) FILTER (event_type = 'view') OVER w AS n, row_number() OVER w AS pos FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
c AS (SELECT user_id, pos, CASE WHEN event_type IN ('click', 'error') THEN 'p' || (event_id % 2 + 1) ELSE 'field' END AS scope, CASE event_type WHEN 'purchase' THEN 'weather' WHEN 'signup' THEN 'F' || (event_id % 2) ELSE 'C' || (event_id % 3) END AS name,
CASE event_type WHEN 'click' THEN 'C' || (event_id % 3) WHEN 'signup' THEN 'F' || (event_id % 2) WHEN 'purchase' THEN CASE WHEN event_id % 3 > 0 THEN 'W' || (event_id % 3) END END AS v FROM e WHERE event_type IN ('click', 'error', 'purchase', 'signup')),
t AS (SELECT user_id, n, min(pos) AS at FROM e WHERE event_type = 'view' GROUP BY ALL),
h AS (SELECT c.user_id, n, scope, name, arg_max([v], pos)[1] AS v FROM t JOIN c ON c.user_id = t.user_id AND c.pos < t.at GROUP BY ALL)
SELECT user_id::VARCHAR AS game_id, n::INT AS turn, scope, v AS name FROM h WHERE v IS NOT NULL""")
def protocol_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    e = e.withColumn("n", F.count_if(F.col("event_type") == "view").over(sequence.so_far(["user_id"], ["ts", "event_id"])))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", F.expr(_CONDITION).alias("line")))), lambda x: x["line"])
    return protocol.conditions(e.groupBy(F.col("user_id").cast("string").alias("game_id")).agg(F.array_join(lines, "\n").alias("log")))


@query("""WITH x AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'mon-' ELSE 'Mon ' END || (event_id // 2 % 3) AS species, 'mon' || (event_id // 2 % 3) AS species_key, CASE WHEN value > 50 THEN 'I' || (event_id % 5) END AS item, 'M' || (event_id * 7 % 11) AS mv FROM events),
m AS (SELECT user_id, species_key, list_concat(list(mv ORDER BY p)[1:4], ['?', '?', '?', '?'])[1:4] AS moves FROM (SELECT user_id, species_key, mv, min(event_id) AS p FROM x GROUP BY ALL) GROUP BY ALL)
SELECT user_id, species_key, arg_min(species, ((species = lower(species))::INT, event_id)) AS species, arg_min(item, event_id) FILTER (item IS NOT NULL) AS item, min(event_id) AS first_pos, array_to_string(any_value(moves), ',') AS moves FROM x JOIN m USING (user_id, species_key) GROUP BY ALL""")
def team_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("event_id"), F.lit(None).cast("string")
    text = lambda head, n: F.concat(F.lit(head) if isinstance(head, str) else head, n.cast("long").cast("string"))
    species = text(F.when(k % 2 == 0, "mon-").otherwise("Mon "), F.floor(k / 2) % 3)
    seen = table(spark, sf_dir, "events").select("user_id", species.alias("species"), F.when(F.col("value") > 50, text("I", k % 5)).alias("item"), none.alias("ability"), none.alias("tera_type"), F.array(text("M", k * 7 % 11)).alias("moves"), k.alias("pos"))
    return series.reconstruct_teams(seen, ["user_id"]).select("user_id", "species_key", "species", "item", "first_pos", F.array_join("moves", ",").alias("moves"))


@query("""WITH c AS (SELECT l_orderkey AS row_id, (l_suppkey % 5)::VARCHAR AS target, l_quantity::DOUBLE AS lo, (l_quantity + l_linenumber)::DOUBLE AS hi, l_partkey % 120 - 20 AS gap FROM lineitem)
SELECT DISTINCT row_id, CASE WHEN hi < 25 THEN 'ko_impossible' ELSE 'ko_not_guaranteed' END AS violation, target, lo, hi FROM c WHERE gap BETWEEN 0 AND 70 AND lo < 25""")
def claim_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, q = F.col("l_linenumber"), F.col("l_quantity").cast("double")
    claims = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row_id"), (k * 10).alias("target_pos"), (F.col("l_suppkey") % 5).cast("string").alias("target"), q.alias("lo"), (q + k).alias("hi"), (k * 10 + F.col("l_partkey") % 120 - 20).alias("ko_pos"), F.lit(25.0).alias("hp"),
    )
    return texts.grounded_claims(claims).select("row_id", "violation", "target", "lo", "hi")


@query("""SELECT a.l_orderkey, b.species, min(cap)::INT AS hi FROM (SELECT * FROM lineitem) a JOIN (SELECT *, 's' || (l_partkey % 9) AS species FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_linenumber % 2 <> b.l_linenumber % 2,
LATERAL (SELECT max(x) AS cap FROM (SELECT unnest(range(0, 253, 4)) AS x) WHERE (2 * (50 + b.l_partkey % 100) + 31 + x // 4) * 50 // 100 + 5 <= (2 * (50 + a.l_partkey % 100) + 31 + 252 // 4) * 50 // 100 + 5) WHERE cap IS NOT NULL GROUP BY 1, 2""")
def speed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber")
    order = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.lit(1).alias("turn_key"), k.alias("pos"), (k % 2).cast("string").alias("side"), F.concat(F.lit("s"), (F.col("l_partkey") % 9).cast("string")).alias("species_key"),
        (50 + F.col("l_partkey") % 100).alias("base_speed"), F.lit(0).alias("known_lo"), F.lit(252).alias("known_hi"),
    )
    caps = inference.speed_caps(order)
    return caps.groupBy(F.col("match_id").alias("l_orderkey"), F.col("species_key").alias("species")).agg(F.min("hi").cast("int").alias("hi"))


@query("""WITH m AS (SELECT 's' || (p_size % 7) AS species_key, CASE WHEN p_partkey % 3 = 0 THEN 'Spreads' WHEN p_partkey % 3 = 1 THEN 'Items' ELSE 'Moves' END AS field, p_brand AS value, p_retailprice AS weight, p_partkey % 3 = 0 AS is_spread, p_partkey FROM part),
v AS (SELECT species_key, field, CASE WHEN is_spread THEN CASE WHEN p_partkey % 2 = 0 THEN 'Bold:' || p_partkey % 9 || '/0/0/0/0/4' ELSE 'broken' || p_partkey END WHEN p_partkey % 11 = 1 THEN 'Nothing' ELSE 'v' || p_partkey END AS value, weight FROM m),
s AS (SELECT species_key, field, value, weight, p.mass FROM v JOIN (SELECT species_key, sum(weight) AS mass FROM v WHERE field = 'Spreads' GROUP BY 1) p USING (species_key) WHERE weight > 0 AND lower(value) NOT IN ('', 'nothing', 'other', 'noitem', 'noability') AND (field <> 'Spreads' OR value LIKE 'Bold:%')),
r AS (SELECT *, row_number() OVER (PARTITION BY species_key, field ORDER BY weight DESC, value) AS rank FROM s)
SELECT species_key, field, rank::INT AS rank, value, round(weight * 100 / mass, 6) AS usage_pct FROM r WHERE rank <= CASE field WHEN 'Spreads' THEN 2 WHEN 'Items' THEN 3 ELSE 4 END""")
def usage_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    is_spread = k % 3 == 0
    value = F.when(is_spread & (k % 2 == 0), F.concat(F.lit("Bold:"), (k % 9).cast("string"), F.lit("/0/0/0/0/4"))).when(is_spread, F.concat(F.lit("broken"), k.cast("string"))).when(k % 11 == 1, "Nothing").otherwise(F.concat(F.lit("v"), k.cast("string")))
    m = table(spark, sf_dir, "part").select(F.concat(F.lit("s"), (F.col("p_size") % 7).cast("string")).alias("species_key"), F.when(is_spread, "Spreads").when(k % 3 == 1, "Items").otherwise("Moves").alias("field"), value.alias("value"), F.col("p_retailprice").alias("weight"))
    return usage.top_shares(m, {"Spreads": 2, "Items": 3, "Moves": 4}).withColumn("usage_pct", F.round("usage_pct", 6))


@query("""SELECT o_orderkey, 'Big-' || k % 3 AS head, 'Rain ' || k % 4 AS source, 'Rain ' || k % 4 AS effect, CASE k % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'X' ELSE 'X-Mega' END AS forme, 'p' || (k % 2 + 1) || 'b' AS slot, 'p' || (k % 2 + 1) AS side,
CASE WHEN k % 2 = 0 THEN floor((k % 100) * 320 / 100.0) ELSE (k % 100)::DOUBLE END AS hp, CASE WHEN k % 5 > 0 THEN 'Calm' END AS nature, printf('%.1f', least(k % 7, k % 11)::DOUBLE) || '–' || printf('%.1f', greatest(k % 7, k % 11)::DOUBLE) || '%' AS span,
'a ' || printf('%.1f', (k % 50)::DOUBLE) || '%, b ' || printf('%.1f', (k % 9)::DOUBLE) || '%' AS shares, CASE WHEN length(o_orderpriority) > 5 THEN left(o_orderpriority, 5) || '…' ELSE o_orderpriority END AS short FROM (SELECT *, o_orderkey AS k FROM orders)""")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    effect = s("move: Rain ", k % 4)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.head_of(s("Big-", k % 3, ", L50, M")).alias("head"),
        scalars.keyword(s("[from] Rain ", k % 4), "from").alias("source"),
        scalars.effect_name(effect).alias("effect"),
        scalars.base_forme(F.when(k % 3 == 0, "X-Stellar").when(k % 3 == 1, "X-Tera").otherwise("X-Mega")).alias("forme"),
        scalars.slot_of(s("p", k % 2 + 1, "b: name")).alias("slot"),
        scalars.side_of(s("p", k % 2 + 1, "b: name")).alias("side"),
        scalars.hp_value(F.when(k % 2 == 0, s(k % 100, "%")).otherwise((k % 100).cast("string")), F.lit(320)).alias("hp"),
        scalars.spread(F.when(k % 5 > 0, s("Calm:4/0/0/0/", k % 5, "/0")).otherwise("Calm:1/2/3"))["nature"].alias("nature"),
        scalars.range_text((k % 7).cast("double"), (k % 11).cast("double")).alias("span"),
        scalars.share_text(F.array(F.lit("a"), F.lit("b")), F.array((k % 50).cast("double"), (k % 9).cast("double"))).alias("shares"),
        textops.truncated(F.col("o_orderpriority"), 5, "…").alias("short"),
    )


@query("""SELECT o_orderkey, 'alpha' AS species, k % 3 AS n, (3 * (k % 3) * (k % 3 - 1))::BIGINT AS places FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k % 3 > 0 UNION ALL SELECT o_orderkey, 'beta', 2, (12 * (o_orderkey % 3) + 15)::BIGINT FROM orders""")
def name_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("name_mentions", texts.Mentions)
    text = F.concat(F.repeat(F.lit("alpha "), (F.col("o_orderkey") % 3).cast("int")), F.lit("Beta alphabeta BETA"))
    told = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("told"))
    found = spark.sql("SELECT o_orderkey, m.species, m.start FROM {told}, LATERAL name_mentions(told, array('alpha', 'beta')) m", told=told)
    return found.groupBy("o_orderkey", "species").agg(F.count("*").alias("n"), F.sum("start").alias("places"))


@query("""SELECT o_orderkey, 'alpha' AS name, (o_orderkey % 101)::DOUBLE AS hp FROM orders UNION ALL SELECT o_orderkey, 'betaii', 12.5 FROM orders""")
def active_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("[p1a] Alpha | HP 3%\n[b] Alpha | HP "), (F.col("o_orderkey") % 101).cast("string"), F.lit("%\nbench: Gamma | HP 9%\n[p2c] Beta-II  | HP 12.5 % | Tera"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(texts.on_field_hp(text)).alias("name", "hp"))


@query("""SELECT o_orderkey, 0 AS rule, 'Intro' AS text FROM orders UNION ALL SELECT o_orderkey, 1, 'first ' || o_orderkey % 7 || chr(10) || '   more' FROM orders UNION ALL SELECT o_orderkey, 2, 'second' FROM orders""")
def numbered_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Intro\n1. first "), (F.col("o_orderkey") % 7).cast("string"), F.lit("\n   more\n2) second\n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(textops.numbered(text)))


@query("""SELECT o_orderkey, best, CASE WHEN n = 3 THEN NULL WHEN sure THEN best ELSE best + 1 END AS worst FROM (SELECT *, CASE n WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE n + 1 END::INT AS best FROM (SELECT o_orderkey, o_orderkey % 4 AS n, o_custkey % 2 = 0 AS sure FROM orders))""")
def ko_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 4
    hits = F.when(n == 0, "OHKO").when(n == 3, "nothing").otherwise(F.concat((n + 1).cast("string"), F.lit("HKO")))
    best, worst = textops.ko_count(F.concat(F.when(F.col("o_custkey") % 2 == 0, "guaranteed ").otherwise("41% chance to "), hits))
    return table(spark, sf_dir, "orders").select("o_orderkey", best.alias("best"), worst.alias("worst"))


@query("""SELECT conv_id, turn, n AS chars, next_n AS next_chars FROM (SELECT *, length(text)::INT AS n, lead(length(text)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS next_n FROM conversations) WHERE role = 'assistant'""")
def source_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    out = relational.source_trace(c.where("role = 'assistant'").select("conv_id", "turn"), c, ["conv_id", "turn"], "turn", ["n"])
    return out.select("conv_id", "turn", F.col("state.n").alias("chars"), F.col("next_state.n").alias("next_chars"))


@query("""WITH p AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN lead(text) OVER (PARTITION BY conv_id ORDER BY turn) END AS answer, role, text FROM conversations)
SELECT conv_id, count(*) AS calls, count(answer) AS answered, max(length(text))::INT AS longest FROM p WHERE role = 'assistant' GROUP BY 1""")
def call_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    j = relational.paired(c.where("role = 'assistant'").select("conv_id", "turn", "text"), c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")), ["conv_id", "turn"]).where("status <> 'orphan'")
    return j.groupBy("conv_id").agg(F.count("*").alias("calls"), F.count("answer").alias("answered"), F.max(F.length("text")).alias("longest"))


@query("""SELECT counter, sum(n)::BIGINT AS n FROM (SELECT o_orderstatus AS counter, 1 AS n FROM orders UNION ALL SELECT o_orderpriority, 2 FROM orders) GROUP BY 1""")
def merged_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "orders").select(F.create_map(F.col("o_orderstatus"), F.lit(1), F.col("o_orderpriority"), F.lit(2)).alias("c"))
    return relational.counters(parts, "c")


@query("SELECT count(*) AS n, min(k) AS least, floor(median(k))::BIGINT AS median, max(k) AS most FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey)")
def size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.profile(table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("k")), "k")


@query("""SELECT key, CASE WHEN key IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) THEN 'rich' WHEN key IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) THEN 'buyer' ELSE 'any' END AS origin FROM (SELECT n_nationkey AS key FROM nation)""")
def first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda df, key, name: df.select(F.col(key).alias("key"), F.lit(name).alias("origin")).distinct()
    rich = made(table(spark, sf_dir, "supplier").where("s_acctbal > 9000"), "s_nationkey", "rich")
    buyer = made(table(spark, sf_dir, "customer").where("c_acctbal > 9900"), "c_nationkey", "buyer")
    return relational.first_source([rich, buyer, made(table(spark, sf_dir, "nation"), "n_nationkey", "any")], "key")


@query("""SELECT o_orderkey, coalesce(s, 'failed') AS status FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS s FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_orderkey = o_orderkey""")
def result_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("pending").alias("status"))
    results = table(spark, sf_dir, "lineitem").where("l_quantity > 45").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linestatus").alias("status"))
    return relational.routed_results(items, results, "o_orderkey", "status")


@query("""SELECT CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN n_chars < 200 THEN 'short' ELSE 'foreign' END AS drop_reason, count(*) AS n FROM documents WHERE text IS NULL OR text = '' OR n_chars < 200 OR lang <> 'en' GROUP BY 1""")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "n_chars", "lang")
    reasons = {"empty": F.coalesce(F.col("text"), F.lit("")) == "", "short": F.col("n_chars") < 200, "foreign": F.col("lang") != "en"}
    return relational.with_drop_reason(docs, reasons)[1]


@query("""WITH a AS (SELECT o_orderkey, CASE WHEN k % 3 = 0 THEN 'switch' ELSE 'move' END AS kind, 'm' || k % 5 AS mv, k % 7 = 0 AS trapped, CASE WHEN k % 4 = 0 THEN 'M' || o_custkey % 5 ELSE '' END AS lock, k % 2 = 0 AS tera, o_custkey % 9 = 0 AS used FROM (SELECT *, o_orderkey AS k FROM orders))
SELECT o_orderkey, 'trapped_switch' AS issue FROM a WHERE kind = 'switch' AND trapped UNION ALL SELECT o_orderkey, 'not_in_moveset' FROM a WHERE kind = 'move' AND mv = 'm4'
UNION ALL SELECT o_orderkey, 'choice_locked' FROM a WHERE kind = 'move' AND lock <> '' AND lower(lock) <> mv UNION ALL SELECT o_orderkey, 'disabled' FROM a WHERE kind = 'move' AND mv = 'm3' UNION ALL SELECT o_orderkey, 'second_tera' FROM a WHERE kind = 'move' AND tera AND used""")
def action_legality(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    action = F.struct(F.when(k % 3 == 0, "switch").otherwise("move").alias("action_type"), F.concat(F.lit("m"), (k % 5).cast("string")).alias("move"), (k % 2 == 0).alias("tera"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", action.alias("action"), (k % 7 == 0).alias("trapped"), F.when(k % 4 == 0, F.concat(F.lit("M"), (c % 5).cast("string"))).otherwise("").alias("choice_lock"), F.lit("").alias("encored"),
        F.lit("M-3").alias("disabled"), F.array(*[F.lit(f"M {x}") for x in range(4)]).alias("known_moves"), (c % 9 == 0).alias("tera_used"),
    )
    return quality.issues(rows, series.legality_checks(), ["o_orderkey"])


@query("""WITH g AS (SELECT o_orderkey AS id, o_custkey, epoch_us(o_orderdate) // 1000000 AS t FROM orders), p AS (SELECT *, lag(t) OVER (PARTITION BY o_custkey ORDER BY t, id::VARCHAR) AS prev FROM g),
r AS (SELECT *, sum(CASE WHEN t - prev > 2592000 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY t, id::VARCHAR) AS run FROM p),
c AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey, run ORDER BY t, id::VARCHAR) - 1) // 3 AS chunk FROM r),
f AS (SELECT *, first_value(id) OVER (PARTITION BY o_custkey, run, chunk ORDER BY t, id::VARCHAR) AS first FROM c)
SELECT id::VARCHAR AS id, 'bo3-' || first AS match_id FROM f""")
def stitched_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    seconds = F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate").cast("timestamp_ntz")) / 1_000_000).cast("long")
    key = F.col("o_custkey").cast("string")
    games = o.select(F.col("o_orderkey").cast("string").alias("id"), F.array(key, F.concat(F.lit("S"), key)).alias("players"), seconds.alias("uploadtime"))
    return series.stitch(games, 30 * 86400, 3).select("id", "match_id")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN flip AND l_returnflag = 'R' THEN 'p1' WHEN flip THEN 'p2' WHEN l_returnflag = 'R' THEN 'p2' ELSE 'p1' END AS side,
CASE WHEN flip THEN l_tax ELSE l_discount END AS p1_rate, CASE WHEN flip THEN l_discount ELSE l_tax END AS p2_rate
FROM (SELECT *, l_linestatus = 'F' AS flip FROM lineitem)""")
def perspective_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", "p2").otherwise("p1").alias("side"), F.col("l_discount").alias("p1_rate"), F.col("l_tax").alias("p2_rate"),
        F.when(F.col("l_linestatus") == "F", "p2").otherwise("p1").alias("winner"),
    )
    return series.winner_first(d).drop("winner")


@query("""SELECT p_partkey, CASE WHEN greatest(atk, spa) >= 110 THEN CASE WHEN atk >= spa THEN CASE WHEN spe >= 90 THEN 'Jolly:4/252/0/0/0/252' ELSE 'Adamant:4/252/0/0/0/252' END ELSE CASE WHEN spe >= 90 THEN 'Timid:4/0/0/252/0/252' ELSE 'Modest:4/0/0/252/0/252' END END
WHEN hp >= 95 AND spe <= 70 THEN CASE WHEN def > spd THEN 'Bold:252/0/252/0/4/0' ELSE 'Calm:252/0/4/0/252/0' END ELSE CASE WHEN spe >= 90 THEN 'Timid:4/0/0/252/0/252' ELSE 'Modest:4/0/0/252/0/252' END END AS spread
FROM (SELECT p_partkey, 60 + p_partkey % 71 AS hp, 50 + p_partkey * 7 % 83 AS atk, 60 + p_size AS def, 40 + p_partkey * 11 % 91 AS spa, 60 + p_partkey % 47 AS spd, 30 + p_partkey * 13 % 97 AS spe FROM part)""")
def heuristic_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    s = usage.heuristic_spread(60 + k % 71, 50 + k * 7 % 83, 60 + F.col("p_size"), 40 + k * 11 % 91, 60 + k % 47, 30 + k * 13 % 97)
    return table(spark, sf_dir, "part").select("p_partkey", s.alias("spread"))


@query("""SELECT l_orderkey, l_linenumber, round(greatest((CASE WHEN ko THEN l_quantity ELSE l_quantity * (1 - l_discount) END) - 0.9, 0), 6) AS lo, CASE WHEN ko THEN NULL ELSE round(l_quantity * (1 - l_discount) + 0.9, 6) END AS hi
FROM (SELECT *, l_returnflag = 'R' AS ko FROM lineitem)""")
def observed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    lo, hi = intervals.observed_range(q, q - q * (1 - F.col("l_discount")), F.col("l_returnflag") == "R")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(lo, 6).alias("lo"), F.nullif(F.round(hi, 6), F.lit(float("inf"))).alias("hi"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN best IS NULL AND worst IS NULL THEN '' WHEN best IS NULL OR worst IS NULL THEN (CASE WHEN coalesce(best, worst) = 1 THEN 'OHKO' ELSE coalesce(best, worst) || 'HKO' END) || '+'
WHEN best = worst THEN (CASE WHEN best = 1 THEN 'OHKO' ELSE best || 'HKO' END)
ELSE (CASE WHEN least(best, worst) = 1 THEN 'OHKO' ELSE least(best, worst) || 'HKO' END) || '–' || greatest(best, worst) || 'HKO' END AS label
FROM (SELECT l_orderkey, l_linenumber, nullif(l_orderkey % 4, 0) AS best, nullif(l_suppkey % 5, 0) AS worst FROM lineitem)""")
def hits_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, w = F.nullif(F.col("l_orderkey") % 4, F.lit(0)), F.nullif(F.col("l_suppkey") % 5, F.lit(0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", inference.hits_label(b, w).alias("label"))


@query("""WITH a AS (SELECT s_nationkey AS n, s_suppkey AS attacker, 40.0 + s_suppkey % 90 AS power, s_suppkey % 100 AS alo, s_suppkey % 100 + 100 AS ahi FROM supplier),
d AS (SELECT c_nationkey AS n, c_mktsegment AS defender, min(c_custkey % 50)::INT AS plo, max(c_custkey % 50)::INT + 100 AS phi FROM customer GROUP BY 1, 2)
SELECT n AS turn, attacker::VARCHAR AS attacker, defender, round(85.0 * power / 200 * (100 + alo / 4.0) / (100 + phi / 4.0) / (1 + phi / 1000.0), 6) AS lo, round(100.0 * power / 200 * (100 + ahi / 4.0) / (100 + plo / 4.0) / (1 + plo / 1000.0), 6) AS hi FROM a JOIN d USING (n)""")
def effect_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, key = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    a = s.select(F.lit("g").alias("game_id"), F.col("s_nationkey").alias("turn"), key.cast("string").alias("attacker"), F.lit("m").alias("move"), F.lit("Physical").alias("category"), (F.lit(40.0) + key % 90).alias("power"), (key % 100).cast("int").alias("atk_lo"), (key % 100 + 100).cast("int").alias("atk_hi"))
    b = F.col("c_custkey") % 50
    d = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("turn"), F.col("c_mktsegment").alias("defender")).agg(F.min(b).cast("int").alias("hp_lo"), (F.max(b) + 100).cast("int").alias("hp_hi"))
    d = d.select(F.lit("g").alias("game_id"), "*", F.col("hp_lo").alias("def_lo"), F.col("hp_hi").alias("def_hi"))
    return inference.matrix(a, d).select("turn", "attacker", "defender", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


# The fold as a recursion over the lines of an order: lists of six bounds for each side, searches as filters over all values.
_EFFECT = "40.0 * (100 + {0} / 4) / (100 + {2} / 4) / (1 + {1} / 1000)"
_LEAST = "list_min(list_filter(range(0, 253), lambda v: {}))"
_MOST = "list_max(list_filter(range(0, 253), lambda v: {}))"


def _e(x: str, h: str, y: str, part: str = "") -> str:
    return f"({_EFFECT.format(x, h, y)}){part}"


_SETTLED = "(SELECT {'lo': list_transform(range(1, 7), lambda j: least(l[j], h2[j])), 'hi': h2} FROM (SELECT l, CASE WHEN list_sum(l) <= 508 THEN list_transform(range(1, 7), lambda j: greatest(least(h[j], 508 - (list_sum(l) - l[j])), l[j])) ELSE h END::BIGINT[] AS h2 FROM (SELECT {l} AS l, {h} AS h)))"
_FOLD = f"""RECURSIVE ev AS (SELECT l_orderkey AS m, l_linenumber AS t, row_number() OVER w AS k, count(*) OVER (PARTITION BY l_orderkey) AS n, coalesce(lag(l_linenumber) OVER w <> l_linenumber, false) AS begins, l_linenumber % 2 = 0 AS first_side, CASE WHEN l_returnflag = 'R' THEN 4 ELSE 2 END AS off,
CASE WHEN l_returnflag = 'R' THEN 5 ELSE 3 END AS df, greatest(100.0::DOUBLE - (75.0::DOUBLE - l_quantity::DOUBLE / 5) - 0.9::DOUBLE, 0) AS low, 100.0::DOUBLE - (75.0::DOUBLE - l_quantity::DOUBLE / 5) + 0.9::DOUBLE AS high FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey)),
f AS (SELECT m, 0::BIGINT AS k, [0, 0, 0, 0, 0, 0]::BIGINT[] AS lo1, [252, 252, 252, 252, 252, 252]::BIGINT[] AS hi1, [0, 0, 0, 0, 0, 0]::BIGINT[] AS lo2, [252, 252, 252, 252, 252, 252]::BIGINT[] AS hi2 FROM ev WHERE k = 1
UNION ALL SELECT m, k, CASE WHEN first_side THEN a.lo ELSE d.lo END, CASE WHEN first_side THEN a.hi ELSE d.hi END, CASE WHEN first_side THEN d.lo ELSE a.lo END, CASE WHEN first_side THEN d.hi ELSE a.hi END
FROM (SELECT m, k, first_side, {_SETTLED.replace("{l}", "list_transform(range(1, 7), lambda j: CASE WHEN j = off THEN greatest(al[j], coalesce(r3, 0)) ELSE al[j] END)").replace("{h}", "list_transform(range(1, 7), lambda j: CASE WHEN j = off THEN least(ah[j], coalesce(l3, 252)) ELSE ah[j] END)")} AS a,
{_SETTLED.replace("{l}", "list_transform(range(1, 7), lambda j: CASE WHEN j = df THEN greatest(dl[j], coalesce(r1, 0)) WHEN j = 1 THEN greatest(dl[j], coalesce(r2, 0)) ELSE dl[j] END)").replace("{h}", "list_transform(range(1, 7), lambda j: CASE WHEN j = df THEN least(dh[j], coalesce(l1, 252)) WHEN j = 1 THEN least(dh[j], coalesce(l2, 252)) ELSE dh[j] END)")} AS d
FROM (SELECT *, {_LEAST.format(_e("al[off]", "dh[1]", "v", " * 0.85 <= high"))} AS r1, {_LEAST.format(_e("al[off]", "v", "dh[df]", " * 0.85 <= high"))} AS r2, {_LEAST.format(_e("v", "dl[1]", "dl[df]", " >= low"))} AS r3,
{_MOST.format(_e("ah[off]", "dl[1]", "v", " >= low"))} AS l1, {_MOST.format(_e("ah[off]", "v", "dl[df]", " >= low"))} AS l2, {_MOST.format(_e("v", "dh[1]", "dh[df]", " * 0.85 <= high"))} AS l3
FROM (SELECT ev.m, ev.k, first_side, off, df, low, high, CASE WHEN first_side THEN lo1 ELSE lo2 END AS al, CASE WHEN first_side THEN hi1 ELSE hi2 END AS ah, CASE WHEN first_side THEN lo2 ELSE lo1 END AS dl, CASE WHEN first_side THEN hi2 ELSE hi1 END AS dh FROM f JOIN ev ON ev.m = f.m AND ev.k = f.k + 1)))),
st AS (SELECT ev.m, ev.t AS turn, false AS final, lo1, hi1, lo2, hi2 FROM ev JOIN f ON f.m = ev.m AND f.k = ev.k - 1 WHERE begins UNION ALL SELECT ev.m, ev.t + 1, true, lo1, hi1, lo2, hi2 FROM ev JOIN f ON f.m = ev.m AND f.k = ev.k WHERE ev.k = ev.n),
known AS (SELECT m::VARCHAR AS match_id, turn::BIGINT AS turn_key, final, side, 'a' AS species_key, ['hp', 'atk', 'def', 'spa', 'spd', 'spe'][j] AS stat, CASE side WHEN 'p1' THEN lo1[j] ELSE lo2[j] END::INT AS lo, CASE side WHEN 'p1' THEN hi1[j] ELSE hi2[j] END::INT AS hi, true AS observed
FROM (SELECT *, unnest(['p1', 'p2']) AS side FROM st) CROSS JOIN (SELECT unnest(range(1, 7)) AS j))"""


def _line_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as hits, in order of line."""
    line = table(spark, sf_dir, "lineitem")
    even = F.col("l_linenumber") % 2 == 0
    return line.select(
        F.col("l_orderkey").cast("string").alias("match_id"), F.col("l_linenumber").cast("long").alias("turn_key"), F.col("l_partkey").cast("int").alias("event_pos"), F.when(even, "p1").otherwise("p2").alias("attacker_side"), F.lit("a").alias("attacker"),
        F.when(even, "p2").otherwise("p1").alias("defender_side"), F.lit("a").alias("defender"), F.when(F.col("l_returnflag") == "R", "Special").otherwise("Physical").alias("category"), F.lit(80.0).alias("power"),
        F.lit(100.0).alias("hp_before_pct"), (F.lit(75.0) - F.col("l_quantity") / 5).alias("hp_after_pct"), F.lit(False).alias("is_ko"),
    )


@query(f"WITH {_FOLD} SELECT * FROM known")
def interval_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds before each line and at the end."""
    return inference.fold(_line_hits(spark, sf_dir))


@query(f"""WITH {_FOLD}, asked AS (SELECT DISTINCT l_orderkey::VARCHAR AS match_id, l_linenumber + x AS turn_key, side, species_key FROM lineitem, (SELECT unnest([0, 9]) AS x), (SELECT unnest(['p1', 'p2']) AS side), (SELECT unnest(['a', 'b']) AS species_key)),
got AS (SELECT a.*, s.stat, CASE WHEN a.side = 'p1' THEN (SELECT [lo, hi, 1] FROM known k WHERE k.final AND k.match_id = a.match_id AND k.side = 'p1' AND k.species_key = a.species_key AND k.stat = s.stat)
ELSE (SELECT arg_max([lo, hi, 1], (k.turn_key, k.final)) FROM known k WHERE k.turn_key <= a.turn_key AND k.match_id = a.match_id AND k.side = a.side AND k.species_key = a.species_key AND k.stat = s.stat) END AS b FROM asked a, (SELECT unnest(['hp', 'atk', 'def', 'spa', 'spd', 'spe']) AS stat) s)
SELECT match_id, side, species_key, stat, count(*) AS n, sum(coalesce(b[1], 0))::BIGINT AS lo, sum(coalesce(b[2], 252))::BIGINT AS hi, sum(coalesce(b[3], 0))::BIGINT AS observed FROM got GROUP BY ALL""")
def asymmetric_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At every line, and nine later: p1's final bounds, and what had been seen of p2; of two entities, one of which is never met."""
    hits = _line_hits(spark, sf_dir)
    turns = hits.select("match_id", F.explode(F.array("turn_key", F.col("turn_key") + 9)).alias("turn_key")).repartition("match_id").distinct()
    present = turns.select("*", F.explode(F.array(F.lit("p1"), F.lit("p2"))).alias("side")).select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("species_key"))
    b = inference.asymmetric_entities(inference.entities(hits), present, "p1")
    totals = [F.struct(F.lit(stat).alias("stat"), F.sum(F.get("los", F.lit(k))).alias("lo"), F.sum(F.get("his", F.lit(k))).alias("hi")) for k, stat in enumerate(inference.STATS)]
    t = b.groupBy("match_id", "side", "species_key").agg(F.count("*").alias("n"), F.count_if("observed").alias("observed"), F.array(*totals).alias("totals"))
    return t.select("match_id", "side", "species_key", "n", "observed", F.explode("totals").alias("s")).select("match_id", "side", "species_key", "s.stat", "n", "s.lo", "s.hi", "observed")


@query("""SELECT o_orderkey, floor(o_totalprice * 10 + 0.5) / 10 AS rounded, CASE WHEN k % 9 > 0 THEN floor((k % 7) * 100.0 / (k % 9) * 10 + 0.5) / 10 ELSE 0.0 END AS pct,
CASE WHEN n IS NULL THEN '' WHEN n = 1 THEN ' (1 turn left)' ELSE ' (' || n || ' turns left)' END AS left_text, regexp_replace(o_orderpriority || ':x/' || k, '[^A-Za-z0-9._-]', '_', 'g') AS safe,
strftime(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH, '%Y-%m') AS two_back, coalesce(nullif(k % 3, 0), -1)::BIGINT AS truthy, ((2 * (k % 150) + 31 + (k % 253) // 4) * 50 // 100 + 5)::BIGINT AS speed
FROM (SELECT *, o_orderkey AS k, nullif(o_orderkey % 4, 0) AS n FROM orders)""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.round_half_up(F.col("o_totalprice")).alias("rounded"),
        scalars.percent_of(k % 7, k % 9).alias("pct"),
        scalars.turns_left(F.nullif(k % 4, F.lit(0))).alias("left_text"),
        scalars.safe_name(F.concat("o_orderpriority", F.lit(":x/"), k.cast("string"))).alias("safe"),
        F.get(scalars.months_back(F.date_format("o_orderdate", "yyyy-MM"), 3), F.lit(2)).alias("two_back"),
        scalars.or_default(k % 3, F.lit(0), F.lit(-1)).cast("long").alias("truthy"),
        intervals.speed_stat(k % 150, k % 253).alias("speed"),
    )


@query(f"""WITH {_STATES}, b AS (SELECT user_id::VARCHAR AS game_id, left(s, 2) AS side, sp, min(pos) AS p FROM st WHERE sp IS NOT NULL GROUP BY ALL)
SELECT game_id, turn, side, coalesce(string_agg(CASE WHEN sp IS DISTINCT FROM species THEN sp END, ',' ORDER BY p), '') AS bench FROM (SELECT game_id, turn, left(slot, 2) AS side, species FROM snap) JOIN b USING (game_id, side) GROUP BY ALL""")
def bench_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir)
    out = protocol.bench(protocol.snapshots(logs), protocol.brought(logs))
    return out.select("game_id", "turn", "side", F.array_join("bench", ",").alias("bench"))


@query("""WITH m AS (SELECT event_id, user_id, event_id // 40 AS turn, CASE WHEN event_id % 37 = 0 THEN 'After You' ELSE 'M' || event_id % 5 END AS mv, event_id % 6 = 0 AS called, event_id % 9 = 0 AS quick, event_type FROM events),
c AS (SELECT user_id, event_id // 40 AS turn FROM events WHERE event_id % 53 = 0) SELECT event_id FROM m WHERE NOT called AND NOT quick AND event_type IN ('click', 'view')
AND (user_id, turn) NOT IN (SELECT user_id, turn FROM m WHERE mv = 'After You') AND (user_id, turn) NOT IN (SELECT user_id, turn FROM c)""")
def clean_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("match_id"), F.floor(k / 40).alias("turn_key"), "event_type")
    category = F.when(F.col("event_type") == "click", "Physical").when(F.col("event_type") == "view", "Special").otherwise("Status")
    moves = e.select("*", F.when(k % 37 == 0, "After You").otherwise(F.concat(F.lit("M"), (k % 5).cast("string"))).alias("move_name"), F.when(k % 6 == 0, "Metronome").alias("called_via"), F.when(k % 9 == 0, 1).otherwise(0).alias("priority"), category.alias("category"))
    held = e.where(k % 53 < 2).select("match_id", "turn_key", F.when(k % 53 == 0, "move: Tailwind").otherwise("Rain").alias("name"))
    return inference.clean_order(moves, held).select("event_id")


@query("""WITH g AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS game_no, CASE o_orderstatus WHEN 'F' THEN 'p1' WHEN 'O' THEN 'p2' END AS winner, o_orderkey % 20 AS turns FROM orders),
l AS (SELECT *, 'Game ' || game_no || ': ' || coalesce(winner || ' won', 'tie') || ' in ' || turns || ' turns' AS line FROM g)
SELECT o_orderkey, coalesce(string_agg(line, chr(10)) OVER (PARTITION BY o_custkey ORDER BY game_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS earlier FROM l""")
def series_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    g = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("match_id"), F.row_number().over(sequence.ordered(["o_custkey"], ["o_orderdate", "o_orderkey"])).alias("game_no"), F.when(status == "F", "p1").when(status == "O", "p2").alias("winner"),
        (F.col("o_orderkey") % 20).alias("turns"), F.col("o_orderkey").alias("id"),
    )
    return series.summaries(g).select(F.col("id").alias("o_orderkey"), "earlier")


@query("""WITH r AS (SELECT p_brand, p_size % 3 AS f, p_partkey, row_number() OVER (PARTITION BY p_brand, p_size % 3 ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part),
l AS (SELECT p_brand, f, '  F' || f || ': ' || string_agg('v' || p_partkey || ' ' || printf('%.1f', rank * 10.0) || '%', ', ' ORDER BY rank) AS line FROM r WHERE rank <= 3 GROUP BY p_brand, f)
SELECT p_brand AS species_key, p_brand || chr(10) || string_agg(line, chr(10) ORDER BY f) AS text FROM l GROUP BY p_brand""")
def usage_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("species_key"), F.concat(F.lit("F"), (F.col("p_size") % 3).cast("string")).alias("field"), F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("value"), "p_retailprice", "p_partkey")
    ranked = p.withColumn("rank", F.row_number().over(Window.partitionBy("species_key", "field").orderBy(F.desc("p_retailprice"), "p_partkey"))).where("rank <= 3")
    return texts.usage_block(ranked.withColumn("usage_pct", F.col("rank") * 10.0))


@query("""WITH o AS (SELECT o_orderkey AS k, printf('%.1f', (o_orderkey % 90)::DOUBLE) AS lo, printf('%.1f', (o_orderkey % 70 + 10)::DOUBLE) AS hi FROM orders)
SELECT k AS o_orderkey, 'Fake Out' AS move, 'Beta-II' AS target, lo::DOUBLE AS lo, hi::DOUBLE AS hi, CASE WHEN k % 3 = 0 THEN 'OHKO' ELSE '' END AS label FROM o UNION ALL SELECT k, 'M' || k % 4, 'Alpha', 5.0, 7.5, '' FROM o""")
def matrix_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prompts(spark, sf_dir).select("o_orderkey", F.explode(texts.matrix_entries(F.col("user"))).alias("e")).select("o_orderkey", "e.*")


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, user, action: texts with a state line and a matrix, and actions of which some lack a part."""
    k = F.col("o_orderkey")
    number = lambda c: F.format_string("%.1f", c.cast("double"))
    user = F.concat(
        F.lit("[p2a] Beta-II | HP "), (k % 101).cast("string"), F.lit("%\n=== THREAT MATRIX ===\n  Fake Out → Beta-II        "), number(k % 90), F.lit("–"), number(k % 70 + 10), F.lit("%"), F.when(k % 3 == 0, " OHKO").otherwise(""),
        F.lit("\n  M"), (k % 4).cast("string"), F.lit(" → Alpha          5.0–7.5%\n"),
    )
    one = F.when(k % 7 == 0, '{"action_type": "move"}').when(k % 7 == 1, '{"action_type": "dance"}').when(k % 7 == 2, '{"action_type": "switch", "switch_to": "X"}').otherwise('{"action_type": "move", "move": "M"}')
    two = F.when(k % 5 == 0, "null").otherwise('{"action_type": "pass"}')
    return table(spark, sf_dir, "orders").select("o_orderkey", user.alias("user"), F.concat(F.lit('{"slot_1": '), one, F.lit(', "slot_2": '), two, F.lit("}")).alias("action"))


@query("""SELECT o_orderkey, 'matrix_ranges' AS issue FROM orders WHERE o_orderkey % 90 > o_orderkey % 70 + 10 UNION ALL SELECT o_orderkey, 'ko_labels' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 90 < o_orderkey % 101 - 5
UNION ALL SELECT o_orderkey, 'action_structure' FROM orders WHERE o_orderkey % 7 < 2 OR o_orderkey % 5 = 0""")
def text_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issues(_prompts(spark, sf_dir), texts.text_checks(), ["o_orderkey"])


_BASE = "100::DOUBLE * 80::DOUBLE / 200::DOUBLE * (100 + {x} / 4::DOUBLE) / (100 + {y} / 4::DOUBLE) / (1 + {h} / 1000::DOUBLE)"
_LEAST = "coalesce(list_min(list_filter(range(0, 253), lambda v: " + _BASE + "{scale} {test})), 0)"
_MOST = "coalesce(CASE WHEN NOT ko THEN list_max(list_filter(range(0, 253), lambda v: " + _BASE + "{scale} {test})) END, 252)"
_LOW = " * 0.85::DOUBLE"


@query(f"""WITH e AS (SELECT o_orderkey AS k, o_orderkey % 13 = 0 AS ko, 100::DOUBLE AS was, 100::DOUBLE - (o_orderkey % 53 + 12)::DOUBLE AS now, CASE WHEN o_custkey % 2 = 0 THEN ['atk', 'def'] ELSE ['spa', 'spd'] END AS s FROM orders),
r AS (SELECT *, greatest((CASE WHEN ko THEN was ELSE was - now END) - 0.9::DOUBLE, 0::DOUBLE) AS least, CASE WHEN ko THEN 'infinity'::DOUBLE ELSE was - now + 0.9::DOUBLE END AS most FROM e),
b AS (SELECT k, s, {_LEAST.format(x=0, y='v', h=252, scale=_LOW, test='<= most')} AS def_lo, {_LEAST.format(x=0, y=252, h='v', scale=_LOW, test='<= most')} AS hp_lo, {_LEAST.format(x='v', y=0, h=0, scale='', test='>= least')} AS off_lo,
{_MOST.format(x=252, y='v', h=0, scale='', test='>= least')} AS def_hi, {_MOST.format(x=252, y=0, h='v', scale='', test='>= least')} AS hp_hi, {_MOST.format(x='v', y=252, h=252, scale=_LOW, test='<= most')} AS off_hi FROM r),
w AS (SELECT k, side, stat, CASE WHEN side = 'p1' AND stat = s[1] THEN off_lo WHEN side = 'p2' AND stat = s[2] THEN def_lo WHEN side = 'p2' AND stat = 'hp' THEN hp_lo ELSE 0 END AS lo,
CASE WHEN side = 'p1' AND stat = s[1] THEN off_hi WHEN side = 'p2' AND stat = s[2] THEN def_hi WHEN side = 'p2' AND stat = 'hp' THEN hp_hi ELSE 252 END AS hi
FROM b, (SELECT unnest(['p1', 'p2']) AS side), (SELECT unnest(['hp', 'atk', 'def', 'spa', 'spd', 'spe']) AS stat)),
t AS (SELECT *, sum(lo) OVER (PARTITION BY k, side) AS spent FROM w), c AS (SELECT *, CASE WHEN spent <= 508 THEN greatest(least(hi, 508 - (spent - lo)), lo) ELSE hi END AS top FROM t)
SELECT k::VARCHAR AS match_id, side, stat, least(lo, top)::INT AS lo, top::INT AS hi FROM c""")
def two_way_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hit for each order: what six searches and the budget leave of both sides' bounds."""
    k = F.col("o_orderkey")
    e = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("match_id"), F.lit(1).cast("long").alias("turn_key"), F.lit(0).alias("event_pos"), F.lit("p1").alias("attacker_side"), F.lit("a").alias("attacker"), F.lit("p2").alias("defender_side"), F.lit("b").alias("defender"),
        F.when(F.col("o_custkey") % 2 == 0, "Physical").otherwise("Special").alias("category"), F.lit(80.0).alias("power"), F.lit(100.0).alias("hp_before_pct"), (F.lit(100.0) - (k % 53 + 12).cast("double")).alias("hp_after_pct"), (k % 13 == 0).alias("is_ko"),
    )
    return inference.fold(e, turns=False).select("match_id", "side", "stat", "lo", "hi")


_ITEM_LINES = (
    "|-enditem|p1a: x|Berry|[eat]", "|-enditem|p1a: x|Belt|[from] move: Knock Off", "|-enditem|p1a: x|Orb|[from] move: Fling", "|-enditem|p1a: x|Band|[from] move: Thief", "|-enditem|p1a: x|Herb",
    "|-item|p1a: x|Vest|[from] move: Trick", "|-item|p1a: x|Scarf|[from] ability: Frisk", "|-item|p1a: x|Seed",
)


@query("""SELECT o_orderkey, ['eaten', 'knocked_off', 'flung', 'stolen', 'consumed', 'swapped', 'revealed', 'gained'][o_orderkey % 8 + 1] AS kind, ['Berry', 'Belt', 'Orb', 'Band', 'Herb', 'Vest', 'Scarf', 'Seed'][o_orderkey % 8 + 1] AS item FROM orders""")
def item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    logs = table(spark, sf_dir, "orders").select(k.cast("string").alias("game_id"), F.get(F.array(*map(F.lit, _ITEM_LINES)), (k % 8).cast("int")).alias("log"))
    return protocol.events(logs).select(F.col("game_id").cast("long").alias("o_orderkey"), "kind", "item")


@query("""WITH s AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS stint FROM events)
SELECT event_id, bool_or(event_type = 'purchase') OVER (PARTITION BY user_id, stint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS touched FROM s""")
def touched_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, order = ["user_id"], ["ts", "event_id"]
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    e = e.withColumn("stint", sequence.stint(F.col("event_type") == "signup", keys, order))
    return e.select("event_id", sequence.touched_since_reset(F.col("event_type") == "purchase", keys, order, "stint").alias("touched"))


@query("""WITH n AS (SELECT n_nationkey AS k, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9000) AS c FROM nation)
SELECT k, s > 0 OR c > 0 AS either, s > 0 AND c > 0 AS both, s > 0 AND c = 0 AS only_first, s = 0 AND c = 0 AS missing FROM n""")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, intersection, difference and complement of the keys of two tables."""
    every = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    b = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).distinct()
    out, missing = every, relational.without(every, a.union(b), ["k"])
    for name, keys in {"either": a.union(b).distinct(), "both": a.intersect(b), "only_first": relational.without(a, b, ["k"]), "missing": missing}.items():
        out = out.join(keys.withColumn(name, F.lit(True)), "k", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_min(event_id, (ts, event_id)) AS first_event, (list(event_id ORDER BY ts, event_id))[1:2]::VARCHAR AS head FROM events GROUP BY 1""")
def group_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row's attribute, the first row's id, and the first two ids of each group."""
    e, at = table(spark, sf_dir, "events"), F.struct("ts", "event_id")
    head = sequence.first_wins(e.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", F.col("event_id").alias("first_event"))
    two = relational.examples_per_group(e, "user_id", ["ts", "event_id"], 2).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "event_id"))).alias("x"))
    two = two.select("user_id", F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: r["event_id"].cast("string")), ", "), F.lit("]")).alias("head"))
    return e.groupBy("user_id").agg(F.max_by("event_type", at).alias("last_type")).join(head, "user_id").join(two, "user_id")
