"""Queries of renderers, rows, readers and of what the commands use: each calls the library's own function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.domain import blocks, inference, protocol, rows, series, texts, usage
from logweave.functions import packed
from logweave.operators import relational, split, textops
from logweave.plans.catalog import query, spread, table
from logweave.plans.domain_catalog import _FOLD, _LABELS, _STATES, _line_hits, event_logs
from logweave.plans.state_catalog import _PACKED
from logweave.sources import readers
from logweave.sources.shared import folder


@query(
    f"""WITH {_FOLD}, b AS (SELECT match_id, side, stat, lo, hi, list_position(['hp', 'atk', 'def', 'spa', 'spd', 'spe'], stat) AS place FROM known WHERE final AND (lo > 0 OR hi < 252)),
l AS (SELECT match_id, side, string_agg(['HP', 'Atk', 'Def', 'SpA', 'SpD', 'Spe'][place] || ' ' || CASE WHEN lo = hi THEN '= ' || lo WHEN lo <= 0 THEN '≤ ' || hi WHEN hi >= 252 THEN '≥ ' || lo ELSE lo || '–' || hi END, ', ' ORDER BY place) || CASE WHEN count(*) < 6 THEN ', others ?' ELSE '' END AS told FROM b GROUP BY ALL)
SELECT DISTINCT l_orderkey::VARCHAR AS match_id, s.side AS side, CASE WHEN s.side = 'p1' THEN '=== YOUR SPREADS ===' || chr(10) || '  A: ' || coalesce(told, 'unknown') || chr(10) || '  B: unknown' ELSE '=== OPP SPREADS ===' || chr(10) || '  A: ' || told END AS text
FROM lineitem CROSS JOIN (SELECT unnest(['p1', 'p2']) AS side) s LEFT JOIN l ON l.match_id = l_orderkey::VARCHAR AND l.side = s.side WHERE s.side = 'p1' OR told IS NOT NULL"""
)
def spread_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each side's investments at the end: all of the own team, of the other one only what was inferred."""
    hits = _line_hits(spark, sf_dir)
    final = inference.fold(hits, turns=False).select("match_id", "side", "species_key", "stat", "lo", "hi")
    roster = hits.select("match_id").distinct().select("match_id", F.explode(F.array(F.lit("p1"), F.lit("p2"))).alias("side")).select("*", F.posexplode(F.array(F.lit("A"), F.lit("B"), F.lit("a"))).alias("pos", "species"))
    lines = blocks.spread_lines(roster, final, ["match_id", "side"])
    own = F.col("side") == "p1"
    return blocks.spread_block(lines, ["match_id", "side"], F.when(own, "YOUR SPREADS").otherwise("OPP SPREADS"), ~own)


@query(
    """SELECT p_partkey AS k, 'Team:' || chr(10) || CASE WHEN p_partkey % 2 = 0 THEN '★ ' ELSE '  ' END || 'Mon ' || (p_partkey % 3) || ' A @ Safety Goggles, ability=Intimidate, tera=' || CASE WHEN p_partkey % 2 = 1 THEN 'Fire' ELSE '?' END || chr(10) || '      moves: ' || CASE p_partkey % 3 WHEN 0 THEN 'Knock Off' WHEN 1 THEN 'Knock Off / Fake Out' ELSE 'Knock Off / Fake Out / Uturn / Protect' END
|| CASE WHEN p_partkey % 4 = 1 THEN chr(10) || '  Solo @ ?, ability=?, tera=?' || chr(10) || '      moves: ' ELSE '' END || chr(10) || '{other}' AS prompt, CASE WHEN p_partkey % 7 < 4 THEN 4 - p_partkey % 7 ELSE 0 END::INT AS unknown FROM part WHERE p_partkey % 4 <> 2"""
)
def team_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), "k")
    p = p.select("k", packed.decoded(F.expr(_PACKED)).alias("team")).where("team is not null")
    brought = F.when(F.col("k") % 2 == 0, F.array(F.concat(F.lit("mon"), (F.col("k") % 3).cast("string"), F.lit("a"))))
    prompt = blocks.system_prompt("Team:\n{team}\n{other}", team=blocks.sheet(F.col("team"), brought))
    return p.select("k", prompt.alias("prompt"), F.size(blocks.placeholders(F.col("k") % 7, F.col("k") % 2 == 0)).alias("unknown"))


@query(
    f"""WITH {_LABELS}, clear AS (SELECT game_id, turn, string_agg(action_type, ',' ORDER BY slot) AS actions FROM labels GROUP BY ALL HAVING count(*) = count(action_type)),
state AS (SELECT game_id, turn, '=== GAME STATE ===' || chr(10) || string_agg('[' || slot || '] ' || coalesce(species, '?') || ' | HP ' || CASE WHEN fainted THEN '0%' ELSE printf('%.1f', hp_percent) || '%' END || CASE WHEN revealed <> '' THEN ' | moves: ' || replace(revealed, ',', ', ') ELSE '' END, chr(10) ORDER BY slot) AS text FROM snap GROUP BY ALL),
hit AS (SELECT user_id, grp, string_agg(s || ' ' || printf('%.1f', was) || '→' || printf('%.1f', hp) || CASE WHEN hp <= 0 THEN ' KO' ELSE '' END, ', ' ORDER BY pos) AS hits FROM st WHERE event_type = 'purchase' GROUP BY ALL),
told AS (SELECT user_id, n, pos, CASE event_type WHEN 'click' THEN slot || ': ' || mv || coalesce(' → ' || hits, '') WHEN 'signup' THEN slot || ': ' || coalesce(left_sp, '–') || ' ⇒ ' || sp ELSE slot || ': can''t move (par)' END AS told FROM st LEFT JOIN hit USING (user_id, grp) WHERE event_type <> 'purchase'),
history AS (SELECT user_id::VARCHAR AS game_id, n + 1 AS turn, 'Turn ' || n || chr(10) || '  ' || string_agg(told, chr(10) || '  ' ORDER BY pos) AS text FROM told GROUP BY user_id, n)
SELECT c.game_id, c.turn::INT AS turn, s.text || coalesce(chr(10) || chr(10) || '=== TURN HISTORY ===' || chr(10) || h.text, '') AS prompt, actions FROM clear c JOIN state s ON s.game_id = c.game_id AND s.turn = c.turn LEFT JOIN history h ON h.game_id = c.game_id AND h.turn = c.turn"""
)
def turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rows.turn_rows(event_logs(spark, sf_dir))
    return r.withColumn("actions", F.array_join(F.transform("actions", lambda x: x["action"]["action_type"]), ","))


@query(
    """WITH a AS (SELECT l_orderkey AS game_id, l_linenumber AS turn, CASE WHEN l_suppkey % 2 = 0 THEN 'p1' ELSE 'p2' END AS side, l_partkey AS slot, CASE l_partkey % 3 WHEN 0 THEN 'Shadow Tag' WHEN 1 THEN 'Intimidate' END AS ability, l_partkey % 5 = 0 AS ghost, l_partkey % 7 = 0 AS shell FROM lineitem),
t AS (SELECT game_id, 0 AS turn, side, slot, any_value(ability) AS ability, any_value(ghost) AS ghost, any_value(shell) AS shell FROM a GROUP BY ALL)
SELECT game_id, side, slot, NOT ghost AND NOT shell AND EXISTS (SELECT 1 FROM t f WHERE f.game_id = t.game_id AND f.side <> t.side AND f.ability = 'Shadow Tag') AS trapped FROM t"""
)
def trapped_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_partkey")
    a = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.lit(0).alias("turn"), F.when(F.col("l_suppkey") % 2 == 0, "p1").otherwise("p2").alias("side"), k.alias("slot"),
        F.when(k % 3 == 0, "Shadow Tag").when(k % 3 == 1, "Intimidate").alias("ability"), F.when(k % 5 == 0, F.array(F.lit("Ghost"))).otherwise(F.array(F.lit("Water"))).alias("types"), F.when(k % 7 == 0, "Shed Shell").alias("item"),
    ).distinct()
    return series.trapped(a, ["shadowtag", "arenatrap"]).select("game_id", "side", "slot", "trapped")


@query(
    """WITH g AS (SELECT o_custkey AS m, o_orderkey AS g, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n, CASE o_orderkey % 3 WHEN 0 THEN 'p1' WHEN 1 THEN 'p2' END AS winner FROM orders)
SELECT m, count(*) FILTER (n < 3)::INT AS dropped, count(*) FILTER (n >= 3)::INT AS kept, CASE WHEN count(*) FILTER (winner = 'p1') > count(*) FILTER (winner = 'p2') THEN 'p1' WHEN count(*) FILTER (winner = 'p2') > count(*) FILTER (winner = 'p1') THEN 'p2' END AS winner FROM g GROUP BY m"""
)
def match_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games of a customer's match, lines as snapshots: fragments dropped, and the match's winner."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey").join(n, "o_orderkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    winner = F.when(F.col("o_orderkey") % 3 == 0, "p1").when(F.col("o_orderkey") % 3 == 1, "p2")
    won = series.series_winner(o.select(F.col("o_custkey").alias("match_id"), winner.alias("winner")))
    snapshots = F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n"))).otherwise(F.array().cast("array<long>"))
    m = o.groupBy(F.col("o_custkey").alias("match_id")).agg(F.collect_list(F.struct("o_orderkey", snapshots.alias("snapshots"))).alias("games"))
    d = series.without_fragments(m).join(won, "match_id")
    return d.select(F.col("match_id").alias("m"), F.col("dropped_fragment_games").alias("dropped"), F.size("games").alias("kept"), "winner")


@query(
    f"""WITH {_STATES}, m AS (SELECT user_id, grp, slot AS hitter, mv AS used, n AS turn FROM st WHERE event_type = 'click'),
h AS (SELECT user_id, grp, hitter, used, turn, s AS target, count(*) AS hits, any_value(was) AS was, any_value(hp) AS hp FROM st JOIN m USING (user_id, grp) WHERE event_type = 'purchase' AND hp < was AND left(hitter, 2) <> left(s, 2) GROUP BY ALL)
SELECT user_id::VARCHAR AS game_id, turn::INT AS turn, hitter AS attacker_slot, target AS defender_slot, used AS move_name, was AS hp_before_pct, hp AS hp_after_pct FROM h WHERE hits = 1"""
)
def damage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inference.damage_events(protocol.events(event_logs(spark, sf_dir)))
    return d.select("game_id", "turn", "attacker_slot", "defender_slot", "move_name", "hp_before_pct", "hp_after_pct")


@query(
    """WITH m AS (SELECT l_orderkey AS game_id, l_suppkey AS attacker, 'M' || (l_partkey % 9) AS move, l_partkey AS defender, l_linenumber AS line, l_quantity::DOUBLE AS hi FROM lineitem), b AS (SELECT game_id, attacker, move, max(hi) AS best FROM m GROUP BY ALL)
SELECT game_id, attacker, (SELECT count(*) FROM m JOIN b USING (game_id, attacker, move) WHERE best >= 15 AND m.game_id = x.game_id AND m.attacker = x.attacker) AS shown, coalesce(string_agg(move, ',' ORDER BY move) FILTER (best < 15), '') AS chip FROM b x GROUP BY game_id, attacker"""
)
def chip_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"), F.lit(1).alias("turn"), F.col("l_suppkey").alias("attacker"), F.concat(F.lit("M"), (F.col("l_partkey") % 9).cast("string")).alias("move"), F.col("l_partkey").alias("defender"), F.col("l_quantity").cast("double").alias("hi"))
    shown, chip = inference.chip_free(m)
    key = ["game_id", "attacker"]
    n = shown.groupBy(*key).agg(F.count("*").alias("shown"))
    j = m.select(*key).distinct().join(n, key, "left").join(chip.select(*key, F.array_join("moves", ",").alias("chip")), key, "left")
    return j.select(*key, F.coalesce("shown", F.lit(0)).alias("shown"), F.coalesce("chip", F.lit("")).alias("chip"))


@query(
    """WITH c AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL),
x AS (SELECT *, turn % 11 = 0 AS broken FROM c) SELECT role, count(*) FILTER (NOT broken) AS good, count(*) FILTER (broken) AS dead, coalesce(sum(length(coalesce(text, ''))) FILTER (NOT broken), 0)::BIGINT AS chars FROM x GROUP BY role"""
)
def json_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as JSON lines, every eleventh of a conversation cut in half, and read back: good rows and dead letters by role."""
    path = folder(spark, "json")
    c = table(spark, sf_dir, "conversations").where("conv_id is not null AND turn is not null AND role is not null")
    line = F.to_json(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))
    c.select("role", F.when(F.col("turn") % 11 == 0, F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit(', "role'))).otherwise(line).alias("value")).write.partitionBy("role").text(path)
    raw = readers.json_rows(spark, path, "turn int, text string").withColumn("role", F.regexp_extract(F.input_file_name(), "role=([^/]*)/", 1))
    good, dead = readers.routed(raw, F.col(readers.CORRUPT).isNull())
    n = good.groupBy("role").agg(F.count("*").alias("good"), F.sum(F.length("text")).alias("chars"))
    dead.select("role", "turn", F.col(readers.CORRUPT).alias("line")).write.json(letters := folder(spark, "dead-letters"))
    d = spark.read.schema("role string, line string").json(letters).groupBy("role").agg(F.count("line").alias("dead"))
    j = n.join(d, "role", "full")
    return j.select("role", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("good", "dead", "chars")])


@query(
    """WITH g AS (SELECT 'g' || (o_orderkey % 5000) AS id, o_orderkey % 4 + 1 AS n_players, o_orderkey % 6 = 0 AS private, o_orderkey AS up FROM orders)
SELECT id, min(up) AS uploadtime, arg_min(n_players, up)::INT AS players FROM g WHERE n_players >= 2 AND NOT private GROUP BY id"""
)
def game_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(F.concat(F.lit("g"), (k % 5000).cast("string")).alias("id"), F.lit("f").alias("formatid"), F.array_repeat(F.lit("x"), (k % 4 + 1).cast("int")).alias("players"), k.alias("uploadtime"), (k % 6 == 0).alias("private"))
    return readers.game_headers(raw).select("id", "uploadtime", F.size("players").alias("players"))


@query(
    """WITH m AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders), w AS (SELECT max(month) AS month FROM m WHERE month <= '1997-05' AND month >= '1996-05') SELECT o_orderkey, month FROM m JOIN w USING (month)"""
)
def latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return readers.latest_month(o, "month", "1997-05").select("o_orderkey", "month")


@query("SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id % 10 > 0")
def holdout_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as holdout lists, in lines of text and as JSON, read back and left out."""
    path = folder(spark, "holdout")
    d = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("id"))
    held = d.where("cast(id AS long) % 10 = 0").distinct().withColumn("part", F.pmod(F.xxhash64("id"), F.lit(16)))
    listed = held.groupBy("part").agg(F.collect_list("id").alias("ids"))  # one sixteenth of a list that is a file
    text = F.when(F.col("part") % 3 == 0, F.array_join("ids", "\n")).when(F.col("part") % 3 == 1, F.to_json("ids")).otherwise(F.to_json(F.struct(F.col("ids").alias("holdout"))))
    listed.select("part", text.alias("value")).write.partitionBy("part").text(path)
    out = readers.excluded_ids(spark, path)
    return relational.without(d, out, ["id"])


@query("SELECT count(*)::BIGINT AS n, sum(s_suppkey)::BIGINT AS ids, true AS clean FROM supplier WHERE s_suppkey % 9 > 0")
def transcript_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts written to a file each, one in nine of them blank, and read back clean."""
    path = folder(spark, "transcripts")
    k = F.col("s_suppkey")
    text = F.when(k % 9 > 0, F.concat(F.lit("[00:0"), (k % 10).cast("string"), F.lit("] Speaker A: first  line\n1:23 text "), k.cast("string"), F.lit("\n   "))).otherwise(" \n [00:12] \n")
    spread(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    raw = readers.transcripts(spark, path)
    words = F.regexp_extract("text", r"text (\d+)", 1).try_cast("long")
    return raw.agg(F.count("*").alias("n"), F.sum(words).alias("ids"), F.bool_and(~F.col("text").rlike(r"\d:\d|Speaker|\s\s")).alias("clean"))


@query(
    """WITH p AS (SELECT 'S-' || (p_size % 7) AS species, p_brand, p_type, sum(p_retailprice) AS w FROM part GROUP BY ALL) SELECT 's' || right(species, 1) AS species_key, p_brand AS field, p_type AS value, round(w, 4) AS weight FROM p"""
)
def usage_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").groupBy(F.concat(F.lit("S-"), (F.col("p_size") % 7).cast("string")).alias("species"), "p_brand", "p_type").agg(F.sum("p_retailprice").alias("w"))
    inner = p.groupBy("species", "p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "w"))).alias("values"))  # a species' containers
    raw = inner.groupBy("species").agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "values"))).alias("data"))
    return usage.marginals(raw).select("species_key", "field", "value", F.round("weight", 4).alias("weight"))


@query(
    """WITH t AS (SELECT o_custkey % 3 AS g, CASE WHEN o_orderkey % 4 = 0 THEN 1 WHEN o_orderkey % 4 = 1 THEN 5 ELSE o_orderkey % 13 END AS turns, o_orderkey FROM orders), c AS (SELECT g, list(turns ORDER BY turns) AS v FROM t GROUP BY g)
SELECT g, CASE WHEN turns <= v[len(v) // 3 + 1] THEN 'short' WHEN turns <= v[2 * len(v) // 3 + 1] THEN 'medium' ELSE 'long' END AS bucket, count(*) AS n, sum(turns)::BIGINT AS turns FROM t JOIN c USING (g) GROUP BY ALL"""
)
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    t = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).alias("g"), F.when(k % 4 == 0, 1).when(k % 4 == 1, 5).otherwise(k % 13).alias("turns"))
    cuts = split.index_terciles(t, "g", "turns")
    b = t.join(cuts, "g").withColumn("bucket", split.bucket(F.col("turns"), F.col("low_cut"), F.col("high_cut")))
    return b.groupBy("g", "bucket").agg(F.count("*").alias("n"), F.sum("turns").alias("turns"))


@query(
    """SELECT l_orderkey, l_linenumber, 'Head' || chr(10) || chr(10) || '  M' || (l_partkey % 5) || ' → ' || rpad('D' || (l_suppkey % 9), 14, ' ') || ' ' || printf('%.1f', least(l_quantity, l_linenumber * 9)::DOUBLE) || '–' || printf('%.1f', greatest(l_quantity, l_linenumber * 9)::DOUBLE) || '%' AS text FROM lineitem"""
)
def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda head, n: F.concat(F.lit(head), n.cast("string"))
    m = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text("M", F.col("l_partkey") % 5).alias("move"), text("D", F.col("l_suppkey") % 9).alias("defender"), F.col("l_quantity").cast("double").alias("lo"), (F.col("l_linenumber") * 9).cast("double").alias("hi"))
    return m.select("l_orderkey", "l_linenumber", texts.prompt([F.lit("Head"), F.lit(""), F.lit(None).cast("string"), texts.matrix_line()]).alias("text"))


@query(
    """WITH w AS (SELECT DISTINCT 'S' || (p_size % 9) AS species_key, p_size % 9 AS k FROM part) SELECT species_key, CASE WHEN k % 3 = 0 THEN 'Jolly:4/252/0/0/0/252' WHEN k % 3 = 1 THEN 'Calm:252/0/4/0/252/0' WHEN k = 2 THEN 'Bold:252/0/252/0/4/0' ELSE 'Modest:4/0/0/252/0/252' END AS spread,
CASE k % 3 WHEN 0 THEN 'usage' WHEN 1 THEN 'curated' ELSE 'heuristic' END AS source FROM w"""
)
def spread_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "part").select((F.col("p_size") % 9).alias("k")).distinct().withColumn("species_key", F.concat(F.lit("S"), F.col("k").cast("string")))
    key = w.select("species_key", "k")
    top = key.where("k % 3 = 0").select("species_key", F.lit("Spreads").alias("field"), F.lit(1).alias("rank"), F.lit("Jolly:4/252/0/0/0/252").alias("value"))
    curated = key.where("k % 3 < 2").select("species_key", F.lit("Calm:252/0/4/0/252/0").alias("spread"))
    base = key.where("k = 2").select("species_key", *[F.lit(v).alias(s) for s, v in (("hp", 100), ("atk", 50), ("def", 120), ("spa", 60), ("spd", 90), ("spe", 30))])
    return usage.spreads_with_fallback(w.select("species_key"), top, curated, base)


@query(
    f"""WITH {_STATES} SELECT user_id::VARCHAR AS game_id, CASE WHEN any_value(user_id) % 3 > 0 THEN 'P' || (user_id % 3) END AS winner FROM (SELECT DISTINCT user_id FROM e) GROUP BY user_id"""
)
def game_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir)
    k = F.col("game_id").cast("long") % 3
    return protocol.winners(logs.withColumn("log", F.concat("log", F.lit("\n"), F.when(k > 0, F.concat(F.lit("|win|P"), k.cast("string"))).otherwise("|tie"))))


@query(
    """SELECT o_orderkey, unnest(CASE WHEN k > 0 THEN ['', 'ONE', 'TWO ' || k] ELSE ['ONE', 'TWO ' || k] END) AS title, unnest(CASE WHEN k > 0 THEN ['before', 'body ' || o_custkey, ''] ELSE ['body ' || o_custkey, ''] END) AS body FROM (SELECT o_orderkey, o_custkey, o_orderkey % 3 AS k FROM orders)"""
)
def titled_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    text = F.concat(F.when(k > 0, "before\n").otherwise(" \n"), F.lit("=== ONE ===\nbody "), F.col("o_custkey").cast("string"), F.lit("\n\n=== TWO "), k.cast("string"), F.lit(" ===\n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(textops.sections(text))).withColumn("title", F.coalesce("title", F.lit("")))
