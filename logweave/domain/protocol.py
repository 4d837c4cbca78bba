r"""Protocol logs as tables, by windows over their lines.

A log holds one ``|tag|argument|...`` line per event. :func:`lines` numbers them, with their turn and
move group; :func:`events` gives one row per turn event (move, cant_move, switch, faint, tera,
item_event), hits gathered under their move and side effects after it; :func:`snapshots` gives the
state of every slot and side at the start of each turn. Everything is a window or an aggregation
over (game, position), so games of any length and number spread over the cluster; nothing is
collected per game in Python.

A slot's species is the last one that entered it; with ``fix`` (:func:`logweave.domain.identity.corrected`) it is who really was
there. Conditions with their durations are in :mod:`logweave.domain.conditions`. Not covered, since it needs the game's own rules: trapping by ability.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions import scalars
from logweave.operators import relational, sequence

GAME, POS = ["game_id"], ["pos"]
SWITCHES = ("switch", "drag", "replace")
#: Result tags of a move without damage, and the outcome each means.
OUTCOMES = {"-miss": "miss", "-immune": "immune", "-fail": "fail", "-block": "blocked"}
#: Lines that end the open move.
CLOSES = ("move", "switch", "drag", "turn", "cant", "upkeep", "win", "tie", "faint")


def arg(k: int) -> Column:
    return F.coalesce(F.try_element_at("args", F.lit(k + 1)), F.lit(""))


def tag_is(*tags: str) -> Column:
    return F.col("tag").isin(*tags)


def keyword(name: str) -> Column:
    """Value of an argument ``[name] value``."""
    hit = F.filter("args", lambda a: F.startswith(a, F.lit(f"[{name}]")))
    return F.when(F.size(hit) > 0, scalars.keyword(F.element_at(hit, 1), name))


def percent(condition: Column) -> Column:
    """Remaining health in percent from ``75/100 par`` or ``0 fnt``; null if absent."""
    part = F.regexp_extract(condition, r"^([0-9.]+)/([0-9.]+)", 1).try_cast("double")
    whole = F.regexp_extract(condition, r"^([0-9.]+)/([0-9.]+)", 2).try_cast("double")
    return F.when(F.startswith(condition, F.lit("0 fnt")), 0.0).when(whole > 0, scalars.round_half_up(part * 100 / whole))


def lines(logs: DataFrame) -> DataFrame:
    """game_id, pos, tag, args, turn, group: the parseable lines of ``logs`` (game_id, log)."""
    split = logs.select("game_id", F.posexplode(F.split("log", "\n")).alias("pos", "line")).where(F.startswith("line", F.lit("|")))
    parts = split.select("game_id", "pos", F.split("line", r"\|").alias("p"))
    d = parts.select("game_id", "pos", F.col("p")[1].alias("tag"), F.slice("p", F.lit(3), F.greatest(F.size("p") - 2, F.lit(0))).alias("args")).where("tag <> ''")
    turn = F.last(F.when(tag_is("turn"), F.expr("try_cast(args[0] AS int)")), ignorenulls=True).over(sequence.so_far(GAME, POS))
    d = d.withColumn("turn", F.coalesce(turn, F.lit(0)))
    return d.withColumn("group", sequence.stint(tag_is(*CLOSES), GAME, POS))


Fix = Callable[[DataFrame], DataFrame]


def read(logs: DataFrame, fix: Fix | None) -> DataFrame:
    """The lines of ``logs``, corrected by ``fix`` if it is given."""
    return fix(lines(logs)) if fix else lines(logs)


def slot_history(d: DataFrame) -> DataFrame:
    """``d`` with slot, side, health (on this line) and species (that occupies the slot after this line)."""
    d = d.withColumn("slot", scalars.slot_of(arg(0))).withColumn("side", scalars.side_of(arg(0)))
    enters = F.when(tag_is(*SWITCHES), scalars.head_of(arg(1)))
    d = d.withColumn("species", F.col("named") if "named" in d.columns else F.last(enters, ignorenulls=True).over(sequence.so_far([*GAME, "slot"], POS)))
    health = F.when(tag_is("-damage", "-heal", "-sethp"), percent(arg(1))).when(tag_is(*SWITCHES), percent(arg(2))).when(tag_is("faint"), F.lit(0.0))
    return d.withColumn("health", health)


def hits(d: DataFrame) -> DataFrame:
    """game_id, group, pos, hit: results of the open move. Damage with a source of its own is no hit; a critical hit counts for the next damage of the same target within the move."""
    per_slot = [*GAME, "slot"]
    was = F.coalesce(F.last("health", ignorenulls=True).over(sequence.before(per_slot, POS)), F.lit(100.0))
    crit = F.coalesce(F.bool_or(tag_is("-crit")).over(sequence.before([*GAME, "group", "slot"], POS)), F.lit(False))
    d = d.withColumn("was", was).withColumn("crit", crit)
    direct = tag_is("-damage") & keyword("from").isNull()
    outcome = F.when(direct, "hit")
    for tag, name in OUTCOMES.items():
        outcome = F.when(tag_is(tag), name).otherwise(outcome)
    target = F.when(tag_is("-miss"), F.coalesce(scalars.slot_of(arg(1)), F.col("slot"))).otherwise(F.col("slot"))
    hit = F.struct(
        target.alias("defender_slot"), outcome.alias("outcome"), F.when(direct, F.col("was")).alias("hp_before_pct"), F.when(direct, F.col("health")).alias("hp_after_pct"),
        (direct & F.col("crit")).alias("is_crit"), (direct & (F.col("health") <= 0)).alias("is_ko"),
    )
    return d.where(outcome.isNotNull()).select("game_id", "group", "pos", hit.alias("hit"))


def item_kind() -> Column:
    """What an item line says."""
    how = F.coalesce(keyword("from"), F.lit(""))
    eaten = F.exists("args", lambda a: F.startswith(a, F.lit("[eat]")))
    end = F.when(eaten, "eaten").when(how.contains("Knock Off"), "knocked_off").when(how.contains("Fling"), "flung").when(how.contains("Thief") | how.contains("Covet"), "stolen").otherwise("consumed")
    gain = F.when(how.contains("Trick") | how.contains("Switcheroo"), "swapped").when(how.contains("Frisk"), "revealed").otherwise("gained")
    return F.when(tag_is("-enditem"), end).otherwise(gain)


def events(logs: DataFrame, fix: Fix | None = None) -> DataFrame:
    """One row per turn event, event_pos counting from 0 within the game: see the module's text."""
    d = slot_history(read(logs, fix))
    gathered = hits(d).groupBy("game_id", "group").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "hit"))), lambda x: x["hit"]).alias("hits"))
    kind = (
        F.when(tag_is("move"), "move").when(tag_is("cant"), "cant_move").when(tag_is(*SWITCHES), "switch").when(tag_is("faint"), "faint")
        .when(tag_is("-terastallize"), "tera").when(tag_is("-enditem", "-item"), "item_event")
    )
    before_species = F.last(F.when(tag_is(*SWITCHES), scalars.head_of(arg(1))), ignorenulls=True).over(sequence.before([*GAME, "slot"], POS))
    d = d.withColumn("type", kind).withColumn("from_species", before_species).where("type is not null")
    late = F.col("type") == "item_event"
    order = F.row_number().over(Window.partitionBy("game_id").orderBy("group", late.cast("int"), "pos")) - 1
    is_move = F.col("type") == "move"
    d = d.withColumn("event_pos", order).join(gathered, ["game_id", "group"], "left")
    targets = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["defender_slot"])))
    source = keyword("from")
    no_text = F.lit(None).cast("string")
    return d.select(
        "game_id", "turn", "event_pos", "type", "side", "slot", F.when(is_move, F.col("slot")).alias("attacker_slot"), F.when(is_move, arg(1)).alias("move_name"),
        F.when(is_move, scalars.effect_name(source)).alias("called_via"), F.when(is_move, F.coalesce(targets, F.array().cast("array<string>"))).alias("target_slots"),
        F.when(is_move, F.exists("args", lambda a: F.startswith(a, F.lit("[spread]")))).alias("is_spread"), F.when(is_move, F.col("hits")).alias("hits"),
        F.when(F.col("type") == "cant_move", arg(1)).alias("reason"), F.when(F.col("type") == "cant_move", F.nullif(arg(2), F.lit(""))).alias("attempted_move"),
        F.when(F.col("type") != "switch", F.col("species")).alias("species"), F.when(F.col("type") == "tera", arg(1)).alias("to_type"),
        F.when(F.col("type") == "switch", F.col("from_species")).alias("from_species"), F.when(F.col("type") == "switch", scalars.head_of(arg(1))).alias("to_species"),
        F.when(F.col("type") == "switch", F.when(tag_is("drag"), F.coalesce(scalars.effect_name(source), F.lit("drag"))).when(tag_is("replace"), "replace").otherwise(scalars.effect_name(source))).alias("forced_by"),
        F.when(F.col("type") == "item_event", item_kind()).otherwise(no_text).alias("kind"), F.when(F.col("type") == "item_event", arg(1)).alias("item"),
    )


def first_seen(value: Column, keys: list[str]) -> Column:
    """The value where it comes up for the first time within the keys, else null: so that running lists grow with distinct values only."""
    return F.when(value.isNotNull() & (F.row_number().over(Window.partitionBy(*keys, value).orderBy(*POS)) == 1), value)


def snapshots(logs: DataFrame, fix: Fix | None = None) -> DataFrame:
    """game_id, turn, slot, side, species, hp_percent, fainted, last_move, revealed_moves, item, terastallized, side_faints, seen_species: state of each slot when the turn begins; the first of repeated turn lines.

    A mark for each turn and slot is put among the slot's lines and takes the last state before it, so the work grows with the lines.
    """
    d = slot_history(read(logs, fix))
    stint = [*GAME, "slot"]
    d = d.withColumn("stint", sequence.stint(tag_is(*SWITCHES), stint, POS))
    run = sequence.so_far([*stint, "stint"], POS)
    d = d.withColumn("s_health", F.last("health", ignorenulls=True).over(run))
    d = d.withColumn("s_moves", F.collect_list(first_seen(F.when(tag_is("move") & keyword("from").isNull(), arg(1)), [*stint, "stint"])).over(run))
    d = d.withColumn("s_last", F.last(F.when(tag_is("move"), arg(1)), ignorenulls=True).over(run))
    d = d.withColumn("s_item", F.last(F.when(tag_is("-item"), arg(1)).when(tag_is("-enditem"), F.lit("")), ignorenulls=True).over(run))
    d = d.withColumn("s_tera", F.coalesce(F.bool_or(tag_is("-terastallize")).over(run), F.lit(False)))
    of_side = sequence.so_far([*GAME, "side"], POS)
    d = d.withColumn("s_faints", F.count_if(tag_is("faint")).over(of_side).cast("int"))
    d = d.withColumn("s_seen", F.collect_list(first_seen(F.when(tag_is(*SWITCHES), scalars.head_of(arg(1))), [*GAME, "side"])).over(of_side))
    turns = d.where(tag_is("turn")).groupBy("game_id", "turn").agg(F.min("pos").alias("pos"))
    x, y = F.struct("species", "s_health", "s_moves", "s_last", "s_item", "s_tera"), F.struct("s_faints", "s_seen")
    state = d.where("slot is not null").select("game_id", "slot", "side", "pos", x.alias("x"), y.alias("y"))
    marks = turns.join(state.select("game_id", "slot", "side").distinct(), "game_id")
    u = state.unionByName(marks, allowMissingColumns=True)
    last = lambda c, keys: F.last(c, ignorenulls=True).over(sequence.before(keys, POS))
    u = u.withColumn("x", F.when(F.col("turn").isNull(), F.col("x")).otherwise(last("x", [*GAME, "slot"]))).withColumn("y", last("y", [*GAME, "side"]))
    return u.where("turn is not null AND x is not null").select(
        "game_id", "turn", "slot", "side", "x.species", F.coalesce("x.s_health", F.lit(100.0)).alias("hp_percent"), (F.coalesce("x.s_health", F.lit(100.0)) <= 0).alias("fainted"), F.col("x.s_last").alias("last_move"),
        F.col("x.s_moves").alias("revealed_moves"), F.nullif("x.s_item", F.lit("")).alias("item"), F.col("x.s_tera").alias("terastallized"), F.col("y.s_faints").alias("side_faints"), F.col("y.s_seen").alias("seen_species"),
    )


def brought(logs: DataFrame, fix: Fix | None = None) -> DataFrame:
    """game_id, side, brought: the species that a side sends out anywhere in the log, by first appearance. It looks ahead on purpose: a turn's bench is what comes later or was there before."""
    enters = slot_history(read(logs, fix)).where(tag_is(*SWITCHES)).select("game_id", "side", "pos", scalars.head_of(arg(1)).alias("species"))
    return relational.ordered_distinct(enters, ["game_id", "side"], "species", "pos").withColumnRenamed("values", "brought")


def bench(state: DataFrame, team: DataFrame) -> DataFrame:
    """game_id, turn, side, bench: what a side brought (``team``, of :func:`brought`) and has in no slot when the turn begins; names compared by key."""
    on = state.groupBy("game_id", "turn", "side").agg(F.collect_set(scalars.name_key(F.col("species"))).alias("on"))  # a few slots
    j = on.join(team, ["game_id", "side"])
    return j.select("game_id", "turn", "side", F.filter("brought", lambda s: ~F.array_contains("on", scalars.name_key(s))).alias("bench"))


def conditions(logs: DataFrame) -> DataFrame:
    """game_id, turn, scope (field, p1, p2), name: conditions that hold when the turn begins: the last start or end of each wins."""
    d = lines(logs)
    scope = F.when(tag_is("-sidestart", "-sideend"), scalars.side_of(arg(0))).otherwise("field")
    name = F.when(tag_is("-sidestart", "-sideend"), scalars.effect_name(arg(1))).when(tag_is("-weather"), F.lit("weather")).otherwise(scalars.effect_name(arg(0)))
    value = F.when(tag_is("-weather"), F.when(arg(0) == "none", None).otherwise(arg(0))).when(tag_is("-sidestart", "-fieldstart"), name)
    c = d.where(tag_is("-sidestart", "-sideend", "-fieldstart", "-fieldend", "-weather")).select("game_id", "pos", scope.alias("scope"), name.alias("name"), value.alias("value"))
    turns = d.where(tag_is("turn")).groupBy("game_id", "turn").agg(F.min("pos").alias("pos"))
    marks = turns.join(c.select("game_id", "scope", "name").distinct(), "game_id")
    u = c.select("game_id", "pos", "scope", "name", F.struct("value").alias("v")).unionByName(marks, allowMissingColumns=True)
    held = u.withColumn("v", F.last("v", ignorenulls=True).over(sequence.before([*GAME, "scope", "name"], POS))).where("turn is not null")
    return held.where("v.value is not null").select("game_id", "turn", "scope", F.col("v.value").alias("name"))


def winners(logs: DataFrame) -> DataFrame:
    """game_id, winner (name; null on a tie or without an end)."""
    d = lines(logs).where(tag_is("win", "tie"))
    return d.groupBy("game_id").agg(F.max_by(F.when(tag_is("win"), arg(0)), "pos").alias("winner"))
