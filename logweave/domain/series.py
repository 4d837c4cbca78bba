"""Series of games: stitching, winners, perspective, fragments, teams, labels and their legality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions import scalars
from logweave.operators import quality, relational, sequence


def stitch(games: DataFrame, gap_seconds: int = 1800, ceiling: int = 3) -> DataFrame:
    """``games`` (id, players, uploadtime) with pair (unordered, case-folded), series and match_id, named by the series' first game."""
    g = games.withColumn("pair", F.array_join(F.array_sort(F.transform("players", F.lower)), "|")).withColumn("ts", F.timestamp_seconds("uploadtime"))
    s = sequence.sessionize(g, ["pair"], "ts", "id", gap_seconds, ceiling)
    first = F.first("id").over(Window.partitionBy("pair", "session").orderBy("ts", "id"))
    return s.withColumn("match_id", F.concat(F.lit("bo3-"), first)).withColumnRenamed("session", "series").drop("ts")


def series_winner(games: DataFrame) -> DataFrame:
    """match_id, winner: the side (p1, p2) with more games, null on a tie."""
    return games.groupBy("match_id").agg(relational.majority(F.col("winner") == "p1", F.col("winner") == "p2", "p1", "p2").alias("winner"))


def other_side(c: Column) -> Column:
    """p1 for p2 and the other way, at the head of a side or slot."""
    return F.when(F.startswith(c, F.lit("p1")), F.concat(F.lit("p2"), F.substr(c, F.lit(3)))).when(F.startswith(c, F.lit("p2")), F.concat(F.lit("p1"), F.substr(c, F.lit(3)))).otherwise(c)


def winner_first(df: DataFrame, winner: str = "winner") -> DataFrame:
    """Swaps all sides of rows whose winner is p2: columns side, slot, attacker_slot, target_slots, hits and pairs named p1_*, p2_*; target slots as well as hits."""
    swap = F.coalesce(F.col(winner) == "p2", F.lit(False))
    out = df
    for c in ("side", "slot", "attacker_slot"):
        if c in df.columns:
            out = out.withColumn(c, F.when(swap, other_side(F.col(c))).otherwise(F.col(c)))
    if "target_slots" in df.columns:
        out = out.withColumn("target_slots", F.when(swap, F.transform("target_slots", other_side)).otherwise(F.col("target_slots")))
    if "hits" in df.columns:
        flipped = F.transform("hits", lambda h: h.withField("defender_slot", other_side(h["defender_slot"])))
        out = out.withColumn("hits", F.when(swap, flipped).otherwise(F.col("hits")))
    for c in [c for c in df.columns if c.startswith("p1_") and "p2_" + c[3:] in df.columns]:
        a, b = F.col(f"{c}"), F.col(f"p2_{c[3:]}")
        out = out.withColumn("__a", F.when(swap, b).otherwise(a)).withColumn("__b", F.when(swap, a).otherwise(b)).drop(c, f"p2_{c[3:]}").withColumnRenamed("__a", c).withColumnRenamed("__b", f"p2_{c[3:]}")
    return out


def summaries(games: DataFrame) -> DataFrame:
    """``games`` (match_id, game_no, winner, turns, id) with earlier: a line for each game of the match before this one."""
    line = F.concat(F.lit("Game "), F.col("game_no").cast("string"), F.lit(": "), F.coalesce(F.concat("winner", F.lit(" won")), F.lit("tie")), F.lit(" in "), F.col("turns").cast("string"), F.lit(" turns"))
    before = F.collect_list(line).over(sequence.before(["match_id"], ["game_no", "id"]))
    return games.withColumn("earlier", F.array_join(before, "\n"))


def without_fragments(matches: DataFrame, least_turns: int = 2) -> DataFrame:
    """``matches`` with the games that have at least so many turns (snapshots less one), and dropped_fragment_games."""
    keep = F.filter("games", lambda g: F.greatest(F.size(g["snapshots"]) - 1, F.lit(0)) >= least_turns)
    return matches.withColumn("dropped_fragment_games", F.size("games") - F.size(keep)).withColumn("games", keep)


def reconstruct_teams(seen: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, species_key) from sightings (species, item, ability, tera_type, moves, pos): first non-null attributes, first four moves in order, best display name."""
    s = seen.withColumn("species_key", scalars.name_key(F.col("species")))
    shown = F.struct((F.col("species") == F.lower("species")).cast("int"), F.col("pos"))  # a name with capitals first
    one = s.groupBy(*keys, "species_key").agg(
        F.min_by("species", shown).alias("species"),
        *[relational.first_non_null(F.nullif(F.col(c), F.lit("")), F.col("pos")).alias(c) for c in ("item", "ability", "tera_type")],
        F.min("pos").alias("first_pos"),
    )
    moves = relational.ordered_distinct(s.select(*keys, "species_key", F.posexplode("moves").alias("at", "move"), "pos").withColumn("o", F.struct("pos", "at")), [*keys, "species_key"], "move", "o")
    out = one.join(moves, [*keys, "species_key"], "left")
    return out.withColumn("moves", relational.padded(F.coalesce("values", F.array().cast("array<string>")), 4, "?")).drop("values")


def labels(pre: DataFrame, post: DataFrame, events: DataFrame, side: str = "p1") -> DataFrame:
    """game_id, turn, slot, action (action_type, move, target, tera, switch_to): what each slot of the side chose.

    ``pre`` and ``post`` are slot states (game_id, turn, slot, species, fainted, terastallized); post is
    the next turn's. In order: absent or fainted: pass; last switch that wasn't forced; first own move;
    couldn't move: pass; else null, and with a null slot the whole turn is ambiguous.
    """
    key = ["game_id", "turn", "slot"]
    mine = events.where(F.startswith("slot", F.lit(side)))
    own = (F.col("type") == "move") & (F.col("called_via").isNull() | (F.col("called_via") == "Sleep Talk"))
    chosen = (F.col("type") == "switch") & F.col("forced_by").isNull()
    did = mine.groupBy(*key).agg(
        F.max_by(F.when(chosen, F.col("to_species")), F.when(chosen, F.col("event_pos"))).alias("switch_to"),
        F.min_by(F.when(own, F.struct("move_name", "hits")), F.when(own, F.col("event_pos"))).alias("m"),
        F.bool_or(F.col("type") == "cant_move").alias("cant"),
    )
    slots = pre.select("game_id", "turn").distinct().crossJoin(F.broadcast(pre.sparkSession.createDataFrame([(side + "a",), (side + "b",)], "slot string")))  # two rows
    now = pre.select(*key, "species", "fainted", F.col("terastallized").alias("tera_before"))
    then = post.select("game_id", (F.col("turn") - 1).alias("turn"), "slot", F.col("species").alias("species_after"), F.col("terastallized").alias("tera_after"))
    j = slots.join(now, key, "left").join(then, key, "left").join(did, key, "left")
    targets = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("m.hits", F.array()), lambda h: h["defender_slot"]), lambda x: x.isNotNull())))
    target = F.when(F.size(targets) == 0, "self").when(F.size(targets) == 1, F.get(targets, F.lit(0))).otherwise("spread")
    tera = (F.col("species_after") == F.col("species")) & F.coalesce("tera_after", F.lit(False)) & ~F.coalesce("tera_before", F.lit(False))
    none = F.lit(None).cast("string")
    made = lambda kind, move=none, target=none, tera=F.lit(False), to=none: F.struct(F.lit(kind).alias("action_type"), move.alias("move"), target.alias("target"), tera.alias("tera"), to.alias("switch_to"))
    action = (
        F.when(F.col("species").isNull() | F.coalesce("fainted", F.lit(False)), made("pass"))
        .when(F.col("switch_to").isNotNull(), made("switch", to=F.col("switch_to")))
        .when(F.col("m").isNotNull(), made("move", F.col("m.move_name"), target, F.coalesce(tera, F.lit(False))))
        .when(F.coalesce("cant", F.lit(False)), made("pass"))
    )
    return j.select(*key, action.alias("action"))


def clear_turns(actions: DataFrame) -> DataFrame:
    """game_id, turn, actions: turns of which every slot's action is known."""
    t = actions.groupBy("game_id", "turn").agg(F.bool_and(F.col("action").isNotNull()).alias("clear"), F.array_sort(F.collect_list(F.struct("slot", "action"))).alias("actions"))
    return t.where("clear").drop("clear")


def legality_checks() -> dict[str, quality.Check]:
    """Six rules over a row with action, trapped, choice_lock, encored, disabled, known_moves, tera_used: a played action that breaks one is a data error."""
    a = lambda x: F.col(f"action.{x}")
    move = a("action_type") == "move"
    key = scalars.name_key
    forced = lambda c: move & (F.col(c) != "") & (key(F.col(c)) != key(a("move")))
    return {
        "trapped_switch": quality.Check((a("action_type") == "switch") & F.col("trapped")),
        "not_in_moveset": quality.Check(move & (F.size("known_moves") >= 4) & ~F.array_contains(F.transform("known_moves", key), key(a("move")))),
        "choice_locked": quality.Check(forced("choice_lock")),
        "encored": quality.Check(forced("encored")),
        "disabled": quality.Check(move & (key(F.col("disabled")) == key(a("move")))),
        "second_tera": quality.Check(move & a("tera") & F.col("tera_used")),
    }


def trapped(actives: DataFrame, trappers: list[str]) -> DataFrame:
    """``actives`` (game_id, turn, side, slot, ability, types, item) with trapped: some active of the other side has a trapping ability; Ghost types and shed shells never are."""
    foes = actives.where(scalars.name_key(F.col("ability")).isin(*trappers)).select("game_id", "turn", F.col("side").alias("foe_side")).distinct()
    by = foes.groupBy("game_id", "turn").agg(F.collect_set("foe_side").alias("foes"))  # at most two
    j = actives.join(by, ["game_id", "turn"], "left")
    exempt = F.array_contains("types", "Ghost") | (scalars.name_key(F.coalesce("item", F.lit(""))) == "shedshell")
    held = F.exists(F.coalesce("foes", F.array().cast("array<string>")), lambda s: s != F.col("side"))
    return j.withColumn("trapped", held & ~F.coalesce(exempt, F.lit(False))).drop("foes")
