r"""Timed conditions and volatile effects of a protocol log, with the turns that are left.

A condition belongs to the field, to a side or to who is in a slot. Its marks become intervals
(:mod:`logweave.operators.spans`), which end with an end line, a restart, a switch or a faint, or when the longest
duration is over. Time is counted in ``|upkeep|`` lines, so what begins after a turn's upkeep isn't a turn
older at the next turn; logs without any are counted in turns.

- A second layer of what has layers adds a level; layers have no duration.
- A ``[upkeep]`` weather line only repeats what holds. Another weather or terrain takes the place of the one before.
- ``|-swapsideconditions|`` exchanges the sides' conditions with their time: they are kept by lane, and a lane's side is read off at every turn.
- A volatile effect ends when its occupant leaves, but for a Baton Pass.

:func:`timed` gives one row per turn and condition that holds when the turn begins: game_id, turn, scope (field, p1,
p2, or a slot), name, value, level, since_turn, turns_left (by the shorter duration, null once that is over), turns_left_max (by the longer one;
null if there is none). A log is one window partition. Null logs, logs without turns and empty ones have no rows; of repeated or falling turn
numbers the first counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.domain import protocol
from logweave.domain.protocol import GAME, POS, arg, tag_is
from logweave.functions import scalars
from logweave.operators import sequence, spans

#: Turns that a condition lasts, and those with an item that makes it longer.
DURATIONS = {
    "weather": (5, 8),
    "terrain": (5, 8),
    "Aurora Veil": (5, 8),
    "Gravity": (5, 5),
    "Light Screen": (5, 8),
    "Lucky Chant": (5, 5),
    "Magic Room": (5, 5),
    "Mist": (5, 5),
    "Reflect": (5, 8),
    "Safeguard": (5, 5),
    "Tailwind": (4, 4),
    "Trick Room": (5, 5),
    "Wonder Room": (5, 5),
    "confusion": (2, 5),
    "Disable": (5, 5),
    "Embargo": (5, 5),
    "Encore": (3, 3),
    "Heal Block": (5, 5),
    "Magnet Rise": (5, 5),
    "Taunt": (3, 3),
    "Telekinesis": (3, 3),
    "Throat Chop": (2, 2),
}
#: The most layers of side conditions.
LAYERS = {"Spikes": 3, "Stealth Rock": 1, "Sticky Web": 1, "Toxic Spikes": 2}
#: Turns left to an occupant that has heard the song.
COUNTS = {"perish1": "1", "perish2": "2", "perish3": "3"}


def clocked(logs: DataFrame) -> DataFrame:
    """Lines with slot, stint, tick (turns begun before), clock (upkeeps before), lane (0: as printed, 1: sides swapped) and begins (a turn's first line)."""
    d = protocol.slot_history(protocol.lines(logs))
    so_far = sequence.so_far(GAME, POS)
    number = F.when(tag_is("turn"), F.col("turn"))
    d = d.withColumn("begins", number > F.coalesce(F.max(number).over(sequence.before(GAME, POS)), F.lit(-1)))
    d = d.withColumn("begins", F.coalesce("begins", F.lit(False)))
    d = d.withColumn("tick", F.count_if("begins").over(so_far)).withColumn("ups", F.count_if(tag_is("upkeep")).over(so_far))
    d = d.withColumn("lane", (F.count_if(tag_is("-swapsideconditions")).over(so_far) % 2).cast("int"))
    whole = Window.partitionBy(*GAME)
    d = d.withColumn("ticks", F.max("tick").over(whole)).withColumn("clock", F.when(F.max("ups").over(whole) > 0, F.col("ups")).otherwise(F.col("tick"))).drop("ups")
    return d.withColumn("stint", sequence.stint(leaves(), [*GAME, "slot"], POS))


def leaves() -> Column:
    """The slot's occupant changes, and takes its effects with it."""
    return tag_is("switch", "drag") & (F.coalesce(protocol.keyword("from"), F.lit("")) != "Baton Pass")


def other(side: Column) -> Column:
    return F.when(side == "p1", "p2").when(side == "p2", "p1")


def family(name: Column) -> Column:
    """What can hold once only in a scope: one terrain, one count of a song."""
    return F.when(F.endswith(name, F.lit(" Terrain")), "terrain").when(name.isin(*COUNTS), "perish").otherwise(name)


def marks(d: DataFrame) -> DataFrame:
    """game_id, pos, tick, clock, ticks, turn, scope, stint, family, name, value, starts, told, stop: start and end lines of conditions."""
    of_side, of_field, of_slot = tag_is("-sidestart", "-sideend"), tag_is("-fieldstart", "-fieldend"), tag_is("-start", "-end")
    side = scalars.side_of(arg(0))
    scope = F.when(of_side, F.when(F.col("lane") == 1, other(side)).otherwise(side)).when(of_slot, F.col("slot")).otherwise("field")
    name = F.when(tag_is("-weather"), arg(0)).when(of_field, scalars.effect_name(arg(0))).otherwise(scalars.effect_name(arg(1)))
    last_move = sequence.last_since_reset(F.when(tag_is("move"), arg(1)), [*GAME, "slot"], POS, "stint")
    d = d.withColumn("last_move", last_move)
    gone = F.when(leaves() | tag_is("faint"), F.col("tick"))
    later = Window.partitionBy(*GAME, "slot").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("gone", F.last(gone, ignorenulls=True).over(later))
    d = d.where(of_side | of_field | of_slot | tag_is("-weather")).withColumn("scope", scope).withColumn("name", name)
    value = F.when(F.col("name") == "Encore", F.col("last_move")).when(F.col("name") == "Disable", F.nullif(arg(2), F.lit("")))
    for told, count in COUNTS.items():
        value = F.when(F.col("name") == told, count).otherwise(value)
    starts = F.when(tag_is("-weather"), arg(0) != "none").otherwise(tag_is("-sidestart", "-fieldstart", "-start"))
    told = tag_is("-weather") & F.exists("args", lambda a: a == "[upkeep]")
    return d.where("scope is not null AND name <> ''").select(
        "game_id", "pos", "tick", "clock", "ticks", "turn", "scope", F.when(of_slot, F.col("stint")).otherwise(0).alias("stint"),
        F.when(tag_is("-weather"), "weather").otherwise(family(F.col("name"))).alias("family"), "name", value.alias("value"), starts.alias("starts"), told.alias("told"), F.when(of_slot, F.col("gone")).alias("stop"),
    )


def timed(logs: DataFrame, durations: Mapping[str, tuple[int, int]] | None = None, layers: Mapping[str, int] | None = None) -> DataFrame:
    """Conditions that hold when a turn begins; see the module's text."""
    durations, layers = DURATIONS if durations is None else durations, LAYERS if layers is None else layers
    d = clocked(logs)
    key = ["game_id", "scope", "stint", "family"]
    m = marks(d)
    # a repeated weather line starts nothing, unless the one before it was of another weather, or missing
    before = F.lag(F.when(F.col("starts"), F.col("name")).otherwise("")).over(sequence.ordered(key, POS))
    m = m.withColumn("told", F.col("told") & F.coalesce(before == F.col("name"), F.lit(False))).where("NOT told")
    # an end line of another name of the family (a terrain that is no more, a count) ends nothing
    on = F.last(F.when(F.col("starts"), F.col("name")), ignorenulls=True).over(sequence.before(key, POS))
    m = m.withColumn("on", on).where("starts OR family = 'weather' OR coalesce(on, '') = name").drop("on")
    s = spans.intervals(m, key, POS, "starts", "tick", stop="stop")
    most = pick(layers, lambda n: n)
    s = s.withColumn("level", F.when(most.isNotNull(), F.least("level", most)))
    shorter, longer = pick(durations, lambda x: x[0]), pick(durations, lambda x: x[1])
    s = s.withColumn("shorter", F.when(most.isNull(), shorter)).withColumn("longer", F.when(most.isNull(), longer))
    turns = d.where("begins").select("game_id", "tick", F.col("turn").alias("at_turn"), F.col("clock").alias("at_clock"), F.col("lane").alias("at_lane"))
    held = spans.at_ticks(s.withColumnRenamed("turn", "since_turn"), turns, GAME, "tick", "ticks")
    elapsed = F.col("at_clock") - F.col("clock")
    held = held.where(F.col("longer").isNull() | (elapsed < F.col("longer")))
    scope = F.when((F.col("at_lane") == 1) & F.col("scope").isin("p1", "p2"), other(F.col("scope"))).otherwise(F.col("scope"))
    return held.select(
        "game_id", F.col("at_turn").alias("turn"), scope.alias("scope"), "name", "value", "level", "since_turn",
        spans.left(F.col("shorter"), elapsed).cast("int").alias("turns_left"), spans.left(F.col("longer"), elapsed).cast("int").alias("turns_left_max"),
    )


def pick(table: Mapping, of) -> Column:
    """The entry of a condition's name, or of its family."""
    out = F.lit(None).cast("int")
    for name, x in table.items():
        out = F.when((F.col("name") == name) | (F.col("family") == name), of(x)).otherwise(out)
    return out


def by_scope(held: DataFrame) -> DataFrame:
    """game_id, turn, scope, conditions: JSON with only what is set, by name; a few conditions for each scope and turn."""
    what = F.struct("name", F.to_json(F.struct("value", "level", F.col("turns_left").alias("turnsLeft"))).alias("x"))
    listed = F.transform(F.array_sort(F.collect_list(what)), lambda c: F.concat(F.lit('"'), c["name"], F.lit('":'), c["x"]))
    return held.groupBy("game_id", "turn", "scope").agg(F.concat(F.lit("{"), F.array_join(listed, ","), F.lit("}")).alias("conditions"))


def lines_of(held: DataFrame) -> DataFrame:
    """game_id, turn, text: one line for each scope, ``p1: Spikes x2, Tailwind (3 turns left)``."""
    one = F.concat("name", F.coalesce(F.concat(F.lit(" "), F.col("value")), F.lit("")), F.when(F.col("level") > 1, F.concat(F.lit(" x"), F.col("level").cast("string"))).otherwise(""), scalars.turns_left(F.col("turns_left")))
    scopes = held.groupBy("game_id", "turn", "scope").agg(F.array_join(F.array_sort(F.collect_list(one)), ", ").alias("told"))
    every = F.array_sort(F.collect_list(F.concat("scope", F.lit(": "), "told")))
    return scopes.groupBy("game_id", "turn").agg(F.array_join(every, "\n").alias("text"))
