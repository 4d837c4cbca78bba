"""Blocks of a prompt about teams: what is known of investments, sheets with marks, places for those not known yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.domain import inference
from logweave.functions import scalars
from logweave.operators import intervals

#: Names of the stats in order, and how many of a team are brought.
STAT_NAMES = {"hp": "HP", "atk": "Atk", "def": "Def", "spa": "SpA", "spd": "SpD", "spe": "Spe"}
BROUGHT = 4


def spread_lines(roster: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """``roster`` (keys, pos, species) with known (whether anything is) and line: ``Name: Atk ≥ 100, Spe = 252, others ?``.

    ``bounds``: keys, species_key, stat, lo, hi. A stat without bounds on either side is one of the others; with none bounded the line says unknown. Of species with one name key the first counts.
    """
    one = intervals.render(F.col("lo"), F.col("hi"), 0, inference.MOST)
    place = F.array_position(F.array(*map(F.lit, STAT_NAMES)), F.col("stat"))
    name = F.element_at(F.create_map(*[F.lit(x) for kv in STAT_NAMES.items() for x in kv]), F.col("stat"))
    told = F.when(one != "?", F.struct(place.alias("place"), F.concat_ws(" ", name, one).alias("text")))
    by = bounds.where(F.col("stat").isin(*STAT_NAMES)).groupBy(*keys, "species_key").agg(F.array_sort(F.collect_list(told)).alias("told"))  # six at most
    r = roster.withColumn("species_key", scalars.name_key(F.col("species"))).groupBy(*keys, "species_key").agg(F.min(F.struct("pos", "species")).alias("r"))
    j = r.join(by, [*keys, "species_key"], "left").withColumn("told", F.coalesce("told", F.array()))
    n = F.size("told")
    text = F.concat(F.array_join(F.transform("told", lambda x: x["text"]), ", "), F.when(n < len(STAT_NAMES), ", others ?").otherwise(""))
    return j.select(*keys, F.col("r.pos").alias("pos"), F.col("r.species").alias("species"), (n > 0).alias("known"), F.concat(F.lit("  "), "r.species", F.lit(": "), F.when(n > 0, text).otherwise("unknown")).alias("line"))


def spread_block(lines: DataFrame, keys: list[str], title: str | Column, hide_unknown: bool | Column) -> DataFrame:
    """keys, text: a titled block of the lines in order of ``pos``; without lines that say nothing if they are hidden, and no block if none is left.

    ``title`` and ``hide_unknown`` may be columns of the keys, so that blocks of several kinds are made in one pass.
    """
    title, hide = (x if isinstance(x, Column) else F.lit(x) for x in (title, hide_unknown))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])  # a roster
    blocks = lines.where(F.col("known") | ~hide).groupBy(*keys).agg(ordered.alias("lines"))
    return blocks.select(*keys, F.concat(F.lit("=== "), title, F.lit(" ===\n"), F.array_join("lines", "\n")).alias("text"))


def placeholders(identified: Column, own: Column, brought: int = BROUGHT) -> Column:
    """A line for each one of the brought that isn't identified; none if all are."""
    note = F.when(own, "  - (brought, not sent out in this game so far; spread unknown)").otherwise("  - (brought, not seen yet; spread unknown)")
    return F.array_repeat(note, F.greatest(F.lit(brought) - identified, F.lit(0)).cast("int"))


def sheet(team: Column, brought_keys: Column | None = None) -> Column:
    """Text of an array of sets (:mod:`logweave.functions.packed`), two lines for each; those whose name key is among the brought ones get a star. Null keys mark none."""
    text = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("?"))

    def one(s: Column) -> Column:
        mark = F.lit("  ") if brought_keys is None else F.when(F.array_contains(brought_keys, scalars.name_key(s["species"])), "★ ").otherwise("  ")
        moves = F.array_join(F.filter(s["moves"], lambda m: m != ""), " / ")
        return F.concat(F.coalesce(mark, F.lit("  ")), text(s["species"]), F.lit(" @ "), text(s["item"]), F.lit(", ability="), text(s["ability"]), F.lit(", tera="), text(s["tera_type"]), F.lit("\n      moves: "), moves)

    return F.array_join(F.transform(team, one), "\n")


def system_prompt(template: str, **blocks: Column) -> Column:
    """A template with ``{name}`` places filled; null blocks are empty. A place that no block is for stays, for the check of leftovers."""
    out = F.lit(template)
    for name, block in blocks.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(block, F.lit("")))
    return out
