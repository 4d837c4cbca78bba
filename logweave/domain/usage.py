"""Usage marginals: shares of a common total, top-n with fallbacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions import scalars

#: Entries of the marginals that stand for nothing.
SENTINELS = ("", "nothing", "other", "noitem", "noability")


def marginals(raw: DataFrame) -> DataFrame:
    """species, species_key, field, value, weight from maps (species, data MAP<field, MAP<value, weight>>)."""
    f = raw.select("species", F.explode("data").alias("field", "values"))
    return f.select("species", scalars.name_key(F.col("species")).alias("species_key"), "field", F.explode("values").alias("value", "weight"))


def top_shares(m: DataFrame, n: dict[str, int], total_field: str = "Spreads") -> DataFrame:
    """species_key, field, rank, value, usage_pct: the heaviest values of each field, as percent of the species' mass in one field.

    Sentinels and weights of 0 don't count; spreads that can't be parsed are skipped before ranking.
    """
    mass = m.where(F.col("field") == total_field).groupBy("species_key").agg(F.sum("weight").alias("mass"))
    usable = (F.col("weight") > 0) & ~F.lower("value").isin(*SENTINELS) & ((F.col("field") != total_field) | scalars.spread(F.col("value")).isNotNull())
    rank = F.row_number().over(Window.partitionBy("species_key", "field").orderBy(F.desc("weight"), "value"))
    limit = F.lit(0)
    for field, k in n.items():
        limit = F.when(F.col("field") == field, k).otherwise(limit)
    top = m.where(usable).withColumn("rank", rank).where(F.col("rank") <= limit).join(mass, "species_key")
    return top.select("species_key", "field", "rank", "value", F.coalesce(F.try_divide(F.col("weight") * 100, F.col("mass")), F.lit(0.0)).alias("usage_pct"))


@dataclass(frozen=True)
class Role:
    """A spread and the base stats it is for: least and greatest values by stat, and pairs (a, b, strict) of which a must be above b, or as high unless strict."""

    spread: str
    least: Mapping[str, int] = field(default_factory=dict)
    most: Mapping[str, int] = field(default_factory=dict)
    above: tuple[tuple[str, str, bool], ...] = ()

    def fits(self, stats: Mapping[str, Column]) -> Column:
        tests = [stats[s] >= v for s, v in self.least.items()] + [stats[s] <= v for s, v in self.most.items()]
        tests += [stats[a] > stats[b] if strict else stats[a] >= stats[b] for a, b, strict in self.above]
        return reduce(lambda x, y: x & y, tests, F.lit(True))


#: Default spreads in order of precedence, with their cut-offs (``best`` is the higher attack).
ROLES = (
    Role("Jolly:4/252/0/0/0/252", least={"best": 110, "spe": 90}, above=(("atk", "spa", False),)),
    Role("Adamant:4/252/0/0/0/252", least={"best": 110}, above=(("atk", "spa", False),)),
    Role("Timid:4/0/0/252/0/252", least={"best": 110, "spe": 90}),
    Role("Modest:4/0/0/252/0/252", least={"best": 110}),
    Role("Bold:252/0/252/0/4/0", least={"hp": 95}, most={"spe": 70}, above=(("def", "spd", True),)),
    Role("Calm:252/0/4/0/252/0", least={"hp": 95}, most={"spe": 70}),
    Role("Timid:4/0/0/252/0/252", least={"spe": 90}),
    Role("Modest:4/0/0/252/0/252"),
)


def heuristic_spread(hp: Column, atk: Column, dfn: Column, spa: Column, spd: Column, spe: Column, roles: Sequence[Role] = ROLES) -> Column:
    """A default ``Nature:hp/atk/def/spa/spd/spe`` from base stats: that of the first role that fits."""
    stats = {"hp": hp, "atk": atk, "def": dfn, "spa": spa, "spd": spd, "spe": spe, "best": F.greatest(atk, spa)}
    return F.coalesce(*[F.when(r.fits(stats), r.spread) for r in roles])


def spreads_with_fallback(wanted: DataFrame, top: DataFrame, curated: DataFrame, base: DataFrame) -> DataFrame:
    """species_key, spread, source for every wanted species: usage, else curated, else the heuristic over base stats (80 each if unknown)."""
    best = top.where("field = 'Spreads' AND rank = 1").select("species_key", F.col("value").alias("used"))
    j = wanted.join(best, "species_key", "left").join(curated.select("species_key", F.col("spread").alias("picked")), "species_key", "left").join(base, "species_key", "left")
    stats = [F.coalesce(c, F.lit(80)) for c in ("hp", "atk", "def", "spa", "spd", "spe")]
    source = F.when(F.col("used").isNotNull(), "usage").when(F.col("picked").isNotNull(), "curated").otherwise("heuristic")
    return j.select("species_key", F.coalesce("used", "picked", heuristic_spread(*stats)).alias("spread"), source.alias("source"))
