r"""Who really is in a slot: illusions undone backward, formes and transformations carried forward.

A ``|replace|`` line says that the slot's occupant has been another one since it came in. :func:`corrected`
rewrites the lines of that stint from its beginning: the name and species of the line that brought it in, the names of its
own lines, and who is named. The replace line itself becomes ``-unmasked``, since nobody was switched.

A ``-formechange`` holds until the occupant leaves, a ``detailschange`` for the rest of the game, also when it
comes back; both are carried forward only. A ``-transform`` makes it look like the one in another slot, until it leaves.
An occupant is an *individual*: game, side and its true name. :func:`individuals` unites all species names that one had,
those of its formes included, those that it only pretended to be not.

Everything is windows over a stint, a slot or an individual of one game. Logs without such lines come out as they went in, with
``named``, ``shown`` and ``looks_like`` added. Lines of a slot before anybody came in have null names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.domain import protocol
from logweave.domain.protocol import GAME, POS, arg, tag_is
from logweave.functions import scalars
from logweave.operators import relational, sequence

ENTERS = ("switch", "drag")


def nickname(c: Column) -> Column:
    """``Name`` of ``p1a: Name``."""
    return F.nullif(F.trim(F.regexp_extract(c, r"^p[12][a-c]?:(.*)$", 1)), F.lit(""))


def stints(d: DataFrame) -> DataFrame:
    """Lines with slot, side, stint, shown, nick (as printed), mask (pos, details and nick of the line that undoes an illusion, null without one)."""
    d = d.withColumn("slot", scalars.slot_of(arg(0))).withColumn("side", scalars.side_of(arg(0)))
    keys = [*GAME, "slot"]
    d = d.withColumn("stint", sequence.stint(tag_is(*ENTERS), keys, POS))
    came = F.struct(arg(1).alias("details"), nickname(arg(0)).alias("nick"))
    d = d.withColumn("came", F.last(F.when(tag_is(*ENTERS, "replace"), came), ignorenulls=True).over(sequence.so_far([*keys, "stint"], POS)))
    true = F.struct("pos", arg(1).alias("details"), nickname(arg(0)).alias("nick"))
    d = d.withColumn("mask", F.max(F.when(tag_is("replace"), true)).over(Window.partitionBy(*keys, "stint")))
    return d.withColumn("mask", F.when(F.col("slot").isNotNull(), F.col("mask")))


def corrected(d: DataFrame) -> DataFrame:
    """Lines (of :func:`protocol.lines`) with the true names in them, and named (species at this line), shown (as printed), individual (true name), looks_like."""
    columns = d.columns
    d = stints(d)
    masked = F.col("mask").isNotNull() & (F.col("pos") < F.col("mask.pos"))
    d = d.withColumn("shown", scalars.head_of(F.col("came.details"))).withColumn("individual", F.coalesce("mask.nick", "came.nick"))
    base = scalars.head_of(F.coalesce("mask.details", "came.details"))
    changes = F.when(tag_is("-formechange", "detailschange"), scalars.head_of(arg(1)))
    here = sequence.last_since_reset(changes, [*GAME, "slot"], POS, "stint")
    d = d.withColumn("here", here).withColumn("base", F.when(F.col("came").isNotNull(), base))
    for_good = F.last(F.when(tag_is("detailschange"), scalars.head_of(arg(1))), ignorenulls=True).over(sequence.so_far([*GAME, "side", "individual"], POS))
    d = d.withColumn("named", F.coalesce("here", for_good, "base"))
    d = with_looks(d)
    entering = tag_is(*ENTERS)
    true_ident = F.concat("slot", F.lit(": "), "mask.nick")
    rest = lambda n: F.slice("args", F.lit(n + 1), F.greatest(F.size("args") - n, F.lit(0)))
    args = F.when(masked & entering, F.concat(F.array(true_ident, F.col("mask.details")), rest(2))).when(masked, F.concat(F.array(true_ident), rest(1))).otherwise(F.col("args"))
    d = d.withColumn("args", args).withColumn("tag", F.when(tag_is("replace"), "-unmasked").otherwise(F.col("tag")))
    return d.select(*columns, "named", "shown", "individual", "looks_like")


def with_looks(d: DataFrame) -> DataFrame:
    """Adds looks_like: the species that a transformed occupant looks like, read off the other slot when it transforms."""
    asks = d.where(tag_is("-transform")).select("game_id", "pos", scalars.slot_of(arg(1)).alias("slot")).withColumn("ask", F.lit(True))
    u = d.where("slot is not null").select("game_id", "pos", "slot", "named").unionByName(asks, allowMissingColumns=True)
    seen = F.last("named", ignorenulls=True).over(sequence.before([*GAME, "slot"], POS))
    told = u.withColumn("target", seen).where("ask").select("game_id", "pos", "target")
    d = d.join(told, ["game_id", "pos"], "left")
    return d.withColumn("looks_like", sequence.last_since_reset(F.col("target"), [*GAME, "slot"], POS, "stint")).drop("target")


def individuals(logs: DataFrame) -> DataFrame:
    """game_id, side, individual, species (its first), aliases (all species that it was, by first line), pretended (those that it was taken for), stints."""
    d = corrected(protocol.lines(logs)).withColumn("slot", scalars.slot_of(arg(0))).withColumn("side", scalars.side_of(arg(0)))
    d = d.where("slot is not null AND individual is not null AND named is not null")
    keys = ["game_id", "side", "individual"]
    names = relational.ordered_distinct(d, keys, "named", "pos").withColumnRenamed("values", "aliases")
    posed = d.where(tag_is(*ENTERS) & (F.col("shown") != scalars.head_of(arg(1))))
    posed = relational.ordered_distinct(posed, keys, "shown", "pos").withColumnRenamed("values", "pretended")
    times = d.groupBy(*keys).agg(F.count_if(tag_is(*ENTERS)).alias("stints"))
    out = names.join(times, keys).join(posed, keys, "left")
    return out.select(*keys, F.col("aliases")[0].alias("species"), "aliases", F.coalesce("pretended", F.array().cast("array<string>")).alias("pretended"), "stints")
