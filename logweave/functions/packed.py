"""The packed team format as expressions: nested positional fields with defaults, decoded and encoded.

Sets are separated by ``]``, fields by ``|``: nickname, species (empty: the nickname), item, ability, moves (comma), nature, EVs (comma, empty: 0),
gender, IVs (comma, empty: 31), shiny, level, and a comma list of happiness, ball, hidden power type, gigantamax, dynamax level, tera type.
Names are packed without spaces and get them back before capitals and around numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STATS = ("hp", "atk", "def", "spa", "spd", "spe")
#: Fields of a set, the last one a list.
FIELDS = 12
SET = "struct<species: string, item: string, ability: string, moves: array<string>, tera_type: string, level: int, gender: string, nature: string, evs: map<string, int>, ivs: map<string, int>>"


def spaced(c: Column) -> Column:
    """``FlutterMane`` as ``Flutter Mane``."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "([0-9]+)", " $1 "), "([A-Z])", " $1"), " +", " "))


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _once(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def _spread(c: Column, default: int) -> Column:
    """Values by stat; null unless one differs from the default."""
    values = _once(F.split(c, ","), lambda at: F.array(*[F.coalesce(F.get(at, k).try_cast("int"), F.lit(default)) for k in range(len(STATS))]))
    return F.when(c != "", _once(values, lambda v: F.when(F.exists(v, lambda x: x != default), F.map_from_arrays(F.array(*map(F.lit, STATS)), v))))


def sets(packed: Column) -> Column:
    """Array of sets, moves cut and filled up to four; null for a null or empty text and for one with a set of too few fields. What an open sheet hides (nature, EVs, IVs) is null."""
    parts = F.transform(F.filter(F.split(packed, r"\]"), lambda s: s != ""), lambda s: F.split(s, r"\|"))

    def one(f: Column) -> Column:
        field = lambda k: F.trim(F.get(f, k))
        moves = F.transform(F.filter(F.split(field(4), ","), lambda m: m != ""), spaced)
        return F.struct(
            spaced(F.coalesce(_some(field(1)), field(0))).alias("species"),
            spaced(field(2)).alias("item"),
            spaced(field(3)).alias("ability"),
            F.slice(F.concat(moves, F.array_repeat(F.lit(""), 4)), 1, 4).alias("moves"),
            _some(F.trim(F.get(F.split(field(11), ","), 5))).alias("tera_type"),
            F.coalesce(field(10).try_cast("int"), F.lit(50)).alias("level"),
            _some(field(7)).alias("gender"),
            _some(field(5)).alias("nature"),
            _spread(field(6), 0).alias("evs"),
            _spread(field(8), 31).alias("ivs"),
        )

    def every(p: Column) -> Column:
        return F.when((F.size(p) > 0) & ~F.exists(p, lambda f: F.size(f) < FIELDS), F.transform(p, one))

    return _once(parts, every).cast(f"array<{SET}>")


def decoded(packed: Column) -> Column:
    """:func:`sets` as a generated column, one row for each row: filters and later expressions use its value instead of computing it again."""
    return F.explode(F.array(sets(packed)))


def pack(teams: Column) -> Column:
    """The packed text of an array of sets: the inverse of :func:`sets` for what that gives."""

    def spread(m: Column, default: int) -> Column:
        return F.coalesce(F.array_join(F.array(*[F.coalesce(F.nullif(m[s], F.lit(default)).cast("string"), F.lit("")) for s in STATS]), ","), F.lit(""))

    def one(s: Column) -> Column:
        name = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), " ", "")
        text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
        moves = F.array_join(F.transform(F.filter(s["moves"], lambda m: m != ""), name), ",")
        tail = F.when(s["tera_type"].isNotNull(), F.concat(F.lit(",,,,,"), s["tera_type"])).otherwise("")
        return F.concat_ws("|", name(s["species"]), F.lit(""), name(s["item"]), name(s["ability"]), moves, text(s["nature"]), spread(s["evs"], 0), text(s["gender"]), spread(s["ivs"], 31), F.lit(""), text(s["level"]), tail)

    return F.array_join(F.transform(teams, one), "]")
