"""Scalar helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(c: Column) -> Column:
    """Lower case, ASCII letters and digits only: one key function everywhere."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def slot_of(c: Column) -> Column:
    """Slot id (p1a) at the head of an identifier."""
    return F.nullif(F.regexp_extract(c, "^(p[12][a-c])", 1), F.lit(""))


def side_of(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^(p[12])", 1), F.lit(""))


def head_of(c: Column, sep: str = ",") -> Column:
    return F.trim(F.split_part(c, F.lit(sep), F.lit(1)))


def keyword(c: Column, key: str) -> Column:
    """Value of ``[key] value`` in an argument."""
    return F.nullif(F.trim(F.regexp_extract(c, rf"^\[{key}\]\s*(.*)$", 1)), F.lit(""))


def effect_name(c: Column) -> Column:
    """What follows ``move:``, ``item:`` or ``ability:``; the text itself without one."""
    return F.trim(F.regexp_replace(c, r"^(?:move|item|ability):\s*", ""))


def base_forme(c: Column) -> Column:
    return F.regexp_replace(c, "-(?:Stellar|Terastal|Tera)$", "")


def round_half_up(c: Column) -> Column:
    """One decimal, halves up."""
    return F.floor(c * 10 + 0.5) / 10


def percent_of(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, round_half_up(part * 100 / whole)).otherwise(F.lit(0.0))


def percent_text(c: Column) -> Column:
    return F.concat(F.format_string("%.1f", c), F.lit("%"))


def range_text(lo: Column, hi: Column) -> Column:
    return F.concat(F.format_string("%.1f", F.least(lo, hi)), F.lit("–"), percent_text(F.greatest(lo, hi)))


def or_default(c: Column, empty: Column, default: Column) -> Column:
    """The value unless it is null or equals the empty value."""
    return F.coalesce(F.nullif(c, empty), default)


def hp_value(c: Column, most: Column) -> Column:
    """A number from ``75%`` (of the most) or ``120``; null if neither."""
    pct = F.regexp_extract(c, r"^([0-9.]+)%$", 1).try_cast("double")
    return F.coalesce(F.floor(pct * most / 100), c.try_cast("double"))


def spread(c: Column) -> Column:
    """``Nature:a/b/c/d/e/f`` as a struct of nature and six integers; null if it isn't of that form."""
    values = F.transform(F.split(F.split_part(c, F.lit(":"), F.lit(2)), "/"), lambda x: x.try_cast("int"))
    ok = (F.size(values) == 6) & F.forall(values, lambda x: x.isNotNull())
    return F.when(ok, F.struct(F.split_part(c, F.lit(":"), F.lit(1)).alias("nature"), values.alias("values")))


def turns_left(n: Column) -> Column:
    return F.when(n.isNull(), "").when(n == 1, " (1 turn left)").otherwise(F.concat(F.lit(" ("), n.cast("string"), F.lit(" turns left)")))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9._-]", "_")


def json_argument(c: Column, path: str) -> Column:
    """A field of a JSON text; null where the text doesn't parse."""
    return F.get_json_object(c, path)


def months_back(month: Column, n: int) -> Column:
    """The n months up to a month (yyyy-MM), newest first."""
    first = F.to_date(month, "yyyy-MM")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.date_format(F.add_months(first, -k), "yyyy-MM"))


def share_text(names: Column, shares: Column) -> Column:
    """``a 40.0%, b 12.5%``."""
    return F.array_join(F.zip_with(names, shares, lambda n, s: F.concat(n, F.lit(" "), percent_text(s))), ", ")
