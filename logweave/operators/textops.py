"""Text operators: leaks, sections, chunks, claims."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_hit(text: Column, pattern: str) -> Column:
    """The first match of a pattern, null if none."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def normalised(name: Column) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


@F.udtf(returnType="chunk int, start int, piece string")
class TextChunks:
    """Pieces of at most ``size`` characters, ended at the last ``. `` of the second half where there is one."""

    def eval(self, text: str, size: int) -> Iterator[tuple[int, int, str]]:
        at, k = 0, 0
        text = text or ""
        while at < len(text):
            end = min(len(text), at + size)
            if end < len(text):
                stop = text.rfind(". ", at + size // 2, end)
                end = stop + 2 if stop >= 0 else end
            yield k, at, text[at:end]
            at, k = end, k + 1


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sections(text: Column) -> Column:
    """Array of (title, body): parts of a text by lines ``=== TITLE ===``; text before the first has the title null, and none if it is blank. What :class:`Sections` gives, without Python."""
    head = r"=== (?:[^\n]* )?===[ \t\r\f]*"
    parts = F.split(F.coalesce(text, F.lit("")), rf"(?m)(?=^{head}$)")

    def part(p: Column) -> Column:
        first = F.regexp_extract(p, rf"^({head})(?:\n|$)", 1)
        title = F.when(first != "", _stripped(F.regexp_replace(_stripped(first), "^=+|=+$", "")))
        return F.struct(title.alias("title"), _stripped(F.substr(p, F.length(first) + 1)).alias("body"))

    return F.filter(F.transform(parts, part), lambda x: x["title"].isNotNull() | (x["body"] != ""))


def numbered(text: Column) -> Column:
    """Array of (rule, text): items of a numbered list, each with its continuation lines; the text before the first is rule 0, if it isn't blank. What :class:`NumberedRules` gives, without Python."""
    head = r"[^\S\n]*([0-9]+)[.)][^\S\n]+"
    parts = F.split(F.coalesce(text, F.lit("")), rf"(?m)(?=^{head})")

    def part(p: Column) -> Column:
        number = F.regexp_extract(p, f"^{head}", 1)
        return F.struct(F.coalesce(number.try_cast("int"), F.lit(0)).alias("rule"), _stripped(F.regexp_replace(p, f"^{head}", "")).alias("text"))

    return F.filter(F.transform(parts, part), lambda x: (x["rule"] != 0) | (x["text"] != ""))


@F.udtf(returnType="section int, title string, body string")
class Sections:
    """Parts of a text by lines ``=== TITLE ===``; text before the first has the title null."""

    def eval(self, text: str) -> Iterator[tuple[int, str | None, str]]:
        title, body, k = None, [], 0
        for line in (text or "").split("\n"):
            if line.startswith("=== ") and line.rstrip().endswith(" ==="):
                if title is not None or any(x.strip() for x in body):
                    yield k, title, "\n".join(body).strip()
                    k += 1
                title, body = line.strip().strip("=").strip(), []
            else:
                body.append(line)
        if title is not None or any(x.strip() for x in body):
            yield k, title, "\n".join(body).strip()


@F.udtf(returnType="rule int, text string")
class NumberedRules:
    """Items of a numbered list, each with its continuation lines; the text before the first is rule 0."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        import re

        number, body = 0, []
        for line in (text or "").split("\n"):
            m = re.match(r"\s*(\d+)[.)]\s+(.*)", line)
            if m:
                if number or any(x.strip() for x in body):
                    yield number, "\n".join(body).strip()
                number, body = int(m[1]), [m[2]]
            else:
                body.append(line)
        if number or any(x.strip() for x in body):
            yield number, "\n".join(body).strip()


def tag_sections(df: DataFrame, key: str, html: str, tags: str) -> DataFrame:
    """key, section (from 0), tag, body: elements of the given tags (a|b|c) in page order, without markup."""
    found = F.regexp_extract_all(F.col(html), F.lit(rf"(?s)<(?:{tags})[^>]*>.*?</(?:{tags})>"), F.lit(0))
    part = df.select(key, F.posexplode(found).alias("section", "__part"))
    body = F.trim(F.regexp_replace(F.regexp_replace("__part", "<[^>]*>", " "), r"\s+", " "))
    return part.select(key, F.col("section").cast("long").alias("section"), F.regexp_extract("__part", r"^<([a-z0-9]+)", 1).alias("tag"), body.alias("body"))


def key_values(text: Column, pattern: str) -> Column:
    """Map from group 1 to group 2 of all matches; the last of equal keys wins."""
    keys, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    pairs = F.arrays_zip(F.reverse(keys).alias("k"), F.reverse(values).alias("v"))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.when(F.map_contains_key(m, x["k"]), m).otherwise(F.map_concat(m, F.create_map(x["k"], x["v"]))))


def ko_count(text: Column) -> tuple[Column, Column]:
    """Best and worst number of hits in a text such as ``guaranteed 2HKO`` or ``41% chance to 2HKO``; null without one."""
    n = F.when(text.contains("OHKO"), F.lit(1)).otherwise(F.regexp_extract(text, r"([0-9])HKO", 1).try_cast("int"))
    worst = F.when(text.contains("guaranteed"), n).otherwise(n + 1)
    return n, F.when(n.isNotNull(), worst)


def claim_violation(lo: Column, hi: Column, hp: Column) -> Column:
    """``ko_impossible`` if even the greatest effect leaves something, ``ko_not_guaranteed`` if the least does."""
    return F.when(hi < hp, "ko_impossible").when(lo < hp, "ko_not_guaranteed")


def truncated(text: Column, most: int, mark: str) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(mark))).otherwise(text)


def batched_reduce(df: DataFrame, order: Column, size: int, partial: Mapping[str, Column], final: Mapping[str, Column]) -> DataFrame:
    """Two-level reduction: groups of ``size`` consecutive numbers first, then all groups."""
    groups = df.groupBy(F.floor(order / size).alias("batch")).agg(*[c.alias(n) for n, c in partial.items()])
    return groups.agg(*[c.alias(n) for n, c in final.items()])
