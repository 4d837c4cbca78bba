r"""URL filter: rules first, then a path-template tree for each host.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there
up to ``?``, ``#`` or the end. A rule ``host/path`` fits its host and all subdomains if the URL's path
starts with the rule's; the longest rule that fits decides.

Other pages are judged by their template. A path's segments are generalised level by level: first
by form (numbers, hexadecimal ids, slugs with digits), then by count: a segment of fewer than
``least_rows`` pages becomes ``*``, whatever its parent's size. Kept siblings are merged into
one ``*`` branch where the main form below them is the same and each one's labelled share doesn't differ
significantly from that of its siblings together, so a variable segment of many pages each becomes a branch, and a
section that differs stays by itself however small its share. A template is blocked if its share of bad labelled pages,
smoothed towards its host's, which is smoothed towards the share of all, is ``block_at`` or more; so
a template without labels follows its host. How much is smoothed comes from the labels: the weight of
the wider share is that of a beta-binomial law with the variance between hosts, or between a host's
templates, that the labels show (by moments, within ``smoothing``). Where labels don't depend on the
URL, the wider share thus decides; where they do, a few labelled pages are enough.

All steps work on counts of (host, path form), a few rows for each host, so a host with a third of
all pages costs one row per form and task. Pages of a form with more than ``hot_rows`` pages are spread
over several keys when they get their template. Paths of any depth are told apart: level by level while
pages of a template differ below it, and all at once where they don't.

Null URLs and URLs without ``://`` have empty host and path and belong to one template of that empty
host. Repeated pages count repeatedly and get the same result. Labels of no page are ignored, null
labels too; with no labels at all nothing is blocked but by rules. URLs of any length
are read whole; rules that tie in length are told apart by their text, and a share that ties with ``block_at`` blocks. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import BROADCAST_ROWS, read, written


@dataclass(frozen=True)
class Rule:
    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


@dataclass(frozen=True)
class Config:
    least_rows: int = 5
    #: Siblings whose labelled share lies within this many standard deviations are alike.
    alike_z: float = 2.0
    #: Least and greatest weight of the wider share in a smoothed one, in pages.
    smoothing: tuple[float, float] = (3.0, 100.0)
    block_at: float = 0.5
    #: Pages of a (host, form) that one key gets when pages are joined to their templates.
    hot_rows: int = 100_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. For lists of some hundred rules."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        rule, verdict = F.when(fits, F.lit(r.rule)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def form(segment: Column) -> Column:
    """A segment with numbers, long hexadecimal ids and slugs that hold digits replaced by their kind."""
    s = F.regexp_replace(segment, r"^[0-9a-fA-F]{8,}(?=\.|$)|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?=\.|$)", "{id}")
    s = F.regexp_replace(s, r"^[^.{]*-[^.{]*[0-9][^.{]*(?=\.|$)|^[^.{]*[0-9][^.{]*-[^.{]*(?=\.|$)", "{slug}")
    return F.regexp_replace(s, r"[0-9]+", "{n}")


def path_forms(path: Column) -> Column:
    """The segments of a path by form."""
    return F.transform(F.array_remove(F.split(path, "/"), ""), form)


def opened(t: DataFrame, level: int, c: Config) -> DataFrame:
    """``t`` with ``open``: whether pages of the row's template differ below ``level``. Where they don't, the template takes the rest of their path."""
    rest = F.slice("forms", F.lit(level + 1), F.greatest(F.size("forms") - level, F.lit(0)))
    node = t.groupBy("host", "template").agg(F.min(rest).alias("low"), F.max(rest).alias("high"), F.sum("n").alias("all_n"))
    same = F.col("low") == F.col("high")
    whole = F.concat("template", F.when(F.col("all_n") >= c.least_rows, F.col("low")).otherwise(F.transform("low", lambda _: F.lit("*"))))
    grown = F.when(same, whole).otherwise(F.col("template"))
    return t.join(node, ["host", "template"]).select("host", "forms", "n", "labelled", "bad", grown.alias("template"), (~same & (F.size("forms") > level)).alias("open"))


def tree(counts: DataFrame, c: Config) -> DataFrame:
    """host, forms, template: templates of all (host, forms) in ``counts`` (host, forms, n, labelled, bad)."""
    t = written(opened(counts.withColumn("template", F.array().cast("array<string>")), 0, c), "url-tree")
    finished, level = t.where("NOT open"), 0
    while not (here := t.where("open").drop("open")).isEmpty():
        level += 1
        below = F.coalesce(F.try_element_at("forms", F.lit(level + 1)), F.lit(""))
        here = here.withColumn("seg", F.try_element_at("forms", F.lit(level))).withColumn("below", below)
        child = here.groupBy("host", "template", "seg", "below").agg(*[F.sum(x).alias(x) for x in ("n", "labelled", "bad")])
        child = child.groupBy("host", "template", "seg").agg(*[F.sum(x).alias(x) for x in ("n", "labelled", "bad")], F.max_by("below", F.struct("n", "below")).alias("main"))
        parent = child.groupBy("host", "template").agg(*[F.sum(x).alias("all_" + x) for x in ("n", "labelled", "bad")])
        child = child.join(parent, ["host", "template"])
        kept = F.col("n") >= c.least_rows
        own, others, others_bad = F.col("labelled"), F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
        p = (F.col("all_bad") + 0.5) / (F.col("all_labelled") + 1)
        apart = F.abs(F.col("bad") / F.greatest(own, F.lit(1)) - others_bad / F.greatest(others, F.lit(1)))
        z = apart / F.sqrt(p * (1 - p) * (1 / F.greatest(own, F.lit(1)) + 1 / F.greatest(others, F.lit(1))))
        alike = (own == 0) | (others == 0) | (z < c.alike_z)
        branch = F.concat(F.lit("*>"), F.col("main"))
        size = child.withColumn("kept", kept).withColumn("branch", F.when(kept & alike, branch))
        groups = size.where("branch is not null").groupBy("host", "template", "branch").agg(F.count("*").alias("siblings"))
        size = size.join(groups, ["host", "template", "branch"], "left")
        name = F.when(~F.col("kept"), "*").when(F.coalesce("siblings", F.lit(0)) > 1, F.col("branch")).otherwise(F.col("seg"))
        names = size.select("host", "template", "seg", name.alias("name"))
        grown = here.join(names, ["host", "template", "seg"]).select("host", "forms", "n", "labelled", "bad", F.concat("template", F.array("name")).alias("template"))
        t = written(opened(grown, level, c), "url-tree")
        finished = finished.union(t.where("NOT open"))
    return finished.drop("open")


def wider_weight(groups: DataFrame, wide: Column, parents: Column | int, c: Config) -> float:
    """Pages that the share ``wide`` weighs against those of a group (labelled, bad), by the variance between groups beyond chance."""
    rows = groups.where("labelled > 0").withColumn("p", F.col("bad") / F.col("labelled")).withColumn("wide", wide)
    got = rows.agg(
        F.count("*").alias("groups"),
        (F.lit(parents) if isinstance(parents, int) else parents).alias("parents"),
        F.sum("labelled").alias("n"),
        F.sum(F.col("labelled") * F.col("labelled")).alias("squares"),
        F.sum(F.col("labelled") * F.pow(F.col("p") - F.col("wide"), 2)).alias("between"),
        F.sum(F.col("labelled") * F.col("wide") * (1 - F.col("wide"))).alias("chance"),
    ).first()
    free = got["groups"] - got["parents"]
    least, most = c.smoothing
    if free < 1 or not got["chance"]:
        return most
    spread = (got["between"] * got["n"] / got["chance"] - free) / max(got["n"] - got["squares"] / got["n"] - free, 1e-9)
    return min(max(1 / spread - 1, least), most) if spread > 0 else most


def with_templates(p: DataFrame, table: DataFrame, counts: DataFrame, c: Config) -> DataFrame:
    """``p`` (page_id, host, path, forms) with the columns of ``table`` for its host and forms; hot ones are split over several keys."""
    hot = counts.where(F.col("n") > c.hot_rows).select("host", "forms", F.ceil(F.col("n") / c.hot_rows).cast("int").alias("parts"))
    many = hot.count()
    if not 0 < many <= BROADCAST_ROWS:
        return p.join(table, ["host", "forms"], "left")
    parts = F.coalesce("parts", F.lit(1))
    p = p.join(F.broadcast(hot), ["host", "forms"], "left").withColumn("part", F.pmod(F.xxhash64("page_id", "path"), parts).cast("int")).drop("parts")
    table = table.join(F.broadcast(hot), ["host", "forms"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return p.join(table, ["host", "forms", "part"], "left").drop("part")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, c: Config = Config()) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, template, bad_share.

    ``labels`` has (page_id, bad): 1 for pages to reject, 0 for others.
    """
    host, path = parts(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("forms", path_forms(F.col("path")))
    marks = labels.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    marked = p.join(marks, "page_id", "left")
    counts = written(marked.groupBy("host", "forms").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "url-counts")
    t = tree(counts, c)
    every = counts.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    overall = every["bad"] / every["labelled"] if every["labelled"] else 0.0
    hosts = counts.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    byt = t.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    share = written(byt.join(hosts, "host"), "url-shares")
    of_host = wider_weight(share.select("host", F.col("host_labelled").alias("labelled"), F.col("host_bad").alias("bad")).distinct(), F.lit(overall), 1, c)
    of_template = wider_weight(share, F.try_divide("host_bad", "host_labelled"), F.count_distinct("host"), c)
    wide = (F.col("host_bad") + of_host * overall) / (F.col("host_labelled") + of_host)
    smooth = (F.col("bad") + of_template * wide) / (F.col("labelled") + of_template)
    share = share.select("host", "template", smooth.alias("bad_share"))
    table = t.select("host", "forms", "template").join(share, ["host", "template"])
    rule, decided = fitting(F.col("host"), F.col("path"), rules)
    judged = with_templates(p, table, counts, c)
    return judged.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(decided, F.when(F.col("bad_share") >= c.block_at, "block").otherwise("allow")).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "bad_share",
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number that ends a page's path is its document's id; pages of documents labelled of low quality or toxic are bad."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    _, path = parts(F.col("url"))
    number = F.regexp_extract(path, r"([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("long")
    known = labels.select("doc_id", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    marks = pages.select("page_id", number.alias("doc_id")).where("doc_id is not null").join(known, "doc_id").select("page_id", "bad")
    return judge(pages, marks)


QUERIES = {"op8_url_filter": op8_url_filter}
ORACLES: dict[str, str] = {}
