r"""Benchmark decontamination with DataFrame functions only.

Benchmark texts are cut into windows of ``n`` normalised words (an item with fewer words is one
window). Their 64-bit hashes form the broadcast hash set; every window of every document is hashed
and probed in the scan's stage. The few that the set holds go on with their words and are joined to
the benchmark's windows, where a hit counts only if the words are equal.

Words: A-Z lower-cased, then ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``. The hash set is broadcast only
while the benchmark's texts have at most ``broadcast_chars`` characters, counted before; beyond
that the windows themselves are the key of a shuffled join. Texts of any length are read whole;
ties don't occur.

Null and empty texts have no words and no hits; a benchmark without words gives no hits. Documents
are told apart by id and text, so repeated rows get equal results, and rows that share an id but
not the text get their own. Items with one id are one item. Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import BROADCAST_ROWS, read, written

N = 10
#: Characters of benchmark text up to which the hashes of its windows are broadcast: at most half as many hashes, of some 24 bytes each, so 50 MB.
BROADCAST_CHARS = 4_000_000
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, _GAP), "")


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window: gram, its length, and the items (as strings) that hold it."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(n - 1), F.lit(1)))
    grams = w.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), n).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).withColumn("len", F.size("gram"))


def lengths(benchmark: DataFrame, n: int = N) -> tuple[list[int], int]:
    """The window lengths that occur (at most n of them), and the characters of all items."""
    size = F.least(F.size(words(F.col("text"))), F.lit(n))
    got = benchmark.agg(F.collect_set(size).alias("sizes"), F.sum(F.length("text")).alias("chars")).first()
    return sorted(x for x in got["sizes"] if x > 0), got["chars"] or 0


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """doc_id, text_key, at (1-based), len, items: one row per document window that is in the benchmark."""
    sizes, chars = lengths(benchmark, n)
    sizes = sizes or [n]
    grams = item_windows(benchmark, n)
    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    d = d.where(F.size("w") >= min(sizes))
    d = d.select("doc_id", "text_key", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.lit(min(sizes) - 1))).alias("at"))
    if len(sizes) > 1:
        d = d.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size")).where(F.col("at") + F.col("size") <= F.size("w") + 1)
        size: Column = F.col("size")
    else:
        size = F.lit(sizes[0])
    if chars <= broadcast_chars:
        probe = d.select("doc_id", "text_key", "w", "at", size.alias("size"), F.xxhash64(F.slice("w", F.col("at"), size)).alias("h"))
        side = grams.withColumn("h", F.xxhash64("gram"))
        near = probe.join(F.broadcast(side.select("h").distinct()), "h", "left_semi")
        near = near.select("doc_id", "text_key", "at", "h", F.slice("w", F.col("at"), F.col("size")).alias("words"))
        found = near.join(side, "h").where(F.col("words") == F.col("gram"))
    else:
        key = lambda c: F.array_join(c, " ")
        probe = d.select("doc_id", "text_key", "at", size.alias("size"), key(F.slice("w", F.col("at"), size)).alias("h"))
        found = probe.join(grams.withColumn("h", key(F.col("gram"))).hint("merge"), "h").where(F.col("size") == F.col("len"))
    return found.select("doc_id", "text_key", "at", "len", "items")


def _covered(starts: Column) -> Column:
    """Words in the union of (at, len) spans; the array is sorted."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["at"] + x["len"]).alias("end"),
        (acc["n"] + F.greatest(x["at"] + x["len"] - F.greatest(acc["end"], x["at"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = (
        hits(docs, benchmark, n, broadcast_chars)
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("found"))
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), _covered(F.col("spans")).alias("covered"), "found")
    )
    every = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = every.join(found, every["doc_id"].eqNullSafe(found["hit_id"]) & (every["text_key"] == found["hit_key"]), "left")
    items = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("covered"), F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce(F.col("covered"), F.lit(0)) > 0).alias("contaminated"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without any benchmark window, with all their columns.

    Only ids and digests of the documents that are hit go through a shuffle, unless they are more than ``BROADCAST_ROWS``.
    """
    bad = hits(docs, read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    bad = written(bad, "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["hit_id"]) & (F.xxhash64(docs["text"]) == bad["hit_key"]), "left_anti")


_SQL_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, w FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b)),
ns AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT rid, i, n, item_id FROM dg JOIN bg USING (gram, n)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM h)) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""

QUERIES = {"op3_decontamination": op3_decontamination}
ORACLES = {"op3_decontamination": ORACLE}
