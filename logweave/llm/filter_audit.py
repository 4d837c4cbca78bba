r"""Filter interaction audit: what each filter removes, in every order of the filters.

The orders of the filters form a trie: a node is the prefix of filters that has been applied, an edge the next one.
Documents that survive a prefix don't depend on its order, so prefixes with the same filters are one
state: 2**n states instead of the trie's n! leaves. The trie is walked depth first. On entering a state
for the first time its filter is applied to the persisted survivors of the state above, the survivors left are
persisted, and one aggregation over them counts, for each part, what every outgoing edge removes; a state that was
reached before is not entered again. So at most n + 1 survivor tables are persisted at a time, and each goes
when the walk leaves its state. Their rows are narrow: a part, a bit for each filter and the labels.

A filter is a condition under which a document fails; one may look at the whole table (``E`` below: a copy of a
document with a smaller id). Conditions are evaluated once, in one scan of the texts; the copies come from
the least id of each SHA-256 digest of a text. Survivors are recomputed from that written table if an executor is lost.

:func:`audit` returns for every part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley (see
the columns' comments there), zeros included. Null texts count as empty. Null parts are the part "", together with empty names. A document is good (toxic) if one of
the labels of its id says so. Null ids have no labels and are no copies: they are neither smaller nor larger than others. Repeated rows count each; rows that
repeat id and text don't make each other copies. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import BROADCAST_ROWS, read, written

#: The mark of a text that a document with a smaller id has too.
COPY = "copy"


def conditions() -> dict[str, Column | str]:
    """Failure conditions on ``text`` by letter; words are runs of ``[^\\x20\\x09-\\x0D]``."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 5 * F.length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
        "E": COPY,
    }


def judged(docs: DataFrame, labels: DataFrame, failing: Mapping[str, Column | str], part: str = "source") -> DataFrame:
    """part, fails (bit i: the i-th condition), good, toxic of every document; written."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    bit = lambda x, k: F.when(F.coalesce(x, F.lit(False)), 1 << k).otherwise(0)
    fails = sum((bit(x, k) for k, x in enumerate(failing.values()) if not isinstance(x, str)), F.lit(0))
    rows = written(d.select("doc_id", "part", fails.alias("fails"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")), "judged")
    copies = [k for k, x in enumerate(failing.values()) if isinstance(x, str)]
    if copies:
        copied = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("digest", "least")
        found = rows.join(marked(written(copied, "copied")), "digest", "left").withColumn("fails", sum((bit(F.col("doc_id") > F.col("least"), k) for k in copies), F.col("fails")))
    else:
        found = rows
    told = labels.select(F.col("doc_id").try_cast(kind).alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("doc_id is not null AND (good OR toxic)")
    told = told.groupBy("doc_id").agg(F.bool_or(F.coalesce("good", F.lit(False))).alias("good"), F.bool_or(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    found = found.join(marked(written(told, "told")), "doc_id", "left")
    return written(found.select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")), "judged")


def marked(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it was counted to have few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def edges(rows: DataFrame, n: int) -> DataFrame:
    """part, state (bits of the filters applied), before (documents there), and arrays over the n filters: removed, good_lost, toxic_lost by that edge."""
    tables: list[DataFrame] = []
    seen: set[int] = set()

    def enter(state: int, above: DataFrame, last: int | None) -> None:
        seen.add(state)
        alive = (above if last is None else above.where(F.col("fails").bitwiseAND(F.lit(1 << last)) == 0)).persist(StorageLevel.MEMORY_AND_DISK)
        goes = [F.col("fails").bitwiseAND(F.lit(1 << k)) != 0 for k in range(n)]
        over = lambda cond, name: F.array(*[F.count_if(g & cond) for g in goes]).alias(name)
        tables.append(written(alive.groupBy("part").agg(F.lit(state).alias("state"), F.count("*").alias("before"), over(F.lit(True), "removed"), over(F.col("good"), "good_lost"), over(F.col("toxic"), "toxic_lost")), "edges"))
        for k in range(n):
            if not state & 1 << k and state | 1 << k not in seen:
                enter(state | 1 << k, alive, k)
        alive.unpersist()

    enter(0, rows, None)
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


def audit(docs: DataFrame, labels: DataFrame, failing: Mapping[str, Column | str] | None = None, part: str = "source") -> DataFrame:
    """One row per part, order and step; see the module's text. Letters name the filters, at most six."""
    failing = conditions() if failing is None else failing
    letters, n = "".join(failing), len(failing)
    if len(letters) != n or n > 6:
        raise ValueError("up to six filters, each named by a letter")
    found = edges(judged(docs, labels, failing, part), n)
    every = (1 << n) - 1
    # How many orders reach an edge after so many filters; none after all.
    reach = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)], F.lit(0)), F.bit_count("state") + 1)
    state = F.struct("before", "removed", "good_lost", "toxic_lost")
    p = found.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("state", state))).alias("states"),  # 2**n at most
        F.array(*[F.sum(reach * F.col("removed")[k]) for k in range(n)]).alias("shapley"),
    )
    at = lambda s: F.try_element_at("states", s)
    p = p.withColumn("fails", at(F.lit(0))["removed"]).withColumn("alone", F.array(*[F.coalesce(at(F.lit(every ^ 1 << k))["removed"][k], F.lit(0)) for k in range(n)]))
    p = p.select("part", "states", "shapley", "fails", "alone", F.explode(F.lit(list(range(every + 1)))).alias("state"))
    steps = [("".join(letters[k] for k in order), j + 1, sum(1 << k for k in order[:j]), order[j]) for order in permutations(range(n)) for j in range(n)]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, k int")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    here = lambda name: number(at(F.col("state"))[name][F.col("k")])
    mine = lambda name: number(F.col(name)[F.col("k")])
    return p.join(F.broadcast(steps), "state").select(  # n! * n rows
        "part",
        "filter_order",
        "step",
        (number(at(F.col("state"))["before"]) - here("removed")).alias("kept"),  # after this step
        here("removed").alias("removed"),  # by this step
        (mine("fails") - here("removed")).alias("redundant"),  # fail this filter, but were removed earlier
        mine("alone").alias("unique_fails"),  # fail this filter only
        here("good_lost").alias("good_lost"),
        here("toxic_lost").alias("toxic_lost"),
        mine("shapley").alias("shapley"),  # removed by this filter, summed over all orders
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_SQL = r"""WITH d AS (SELECT doc_id, coalesce(source::VARCHAR, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
+ 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > least, false)::INT AS fails FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
r AS (SELECT part, filter_order, step, bit, sum(n) FILTER (fails & (before | bit) = 0) AS kept, sum(n) FILTER (fails & before = 0 AND fails & bit > 0) AS removed, sum(n) FILTER (fails & before > 0 AND fails & bit > 0) AS redundant, sum(n) FILTER (fails = bit) AS unique_fails,
sum(good) FILTER (fails & before = 0 AND fails & bit > 0) AS good_lost, sum(toxic) FILTER (fails & before = 0 AND fails & bit > 0) AS toxic_lost FROM s, g GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM r"""

QUERIES = {"op12_filter_audit": op12_filter_audit}
ORACLES = {"op12_filter_audit": _SQL}
