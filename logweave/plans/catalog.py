"""The operators as queries over the shared tables, each with its twin in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions import scalars
from logweave.operators import intervals, quality, relational, sequence, split, textops
from logweave.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
USER, TIME = ["user_id"], ["ts", "event_id"]


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that are few bytes but much work, dealt over all cores: a small file is one task otherwise."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def is_type(name: str) -> Column:
    return F.col("event_type") == name


SESSION_GAP, SESSION_CEILING = 12 * 3600, 3
_SESSIONS = f"""r AS (SELECT *, sum(CASE WHEN date_diff('microsecond', prev, ts) > {SESSION_GAP * 1_000_000} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)),
c AS (SELECT *, CASE WHEN (row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1) % {SESSION_CEILING} = 0 THEN 1 ELSE 0 END AS first FROM r),
s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY run, ts, event_id)::BIGINT AS session FROM c)"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    s = sequence.sessionize(e, USER, "ts", "event_id", SESSION_GAP, SESSION_CEILING)
    first = F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event")
    return s.groupBy("user_id", "session").agg(first, F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).alias("micros"))


@query(f"""WITH {_SESSIONS}
SELECT user_id, session, arg_min(event_id, (ts, event_id)) AS first_event, count(*) AS n, round(sum(value), 4) AS total, date_diff('microsecond', min(ts), max(ts)) AS micros
FROM s GROUP BY user_id, session""")
def session_gap_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir)


@query(f"WITH {_SESSIONS} SELECT n AS size, count(*) AS sessions FROM (SELECT count(*) AS n FROM s GROUP BY user_id, session) GROUP BY n")
def session_size_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).groupBy(F.col("n").alias("size")).agg(F.count("*").alias("sessions"))


@query("""SELECT * FROM (SELECT event_id, user_id, event_type, lead(event_id) OVER w AS next_event_id, lead(event_type) OVER w AS next_event_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE next_event_id IS NOT NULL""")
def adjacent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return sequence.with_next(e, USER, TIME, ["event_id", "event_type"]).drop("ts")


@query("""SELECT event_id, array_to_string(list(event_type ORDER BY p), ',') AS seen FROM (
SELECT e.event_id, f.event_type, f.p FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) e
JOIN (SELECT user_id, event_type, min(n) AS p FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) GROUP BY ALL) f
ON e.user_id = f.user_id AND f.p <= e.n) GROUP BY event_id""")
def running_seen_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return sequence.running_distinct(e, "event_type", USER, TIME, "types").select("event_id", F.array_join("types", ",").alias("seen"))


@query("""WITH s AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS stint FROM events)
SELECT event_id, stint, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, stint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_click,
count(*) OVER (PARTITION BY user_id, stint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS in_stint FROM s""")
def stint_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("stint", sequence.stint(is_type("signup"), USER, TIME))
    click = sequence.last_since_reset(F.when(is_type("click"), F.col("event_id")), USER, TIME, "stint")
    return e.select("event_id", "stint", click.alias("last_click"), F.count("*").over(sequence.so_far([*USER, "stint"], TIME)).alias("in_stint"))


@query("""WITH s AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stint FROM events)
SELECT event_id, bool_or(event_type = 'error') OVER (PARTITION BY user_id, stint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS error_since,
last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM s""")
def sticky_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("stint", sequence.stint(is_type("signup"), USER, TIME))
    since = sequence.touched_since_reset(is_type("error"), USER, TIME, "stint")
    return e.select("event_id", since.alias("error_since"), sequence.sticky(F.when(is_type("purchase"), F.col("event_id")), USER, TIME).alias("last_purchase"))


@query("""SELECT event_id, CASE last_value(CASE WHEN event_type = 'click' THEN 'on' WHEN event_type = 'error' THEN 'off' END IGNORE NULLS) OVER w WHEN 'on' THEN
last_value(CASE WHEN event_type IN ('click', 'error') THEN props END IGNORE NULLS) OVER w END AS active
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def start_end_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", sequence.start_end_value(is_type("click"), is_type("error"), F.col("props"), USER, TIME).alias("active"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0) AS prior_view FROM events""")
def forward_fill_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", sequence.forward_fill_prior(F.when(is_type("view"), F.col("value")), F.lit(-1.0), USER, TIME).alias("prior_view"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 4")
def last_k_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return sequence.last_k(e, USER, TIME, 4).drop("ts")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    first = e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    return first.select("f.event_id", "user_id", "event_type")


@query("SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type AS divides FROM events")
def key_change_divider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", sequence.key_changes("event_type", TIME, USER).alias("divides"))


@query("""WITH g AS (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS "group" FROM events)
SELECT event_id, "group", row_number() OVER (PARTITION BY user_id ORDER BY "group", (event_type = 'error')::INT, event_id) AS new_pos FROM g""")
def side_effect_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return sequence.side_effects_last(e, USER, "event_id", is_type("click"), is_type("error")).select("event_id", "group", "new_pos")


@query("""WITH n AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1), j AS (SELECT o_orderstatus, coalesce(lines, 0) AS lines FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)
SELECT o_orderstatus, count(*) FILTER (lines >= 3) AS kept, count(*) FILTER (lines < 3) AS dropped_fragment FROM j GROUP BY 1""")
def fragment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    j = relational.overlay(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey"], {"lines": F.lit(0)})
    return j.groupBy("o_orderstatus").agg(F.count_if(F.col("lines") >= 3).alias("kept"), F.count_if(F.col("lines") < 3).alias("dropped_fragment"))


@query("""SELECT l_orderkey, CASE WHEN a > b THEN 'R' WHEN b > a THEN 'A' END AS winner FROM (
SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS a, count(*) FILTER (l_returnflag = 'A') AS b FROM lineitem GROUP BY 1)""")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(relational.majority(flag == "R", flag == "A", "R", "A").alias("winner"))


@query("""SELECT user_id, arg_min(value, (ts, event_id)) FILTER (event_type = 'click') AS first_click, arg_min(value, (ts, event_id)) FILTER (event_type = 'purchase') AS first_purchase,
bool_or(event_type = 'error') AS any_error FROM events GROUP BY user_id""")
def entity_first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    first = lambda t: relational.first_non_null(F.when(is_type(t), F.col("value")), at)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(first("click").alias("first_click"), first("purchase").alias("first_purchase"), F.bool_or(is_type("error")).alias("any_error"))


@query("""SELECT user_id, array_to_string(list_concat(list(event_type ORDER BY o)[1:4], ['-', '-', '-', '-'])[1:4], ',') AS types FROM (
SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY 1, 2) GROUP BY user_id""")
def ordered_distinct_pad4(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = relational.ordered_distinct(table(spark, sf_dir, "events"), USER, "event_type", "event_id")
    return d.select("user_id", F.array_join(relational.padded(F.col("values"), 4, "-"), ",").alias("types"))


@query("""SELECT l_orderkey, l_suppkey, any_value(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1""")
def singleton_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.singletons(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), ["l_orderkey", "l_suppkey"])


@query("""SELECT a.l_orderkey, a.l_linenumber AS l_linenumber_1, a.l_returnflag AS l_returnflag_1, b.l_linenumber AS l_linenumber_2, b.l_returnflag AS l_returnflag_2
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_returnflag <> b.l_returnflag""")
def order_pair_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.ordered_pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", [])


@query("""WITH a AS (SELECT s_nationkey AS nation, min(s_acctbal) AS attack_lo, max(s_acctbal) AS attack_hi FROM supplier GROUP BY 1),
d AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, min(abs(c_acctbal) + 1) AS defence_lo, max(abs(c_acctbal) + 1) AS defence_hi FROM customer GROUP BY 1, 2)
SELECT nation, segment, round(attack_lo / defence_hi, 6) AS effect_lo, round(attack_hi / defence_lo, 6) AS effect_hi FROM a JOIN d USING (nation)""")
def cross_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.min("s_acctbal").alias("attack_lo"), F.max("s_acctbal").alias("attack_hi"))
    weight = F.abs("c_acctbal") + 1
    d = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.min(weight).alias("defence_lo"), F.max(weight).alias("defence_hi"))
    e = intervals.envelope(a, d, "nation", lambda x, y: x / y)
    return e.select("nation", "segment", F.round("effect_lo", 6).alias("effect_lo"), F.round("effect_hi", 6).alias("effect_hi"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_extendedprice > o_totalprice * 0.5 AND l_returnflag = 'R')""")
def exists_with_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    hit = (line["l_orderkey"] == o["o_orderkey"]) & (line["l_extendedprice"] > o["o_totalprice"] * 0.5)
    return o.where("o_orderstatus <> 'P'").join(line, hit, "left_semi").select("o_orderkey")


@query("""WITH l AS (SELECT l_orderkey, sum(l_quantity) AS qty, max(l_discount) AS disc FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(qty, 0.0) AS qty, coalesce(disc, 1.0) AS disc FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def overlay_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"), F.max("l_discount").alias("disc"))
    return relational.overlay(table(spark, sf_dir, "orders").select("o_orderkey"), over, ["o_orderkey"], {"qty": F.lit(0.0), "disc": F.lit(1.0)})


@query("""WITH a AS (SELECT s_nationkey AS nation, count(*) AS n, round(max(s_acctbal), 2) AS most FROM supplier GROUP BY 1), b AS (SELECT c_nationkey AS nation, count(*) AS n, round(max(c_acctbal), 2) AS most FROM customer GROUP BY 1)
SELECT coalesce(a.nation, b.nation) AS nation, CASE WHEN a.nation IS NOT NULL THEN a.n ELSE b.n END AS n, CASE WHEN a.nation IS NOT NULL THEN a.most ELSE b.most END AS most,
CASE WHEN a.nation IS NOT NULL THEN 'first' ELSE 'second' END AS origin FROM a FULL JOIN b ON a.nation = b.nation""")
def priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = lambda t, p: table(spark, sf_dir, t).groupBy(F.col(f"{p}_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.round(F.max(f"{p}_acctbal"), 2).alias("most"))
    return relational.priority_merge(by("supplier", "s"), by("customer", "c"), "nation", ["n", "most"])


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.without(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("""WITH p AS (SELECT l_partkey AS p_partkey, max(l_extendedprice / l_quantity) AS price FROM lineitem WHERE l_quantity >= 45 GROUP BY 1),
b AS (SELECT p_brand, min(price) AS price FROM p JOIN part USING (p_partkey) GROUP BY 1)
SELECT p_partkey, round(coalesce(p.price, b.price, 1.0), 4) AS price, CASE WHEN p.price IS NOT NULL THEN 'observed' WHEN b.price IS NOT NULL THEN 'brand' ELSE 'constant' END AS source
FROM part LEFT JOIN p USING (p_partkey) LEFT JOIN b USING (p_brand)""")
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    seen = line.where("l_quantity >= 45").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("observed"))
    brand = seen.join(part, "p_partkey").groupBy("p_brand").agg(F.min("observed").alias("of_brand"))
    out = relational.fallback_chain(part, [(seen, ["p_partkey"], "observed", "observed"), (brand, ["p_brand"], "of_brand", "brand")], "price", F.lit(1.0), "constant")
    return out.select("p_partkey", F.round("price", 4).alias("price"), "source")


@query("""WITH b AS (SELECT p_brand, l_partkey, sum(l_quantity) AS weight FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT p_brand, l_partkey, weight, round(share_pct, 6) AS share_pct, rank FROM (SELECT *, weight * 100 / sum(weight) OVER (PARTITION BY p_brand) AS share_pct, row_number() OVER (PARTITION BY p_brand ORDER BY weight DESC, l_partkey) AS rank FROM b) WHERE rank <= 2""")
def top_n_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return relational.top_n_share(j, "p_brand", "l_partkey", "l_quantity", 2).withColumn("share_pct", F.round("share_pct", 6))


@query("SELECT o_orderstatus, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def examples_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.examples_per_group(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_orderdate", "o_orderkey"], 3).select("o_orderstatus", "o_orderkey", "rank")


@query("""SELECT l_orderkey, round(sum(l_quantity * (CASE l_returnflag WHEN 'R' THEN 2500 WHEN 'N' THEN 10000 ELSE 0 END) / 1e6), 6) AS cost FROM lineitem GROUP BY 1""")
def price_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = relational.cost({"R": 2500.0, "N": 10000.0}, F.col("l_quantity"), F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(c), 6).alias("cost"))


@query("""SELECT c_mktsegment, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS matched, round(avg((o_orderstatus = 'F')::INT), 6) AS match_rate, round(sum(o_totalprice) / nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0), 2) AS value_per_urgent
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    hit = F.col("o_orderstatus") == "F"
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return o.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.count_if(hit).alias("matched"), F.round(F.avg(hit.cast("int")), 6).alias("match_rate"), F.round(F.try_divide(F.sum("o_totalprice"), urgent), 2).alias("value_per_urgent")
    )


@query("""SELECT n, n_good, n_bad, round(n_good / n, 6) AS good_rate, round(n_bad / n, 6) AS bad_rate, CASE WHEN n >= 50 AND n_good / n >= 0.8 AND n_bad / n <= 0.2 THEN 'pass' ELSE 'halt' END AS decision
FROM (SELECT count(*) AS n, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (toxic = 1) AS n_bad FROM labels)""")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(table(spark, sf_dir, "labels"), F.col("quality") == 1, F.col("toxic") == 1, 0.8, 0.2, 50)


@query("""SELECT o_orderpriority, len(v)::BIGINT AS n, v[len(v) // 3 + 1] AS low_cut, v[2 * len(v) // 3 + 1] AS high_cut FROM (SELECT o_orderpriority, list(o_totalprice ORDER BY o_totalprice) AS v FROM orders GROUP BY 1)""")
def index_terciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.index_terciles(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@query("SELECT least(turns, 6) AS bucket, count(*) AS n FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1) GROUP BY 1")
def capped_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    return relational.capped_histogram(turns, "turns", 6)


@query("""WITH q AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, count(*) OVER () AS total, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey) AS place FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN place <= round_even(500 * n / total, 0) THEN 'holdout' ELSE 'train' END AS split FROM q""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_split(o, "o_orderkey", "o_orderpriority", 500, 42)


@query("""WITH q AS (SELECT o_orderpriority AS s, count(*) AS n FROM orders GROUP BY 1) SELECT s AS o_orderpriority, round_even(500 * n / (SELECT sum(n) FROM q), 0)::BIGINT AS holdout, (n - round_even(500 * n / (SELECT sum(n) FROM q), 0))::BIGINT AS train FROM q""")
def stratified_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stratified_split(spark, sf_dir)
    return s.groupBy("o_orderpriority").agg(F.count_if(F.col("split") == "holdout").alias("holdout"), F.count_if(F.col("split") == "train").alias("train"))


@query("""SELECT l_suppkey, l_returnflag, least(lo, hi) AS lo, hi FROM (SELECT l_suppkey, l_returnflag, max(l_quantity * (1 - l_discount)) AS lo, min(l_quantity * (1 + l_tax) + 30) AS hi FROM lineitem GROUP BY 1, 2)""")
def interval_tighten(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return intervals.tighten(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"], q * (1 - F.col("l_discount")), q * (1 + F.col("l_tax")) + 30)


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity * 2 AS lo, 252.0 AS hi FROM lineitem), s AS (SELECT *, sum(lo) OVER (PARTITION BY l_orderkey) AS spent FROM b)
SELECT l_orderkey, l_linenumber, lo, CASE WHEN spent > 508 THEN hi ELSE greatest(least(hi, 508 - (spent - lo)), lo) END AS hi FROM s""")
def budget_constraint(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("lo"), F.lit(252.0).alias("hi"))
    return intervals.budget(b, ["l_orderkey"], 508.0)


@query("""SELECT p_partkey, list_min(list_filter(range(0, 253), lambda x: p_retailprice + x * p_size >= 2000))::INT AS least_step, list_max(list_filter(range(0, 253, 4), lambda x: p_retailprice + x * p_size <= 2500))::INT AS greatest_step FROM part""")
def boundary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda x: F.col("p_retailprice") + x * F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", intervals.least_step(lambda x: at(x) >= 2000, 0, 252).alias("least_step"), intervals.greatest_step(lambda x: at(x) <= 2500, 0, 252, 4).alias("greatest_step"))


@query("""SELECT p_partkey, CASE WHEN lo <= 0 AND hi >= 252 THEN '?' WHEN lo = hi THEN '= ' || lo WHEN lo <= 0 THEN '≤ ' || hi WHEN hi >= 252 THEN '≥ ' || lo ELSE lo || '–' || hi END AS interval_text
FROM (SELECT p_partkey, (p_partkey % 5) * p_size AS lo, CASE WHEN p_partkey % 3 = 0 THEN 252 ELSE (p_partkey % 5) * p_size + (p_partkey % 7) * 4 END AS hi FROM part)""")
def one_sided_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    lo = (key % 5) * F.col("p_size")
    hi = F.when(key % 3 == 0, F.lit(252)).otherwise(lo + (key % 7) * 4)
    return table(spark, sf_dir, "part").select("p_partkey", intervals.render(lo, hi, 0, 252).alias("interval_text"))


LEAK = r"(?i)licen[cs]e|copyright|general public|all rights|version [0-9]"


@query("SELECT doc_id, regexp_matches(text, '(?i)licen[cs]e|copyright|general public|all rights|version [0-9]') AS leaks, nullif(regexp_extract(text, '(?i)licen[cs]e|copyright|general public|all rights|version [0-9]', 0), '') AS first_hit FROM documents")
def leak_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.rlike("text", F.lit(LEAK)).alias("leaks"), textops.first_hit(F.col("text"), LEAK).alias("first_hit"))


@query("SELECT 'supplier' AS origin, s_suppkey AS id, regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') AS name FROM supplier UNION ALL SELECT 'part', p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') FROM part")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), scalars.name_key(F.col("s_name")).alias("name"))
    return s.unionByName(table(spark, sf_dir, "part").select(F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), scalars.name_key(F.col("p_name")).alias("name")))


@query("""WITH u AS (SELECT conv_id, turn, text, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS k, role FROM conversations),
c AS (SELECT conv_id, k, min(turn) AS call_turn FROM u WHERE role = 'user' GROUP BY 1, 2), r AS (SELECT conv_id, k, min(turn) AS result_turn FROM u WHERE role = 'assistant' GROUP BY 1, 2)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.k, r.k)::BIGINT AS k, call_turn, result_turn, CASE WHEN result_turn IS NULL THEN 'unanswered' WHEN call_turn IS NULL THEN 'orphan' ELSE 'paired' END AS status
FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.k = r.k""")
def message_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    c = c.withColumn("k", sequence.stint(F.col("role") == "user", ["conv_id"], ["turn"]))
    at = lambda role, name: c.where(F.col("role") == role).groupBy("conv_id", "k").agg(F.min("turn").alias(name))
    return relational.paired(at("user", "call_turn"), at("assistant", "result_turn"), ["conv_id", "k"])


@query("""SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS users, count(*) FILTER (role = 'system') <= 1 AS one_system, max(turn) - min(turn) + 1 = count(*) AS gapless, bool_and(role <> 'system' OR turn = 0 OR turn = 1) AS system_first FROM conversations GROUP BY 1""")
def wellformed_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.count_if(role == "user").alias("users"), (F.count_if(role == "system") <= 1).alias("one_system"),
        (F.max("turn") - F.min("turn") + 1 == F.count("*")).alias("gapless"), F.bool_and((role != "system") | F.col("turn").isin(0, 1)).alias("system_first"),
    )


@query("""WITH d AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) SELECT check_name, n_rows, n_tripped, round(coalesce(n_tripped / nullif(n_rows, 0), 0), 6) AS rate FROM (
SELECT 'short' AS check_name, count(*) AS n_rows, count(*) FILTER (n_chars < 200) AS n_tripped FROM d
UNION ALL SELECT 'shouting', count(*), count(*) FILTER (text = upper(text)) FROM d
UNION ALL SELECT 'licence', count(*), count(*) FILTER (regexp_matches(text, '(?i)licen[cs]e')) FROM d
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NOT NULL), count(*) FILTER (toxic = 1) FROM d
UNION ALL SELECT 'low_quality', count(*) FILTER (quality IS NOT NULL), count(*) FILTER (quality = 0) FROM d)""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    check = quality.Check
    return quality.audit(
        d,
        {
            "short": check(F.col("n_chars") < 200),
            "shouting": check(F.col("text") == F.upper("text")),
            "licence": check(F.rlike("text", F.lit("(?i)licen[cs]e"))),
            "toxic": check(F.col("toxic") == 1, F.col("toxic").isNotNull()),
            "low_quality": check(F.col("quality") == 0, F.col("quality").isNotNull()),
        },
    )


@query("""SELECT doc_id, 'short' AS issue FROM documents WHERE n_chars < 200 UNION ALL SELECT doc_id, 'licence' FROM documents WHERE regexp_matches(text, '(?i)licen[cs]e')""")
def audit_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"short": quality.Check(F.col("n_chars") < 200), "licence": quality.Check(F.rlike("text", F.lit("(?i)licen[cs]e")))}
    return quality.issues(table(spark, sf_dir, "documents"), checks, ["doc_id"])


@query("""WITH RECURSIVE c AS (SELECT doc_id, text, -1 AS chunk, 0 AS start, 0 AS stop FROM documents WHERE length(text) > 0 UNION ALL
SELECT doc_id, text, chunk + 1, stop, CASE WHEN stop + 1000 >= length(text) THEN length(text) WHEN contains(w, '. ') THEN stop + 502 + length(regexp_extract(w, '(?s)^(.*)\\. ', 1)) ELSE stop + 1000 END
FROM (SELECT *, substring(text, stop + 501, 500) AS w FROM c WHERE stop < length(text)))
SELECT doc_id, chunk, start, (stop - start)::INT AS chars, md5(substring(text, start + 1, stop - start)) AS digest FROM c WHERE chunk >= 0""")
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("text_chunks", textops.TextChunks)
    docs = table(spark, sf_dir, "documents")
    return spark.sql("SELECT doc_id, c.chunk, c.start, length(c.piece) AS chars, md5(c.piece) AS digest FROM {docs}, LATERAL text_chunks(text, 1000) c", docs=docs)


@query(r"""SELECT page_id, (i - 1)::BIGINT AS section, regexp_extract(part, '^<([a-z0-9]+)', 1) AS tag, md5(trim(regexp_replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS body
FROM (SELECT page_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<(?:h1|footer|title)[^>]*>.*?</(?:h1|footer|title)>') AS parts FROM pages))""")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textops.tag_sections(table(spark, sf_dir, "pages"), "page_id", "html", "h1|footer|title").withColumn("body", F.md5("body"))


@query("""WITH c AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS s FROM events WHERE event_type = 'click'), p AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS s FROM events WHERE event_type = 'purchase'),
j AS (SELECT c.event_id, p.event_id AS near, abs(c.s - p.s) AS d, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(c.s - p.s), p.event_id) AS n FROM c JOIN p ON c.user_id = p.user_id AND abs(c.s - p.s) <= 86400)
SELECT c.event_id, near AS near_event_id, round(d, 3) AS distance FROM c LEFT JOIN (SELECT * FROM j WHERE n = 1) j USING (event_id)""")
def nearest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")) / 1e6
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", epoch.alias("s"))
    near = relational.nearest_match(e.where(is_type("click")), e.where(is_type("purchase")), "user_id", "s", 86400.0, ["event_id"], "event_id")
    return near.select("event_id", "near_event_id", F.round("distance", 3).alias("distance"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", scalars.json_argument(F.col("props"), "$.k").alias("k"))


@query("SELECT 'conversations' AS tab, 'chat' AS kind UNION ALL SELECT 'labels', 'labels' UNION ALL SELECT 'events', 'unknown'")
def file_kind_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"chat": ["conv_id", "role", "text"], "labels": ["doc_id", "quality"]}
    one = lambda t: table(spark, sf_dir, t).limit(1).select(F.lit(t).alias("tab"), readers.file_kind(F.to_json(F.struct("*")), kinds).alias("kind"))
    return one("conversations").unionByName(one("labels")).unionByName(one("events"))


@query("""WITH s AS (SELECT event_id, user_id, ts, event_type, min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER w AS p, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, n > 1 AS visible FROM s""")
def visibility_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the row's type was seen earlier by the user."""
    seen = F.row_number().over(sequence.ordered([*USER, "event_type"], TIME)) > 1
    return table(spark, sf_dir, "events").select("event_id", seen.alias("visible"))


@query("""WITH b AS (SELECT doc_id // 40 AS batch, count(*) AS n, sum(n_chars) AS chars, max(n_chars) AS longest FROM documents GROUP BY 1) SELECT count(*) AS batches, sum(n)::BIGINT AS n, sum(chars)::BIGINT AS chars, max(longest) AS longest FROM b""")
def hierarchical_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = {"n": F.count("*"), "chars": F.sum("n_chars"), "longest": F.max("n_chars")}
    final = {"batches": F.count("*"), "n": F.sum("n"), "chars": F.sum("chars"), "longest": F.max("longest")}
    return textops.batched_reduce(table(spark, sf_dir, "documents"), F.col("doc_id"), 40, partial, final)
