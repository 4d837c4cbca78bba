"""Queries that store something on the way: committed tables, the routed sink, work items, tables replayed as streams. They write in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.plans.catalog import _SESSIONS, SESSION_CEILING, SESSION_GAP, query, table
from logweave.sources import lines
from logweave.sources.commits import Committed
from logweave.sources.routed import RoutedJson
from logweave.sources.shared import folder
from logweave.streaming import journal, repair, stateful


@query("""WITH r AS (SELECT user_id, event_id, value FROM events WHERE user_id % 3 > 0 UNION ALL SELECT user_id, event_id, value * 2 FROM events WHERE user_id % 3 = 0 AND event_type = 'purchase' UNION ALL SELECT user_id, event_id, -1 FROM events WHERE event_type = 'error')
SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, max(event_id) AS last FROM r GROUP BY user_id""")
def committed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; every third user's are replaced by their purchases, doubled; errors are added again; retries of each and a change that was never committed don't count."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    rows = e.drop("event_type")
    t = Committed(spark, folder(spark, "committed"), "user_id")
    t.append(rows, "load", 0)
    t.append(rows, "load", 0)
    third = e.where("user_id % 3 = 0")
    bought = third.where("event_type = 'purchase'").select("user_id", "event_id", (F.col("value") * 2).alias("value"))
    t.replace(bought, "mend", 0, groups=third)
    t.replace(rows, "mend", 0)
    t._stage(rows, "left-behind", None)
    t.append(e.where("event_type = 'error'").select("user_id", "event_id", F.lit(-1.0).alias("value")), "load", 1)
    return t.read().groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("event_id").alias("last"))


@query("""SELECT CASE WHEN l_quantity < 25 AND l_discount > 0.02 THEN 'good' ELSE 'dead' END AS route, l_linenumber AS line, count(*) AS n, sum(l_orderkey)::BIGINT AS orders, (SELECT count(*) FROM lineitem x WHERE (x.l_quantity < 25 AND x.l_discount > 0.02) = (lineitem.l_quantity < 25 AND lineitem.l_discount > 0.02))::BIGINT AS told
FROM lineitem GROUP BY ALL""")
def routed_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are written to two places in one pass and read again; ``told`` is what the commit messages counted."""
    spark.dataSource.register(RoutedJson)
    path = folder(spark, "routed")
    ok = (F.col("l_quantity") < 25) & (F.col("l_discount") > 0.02)
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ok.alias("ok")).write.format("routed_json").mode("append").save(path)
    told = spark.read.format("routed_json").load(path).groupBy("route").agg(F.sum("rows").alias("told"))
    read = lambda r: spark.read.format("routed_json").option("route", r).schema("l_orderkey long, l_linenumber int").load(path).withColumn("route", F.lit(r))
    n = read("good").union(read("dead")).groupBy("route", F.col("l_linenumber").alias("line")).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"))
    return n.join(F.broadcast(told), "route")  # two rows


_STATUS = "CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'submitted' WHEN 'purchase' THEN 'committed' WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'pending' ELSE 'failed' END ELSE CASE WHEN event_id % 4 = 0 THEN 'written' ELSE 'pending' END END"


@query(f"""WITH RECURSIVE t AS (SELECT user_id, event_id, {_STATUS} AS s, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events),
f AS (SELECT DISTINCT user_id, 0::BIGINT AS k, n, '' AS status, NULL::BIGINT AS last_seq, 0::BIGINT AS accepted FROM t
UNION ALL SELECT f.user_id, t.k, f.n, CASE WHEN ok THEN s ELSE status END, CASE WHEN ok THEN event_id ELSE last_seq END, accepted + ok::BIGINT
FROM f JOIN (SELECT *, k - 1 AS prior FROM t) t ON t.user_id = f.user_id AND t.prior = f.k, LATERAL (SELECT (s = 'pending' AND status IN ('', 'submitted') OR s = 'submitted' AND status = 'pending' OR s IN ('committed', 'failed') AND status = 'submitted' OR s = 'written' AND status = 'committed') AS ok))
SELECT user_id, status, last_seq, accepted, n - accepted AS refused FROM f WHERE k = n""")
def journal_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.expr(_STATUS).alias("status"))
    return journal.folded(e, keys=["user_id"])


@query("""SELECT c_custkey::VARCHAR AS item_id, CASE WHEN k % 5 = 0 OR k % 7 = 0 OR k % 3 > 1 THEN 'failed' ELSE 'committed' END AS status, CASE WHEN k % 5 = 0 THEN 'no answer' WHEN k % 7 = 0 THEN 'bad' WHEN k % 3 > 1 THEN 'out of rounds' END AS error,
CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN 0 ELSE k % 3 END::INT AS iteration, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN 3 ELSE 3 + 2 * (k % 3) END::BIGINT AS accepted FROM (SELECT c_custkey, c_custkey AS k FROM customer)""")
def work_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as work items: two rounds by a first driver whose second batch is never settled, and the rest by one that recovers."""
    answers: dict[str, DataFrame] = {}

    def respond(p: DataFrame) -> DataFrame:
        k = F.col("item_id").cast("int")
        status = F.when(k % 7 == 0, "failed").when(F.col("iteration") >= k % 3, "committed").otherwise("pending")
        return p.where(k % 5 > 0).select("item_id", status.alias("status"), F.when(k % 7 == 0, "bad").alias("error"), "batch_id")

    path = folder(spark, "journal")
    first = journal.Journal(spark, path, lease_seconds=60)
    first.open(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("item_id")))
    items = first.claim("one", 1000)
    first.settle(items, respond(items))
    answers["two"] = respond(first.claim("two", 2000))  # and then the driver is gone
    second = journal.Journal(spark, path, lease_seconds=60)
    second.recover(2060, lambda batches: answers["two"].join(batches, "batch_id", "left_semi"))
    return second.run(respond, 0, "three", lambda: 3000).select("item_id", "status", "error", "iteration", "accepted")


SLICES = 6


@query(f"""WITH {_SESSIONS} SELECT user_id::VARCHAR AS key, session, arg_min(event_id, (ts, event_id)) AS first_id, count(*)::INT AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s WHERE ts IS NOT NULL GROUP BY user_id, session""")
def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events replayed as a stream, in slices of time whose rows come up to a slice late; the sessions are those of the batch operator."""
    path = folder(spark, "replay")
    e = table(spark, sf_dir, "events").where("ts is not null").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    low, high, n = e.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    out = Committed(spark, f"{path}/out")
    if low is None:
        out.append(spark.createDataFrame([], stateful.SESSION), "replay", 0)
        return out.read()
    width = max(1.0, (high - low).total_seconds() / SLICES)
    at = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(low))) / (width * 1e6)) + F.pmod(F.xxhash64("id"), F.lit(2))
    files = -(-n // (SLICES * 200_000))  # of a slice
    for k in range(SLICES + 2):
        e.where(at == k).coalesce(files).write.mode("append").parquet(f"{path}/in")
    for _ in range(2):  # what ends the stream: rows of nobody, far ahead
        high += (high - low) + 10 * (high - low) / SLICES
        spark.createDataFrame([("", -1, high)], e.schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    with stateful.on_rocksdb(spark, n):
        s = stateful.sessions(stream, SESSION_GAP, SESSION_CEILING, f"{int(3 * width) + 1} seconds", max(60, int(width // 4)), max(64, n // 10_000))
        q = s.writeStream.foreachBatch(out.sink("replay")).outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    kind = "timestamp_ntz" if "ntz" in dict(table(spark, sf_dir, "events").dtypes)["ts"] else "timestamp"
    return out.read().where("key IS NULL OR key <> ''").withColumns({c: F.col(c).cast(kind) for c in ("first_ts", "last_ts")})


@query("""WITH r AS (SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS ordinal, count(*) OVER (PARTITION BY role) AS n FROM conversations WHERE role IS NOT NULL)
SELECT role AS bucket, ordinal, conv_id, turn::INT AS turn, n AS rows, (n + count(*) FILTER (turn % 3 = 0) OVER (PARTITION BY role) * 2)::BIGINT AS lines FROM r QUALIFY ordinal % 97 = 0 OR ordinal = n - 1""")
def line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as JSON lines by role, with a blank and a broken line after every third; then every 97th row and the last one of each role by ordinal."""
    path = folder(spark, "lines")
    c = table(spark, sf_dir, "conversations").where("role is not null").select("role", "conv_id", "turn")
    line = F.concat(F.to_json(F.struct("conv_id", "turn")), F.when(F.col("turn") % 3 == 0, '\n \n{"broken": ').otherwise(""))
    c = c.repartitionByRange("role", "conv_id", "turn").sortWithinPartitions("role", "conv_id", "turn")
    c.select("role", line.alias("value")).write.partitionBy("role").text(path)
    index = lines.splits(spark, path)
    index.write.parquet(at := folder(spark, "line-index"))
    index = spark.read.parquet(at)
    n = lines.catalog(index).groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("lines").alias("lines"))
    wanted = n.select("bucket", F.explode(F.array_distinct(F.concat(F.sequence(F.lit(0), F.col("rows") - 1, F.lit(97)), F.array(F.col("rows") - 1)))).alias("ordinal"))
    found = lines.rows_at(spark, path, index, wanted).join(n, "bucket").withColumn("j", F.from_json("value", "conv_id string, turn int"))
    kind = c.schema["conv_id"].dataType
    return found.select(F.substring_index("bucket", "=", -1).alias("bucket"), "ordinal", F.col("j.conv_id").cast(kind).alias("conv_id"), "j.turn", "rows", "lines")


def _repair_round(k: int) -> str:
    """A round of the loop in SQL: judged are groups that changed; the longest of an even group is flagged and gets one less."""
    return f"""g{k} AS (SELECT conv_id, arg_max(turn, (n, turn)) AS turn FROM r{k} WHERE {'true' if k == 0 else f'conv_id IN (SELECT conv_id FROM g{k - 1})'} GROUP BY conv_id HAVING sum(n) % 4 > 0),
r{k + 1} AS (SELECT r.conv_id, r.turn, n - (g.turn IS NOT NULL)::INT AS n FROM r{k} r LEFT JOIN g{k} g ON g.conv_id = r.conv_id AND g.turn = r.turn)"""


@query(f"""WITH r0 AS (SELECT conv_id, turn, any_value(length(coalesce(text, '')))::BIGINT AS n FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn), {", ".join(map(_repair_round, range(3)))}
SELECT conv_id, turn::INT AS turn, n FROM r2 WHERE (conv_id, turn) NOT IN (SELECT conv_id, turn FROM g2)""")
def repair_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose lengths don't add up to a multiple of four have their longest turn shortened, for two rounds; those still flagged lose that turn."""
    c = table(spark, sf_dir, "conversations").where("conv_id is not null AND turn is not null")
    rows = c.groupBy("conv_id", F.col("turn").cast("int").alias("turn")).agg(F.any_value(F.length(F.coalesce("text", F.lit("")))).cast("long").alias("n"))

    def judge(d: DataFrame) -> DataFrame:
        g = d.groupBy("conv_id").agg(F.max_by("turn", F.struct("n", "turn")).alias("turn"), F.sum("n").alias("total"))
        return g.where("total % 4 > 0").select("conv_id", "turn", F.lit("total").alias("reason"))

    loop = repair.Repair(spark, folder(spark, "repair"), "conv_id", "turn", judge, lambda d: d.withColumn("n", F.col("n") - 1))
    loop.run(rows, 2)
    return loop.result()
