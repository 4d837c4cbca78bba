"""Command line: parse logs, make rows of turns, split matches, audit rows, check actions and reasoning, usage shares; from and to Parquet or JSON lines."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.domain import conditions, identity, protocol, rows, series, texts, usage
from logweave.operators import quality, relational, split
from logweave.sources import readers
from logweave.sources.commits import Committed

RAW = "id string, formatid string, players array<string>, uploadtime long, log string, private boolean"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.rstrip("/").endswith(("json", "jsonl")) else spark.read.parquet(path)


def parse(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = readers.json_rows(spark, a.input, RAW)
    good, dead = readers.routed(raw, F.col(readers.CORRUPT).isNull() & F.col("id").isNotNull())
    dead.select(readers.CORRUPT).write.mode("overwrite").json(f"{a.output}/dead_letters")
    games = readers.game_headers(good)
    games = games.where(F.col("formatid") == a.format) if a.format else games
    if a.resume:
        games = relational.without(games, spark.read.parquet(a.resume).select(F.col("game_id").alias("id")), ["id"])
    games = games.orderBy("uploadtime", "id").limit(a.limit) if a.limit else games
    series.stitch(games, a.gap_minutes * 60, a.ceiling).write.mode("overwrite").parquet(f"{a.output}/matches")
    logs = good.join(games.select("id"), "id", "left_semi").select(F.col("id").alias("game_id"), "log")
    fix = identity.corrected if a.identities else None
    for name, table in (("events", protocol.events(logs, fix)), ("snapshots", protocol.snapshots(logs, fix)), ("conditions", conditions.timed(logs)), ("winners", protocol.winners(logs)), ("individuals", identity.individuals(logs))):
        table.write.mode("overwrite").parquet(f"{a.output}/{name}")


def do_split(spark: SparkSession, a: argparse.Namespace) -> None:
    df = read(spark, a.input)
    cuts = split.index_terciles(df, a.group, a.length)
    j = df.join(cuts, a.group)
    j = j.withColumn("stratum", F.concat_ws("/", a.group, split.bucket(F.col(a.length), F.col("low_cut"), F.col("high_cut"))))
    out = split.stratified_split(j.select(a.unit, "stratum"), a.unit, "stratum", a.holdout, a.seed)
    out.orderBy("split", a.unit).write.mode("overwrite").json(a.output)


def do_rows(spark: SparkSession, a: argparse.Namespace) -> None:
    """Rows of the games' turns, committed whole by game: games that the table has already aren't done again, and a job that was lost leaves nothing."""
    raw = readers.json_rows(spark, a.input, RAW)
    good, _ = readers.routed(raw, F.col(readers.CORRUPT).isNull() & F.col("id").isNotNull())
    logs = good.join(readers.game_headers(good).select("id"), "id", "left_semi").select(F.col("id").alias("game_id"), "log").dropDuplicates(["game_id"])
    out = Committed(spark, a.output, "game_id")
    if out.versions():
        logs = relational.without(logs, out.read().select("game_id").distinct(), ["game_id"])
    made = rows.turn_rows(logs, a.side, identity.corrected)
    if a.holdout:
        made = relational.without(made, readers.excluded_ids(spark, a.holdout).withColumnRenamed("id", "game_id"), ["game_id"])
    out.append(made, "rows", out.last_number("rows") + 1)


def checked(spark: SparkSession, a: argparse.Namespace, checks: dict[str, quality.Check]) -> None:
    """A report of the checks, and every issue with its row's keys."""
    df = read(spark, a.input)
    quality.audit(df, checks).orderBy("check_name").write.mode("overwrite").json(f"{a.output}/report")
    quality.issues(df, checks, [k for k in a.keys.split(",") if k in df.columns]).write.mode("overwrite").json(f"{a.output}/issues")


def legality(spark: SparkSession, a: argparse.Namespace) -> None:
    checked(spark, a, series.legality_checks())


def reasoning(spark: SparkSession, a: argparse.Namespace) -> None:
    checked(spark, a, texts.text_checks())


def do_usage(spark: SparkSession, a: argparse.Namespace) -> None:
    """Top shares by species and field from rows (species, data: map of fields to maps of values to weights), of the latest month with some if rows have one."""
    df = readers.json_rows(spark, a.input, "month string, species string, data map<string, map<string, double>>").where(F.col(readers.CORRUPT).isNull())
    df = readers.latest_month(df, "month", a.month) if a.month else df
    top = dict(x.split("=") for x in a.top.split(","))
    usage.top_shares(usage.marginals(df), {k: int(n) for k, n in top.items()}).orderBy("species_key", "field", "rank").write.mode("overwrite").json(a.output)


def audit(spark: SparkSession, a: argparse.Namespace) -> None:
    quality.audit(read(spark, a.input), texts.row_checks()).orderBy("check_name").write.mode("overwrite").json(a.output)


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(description=__doc__)
    sub = top.add_subparsers(required=True)
    p = sub.add_parser("parse")
    p.set_defaults(run=parse)
    p.add_argument("--gap-minutes", type=int, default=30)
    p.add_argument("--ceiling", type=int, default=3)
    p.add_argument("--format")
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--identities", action="store_true", help="undo illusions, follow formes")
    p.add_argument("--resume", help="events of an earlier run; its games are left out")
    s = sub.add_parser("split")
    s.set_defaults(run=do_split)
    s.add_argument("--unit", default="match_id")
    s.add_argument("--group", default="format")
    s.add_argument("--length", default="turns")
    s.add_argument("--holdout", type=int, default=500)
    s.add_argument("--seed", type=int, default=42)
    q = sub.add_parser("audit")
    q.set_defaults(run=audit)
    r = sub.add_parser("rows")
    r.set_defaults(run=do_rows)
    r.add_argument("--side", default="p1")
    r.add_argument("--holdout", help="file of game ids to leave out")
    g = sub.add_parser("legality")
    g.set_defaults(run=legality)
    v = sub.add_parser("reasoning")
    v.set_defaults(run=reasoning)
    for x in (g, v):
        x.add_argument("--keys", default="match_id,game_index,turn,slot")
    u = sub.add_parser("usage")
    u.set_defaults(run=do_usage)
    u.add_argument("--month", help="yyyy-MM; the latest month with rows up to a year before")
    u.add_argument("--top", default="Spreads=2,Items=3,Abilities=2,Moves=10")
    for x in (p, s, q, r, g, v, u):
        x.add_argument("input")
        x.add_argument("output")
    a = top.parse_args(args)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
