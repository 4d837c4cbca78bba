"""Readers and sinks for JSON lines and files: permissive, with bad rows counted and not lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def json_rows(spark: SparkSession, path: str, schema: str | T.StructType, multiline: bool = False) -> DataFrame:
    """JSON with a given schema; rows that don't parse have the text in ``_corrupt_record``."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline).json(path)


def routed(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and the dead letters, from one input."""
    good = F.coalesce(ok, F.lit(False))
    return df.where(good), df.where(~good)


def game_headers(raw: DataFrame, least_players: int = 2) -> DataFrame:
    """Headers of raw games (id, formatid, players, uploadtime): public, with enough players, the first of equal ids."""
    ok = raw.where(~F.coalesce(F.col("private").cast("boolean"), F.lit(False)) & (F.size("players") >= least_players))
    first = ok.groupBy("id").agg(F.min(F.struct("uploadtime", "formatid", "players")).alias("h"))
    return first.select("id", "h.formatid", "h.players", "h.uploadtime")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files without timestamps and speaker marks, white space collapsed: path, text; empty ones go."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    clean = F.regexp_replace("text", r"\[?[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\]?", " ")
    clean = F.regexp_replace(clean, r"(?m)^\s*[A-Z][A-Za-z ]{0,30}:\s", " ")  # also behind a timestamp
    return raw.withColumn("text", F.trim(F.regexp_replace(clean, r"\s+", " "))).where("text <> ''")


def file_catalog(spark: SparkSession, path: str) -> DataFrame:
    """path, bucket (folder), bytes, modified for every file below a path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -2).alias("bucket"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_kind(first_row: Column, kinds: Mapping[str, list[str]]) -> Column:
    """The first kind whose keys the JSON object has all, else ``unknown``."""
    keys = F.coalesce(F.json_object_keys(first_row), F.array().cast("array<string>"))
    kind = F.lit("unknown")
    for name, need in reversed(kinds.items()):
        kind = F.when(F.size(F.array_except(F.array(*map(F.lit, need)), keys)) == 0, name).otherwise(kind)
    return kind


def latest_month(df: DataFrame, month: str, wanted: str, back: int = 12) -> DataFrame:
    """Rows of the latest month that has some, at most ``back`` months before the wanted one (yyyy-MM)."""
    low = F.date_format(F.add_months(F.to_date(F.lit(wanted), "yyyy-MM"), -back), "yyyy-MM")
    some = df.where((F.col(month) <= wanted) & (F.col(month) >= low))
    return some.join(F.broadcast(some.agg(F.max(month).alias(month))), month)  # one row


def excluded_ids(spark: SparkSession, path: str) -> DataFrame:
    """id: holdout ids from lines of text, or from a JSON file with a list or a field ``holdout``."""
    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.coalesce(F.from_json(F.get_json_object("v", "$.holdout"), "array<string>"), F.when(F.startswith("v", F.lit("[")), F.from_json("v", "array<string>")), F.split("v", r"\s*\n\s*"))
    return raw.select(F.explode(listed).alias("id")).where("id <> ''").distinct()


def replace_groups(df: DataFrame, path: str, group: str) -> None:
    """Commits whole groups: the groups in ``df`` replace those at the path, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)
