"""An index of lines for files of JSON lines: counts by split, prefix sums, row by ordinal.

:func:`splits` counts every split of every file once, in the tasks that read it, and adds up the splits before: a few numbers for each
128 MB. :func:`marks` keeps the byte at which every ``stride``-th row begins. From these come the catalogue's row counts
(:func:`catalog`), the rows at many ordinals of a folder (:func:`rows_at`: only the splits that hold them are numbered) and
a single row by a seek (:func:`row_at`). Blank lines and lines that aren't JSON aren't rows, but count as lines and bytes. Rows
of a folder are numbered through its files in order of their names, from 0. Lines end with ``\\n``; an index belongs to files that don't change, and to one ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, bucket (its folder), block, id (grows within a block), value, is_row of all lines below a path."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    d = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    bucket = F.regexp_extract("file", "([^/]*)/[^/]*$", 1)
    return d.withColumn("bucket", bucket).withColumn("is_row", (F.trim("value") != "") & F.try_parse_json("value").isNotNull())


def splits(spark: SparkSession, path: str) -> DataFrame:
    """file, bucket, block, n_lines, n_rows, n_bytes, and those of the splits before in the file (first_byte) and in the folder (first_row)."""
    n = lines(spark, path).groupBy("file", "bucket", "block").agg(F.count("*").alias("n_lines"), F.count_if("is_row").alias("n_rows"), F.sum(F.octet_length("value") + 1).alias("n_bytes"))
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    return n.withColumn("first_byte", total("n_bytes", before(["file"], ["block"]))).withColumn("first_row", total("n_rows", before(["bucket"], ["file", "block"])))


def catalog(index: DataFrame) -> DataFrame:
    """file, bucket, rows, lines, bytes."""
    return index.groupBy("file", "bucket").agg(F.sum("n_rows").alias("rows"), F.sum("n_lines").alias("lines"), F.sum("n_bytes").alias("bytes"))


def numbered(d: DataFrame) -> DataFrame:
    """Lines with nth (rows before, within the split) and at (bytes before, within the split)."""
    w = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return d.withColumn("nth", F.coalesce(F.count_if("is_row").over(w), F.lit(0))).withColumn("at", F.coalesce(F.sum(F.octet_length("value") + 1).over(w), F.lit(0)))


def rows_at(spark: SparkSession, path: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """bucket, ordinal, value for the ``wanted`` (bucket, ordinal) that exist."""
    place = wanted.join(index.select("bucket", "file", "block", "first_row", "n_rows"), "bucket").where("ordinal >= first_row AND ordinal < first_row + n_rows")
    place = place.select("file", "block", (F.col("ordinal") - F.col("first_row")).alias("nth"), "ordinal")
    d = lines(spark, path).join(place.select("file", "block").distinct(), ["file", "block"], "left_semi")
    return numbered(d).where("is_row").join(place, ["file", "block", "nth"]).select("bucket", "ordinal", "value")


def marks(spark: SparkSession, path: str, index: DataFrame, stride: int = 1000) -> DataFrame:
    """bucket, ordinal (a multiple of ``stride``), file, byte."""
    d = numbered(lines(spark, path).drop("bucket")).where("is_row").join(index, ["file", "block"]).withColumn("ordinal", F.col("first_row") + F.col("nth"))
    return d.where(F.col("ordinal") % stride == 0).select("bucket", "ordinal", "file", (F.col("first_byte") + F.col("at")).alias("byte"))


def row_at(spark: SparkSession, index: DataFrame, marked: DataFrame, bucket: str, ordinal: int) -> str | None:
    """The row's text, by a seek to the mark before it, or to its split's file; None beyond the end."""
    files = sorted(index.where(F.col("bucket") == bucket).groupBy("file").agg(F.min("first_row").alias("first"), F.sum("n_rows").alias("n")).collect(), key=lambda r: r["file"])  # one row for each file of a folder
    mine = next((r for r in files if r["first"] <= ordinal < r["first"] + r["n"]), None)
    if mine is None:
        return None
    mark = marked.where((F.col("bucket") == bucket) & (F.col("ordinal") <= ordinal) & (F.col("file") == mine["file"])).agg(F.max(F.struct("ordinal", "byte")).alias("m")).first()["m"]
    at, byte = (mark["ordinal"], mark["byte"]) if mark else (mine["first"], 0)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(mine["file"]))
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    stream.seek(byte)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            if is_row(line):
                if at == ordinal:
                    return line
                at += 1
    finally:
        reader.close()
    return None


def is_row(line: str) -> bool:
    try:
        return bool(line.strip()) and (json.loads(line), True)[1]
    except ValueError:
        return False
