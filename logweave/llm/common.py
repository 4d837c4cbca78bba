"""What the operators share: inputs, keys, checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows up to which a table of ids and digests is broadcast, after counting (about 100 bytes each).
BROADCAST_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, set as the checkpoint folder; where it is unset, as in tests, a new local one, but not on a cluster."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not sc.master.startswith("local") and sc._jsc.sc().getCheckpointDir().isEmpty():
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='checkpoints-')}")
    return folder or sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def remainder(doc_id: Column | str, k: int) -> Column:
    """crc32 of the id as text, modulo k; null ids count as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, most: dict[int, int], name: str) -> tuple[DataFrame, dict[int, float]]:
    """Labelled rows of ``docs`` as (doc_id, text, label), at most ``most[v]`` for each label v; and the share of each label's rows that it has.

    ``wanted`` is a condition on labels.doc_id. The sample is the rows with the lowest hashed ids
    (ties: the lower id), so it is the same in every run and for any partitioning. Ids are compared as the documents' type. Only the sample's ids pass
    through the driver and are broadcast; of documents that share an id the least text counts. Labels
    other than the keys of ``most``, null ids and repeated labels are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = labels.where(wanted & F.col(label).isin(*most)).select(F.col("doc_id").try_cast(kind).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null").distinct()
    have = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    ids: list[tuple] = []
    for v, n in most.items():
        # A cut a little above the wanted share, so that little more than n rows are gathered and then cut to n.
        share = (n + 6 * n**0.5 + 20) / have[v] if have.get(v) else 1.0
        drawn = rows.where(F.col("label") == v).select(draw.alias("draw"), "doc_id").where(F.col("draw") <= share).collect()
        ids += [(i, v) for _, i in sorted(map(tuple, drawn))[:n]]
    chosen = F.broadcast(spark.createDataFrame(ids, f"doc_id {kind}, label int"))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
    return written(texts, name), {v: min(1.0, n / have[v]) if have.get(v) else 1.0 for v, n in most.items()}
