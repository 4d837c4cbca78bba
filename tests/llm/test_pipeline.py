import corpus_pipeline
from test_near_dedup import brute_classes
from test_pii import brute as brute_spans
from test_quality_rules import brute as brute_counts

from logweave.llm import decontamination, pii, quality_rules

SF = "/root/testdata/sf0.001"


def test_run_against_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    at = {c: k for k, c in enumerate(columns)}
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs, quality_rules.bands_for(spark, docs, SF)).collect()}
    for r in rows:
        b = brute_counts(r[at["text"]])
        assert not (kept[r[0]] and (b[0] < 20 or 100 * b[4] > 30 * b[0]))
    rows = [r for r in rows if kept[r[0]]]
    classes, _ = brute_classes([(r[0], r[at["text"]]) for r in rows])
    rows = [r for r, c in zip(rows, classes, strict=True) if r[0] == c]
    left = spark.createDataFrame(rows, docs.schema)
    bad = {r["doc_id"] for r in decontamination.decontaminate(left, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    rows = [r for r in rows if r[0] not in bad]
    want = {r[0]: pii.redacted(r[at["text"]], brute_spans(r[at["text"]])) for r in rows}

    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in out} == want and len(out) == len(want)
    assert len({r["position"] for r in out}) == len(out)
    assert 0 < len(out) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "mixing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
