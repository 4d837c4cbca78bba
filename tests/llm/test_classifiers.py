import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, documents, prose, rows
from pyspark.sql import functions as F

from logweave.llm import quality_classifier as qc
from logweave.llm import textbytes as tb
from logweave.llm import toxicity as tx
from logweave.llm.common import labelled_sample, remainder

SF = "/root/testdata/sf0.1"


def held_out_result(spark, query, label):
    got = query(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("predicted", label).collect()
    p, y = np.array([r[0] for r in got]), np.array([r[1] for r in got])
    return p, y


def test_quality_on_held_out_rows(spark):
    p, y = held_out_result(spark, qc.op9_quality_classifier, "quality")
    assert (p == y).mean() > 0.98 and p[y == 1].mean() > 0.99


def test_toxicity_on_held_out_rows(spark):
    p, y = held_out_result(spark, tx.op10_toxicity, "toxic")
    assert y[p == 1].mean() > 0.95 and p[y == 1].mean() > 0.7


@pytest.mark.parametrize("module,label", [(qc, "quality"), (tx, "toxic")])
def test_edges(spark, module, label):
    rng = random.Random(1)
    more = [(1000 + k, prose(rng, 30) + (" nasty nastier" if k % 2 else " &&& !!!"), "s") for k in range(60)]
    docs = documents(spark, more=more)
    labels = spark.createDataFrame([(1000 + k, k % 2) for k in range(60)] + [(None, 1), (5, None), (99999, 1)], f"doc_id long, {label} int")
    score = lambda d, l: module.classify(d, module.fit(d, l, label, remainder("doc_id", 5) != 0), remainder("doc_id", 5) == 0)
    got = score(docs, labels)
    assert got.count() == docs.count() and got.where("score between 0 and 1").count() == docs.count()
    assert rows(score(clashing(docs), clashing(labels)), "doc_id", "score") == rows(got, "doc_id", "score")
    assert score(docs.limit(0), labels).count() == 0
    none = score(docs, labels.limit(0))
    assert none.count() == docs.count() and none.where("score between 0 and 1").count() == docs.count()
    one = score(docs, labels.where(F.col(label) == 1))
    assert one.where("score < 0.5").count() == 0


def brute_nearest(vectors, query, k, skip):
    dense = lambda v: {int(t): w for t, w in zip(*v, strict=True)}
    q = dense(query)
    cos = [(round(sum(w * q.get(t, 0.0) for t, w in dense(v).items()), 9), i) for i, v in enumerate(vectors) if i != skip]
    return sorted([(-c, i) for c, i in cos if c > 0])[:k]


def test_nearest_is_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):
        t = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt(w @ w)))
    index = tx.BlockMax(vectors, 40, 16)
    for i in range(0, 300, 7):
        at, cos = index.nearest(*vectors[i], 9, skip=i)
        want = brute_nearest(vectors, vectors[i], 9, i)
        assert at.tolist() == [a for _, a in want] and np.allclose(cos, [-c for c, _ in want])


def test_monotone_fit():
    x, y = tx.monotone(np.array([0.1, 0.2, 0.3, 0.4, 0.9]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.full(5, 100.0))
    assert x.tolist() == [0.1, 0.1, 0.2, 0.3, 0.4, 0.9] and (np.diff(y) >= 0).all()
    assert y[0] < 0.01 and abs(y[2] - 0.5) < 0.01 and y[-1] > 0.99


def test_descent_separates():
    rng = np.random.default_rng(3)
    rows_ = [np.array(sorted({0 if k % 2 else 1, *rng.integers(2, 30, 5)})) for k in range(200)]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(200)])
    c = qc.Config()
    r = qc.ratios(rows_, y, 30)
    w, b = qc.descend(rows_, y, r, c)
    assert all(((w * r)[x].sum() / np.sqrt(len(x)) + b) * k > 0 for x, k in zip(rows_, y, strict=True))


def test_features_do_not_depend_on_the_slice():
    c, rng = qc.Config(), random.Random(2)
    texts = [prose(rng, 50), "", "THE THE!! a | b | c ***", "é 12 x"]
    together = next(tb.slices(pa.array(texts)))
    row, place = qc.features(together, c)
    for k, t in enumerate(texts):
        s = next(tb.slices(pa.array([t])))
        assert (qc.features(s, c)[1] == place[row == k]).all()


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)", "smallint"])
def test_toxicity_with_ids_of_any_type(spark, kind):
    rng = random.Random(3)
    rows_ = [(k, prose(rng, 30) + (" nasty nastier" if k % 2 else ""), k % 2) for k in range(80)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, toxic int").selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text", "toxic")
    got = tx.classify(df, tx.fit(df, df.select("doc_id", "toxic"), "toxic", F.lit(True)), F.lit(False))
    assert got.schema["doc_id"].dataType == df.schema["doc_id"].dataType and got.where("size(evidence) > 0").count() > 70


def test_beginnings_are_whole_characters():
    texts = ["éééééééééé", "aé日本語日本", "abcd", ""]
    s = next(tb.slices(pa.array(texts)))
    low = tb.LOWER[s.data]
    seen = {low[a:b].tobytes().decode() for _, _, span in tx.terms(s, tx.Config()) for a, b in zip(span.start, span.end, strict=True)}
    assert seen == {"éééééééééé", "aé日本語日本", "abcd", *("é" * k for k in range(4, 9)), *("aé日本語日本"[:k] for k in range(4, 7))}


def test_labelled_sample_is_the_same_in_every_run(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(3000)] + [(5, "a"), (5, "zz")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3000)] + [(7, 1)] * 5 + [(None, 1), (9999, 0)], "doc_id long, y int")
    take = lambda d, l: rows(labelled_sample(d, l, "y", F.lit(True), {0: 100, 1: 200}, "sample")[0], "doc_id", "text", "label")
    a = take(docs, labels)
    assert a == take(docs.repartition(7), labels.repartition(5)) and len({r[0] for r in a}) == len(a)
    assert sum(r[2] == 1 for r in a) == 200 and sum(r[2] == 0 for r in a) in (99, 100)


def test_labels_with_ids_of_another_type(spark):
    docs = spark.createDataFrame([(str(k), f"t{k}") for k in range(20)] + [("x", "y")], "doc_id string, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, y int")
    got = labelled_sample(docs, labels, "y", F.lit(True), {0: 100, 1: 100}, "sample")[0]
    assert rows(got, "doc_id", "label") == sorted(((str(k), k % 2) for k in range(20)), key=repr)
    back = labelled_sample(labels.selectExpr("doc_id", "'a' AS text"), docs.selectExpr("doc_id", "1 AS y"), "y", F.lit(True), {1: 100}, "sample")[0]
    assert back.count() == 20
