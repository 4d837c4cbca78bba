import random

import duckdb
import pytest
from helpers import clashing, documents, prose, rows

from logweave.llm import decontamination as d

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, 30)) for k in range(6)] + [(7, "Short ITEM text"), (8, None), (9, "..."), (10, "tail"), (0, prose(rng, 12))]
    a, b = items[0][1].split(), items[1][1].split()
    more = [
        (200, prose(rng, 20) + " " + " ".join(a[3:17]).upper() + " " + prose(rng, 20), "s"),
        (201, "x " + " ".join(a[:10]) + ", " + " ".join(a[:10]) + "; " + " ".join(b[5:16]), "s"),
        (202, " ".join(a[:9]), "s"),
        (203, "a short, item. text again", "s"),
        (203, "tail tail", "s"),
        (204, items[2][1] + " " + items[2][1], "s"),
    ]
    return documents(spark, more=more), spark.createDataFrame(items, "item_id long, text string")


def oracle(docs, bench):
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    c.register("benchmark", bench.toPandas())
    r = c.sql(d.ORACLE)
    at = [r.columns.index(x) for x in COLUMNS]
    return sorted((tuple(row[k] for k in at) for row in r.fetchall()), key=repr)


def test_against_sql(tables):
    got = rows(d.decontaminate(*tables), *COLUMNS)
    assert got == oracle(*tables)
    assert sum(r[5] for r in got) >= 5


def test_without_broadcast(tables):
    assert rows(d.decontaminate(*tables, broadcast_chars=0), *COLUMNS) == rows(d.decontaminate(*tables), *COLUMNS)


def test_edges(spark, tables):
    docs, bench = tables
    assert d.decontaminate(docs.limit(0), bench).count() == 0
    assert d.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert rows(d.decontaminate(clashing(docs), clashing(bench.withColumnRenamed("item_id", "item_id"))), *COLUMNS) == rows(d.decontaminate(docs, bench), *COLUMNS)


def test_stage_removes_what_is_hit(spark, tables, tmp_path):
    docs, bench = tables
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = d.stage(spark, clashing(docs), str(tmp_path))
    assert kept.columns == clashing(docs).columns
    bad = {r["doc_id"] for r in d.decontaminate(docs, bench).where("contaminated").collect()}
    assert rows(kept, "doc_id") == [r for r in rows(docs, "doc_id") if r[0] not in bad]


def test_no_python_in_the_plan(tables):
    plan = d.decontaminate(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_stage_without_broadcast_and_with_repeated_rows(spark, tables, tmp_path, monkeypatch):
    docs, bench = tables
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    want = rows(d.stage(spark, docs.union(docs), str(tmp_path)), "doc_id")
    assert want == sorted(2 * rows(d.stage(spark, docs, str(tmp_path)), "doc_id"), key=repr)
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    assert rows(d.stage(spark, docs.union(docs), str(tmp_path)), "doc_id") == want
