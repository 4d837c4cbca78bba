import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest
from helpers import clashing, documents
from pyspark.sql import functions as F

from logweave.llm import filter_audit as a

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int"


def failures(docs):
    """Per row (id, part, letters it fails)."""
    ids = defaultdict(list)
    for r in docs:
        if r["doc_id"] is not None:
            ids[r["text"] or ""].append(r["doc_id"])
    for r in docs:
        t = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": bool(set(t) & set("#$%&*|")),
            "E": r["doc_id"] is not None and any(i < r["doc_id"] for i in ids[t]),
        }
        yield r["doc_id"], r["source"] or "", {k for k, v in fails.items() if v}


def brute(docs, labels):
    good, toxic = ({r["doc_id"] for r in labels if r["doc_id"] is not None and r[c] == 1} for c in ("quality", "toxic"))
    by, out = defaultdict(list), []
    for row in failures(docs):
        by[row[1]].append(row)
    for part, mine in by.items():
        of_filter = defaultdict(int)
        for order in permutations("ABCDE"):
            alive = mine
            for step, x in enumerate(order, 1):
                gone, kept = [r for r in alive if x in r[2]], [r for r in alive if x not in r[2]]
                of_filter[x] += len(gone)
                failing = sum(x in r[2] for r in mine)
                out.append([part, "".join(order), step, len(kept), len(gone), failing - len(gone), sum(r[2] == {x} for r in mine), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)])
                alive = kept
        for row in out:
            if row[0] == part:
                row.append(of_filter[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


def tables(spark):
    more = [(200 + k, ("Word " * 60 if k % 2 else "ab cd ef # " * 9), "src1") for k in range(6)] + [(300, "same text", None), (301, "same text", ""), (302, "same text", "src9"), (-5, "same text", "src9"), (None, "same text", "src9"), (None, None, None), (400, "éÉ " * 70, "src9"), (401, "A b " * 60, "src9")]
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 420, 3)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (301, None, None)]
    return documents(spark, more=more), spark.createDataFrame(labels, LABELS)


def test_against_brute_force_and_sql(spark, tmp_path):
    docs, labels = tables(spark)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in a.audit(clashing(docs.repartition(5)), clashing(labels)).collect())
    assert got == brute(docs.collect(), labels.collect())
    assert len(got) == 600 * len({r[0] for r in got}) and sum(r[4] for r in got) > 0 and any(r[7] for r in got) and any(r[8] for r in got)
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    labels.coalesce(1).write.parquet(str(tmp_path / "l"))
    d = duckdb.connect()
    d.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    d.execute(f"CREATE VIEW labels AS SELECT * FROM '{tmp_path}/l/*.parquet'")
    r = d.sql(a.ORACLES["op12_filter_audit"])
    at = [r.columns.index(c) for c in COLUMNS]
    assert got == sorted(tuple(x[k] for k in at) for x in r.fetchall())


def test_every_state_is_entered_once(spark, monkeypatch):
    """2**n tables of counts, one for each set of filters, and nothing stays persisted."""
    names = []
    monkeypatch.setattr(a, "written", lambda df, name, f=a.written: (names.append(name), f(df, name))[1])
    rows = spark.createDataFrame([("x", k, k % 2 == 0, k % 3 == 0) for k in range(8)] * 3, "part string, fails int, good boolean, toxic boolean")
    got = a.edges(rows, 3).collect()
    assert len(names) == 8 and sorted(r["state"] for r in got) == list(range(8))
    for r in got:
        alive = [k for k in range(8) if not k & r["state"]]
        assert r["before"] == 3 * len(alive) and list(r["removed"]) == [3 * sum(k >> i & 1 for k in alive) for i in range(3)]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_other_filters(spark):
    docs = spark.createDataFrame([(k, "x" * k, "p") for k in range(10)], "doc_id string, text string, source string")
    labels = spark.createDataFrame([("4", 1, 0)], "doc_id string, quality int, toxic int")
    got = a.audit(docs, labels, {"s": F.length("text") < 3, "l": F.length("text") > 6}).collect()
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"], r["shapley"]) for r in got) == [("ls", 1, 7, 3, 6), ("ls", 2, 4, 3, 6), ("sl", 1, 7, 3, 6), ("sl", 2, 4, 3, 6)]
    with pytest.raises(ValueError):
        a.audit(docs, labels, {"ab": F.lit(True)})


def test_edges_of_input(spark):
    docs, labels = tables(spark)
    two = {k: v for k, v in a.conditions().items() if k in "AE"}
    empty = a.audit(docs.limit(0), labels, two)
    assert empty.columns == COLUMNS and empty.count() == 0
    unlabelled = a.audit(docs, labels.limit(0), two).collect()
    assert unlabelled and all(r["good_lost"] == r["toxic_lost"] == 0 for r in unlabelled)
    one = spark.createDataFrame([(None, None, None)] * 2, "doc_id long, text string, source string")
    got = {(r["part"], r["filter_order"][r["step"] - 1], r["removed"]) for r in a.audit(one, labels, two).collect() if r["step"] == 1}
    assert got == {("", "A", 2), ("", "E", 0)}
