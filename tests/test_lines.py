"""The line index against plain reading of the files."""

import json

from logweave.sources import lines


def test_index_marks_and_rows(spark, tmp_path):
    want = {}
    for bucket in ("a", "b"):
        (tmp_path / bucket).mkdir()
        for f in range(3):
            out = []
            for k in range(40 * f + 5):
                row = json.dumps({"b": bucket, "f": f, "k": k, "t": "é" * (k % 50)}, ensure_ascii=False)
                out.append(row)
                want.setdefault(bucket, []).append(row)
                if k % 4 == 0:
                    out += ["", '{"broken', "  "]
            (tmp_path / bucket / f"part-{f}.jsonl").write_text("\n".join(out) + "\n" * (f > 0))
    (tmp_path / "b" / "part-9.jsonl").write_text("")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        path = str(tmp_path)
        index = lines.splits(spark, path).cache()
        assert index.count() > 8
        told = {(r["bucket"], r["file"].rsplit("/", 1)[1]): (r["rows"], r["lines"]) for r in lines.catalog(index).collect()}
        for (bucket, name), (n, all_lines) in told.items():
            text = (tmp_path / bucket / name).read_text().removesuffix("\n").split("\n")
            assert (n, all_lines) == (sum(lines.is_row(x) for x in text), len(text))
        wanted = spark.createDataFrame([(b, o) for b in "abc" for o in (0, 4, 5, 6, 77, 133, 134, 135, 10**6, -1)], "bucket string, ordinal long")
        got = {(r["bucket"], r["ordinal"]): r["value"] for r in lines.rows_at(spark, path, index, wanted).collect()}
        assert got == {(b, o): want[b][o] for b in "ab" for o in (0, 4, 5, 6, 77, 133, 134)}
        marked = lines.marks(spark, path, index, 10).cache()
        assert marked.count() == 28
        for r in marked.collect():
            raw = (tmp_path / r["bucket"] / r["file"].rsplit("/", 1)[1]).read_bytes()
            assert raw[r["byte"] :].split(b"\n")[0].decode() == want[r["bucket"]][r["ordinal"]]
        for b, o in (("a", 0), ("a", 9), ("b", 50), ("b", 134), ("a", 5)):
            assert lines.row_at(spark, index, marked, b, o) == want[b][o]
        assert lines.row_at(spark, index, marked, "a", 135) is None and lines.row_at(spark, index, marked, "z", 0) is None
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
