import base64
import random
import re
from collections import Counter

import numpy as np
from helpers import clashing, documents, prose, rows
from pyspark.sql import functions as F

from logweave.llm import quality_rules as q
from logweave.llm.common import remainder


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_against_brute_force(spark):
    rng = random.Random(4)
    part = prose(rng, 12)
    more = [(200, f"{part}\n{part}\n\n{part} é{part}", "s"), (201, "a b c d\x0be\x0cf\x85g", "s"), (202, "#*$%&|<> " * 40, "s"), (203, "line\nline\n \nline ", "s"), (204, "日本語 テキスト\n" * 9, "s")]
    df = documents(spark, more=more)
    got = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in q.quality_rules(df).collect()}
    want = set()
    for r in df.collect():
        b = brute(r["text"])
        want.add((r["doc_id"], *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert got == want


def test_bands(spark):
    rng = random.Random(5)
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") + (" " if k % 9 == 0 else "") for k in range(6000))
    half = " ".join(f"w{k % 40}x{k % 37}" for k in range(4000))
    df = spark.createDataFrame([(1, prose(rng, 300)), (2, noise), (3, half), (4, " ".join(["same"] * 400)), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in q.quality_rules(df).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_edge_tables_and_stage(spark):
    df = documents(spark)
    assert q.quality_rules(df.limit(0)).count() == 0
    assert rows(q.quality_rules(clashing(df)), "doc_id", "kept") == rows(q.quality_rules(df), "doc_id", "kept")
    kept = q.stage(spark, clashing(df), "")
    assert kept.columns == clashing(df).columns
    assert rows(kept, "doc_id") == sorted(((r["doc_id"],) for r in q.quality_rules(df).collect() if r["kept"]), key=repr)


def test_clean_documents_of_the_tables_stay(spark):
    d = "/root/testdata/sf0.01"
    got = q.op1_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("quality = 1 AND n_words >= 20")
    assert got.where("NOT kept").count() == 0 and got.count() > 100


def test_half_noise_is_rejected_at_every_length():
    rng, bands = random.Random(6), q.Bands()
    pack = q.zstandard.ZstdCompressor(level=bands.level)
    noise = base64.b64encode(rng.randbytes(3072))
    text = prose(rng, 4000).encode()
    for n in (4096, 4100, 6000, 7997, 8191, 8192, 8397, 10_000, 12_000):
        for mixed in (noise + text[: n - 4096], text[: n - 4096] + noise):
            _, odd = q.ratios(mixed, pack, bands)
            assert odd > bands.chunk_share, n
        assert q.ratios(text[:n], pack, bands)[1] == 0
    assert q.ratios(text[:4095], pack, bands)[1] == 0
    # noise at the end that no full chunk holds
    assert q.ratios(text[:4096] + noise[:4000], pack, bands)[1] > bands.chunk_share


def test_fitted_bands_on_held_out_rows(spark):
    """Limits drawn from labelled rows reject most low-quality rows that pass the base, and hardly any good one."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    bands = q.fitted(docs, labels, remainder("doc_id", 5) != 0)
    held = q.quality_rules(docs, bands).join(labels.where(remainder("doc_id", 5) == 0), "doc_id").where("NOT base_failed")
    got = {r["quality"]: (r["n"], r["kept"]) for r in held.groupBy("quality").agg(F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert got[0][0] > 50 and got[0][1] < 0.5 and got[1][1] > 0.99


def test_verdict_against_plain_code(spark):
    """The query's verdict, from its own bands, by a loop over the texts."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    bands = q.bands_for(spark, docs, d)
    assert bands.curve and bands == q.bands_for(spark, docs.repartition(3), d)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    size = lambda x: len(q.zstandard.ZstdCompressor(level=3).compress(x))
    for r in q.op1_quality_rules(spark, d).collect():
        x = (text[r["doc_id"]] or "").encode()
        n_words, _, _, _, repeat = brute(text[r["doc_id"]])
        kept = n_words >= 20 and 100 * repeat <= 30 * n_words
        if kept:
            at = np.log2(len(x))
            knots = [c for c in bands.curve if abs(c[0] - at) <= 0.5]
            if len(knots) >= 2 and knots[0][0] <= at < knots[-1][0]:
                lo, hi = (np.interp(at, [c[0] for c in knots], [c[k] for c in knots]) for k in (1, 2))
            else:
                lo, hi = [b[1:] for b in bands.whole if len(x) >= b[0]][-1]
            odd = np.zeros(len(x), bool)
            for end in [*range(4096, len(x) + 1, 4096), *([len(x)] if len(x) > 4096 else [])]:
                odd[end - 4096 : end] |= not bands.chunk[0] <= size(x[end - 4096 : end]) / 4096 <= bands.chunk[1]
            kept = lo <= size(x) / len(x) <= hi and odd.mean() <= bands.chunk_share
        assert r["kept"] == kept, r["doc_id"]


def test_bands_without_good_rows_are_the_default(spark):
    df = documents(spark)
    none = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert q.fitted(df, none) == q.Bands() == q.fitted(df.limit(0), none.limit(0))
    wide = q.drawn(np.array([(2000.0, 0.5)] * 30), np.zeros((0, 2)), q.Bands(), q.Fit())
    assert wide == q.Bands()  # fewer rows than a length needs


def test_bands_come_from_every_labelled_row(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    seen = []
    monkeypatch.setattr(q, "drawn", lambda whole, chunks, bands, f: seen.append(whole) or bands)
    q.fitted(docs, labels)
    monkeypatch.setattr(q, "BROADCAST_ROWS", 0)
    q.fitted(docs, labels)
    want = q.quality_rules(docs).where("not base_failed").count()
    assert [w[:, 2].sum() for w in seen] == [want, want]
