import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, documents, rows

from logweave.llm import lm_scoring as lm

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(data):
    docs = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]) for d, t in data]
    count = Counter(w for d, x in docs if not held(d) for w in x)
    n, v = sum(count.values()), len(count)
    return [(d, held(d), len(x), sum(count[w] > 0 for w in x), n, sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in x)) for d, x in docs]


@pytest.mark.parametrize("c", [lm.Config(), lm.Config(max_words=50, max_pairs=40)])
def test_base_against_brute_force(spark, c):
    df = documents(spark)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in lm.score(df, c).collect()), key=repr)
    assert got == sorted(((*x[:5], round(x[5], 6)) for x in brute([(r["doc_id"], r["text"]) for r in df.collect()])), key=repr)


def test_edges(spark):
    df = documents(spark)
    assert lm.score(df.limit(0)).count() == 0
    a, b = lm.score(df), lm.score(clashing(df))
    assert [tuple(map(repr, r)) for r in rows(a, "doc_id", "n_tokens", "n_known")] == [tuple(map(repr, r)) for r in rows(b, "doc_id", "n_tokens", "n_known")]
    only = df.where("doc_id in (2, 100)")
    assert lm.score(only).count() == 2


def test_better_than_base_on_held_out_rows(spark):
    got = lm.op7_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_probabilities_after_a_history_add_up_to_one_at_most(spark):
    docs = spark.createDataFrame([(k, "a b c a b d a a b c e f " * 3 + chr(97 + k % 7)) for k in range(30)], "doc_id long, text string")
    model = lm.train(docs, docs["doc_id"] >= 0).model
    known = model.words.known
    n = len(known)
    for before in range(n):
        h = np.stack([np.full(n, known[before]), known], 1).ravel()
        row = np.repeat(np.arange(n), 2)
        at, ok = model.words.find(h)
        p = 10 ** model.score(h, row, at, ok)[1::2]
        assert ok.all() and p.sum() <= 1 + 1e-6


def test_levels_read_back():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    levels = rng.integers(1, 12, 20_000)
    bloom = lm.LogBloom(int(levels.sum()), 14, 5)
    bloom.put(keys, levels)
    got = bloom.levels(keys)
    assert (got >= levels).all() and (got > levels).mean() < 0.01
    assert (bloom.levels(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)) > 0).mean() < 0.01


def test_lookup():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        known = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        table, ask = lm.Lookup(known), np.concatenate([known, rng.integers(0, 1 << 63, 500, dtype=np.uint64)])
        at, ok = table.find(ask)
        assert (ok == np.isin(ask, known)).all() and (known[at[ok]] == ask[ok]).all()


def test_what_is_looked_up_elsewhere_scores_the_same(spark, monkeypatch):
    """The bound of the broadcast's pairs, and the size of the segments that ask, change no score."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    get = lambda c: {r["doc_id"]: r["score"] for r in lm.score(df, c).collect()}
    whole, few = get(lm.Config(bits_per_entry=40)), get(lm.Config(bits_per_entry=40, max_pairs=20))
    assert whole.keys() == few.keys() and all(abs(whole[k] - few[k]) < 1e-4 * abs(whole[k]) for k in whole)
    monkeypatch.setattr(lm, "SEG_ROWS", 3)
    assert all(abs(x - few[k]) < 1e-4 * abs(x) for k, x in get(lm.Config(bits_per_entry=40, max_pairs=20)).items())


def test_the_bound_of_the_vocabulary_changes_no_score(spark):
    """Pairs and histories of words beyond the broadcast count as much as those within."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    get = lambda n: {r["doc_id"]: r["score"] for r in lm.score(df, lm.Config(bits_per_entry=40, max_words=n, all_pairs=True)).collect()}
    whole = get(500_000)
    for n in (0, 60):
        few = get(n)
        assert whole.keys() == few.keys() and all(abs(whole[k] - few[k]) < 1e-4 * abs(whole[k]) for k in whole)


def test_score_against_plain_back_off(spark):
    """Every text's score by dictionaries: quantised counts, discounts, denominators and weights as the module's text says."""
    c = lm.Config(bits_per_entry=60, hashes=8, max_words=40, max_pairs=10)
    df = documents(spark)
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    docs = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]) for d, t in data]
    words = Counter(w for d, x in docs if not held(d) for w in x)
    top = sorted(words.values(), reverse=True)
    least = next(n for n in sorted(set(top)) if sum(k >= n for k in top) <= c.max_words)
    kept = {w for w, n in words.items() if n >= least}
    pairs = Counter((a, b) for d, x in docs if not held(d) for a, b in zip(["<"] + x, x, strict=False) if b in kept and (a == "<" or a in kept))

    def q(n, low):
        level = math.floor(math.log2(max(n, low) / low) * c.steps + 1e-9) + 1
        a, b = low * 2 ** ((level - 1) / c.steps), low * 2 ** (level / c.steps)
        lo, hi = math.ceil(a - 1e-9), math.ceil(b - 1e-9) - 1
        return lo if hi <= lo else math.sqrt(a * b)

    mass = sum(q(n, 1) for n in words.values()) + sum(n == 1 for n in words.values()) + 1
    share = lambda w: (q(words[w], 1) if words[w] else 1) / mass
    seen = {k: max(q(n, c.least_pair) - c.discount, 0.1) for k, n in pairs.items() if n >= c.least_pair}
    weight, den = {}, {}
    for a in {a for a, _ in seen}:
        stored, covered = sum(v for (x, _), v in seen.items() if x == a), sum(share(b) for x, b in seen if x == a)
        total = words[None] if a == "<" else words[a]
        den[a] = 2 ** ((math.ceil(math.log2(max(total, stored / 0.98)) * 4) + 1) / 4)
        weight[a] = 2 ** (-math.ceil(-math.log2(min((1 - stored / den[a]) / max(1 - covered, 1e-9), 1.0)) * 8 - 1e-9) / 8)
    want = Counter()
    for k, (_, x) in enumerate(docs):
        for a, b in zip(["<"] + x, x, strict=False):
            want[k] += math.log10(seen[a, b] / den[a] if (a, b) in seen else weight.get(a, 1.0) * share(b))
    got = sorted(r["score"] for r in lm.score(df, c).collect())
    assert np.allclose(got, sorted(want.values()), rtol=2e-3)


def test_tally_is_small_and_exact():
    import tracemalloc

    rng = np.random.default_rng(5)
    many = rng.integers(0, 2_000_000, 2_400_000).astype(np.uint64)
    tracemalloc.start()
    t, parts, peak = lm.Tally(), [], 0
    for cut in range(0, len(many), 80_000):
        t.add(many[cut : cut + 80_000])
        if t.full:
            lm._split(*t.merged(), 32)
            peak = max(peak, tracemalloc.get_traced_memory()[1])
            parts.append(t.merged())
            t = lm.Tally()
            tracemalloc.stop()  # the parts kept here don't count
            tracemalloc.start()
    tracemalloc.stop()
    parts.append(t.merged())
    assert peak < 54e6, peak  # 61.6e6 with tallies twice as large that were sorted again
    k, n = lm.summed(*map(np.concatenate, zip(*parts, strict=True)))
    want = np.unique(many, return_counts=True)
    assert np.array_equal(k, want[0]) and np.array_equal(n, want[1])
