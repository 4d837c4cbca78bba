import random
from collections import Counter, defaultdict
from fractions import Fraction

from helpers import clashing, documents, rows

from logweave.llm import mixing as m


def test_pattern_meets_all_windows():
    rng = random.Random(2)
    for _ in range(60):
        weights = {f"s{k}": rng.random() ** 3 + 0.001 for k in range(rng.randint(1, 12))}
        share = m.shares(weights, 200)
        total = sum(share.values())
        slots = m.pattern(share, total)
        assert sorted(x for v in slots.values() for x in v) == list(range(total))
        for s, v in slots.items():
            for j, slot in enumerate(v):
                release, deadline = m.window(j, share[s], total)
                assert release <= slot < deadline
            given = 0
            for t in range(1, total + 1):
                given += t - 1 in v
                assert abs(given - Fraction(share[s] * t, total)) < 1


def test_shares_add_up():
    assert m.shares({"a": 1, "b": 1, "c": 1}, 100) == {"a": 34, "b": 33, "c": 33}
    assert sum(m.shares({k: 1e-9 if k else 1.0 for k in range(50)}, 60).values()) == 60


def test_mix_is_whole_and_on_target(spark):
    rows_ = [(k, f"t{k}", "big" if k % 3 else ("small" if k % 2 else None)) for k in range(3000)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string")
    weights = {"big": 0.5, "small": 0.3, None: 0.2}
    c = m.Config(block_docs=4, period=100, bucket_rows=100)
    got = m.mix(df, weights, c).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    assert len({r["position"] for r in got}) == 3000
    blocks = defaultdict(set)
    for r in got:
        blocks[r["slot"]].add((r["source"], r["block"]))
    assert sorted(blocks) == list(range(len(blocks))) and all(len(x) == 1 for x in blocks.values())
    sizes = Counter((r["source"], r["block"]) for r in got)
    assert all(n == 4 for (s, b), n in sizes.items() if b < max(y for x, y in sizes if x == s))
    given, order = Counter(), [next(iter(blocks[k]))[0] for k in range(len(blocks))]
    first = {r["slot"] for r in got if r["phase"] == 0}
    for t, s in enumerate(order[: len(first)], 1):
        given[s] += 1
        assert all(abs(given[x] - w * t) < 1 for x, w in weights.items())


def test_same_for_any_partitioning(spark):
    df = documents(spark)
    a, b = m.mix(df), m.mix(df.repartition(7))
    assert rows(a, "source", "position") == rows(b, "source", "position")


def test_edges(spark):
    df = documents(spark)
    assert m.mix(df.limit(0)).count() == 0
    out = m.mix(clashing(df))
    assert out.columns[: len(clashing(df).columns)] == clashing(df).columns and {"slot_", "position_", "phase_", "block_"} <= set(out.columns)
    assert out.count() == df.count()
    assert m.mix(df, {"src0": 1.0, "unknown": 5.0}).count() == df.count()


def fluid_targets(blocks, weights, ends):
    """Targets of a mix that serves all sources with blocks left at once, at each whole slot, by stepping from phase to phase."""
    given, t, out = [Fraction(0)] * len(blocks), Fraction(0), []
    while t < sum(blocks):
        left = [s for s in range(len(blocks)) if given[s] < blocks[s]]
        total = sum(weights[s] for s in left)
        step = min((blocks[s] - given[s]) * total / Fraction(weights[s]) for s in left)
        while len(out) < ends and len(out) <= t + step:
            out.append([g + (len(out) - t) * Fraction(weights[s]) / total if s in left else g for s, g in enumerate(given)])
        given = [g + step * Fraction(weights[s]) / total if s in left else g for s, g in enumerate(given)]
        t += step
    return out


def test_unrounded_weights_over_many_periods():
    # a third of the rows in one source and 19 equal ones, weights by square root: shares of 139.58 and 45.29 of 1000
    blocks = [9_000, *[947] * 19]
    weights = m.whole_weights([n**0.5 for n in blocks])
    targets = fluid_targets(blocks, weights, sum(blocks) + 1)
    given = [0] * len(blocks)
    for s, j, _, slot, release, deadline in m.places(blocks, weights):
        assert j == given[s] and release <= slot < deadline
        given[s] += 1
        if slot % 7 == 0 or slot > 17_000:
            assert all(abs(g - x) < 1 for g, x in zip(given, targets[slot + 1], strict=True))
    assert given == blocks


def test_every_phase_is_on_target():
    rng = random.Random(3)
    for _ in range(40):
        blocks = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        weights = m.whole_weights([rng.random() ** 6 + 1e-6 for _ in blocks])
        targets, given = fluid_targets(blocks, weights, sum(blocks) + 1), [0] * len(blocks)
        for k, (s, _, phase, slot, release, deadline) in enumerate(m.places(blocks, weights)):
            assert slot == k and release <= slot < deadline
            given[s] += 1
            assert all(abs(g - x) < 1 for g, x in zip(given, targets[k + 1], strict=True))
        assert given == blocks


def test_mix_keeps_windows_of_default_weights(spark):
    df = spark.createDataFrame([(k, f"t{k}", f"s{min(k % 31, 6)}") for k in range(6000)], "doc_id long, text string, source string")
    got = m.mix(df, c=m.Config(block_docs=1, bucket_rows=500)).collect()
    assert sorted(r["slot"] for r in got) == list(range(6000)) and all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    n = Counter(r["source"] for r in got)
    total, first = sum(x**0.5 for x in n.values()), {r["slot"]: r["source"] for r in got if r["phase"] == 0}
    given = Counter()
    for t in range(len(first)):
        given[first[t]] += 1
        assert all(abs(given[s] - x**0.5 / total * (t + 1)) < 1 for s, x in n.items())
    assert len(first) > 1000


def test_many_sources(spark):
    df = spark.createDataFrame([(k, f"t{k}", f"host{k % 1500}" if k % 3 else "big") for k in range(9000)], "doc_id long, text string, source string")
    got = m.mix(df, c=m.Config(block_docs=2, bucket_rows=1000)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(9000)) and len({r["source"] for r in got}) == 1001
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)


def test_null_and_repeated_ids_are_spread(spark):
    """A hot source without ids is numbered in many buckets, whole."""
    df = spark.createDataFrame([(None, f"text {k}", "a") for k in range(4000)] + [(7, "same", "b")] * 50, "doc_id long, text string, source string")
    c = m.Config(bucket_rows=100)
    got = m.mix(df, c=c)
    assert got.count() == 4050 and got.select("position").distinct().count() == 4050
    sizes = df.where("doc_id is null").selectExpr("pmod(xxhash64(doc_id, xxhash64(text), 7), 41) AS b").groupBy("b").count().collect()
    assert len(sizes) > 30 and max(r["count"] for r in sizes) < 200
