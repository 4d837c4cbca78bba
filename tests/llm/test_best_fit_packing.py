import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, documents, rows
from tokenizers import Tokenizer

from logweave.llm import best_fit_packing as p

PLACES = ("doc_id", "piece", "start", "length", "ids_crc32")


def fewest(items, capacity):
    """Bins of a best packing, by search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for room in {r for r in bins if r >= items[k]}:
            i = bins.index(room)
            bins[i] -= items[k]
            go(k + 1, bins)
            bins[i] += items[k]
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best[0]


def unpacked(bins):
    return sum((Counter({s: k * n for s, k in filled}) for filled, n in bins), Counter())


def instances(n):
    rng = random.Random(3)
    for _ in range(n):
        capacity = rng.choice([10, 15, 20, 30])
        least = rng.choice([1, 2, 3, capacity // 4])
        yield [rng.randint(least, capacity) for _ in range(rng.randint(1, 9))], capacity


def test_fixed_bins_are_in_some_best_packing():
    reduces = 0
    for items, capacity in instances(1500):
        fixed, rest = p.reduced(Counter(items), capacity)
        left = [s for s, k in rest.items() for _ in range(k)]
        assert unpacked(fixed) + Counter(left) == Counter(items)
        assert all(sum(s * k for s, k in filled) <= capacity for filled, _ in fixed)
        assert sum(n for _, n in fixed) + fewest(left, capacity) == fewest(items, capacity)
        reduces += 0 < len(left) < len(items) or not left
    assert reduces > 1000


def test_some_instances_stay_whole():
    fixed, rest = p.reduced({6: 1, 5: 2, 4: 3, 3: 5, 2: 2}, 20)
    assert fixed == [] and sum(rest.values()) == 13


def test_bulk_best_fit_is_best_fit():
    for items, capacity in instances(1500):
        bins = p.best_fit(Counter(items), capacity)
        assert unpacked(bins) == Counter(items)
        open_ = []
        for s in sorted(items, reverse=True):
            fits = [(r, k) for k, r in enumerate(open_) if r >= s]
            if fits:
                open_[min(fits)[1]] -= s
            else:
                open_.append(capacity - s)
        assert sorted(open_) == sorted(capacity - sum(s * k for s, k in filled) for filled, n in bins for _ in range(n))


def test_plan_stays_small_for_any_number_of_documents():
    rng = random.Random(4)
    count = {s: rng.randint(1, 10**9) for s in range(1, 1025)}
    plan = p.planned(count, 1024)
    assert unpacked(plan) == Counter(count)
    assert len(plan) < 4 * 1024 and len(p.runs(plan)) < 20_000
    tiny = p.planned({1: 10**10, 1000: 10**9}, 1024)
    assert sum(n for _, n in tiny) == 10**9 and unpacked(tiny)[1] == 10**10


def test_fast_encoder_agrees_with_the_tokenizer():
    c = p.Config()
    exact = Tokenizer.from_file(public_tokenizers.path(c.tokenizer))
    encode = p.encoder(c)
    safe = [chr(k) for k in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x180))]
    texts = [t for x in safe for t in (f"a{x}b", f" {x}", f"{x} {x}x 1{x}", f"{x}{x}  {x}a", f"1{x}2 '{x}s")]
    texts += ["", "<|endoftext|>", "a <|endoftext|> b", " " * 200_000 + "x", "\n" * 5000, "ƀ ა 漢字    🙂", "x" * 50_000, "don't  we'll\t\n ok", "\x1c\x1d \x85"]
    for text in texts:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids, text[:20]


def checked(got, capacity):
    """Places of a packing: gapless from 0 in every sequence, none longer than the capacity."""
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 100, 1024])
def test_pack_against_brute_force(spark, capacity):
    df = clashing(documents(spark))
    c = p.Config(capacity=capacity, run_rows=7)
    got = p.pack(df, c).collect()
    exact = Tokenizer.from_file(public_tokenizers.path(c.tokenizer))
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = exact.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        head = (len(ids) - 1) % capacity + 1
        start = 0
        for n in range(1 + (len(ids) - head) // capacity):
            end = head + n * capacity
            want.append((r["doc_id"], n, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
        assert start == len(ids)
    assert sorted([tuple(r[x] for x in PLACES) for r in got], key=repr) == sorted(want, key=repr)
    lengths = Counter(w[3] for w in want)
    used = checked(got, capacity)
    assert used == sum(n for _, n in p.planned(lengths, capacity))
    assert -(-sum(w[3] for w in want) // capacity) <= used <= 1.1 * sum(w[3] for w in want) / capacity + 2


def test_sequences_hold_the_documents(spark):
    c = p.Config(capacity=64, with_ids=True)
    df = documents(spark)
    packed = p.pack(df, c)
    full = {r["sequence_id"]: r["ids"] for r in p.sequences(packed).collect()}
    found = defaultdict(dict)
    for r in packed.collect():
        assert full[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
        if r["doc_id"] in (0, 105):
            found[r["doc_id"]][r["start"]] = r["ids"]
    exact = Tokenizer.from_file(public_tokenizers.path(c.tokenizer))
    texts = {r["doc_id"]: r["text"] for r in df.where("doc_id IN (0, 105)").collect()}
    for k, parts in found.items():
        assert exact.decode([i for s in sorted(parts) for i in parts[s]][:-1]) == texts[k]


def test_copies_are_spread_and_all_placed(spark):
    """One text in most rows, and rows that are the same in every column."""
    df = spark.range(20_000).selectExpr("id % 100 * 0 AS doc_id", "if(id % 3 = 0, 'same text here', concat('t ', id)) AS text").repartition(5)
    got = p.pack(df, p.Config(capacity=50, run_rows=500)).collect()
    assert len(got) == 20_000
    checked(got, 50)


def test_edges(spark):
    empty = p.pack(documents(spark).limit(0))
    assert empty.count() == 0 and empty.columns == [*PLACES, "sequence_id", "offset"]
    one = p.pack(spark.createDataFrame([(None, None)], "doc_id string, text string")).collect()
    assert [tuple(r) for r in one] == [(None, 0, 0, 1, zlib.crc32(b"\x02\0\0\0"), 0, 0)]
    exact = spark.createDataFrame([(1, " a" * 1023), (2, " a" * 1024), (3, " a" * 2047)], "doc_id int, text string")
    assert rows(p.pack(exact), "doc_id", "piece", "start", "length") == [(1, 0, 0, 1024), (2, 0, 0, 1), (2, 1, 1, 1024), (3, 0, 0, 1024), (3, 1, 1024, 1024)]
