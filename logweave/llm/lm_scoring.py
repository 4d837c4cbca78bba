r"""Language-model scoring with a log-frequency Bloom filter.

Tokens are words ``[^\x20\x09-\x0D]+`` with A-Z lower-cased, and one end per text. Words and word
pairs of the training texts are counted with shuffles. A count is stored as a level on a
logarithmic scale: the n-gram is put into the Bloom filter once for every level up to its own, and
read back by probing level after level until the first miss. The filter goes to all workers.

The model backs off: a pair seen ``least_pair`` times or more has its discounted, quantised count over
its history's denominator; any other has the history's back-off weight times the word's quantised
share. Unseen words share what as many words seen once would have. Denominators and back-off weights
are stored in the filter as well, rounded so that the probabilities after a history don't add up to
more than one (but for the filter's false hits, about one probe in a thousand).

The model grows with the corpus, the broadcast doesn't: the filter holds the ``max_words`` and
``max_pairs`` most frequent n-grams at most (thresholds from histograms of all counts). The levels of
all others stay in hash buckets of a table in the shared folder: a slice of texts sends each bucket the
distinct n-grams that the filter doesn't hold, with the rows they are in, and gets back sums for each
row. So ``max_pairs`` decides only where a pair is looked up; every word's count and every pair's that
the smoothing uses reach the score at any size. Pairs with a word beyond the vocabulary (``max_words``, the
most frequent) are counted and joined with their words' counts as rows; what each of them, and each such history,
adds to a score stays in the same buckets. So ``max_words`` decides only that, too (``all_pairs``). ``base_score`` uses exact counts.

Null texts are empty: one end, so n_tokens is 1. Rows are told apart, so repeated rows repeat their
result (and count twice in training). Null ids count as empty text for the remainder. With no
training rows N and V are 0. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import textbytes as tb
from logweave.llm.common import read, remainder, removed, written

_U = np.uint64
END, BEGIN = _U(0x656E64), _U(0x626567696E)
#: Salts of what the filter holds: words, pairs, denominators, back-off weights.
WORD, PAIR, DENOMINATOR, BACKOFF = map(_U, (11, 22, 33, 44))
LOW32 = _U(0xFFFFFFFF)


@dataclass(frozen=True)
class Config:
    #: The vocabulary: the most frequent words; the broadcast's bound. The others, and their pairs, are looked up by a shuffle.
    max_words: int = 500_000
    #: Pairs in the broadcast filter, at most; the others are looked up by a shuffle.
    max_pairs: int = 1_000_000
    #: Whether words beyond the vocabulary have pairs too, as in op7; else they only have shares of their own.
    all_pairs: bool = False
    #: Count from which a pair has a probability of its own.
    least_pair: int = 2
    #: Levels to a doubling of the count.
    steps: int = 2
    bits_per_entry: int = 14
    hashes: int = 5
    discount: float = 0.6
    #: Share of training rows: all but those with remainder ``held`` of ``folds``.
    folds: int = 7
    held: int = 2


def tokens(s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token of a slice, each row's end included."""
    low = tb.Slice(s.first, s.rows, tb.LOWER[s.data], s.offs)
    w = tb.words(low)
    ends = np.searchsorted(w.row, np.arange(s.rows), "right") + np.arange(s.rows)
    h = np.full(len(w) + s.rows, END, np.uint64)
    inner = np.ones(len(h), bool)
    inner[ends] = False
    h[inner] = tb.hashes(low.data, w)
    row = np.empty(len(h), np.int64)
    row[inner], row[ends] = w.row, np.arange(s.rows)
    return h, row


class Tally:
    """Distinct 64-bit keys and their counts, merged whenever many are waiting; ``full`` once the merged ones are many."""

    def __init__(self, limit: int = 250_000) -> None:
        self.keys, self.counts, self.waiting, self.limit, self.full = [], [], 0, limit, False

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.waiting += len(k)
        if self.waiting > 2 * self.limit:
            self.waiting = len(self.merged()[0])
            self.full = self.waiting > self.limit

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            self.keys, self.counts = [], []  # the parts go before the sort takes its memory
            keys, counts = summed(keys, counts)
            self.keys, self.counts = [keys], [counts]
        return self.keys[0], self.counts[0]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Hash bucket of each key, in two bytes where they do: those sort fast."""
    return (tb.mix(keys) % _U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def _split(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: its keys and counts as bytes."""
    at = bucket_of(keys, buckets)
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(buckets + 1))
    keys, counts = keys[order], counts[order].astype(np.uint32)
    some = [b for b in range(buckets) if ends[b] < ends[b + 1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(some, pa.int32()),
            pa.array([keys[ends[b] : ends[b + 1]].tobytes() for b in some], pa.binary()),
            pa.array([counts[ends[b] : ends[b + 1]].tobytes() for b in some], pa.binary()),
        ],
        ["bucket", "keys", "counts"],
    )


def counted(docs: DataFrame, keys_of, buckets: int, name: str, least: int = 1) -> DataFrame:
    """bucket, keys, counts (as bytes; int64), n, total, level, types: counts of ``keys_of(slice)`` over all texts, a row for each hash bucket.

    Keys and counts are of keys that occur ``least`` times or more; the totals and the histogram are of all.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tally()
        for batch in batches:
            for s in tb.slices(batch.column(0)):
                t.add(keys_of(s))
                if t.full:
                    yield _split(*t.merged(), buckets)
                    t = Tally()
        yield _split(*t.merged(), buckets)

    def total(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["counts"]]).astype(np.int64)
        keys, counts = summed(keys, counts)
        level, n = np.unique(counts, return_counts=True)
        some = counts >= least
        return pa.table({"bucket": table["bucket"][:1], "keys": [keys[some].tobytes()], "counts": [counts[some].tobytes()], "n": [len(keys)], "total": [int(counts.sum())], "level": [level.tolist()], "types": [n.tolist()]})

    parts = docs.select("text").mapInArrow(tally, "bucket int, keys binary, counts binary")
    return written(parts.groupBy("bucket").applyInArrow(total, "bucket int, keys binary, counts binary, n long, total long, level array<long>, types array<long>"), name)


def threshold(counts: DataFrame, most: int) -> tuple[int, dict]:
    """The least count of which at most ``most`` keys have as much; and the table's totals, with the number of keys (types) for each count."""
    at = counts.select(F.explode(F.arrays_zip("level", "types")).alias("x")).select(F.least("x.level", F.lit(100_000)).alias("level"), "x.types")
    rows = at.groupBy("level").agg(F.sum("types").alias("types")).collect()  # at most 100,000 levels
    by = {r["level"]: r["types"] for r in rows}
    kept, least = 0, (max(by) + 1 if by else 1)
    for level in sorted(by, reverse=True):
        if kept + by[level] > most:
            break
        kept, least = kept + by[level], level
    total = counts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return least, {"types": total["n"] or 0, "tokens": total["total"] or 0, "once": by.get(1, 0), "by": by}


def frequent(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys with ``least`` or more, in order, and their counts: gathered in the driver, bounded by the threshold."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0), b.column(1), strict=True):
                key, count = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([key[count >= least].tobytes()]), pa.array([count[count >= least].tobytes()])], ["keys", "counts"])

    rows = counts.select("keys", "counts").mapInArrow(cut, "keys binary, counts binary").collect()
    keys = np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
    n = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    order = np.argsort(keys)
    return keys[order], n[order]


class LogBloom:
    """A Bloom filter of (key, level) entries: the level of a key is the number of levels that it holds in a row."""

    def __init__(self, entries: int, bits_per_entry: int, hashes: int) -> None:
        self.mask = _U((1 << max(10, math.ceil(math.log2(max(entries, 1) * bits_per_entry)))) - 1)
        self.hashes = hashes
        self.bits = np.zeros((int(self.mask) + 1) // 8, np.uint8)

    def _at(self, keys: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            one = tb.mix(keys + (np.asarray(level).astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
            return one, tb.mix(one) | _U(1)

    def put(self, keys: np.ndarray, levels: np.ndarray) -> None:
        """Enters each key once for every level from 1 to its own."""
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = keys[levels >= level]
            for cut in range(0, len(some), 200_000):
                one, two = self._at(some[cut : cut + 200_000], level)
                with np.errstate(over="ignore"):
                    for k in range(self.hashes):
                        at = (one + _U(k) * two) & self.mask
                        np.bitwise_or.at(self.bits, (at >> _U(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & _U(7)).astype(np.uint8)))

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        one, two = self._at(keys, level)
        live = np.arange(len(keys))
        with np.errstate(over="ignore"):
            for k in range(self.hashes):
                at = (one[live] + _U(k) * two[live]) & self.mask
                live = live[(self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0]
        out = np.zeros(len(keys), bool)
        out[live] = True
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probes level after level, each key until its first miss."""
        out, live, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        while len(live):
            live = live[self.has(keys[live], level)]
            out[live] = level
            level += 1
        return out


class Lookup:
    """Places of 64-bit hashes in a sorted array of them, by their leading bits: the hashes are uniform, so a few steps do."""

    def __init__(self, known: np.ndarray) -> None:
        self.names = np.append(known, BEGIN)
        self.shift = _U(64 - max(1, len(known).bit_length()))
        self.start = np.searchsorted(known, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift).astype(np.int32)

    @property
    def known(self) -> np.ndarray:
        return self.names[:-1]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash (0 if absent), and whether it is there."""
        at, ok = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        n = len(self.known)
        if not n:
            return at, ok
        live = np.arange(len(h))
        place = self.start[(h >> self.shift).astype(np.int64)]
        while len(live):
            inside = place < n
            live, place = live[inside], place[inside]
            there, want = self.known[place], h[live]
            hit = there == want
            at[live[hit]], ok[live[hit]] = place[hit], True
            go = there < want
            live, place = live[go], place[go] + 1
        return at, ok


@dataclass
class Model:
    """What workers score with: the filter, and the hashes of the vocabulary, which number the memo of words already probed."""

    bloom: LogBloom
    c: Config
    #: Quantised counts of all words and what is left for unseen ones.
    mass: float
    words: Lookup
    _memo: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": None}

    def level(self, count: np.ndarray, least: float) -> np.ndarray:
        return np.floor(np.log2(np.maximum(count, least) / least) * self.c.steps + 1e-9).astype(np.int64) + 1

    def value(self, level: np.ndarray, least: float) -> np.ndarray:
        """Geometric middle of a level; for single counts the count itself."""
        low, high = least * 2.0 ** ((level - 1) / self.c.steps), least * 2.0 ** (level / self.c.steps)
        lo, hi = np.ceil(low - 1e-9), np.ceil(high - 1e-9) - 1
        return np.where(hi <= lo, lo, np.sqrt(low * high))

    def denominator(self, level: np.ndarray) -> np.ndarray:
        return 2.0 ** (level / 4.0)

    def share(self, count: np.ndarray) -> np.ndarray:
        """Probability of words by their count alone; a word that isn't seen has what is left for one."""
        return np.where(count > 0, self.value(self.level(count, 1), 1), 1.0) / self.mass

    def top(self, level: np.ndarray) -> np.ndarray:
        """Discounted count of pairs."""
        return np.maximum(self.value(level, self.c.least_pair) - self.c.discount, 0.1)

    def word(self, h: np.ndarray) -> np.ndarray:
        """Probability of words that the filter holds."""
        v = self.bloom.levels(tb.mix(h ^ WORD))
        return np.where(v > 0, self.value(np.maximum(v, 1), 1), 1.0) / self.mass

    def history(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Back-off weight and denominator (0: no pair is stored) after a word."""
        den = self.bloom.levels(tb.mix(h ^ DENOMINATOR))
        return 2.0 ** (-(self.bloom.levels(tb.mix(h ^ BACKOFF)) / 8.0)), np.where(den > 0, self.denominator(den), 0.0)

    def known(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Memo of share, weight and denominator by number, with all of ``at`` probed; the last number is the begin."""
        n = len(self.words.known) + 1
        if self._memo is None:
            self._memo = np.full(n, np.nan, np.float32), np.ones(n, np.float32), np.zeros(n, np.float32)
        share, weight, den = self._memo
        new = np.flatnonzero(np.bincount(at[np.isnan(share[at])], minlength=n)) if np.isnan(share[at]).any() else at[:0]
        if len(new):
            h = self.words.names[new]
            share[new] = self.word(h)
            weight[new], den[new] = self.history(h)
        return self._memo

    def look(self, h: np.ndarray, row: np.ndarray, at: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each token after the one before by what the filter holds; the pairs that it may not hold, and their tokens.

        ``at`` and ``ok`` place a token among the words of the vocabulary; a pair is two such places.
        """
        n = len(self.words.known)
        first = np.append(True, row[1:] != row[:-1])[: len(h)]
        before, known_before = np.empty_like(at), np.empty_like(ok)
        before[1:], known_before[1:] = at[:-1], ok[:-1]
        before[first], known_before[first] = n, True
        share, weight, den = self.known(np.append(at[ok], n))
        out = np.full(len(h), 1.0 / self.mass)
        out[ok] = share[at[ok]]
        out[known_before] *= weight[before[known_before]]
        both = np.flatnonzero(known_before & ok)
        both = both[den[before[both]] > 0]
        pairs = (before[both].astype(np.uint64) << _U(32)) | at[both].astype(np.uint64)
        if len(both):
            key, again = np.unique(pairs, return_inverse=True)
            v = self.bloom.levels(tb.mix(pair_key(self.words.names[(key >> _U(32)).astype(np.int64)], self.words.names[(key & LOW32).astype(np.int64)]) ^ PAIR))[again]
            held = both[v > 0]
            out[held] = self.top(v[v > 0]) / den[before[held]]
            both, pairs = both[v == 0], pairs[v == 0]
        return np.log10(out), pairs, both

    def score(self, h: np.ndarray, row: np.ndarray, at: np.ndarray, ok: np.ndarray) -> np.ndarray:
        return self.look(h, row, at, ok)[0]

    def weights(self, history: np.ndarray, stored: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Levels of the denominator and of the back-off weight of histories that occur ``history`` times."""
        den = np.ceil(np.log2(np.maximum(history, stored / 0.98)) * 4).astype(np.int64) + 1
        backoff = np.minimum((1 - stored / self.denominator(den)) / np.maximum(1 - covered, 1e-9), 1.0)
        return den, np.ceil(-np.log2(backoff) * 8 - 1e-9).astype(np.int64)

    def gain(self, pairs: np.ndarray, count: np.ndarray) -> np.ndarray:
        """What a pair's count adds to the log10 probability that ``look`` gave it without."""
        left, right = (pairs >> _U(32)).astype(np.int64), (pairs & LOW32).astype(np.int64)
        share, weight, den = self.known(np.concatenate([left, right]))
        return np.log10(self.top(self.level(count, self.c.least_pair)) / den[left]) - np.log10(share[right].astype(float) * weight[left])


def pair_key(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tb.mix(tb.mix(before) * _U(0x9E3779B97F4A7C15) + h)


def buckets_for(docs: DataFrame) -> int:
    """Several buckets for each input partition, so that one holds less than a partition's distinct keys."""
    return max(16, 4 * docs.rdd.getNumPartitions())


def histories(pairs: DataFrame, model: Model, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the vocabulary and the begin: the discounted counts of all its pairs, and the share of the words that follow in them."""
    shared = pairs.sparkSession.sparkContext.broadcast((model, share))  # max_words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, share = shared.value
        for b in batches:
            for k, c in zip(b.column(0), b.column(1), strict=True):
                key, count = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                if len(key):
                    left = (key >> _U(32)).astype(np.int64)  # in order, as the keys are
                    first = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
                    # whole numbers, so that sums don't depend on their order
                    top = np.round(m.top(m.level(count, m.c.least_pair)) * 1024).astype(np.int64)
                    follow = np.ceil(share[(key & LOW32).astype(np.int64)] * 2.0**40).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(left[first]), pa.array(np.add.reduceat(top, first)), pa.array(np.add.reduceat(follow, first))], ["left", "top", "follow"])

    sums = pairs.select("keys", "counts").mapInArrow(run, "left long, top long, follow long").groupBy("left").agg(F.sum("top").alias("top"), F.sum("follow").alias("follow")).toArrow()
    stored, covered = np.zeros(len(share) + 1), np.zeros(len(share) + 1)
    left = sums["left"].to_numpy()
    stored[left], covered[left] = sums["top"].to_numpy() / 1024, sums["follow"].to_numpy() / 2.0**40
    shared.unpersist()
    return stored, covered


def build(model: Model, counts: np.ndarray, starts: int, pairs: tuple[np.ndarray, np.ndarray], stored: np.ndarray, covered: np.ndarray) -> Model:
    """``model`` with its filter: the vocabulary's counts, the pairs to hold (two places, 32 bits each, and count), and the histories' denominators and weights."""
    c, keys = model.c, model.words.known
    word_level = model.level(counts, 1)
    left, right = (pairs[0] >> _U(32)).astype(np.int64), (pairs[0] & LOW32).astype(np.int64)
    pair_level = model.level(pairs[1], c.least_pair)
    history = np.append(counts, starts).astype(float)
    has = np.flatnonzero(stored > 0)
    den_level, back_level = model.weights(history[has], stored[has], covered[has])
    names = model.words.names
    model.bloom = LogBloom(int(word_level.sum() + pair_level.sum() + den_level.sum() + back_level.sum()), c.bits_per_entry, c.hashes)
    model.bloom.put(tb.mix(keys ^ WORD), word_level)
    model.bloom.put(tb.mix(pair_key(names[left], names[right]) ^ PAIR), pair_level)
    model.bloom.put(tb.mix(names[has] ^ DENOMINATOR), den_level)
    model.bloom.put(tb.mix(names[has] ^ BACKOFF), back_level)
    return model


def rare_pairs(docs: DataFrame, vocabulary, least: int) -> DataFrame:
    """left, right (hashes), n: pairs that occur ``least`` times or more and have a word beyond the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tb.slices(batch.column(0)):
                h, row = tokens(s)
                before, some = preceding(h, row), ~vocabulary.value.find(h)[1]
                some[1:] |= some[:-1] & (row[1:] == row[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(before[some].view(np.int64)), pa.array(h[some].view(np.int64))], ["left", "right"])

    pairs = docs.select("text").mapInArrow(run, "left long, right long").groupBy("left", "right").agg(F.count("*").alias("n"))
    return written(pairs.where(F.col("n") >= least), "lm-rare-pairs")


def preceding(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of the token before each, or the begin."""
    before = np.full(len(h), BEGIN, np.uint64)
    if len(h):
        before[1:] = np.where(row[1:] == row[:-1], h[:-1], BEGIN)
    return before


def rare_sums(rare: DataFrame, counts: DataFrame, shared) -> tuple[DataFrame, DataFrame]:
    """``rare`` with the right word's count (times); and for each left word what :func:`histories` sums, over these pairs: left, place in the vocabulary or null, top, follow."""

    least = shared.value.c.least_pair

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0), b.column(1), strict=True):
                key, count = np.frombuffer(k.as_py(), np.int64), np.frombuffer(c.as_py(), np.int64)
                some = count >= least
                yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(count[some])], ["right", "times"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            left = b.column(0).to_numpy()
            at, ok = placed(m, left.view(np.uint64))
            top = np.round(m.top(m.level(b.column(1).to_numpy(), m.c.least_pair)) * 1024).astype(np.int64)
            follow = np.ceil(m.share(b.column(2).to_numpy()) * 2.0**40).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.int64(), mask=~ok), pa.array(top), pa.array(follow)], ["left", "place", "top", "follow"])

    every = counts.select("keys", "counts").mapInArrow(words, "right long, times long")
    rare = written(rare.join(every, "right").select("left", "right", "n", "times"), "lm-rare-pairs")
    sums = rare.select("left", "n", "times").mapInArrow(parts, "left long, place long, top long, follow long").groupBy("left", "place").agg(F.sum("top").alias("top"), F.sum("follow").alias("follow"))
    return rare, written(sums.join(every.withColumnRenamed("right", "left"), "left", "left"), "lm-rare-histories")


def placed(m: Model, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of words in the vocabulary, the begin's included."""
    at, ok = m.words.find(h)
    at[h == BEGIN], ok[h == BEGIN] = len(m.words.known), True
    return at, ok


def gains(rare: DataFrame, sums: DataFrame, shared, buckets: int) -> DataFrame:
    """bucket, keys, counts (float64 as bytes): what histories beyond the vocabulary, and pairs with a word beyond it, add to a log10 probability."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            den, back = m.weights(*(b.column(k).to_numpy().astype(float) / unit for k, unit in ((1, 1), (2, 1024), (3, 2.0**40))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.log10(m.denominator(den))), pa.array(back / -8.0 * math.log10(2))], ["left", "den", "weight"])

    def adds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            left, right = (b.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            den, weight = (b.column(k).to_numpy(zero_copy_only=False).copy() for k in (4, 5))
            at, ok = placed(m, left)
            if ok.any():
                w, d = m.history(left[ok])
                den[ok], weight[ok] = np.log10(np.maximum(d, 1e-300)), np.log10(w)
            gain = np.log10(m.top(m.level(b.column(2).to_numpy(), m.c.least_pair))) - den - np.log10(m.share(b.column(3).to_numpy())) - weight
            yield binned(pair_key(left, right), gain)

    def backs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield binned(tb.mix(b.column(0).to_numpy().view(np.uint64) ^ BACKOFF), b.column(1).to_numpy())

    def binned(key: np.ndarray, gain: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket_of(key, buckets).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(gain)], ["bucket", "key", "gain"])

    def packed(table: pa.Table) -> pa.Table:
        key, gain = table["key"].to_numpy().view(np.uint64), table["gain"].to_numpy()
        order = np.argsort(key)
        return pa.table({"bucket": table["bucket"][:1], "keys": [key[order].tobytes()], "counts": [gain[order].tobytes()]})

    beyond = written(sums.where("place IS NULL").select("left", "times", "top", "follow").mapInArrow(weighed, "left long, den double, weight double"), "lm-rare-histories")
    row = "bucket int, key long, gain double"
    pairs = rare.join(beyond, "left", "left").select("left", "right", "n", "times", "den", "weight").mapInArrow(adds, row)
    every = pairs.union(beyond.select("left", "weight").mapInArrow(backs, row))
    return written(every.groupBy("bucket").applyInArrow(packed, "bucket int, keys binary, counts binary"), "lm-gains")


@dataclass
class Trained:
    model: Model
    #: Exact counts of the vocabulary, in the order of its hashes.
    exact: np.ndarray
    #: Counts of all words, and of all pairs that have a probability of their own: a row for each of ``buckets``.
    words: DataFrame
    pairs: DataFrame
    #: What pairs and histories beyond the vocabulary add, in the same buckets.
    gains: DataFrame
    buckets: int
    totals: dict


def train(docs: DataFrame, training: Column, c: Config = Config()) -> Trained:
    d = docs.where(training).select("text")
    buckets = buckets_for(d)
    counts = counted(d, lambda s: tokens(s)[0], buckets, "lm-words")
    least, totals = threshold(counts, c.max_words)
    keys, exact = frequent(counts, least)
    vocabulary = d.sparkSession.sparkContext.broadcast(Lookup(keys))  # max_words at most

    def pairs_of(s: tb.Slice) -> np.ndarray:
        h, row = tokens(s)
        at, ok = vocabulary.value.find(h)
        first = np.append(True, row[1:] != row[:-1])[: len(h)]
        before, fine = np.empty_like(at), np.empty_like(ok)
        before[1:], fine[1:] = at[:-1], ok[:-1]
        before[first], fine[first] = len(vocabulary.value.known), True
        good = ok & fine
        return (before[good].astype(np.uint64) << _U(32)) | at[good].astype(np.uint64)

    pair_counts = counted(d, pairs_of, buckets, "lm-pairs", c.least_pair)
    rare = rare_pairs(d, vocabulary, c.least_pair) if c.all_pairs else None
    vocabulary.unpersist()
    model = Model(LogBloom(1, 1, 1), c, 1.0, Lookup(keys))
    quantised = lambda n: model.value(model.level(n, 1), 1)
    rest = np.array([(n, k) for n, k in totals.pop("by").items() if n < least], float).reshape(-1, 2)
    model.mass = float(quantised(exact).sum() + (quantised(rest[:, 0]) * rest[:, 1]).sum()) + totals["once"] + 1
    stored, covered = histories(pair_counts, model, model.share(exact))
    if c.all_pairs:
        shared = d.sparkSession.sparkContext.broadcast(model)
        rare, sums = rare_sums(rare, counts, shared)
        shared.unpersist()
        more = sums.where("place IS NOT NULL").select("place", "top", "follow").toArrow()  # max_words at most
        at = more["place"].to_numpy()
        stored[at] += more["top"].to_numpy() / 1024
        covered[at] += more["follow"].to_numpy() / 2.0**40
    held = frequent(pair_counts, max(c.least_pair, threshold(pair_counts, c.max_pairs)[0]))
    end = np.searchsorted(keys, END)
    starts = int(exact[end]) if end < len(keys) and keys[end] == END else d.count()  # a text has one end
    model = build(model, exact, max(starts, 1), held, stored, covered)
    more = d.sparkSession.createDataFrame([], "bucket int, keys binary, counts binary")
    if c.all_pairs:
        shared = d.sparkSession.sparkContext.broadcast(model)
        more = gains(rare, sums, shared, buckets)
        shared.unpersist()
        removed(rare)
    return Trained(model, exact, counts, pair_counts, more, buckets, totals)


#: Rows of the lookup: texts with what the broadcast gives, what they ask of a bucket, and the buckets' counts.
TEXT, ASK_WORDS, ASK_PAIRS, ASK_GAINS, WORDS, PAIRS, GAINS = range(7)
DOC = "doc_id {id}, held_out boolean, n_tokens long, known long, logs double, score double"
ASKED = "kind int, bucket int, seg long, row long, " + DOC + ", keys binary, counts binary, rows binary"
ANSWERED = "seg long, row long, " + DOC + ", rows binary, more_known binary, more_logs binary, more_score binary"
#: Tokens and rows of a segment: the texts that ask together.
SEG_TOKENS, SEG_ROWS = 1_000_000, 60_000


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _filled(schema: str, columns: dict[str, pa.Array], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """A batch of ``schema`` with null in all but ``columns``."""
    n = len(next(iter(columns.values())))
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(n, types[k] if k in types else kinds[t]) for k, t in fields], [k for k, _ in fields])


def _asks(kind: int, seg: int, keys: np.ndarray, rows: np.ndarray, buckets: int, types: dict) -> pa.RecordBatch | None:
    """A row for each bucket that is asked: distinct keys, the number of rows of each, and the rows, counted from the segment's first."""
    if not len(keys):
        return None
    order = np.argsort(keys)
    keys, rows = keys[order], rows[order].astype(np.uint16)
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, rows, bucket = keys[order], rows[order], bucket[order]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])))
    times = np.diff(np.append(first, len(keys))).astype(np.uint32)
    key_bucket = bucket[first]
    some = np.unique(key_bucket)
    at, to = np.searchsorted(key_bucket, some), np.searchsorted(key_bucket, some, "right")
    low, high = np.searchsorted(bucket, some), np.searchsorted(bucket, some, "right")
    key = keys[first]
    halves = lambda k: (k >> _U(32)).astype(np.uint32).tobytes() + (k & LOW32).astype(np.uint32).tobytes()  # noqa: E731  (equal upper halves compress)
    n = len(some)
    return _filled(
        ASKED,
        {
            "kind": pa.array(np.full(n, kind, np.int32)),
            "bucket": pa.array(some.astype(np.int32)),
            "seg": pa.array(np.full(n, seg)),
            "keys": pa.array([halves(key[a:b]) for a, b in zip(at, to, strict=True)], pa.binary()),
            "counts": pa.array([times[a:b].tobytes() for a, b in zip(at, to, strict=True)], pa.binary()),
            "rows": pa.array([rows[a:b].tobytes() for a, b in zip(low, high, strict=True)], pa.binary()),
        },
        types,
    )


def _rare_keys(h: np.ndarray, row: np.ndarray, ok: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs with a word beyond the vocabulary, and of such words as histories; and the rows, counted from ``base``."""
    before = preceding(h, row)
    after = np.append(False, ~ok[:-1] & (row[1:] == row[:-1]))[: len(h)]
    some = after | ~ok
    return np.concatenate([pair_key(before[some], h[some]), tb.mix(before[after] ^ BACKOFF)]), np.concatenate([row[some], row[after]]) + base


def asked(numbered: DataFrame, trained: Trained, shared, kind: str) -> DataFrame:
    """ASKED: the rows of ``numbered`` (row, doc_id, held_out, text), scored by the broadcast, and what they ask of the buckets."""
    buckets = trained.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, logs = shared.value
        words: list[tuple[np.ndarray, np.ndarray]] = []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        rare: list[tuple[np.ndarray, np.ndarray]] = []
        seg, n, last, types = -1, 0, -1, {}

        def flush() -> Iterator[pa.RecordBatch]:
            for what, have in ((ASK_WORDS, words), (ASK_PAIRS, pairs), (ASK_GAINS, rare)):
                if have:
                    got = _asks(what, seg, *(np.concatenate(x) for x in zip(*have, strict=True)), buckets, types)
                    have.clear()
                    if got is not None:
                        yield got

        for batch in batches:
            types = {"doc_id": batch.schema.field("doc_id").type}
            for s in tb.slices(batch.column(3)):
                number = batch.column(0).slice(s.first, s.rows).to_numpy()
                if seg < 0 or n > SEG_TOKENS or number[-1] - seg >= SEG_ROWS or number[0] != last + 1:
                    yield from flush()
                    seg, n = int(number[0]), 0
                last = int(number[-1])
                for low in range(0, s.rows, SEG_ROWS):  # a slice of very short texts
                    if low:
                        yield from flush()
                        seg, n = int(number[low]), 0
                    part = tb.Slice(s.first + low, min(SEG_ROWS, s.rows - low), s.data[s.offs[low] : s.offs[min(low + SEG_ROWS, s.rows)]], s.offs[low : low + SEG_ROWS + 1] - s.offs[low])
                    h, row = tokens(part)
                    at, ok = m.words.find(h)
                    p, open_pairs, where = m.look(h, row, at, ok)
                    n += len(h)
                    base = int(number[low]) - seg
                    words.append((h[~ok], row[~ok] + base))
                    pairs.append((open_pairs, row[where] + base))
                    if m.c.all_pairs:
                        rare.append(_rare_keys(h, row, ok, base))
                    cut = lambda k: batch.column(k).slice(part.first, part.rows)  # noqa: B023, E731
                    yield _filled(
                        ASKED,
                        {
                            "kind": pa.array(np.full(part.rows, TEXT, np.int32)),
                            "bucket": pa.array(np.full(part.rows, bucket_of(np.array([seg], np.uint64), buckets)[0], np.int32)),
                            "seg": pa.array(np.full(part.rows, seg)),
                            "row": cut(0),
                            "doc_id": cut(1),
                            "held_out": cut(2),
                            "n_tokens": pa.array(np.bincount(row, minlength=part.rows), pa.int64()),
                            "known": pa.array(np.bincount(row[ok], minlength=part.rows), pa.int64()),
                            "logs": pa.array(np.bincount(row[ok], logs[at[ok]], part.rows), pa.float64()),
                            "score": pa.array(np.bincount(row, p, part.rows), pa.float64()),
                        },
                        types,
                    )
        yield from flush()

    return numbered.mapInArrow(run, ASKED.format(id=kind))


def answered(asks: DataFrame, trained: Trained, shared, kind: str) -> DataFrame:
    """ANSWERED: the texts as they are, and for every segment what each bucket adds to its rows."""

    def run(table: pa.Table) -> pa.Table:
        m = shared.value[0]
        what = table["kind"].to_numpy()
        types = {"doc_id": table.schema.field("doc_id").type}
        texts = table.filter(pa.array(what == TEXT)).select([n for n in _names(ANSWERED) if n in _names(ASKED) and n != "rows"])
        out = [_filled(ANSWERED, {n: texts[n].combine_chunks() for n in texts.column_names}, types)] if len(texts) else []
        counts = {}
        for k in np.flatnonzero(what >= WORDS):
            counts[what[k]] = np.frombuffer(table["keys"][k].as_py(), np.uint64), np.frombuffer(table["counts"][k].as_py(), np.float64 if what[k] == GAINS else np.int64)
        for kind in (ASK_WORDS, ASK_PAIRS, ASK_GAINS):
            at = np.flatnonzero(what == kind)
            key, count = counts.get(kind + 3, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            if not len(at) or not len(key):
                continue
            part = table.take(pa.array(at))
            several = lambda n, t: [np.frombuffer(x.as_py(), t) for x in part[n]]  # noqa: B023, E731
            keys, times, rows = several("keys", np.uint32), several("counts", np.uint32), several("rows", np.uint16)
            high = np.concatenate([k[: len(k) // 2] for k in keys]).astype(np.uint64)
            wanted = (high << _U(32)) | np.concatenate([k[len(k) // 2 :] for k in keys])
            place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            there = key[place] == wanted
            # A row of a request as one number, so that all requests are answered together.
            asker = np.repeat(np.arange(len(at)), [len(r) for r in rows]) << 16 | np.concatenate(rows)
            times = np.concatenate(times)
            asker, wanted, c, times = asker[np.repeat(there, times)], wanted[there], count[place[there]], times[there]
            row, back = np.unique(asker, return_inverse=True)
            total = lambda v: np.bincount(back, np.repeat(v, times), len(row))  # noqa: B023, E731
            ends = np.searchsorted(row, np.arange(len(at) + 1) << 16)
            some = np.flatnonzero(np.diff(ends))
            cut = lambda v, t: pa.array([v[ends[i] : ends[i + 1]].astype(t).tobytes() for i in some], pa.binary())  # noqa: B023, E731
            done = {"seg": part["seg"].combine_chunks().take(pa.array(some)), "rows": cut(row & 0xFFFF, np.uint16)}
            if kind == ASK_WORDS:
                done |= {"more_known": cut(np.bincount(back, minlength=len(row)), np.uint32), "more_logs": cut(total(np.log10(c + 1.0)), np.float64)}
                gain = np.log10(m.share(c)) + np.log10(m.mass)
            else:
                gain = c if kind == ASK_GAINS else m.gain(wanted, c)
            out.append(_filled(ANSWERED, done | {"more_score": cut(total(gain), np.float32)}, types))
        schema = out[0].schema if out else _filled(ANSWERED, {"seg": pa.array([], pa.int64())}, types).schema
        return pa.Table.from_batches(out, schema)

    tables = [
        t.select(*[{"kind": F.lit(k), "bucket": F.col("bucket"), "keys": F.col("keys"), "counts": F.col("counts")}.get(n, F.lit(None)).cast(asks.schema[n].dataType).alias(n) for n in _names(ASKED)])
        for k, t in ((WORDS, trained.words), (PAIRS, trained.pairs), (GAINS, trained.gains))
    ]
    return asks.union(tables[0]).union(tables[1]).union(tables[2]).groupBy("bucket").applyInArrow(run, ANSWERED.format(id=kind))


def score(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rest = remainder("doc_id", c.folds)
    d = docs.select("doc_id", "text")
    t = train(d, rest != c.held, c)
    shared = d.sparkSession.sparkContext.broadcast((t.model, np.log10(t.exact + 1.0)))  # bounded by max_words and max_pairs
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", (rest == c.held).alias("held_out"), "text")
    norm = math.log10(t.totals["tokens"] + 1 * (t.totals["types"] + 1))

    def summed_up(table: pa.Table) -> pa.Table:
        """The texts of a segment with all that was added to their rows. Row numbers only tell apart the rows of a segment; a segment is made in one go."""
        texts = table.filter(table["row"].is_valid())
        at = texts["row"].to_numpy() - texts["seg"][0].as_py()
        size = int(at.max()) + 1
        known, logs, more = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for r in table.filter(table["rows"].is_valid()).select(["rows", "more_known", "more_logs", "more_score"]).to_pylist():
            rows = np.frombuffer(r["rows"], np.uint16)
            more[rows] += np.frombuffer(r["more_score"], np.float32)
            if r["more_known"] is not None:
                known[rows] += np.frombuffer(r["more_known"], np.uint32)
                logs[rows] += np.frombuffer(r["more_logs"])
        n = texts["n_tokens"].to_numpy()
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": texts["n_tokens"],
                "n_known": texts["known"].to_numpy() + known[at],
                "train_tokens": np.full(len(n), t_tokens),
                "base_score": texts["logs"].to_numpy() + logs[at] - n * norm,
                "score": texts["score"].to_numpy() + more[at],
            }
        )

    t_tokens = t.totals["tokens"]
    out = answered(asked(numbered, t, shared, kind), t, shared, kind).groupBy("seg")
    return out.applyInArrow(summed_up, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), Config(all_pairs=True))


QUERIES = {"op7_lm_scoring": op7_lm_scoring}
ORACLES: dict[str, str] = {}
