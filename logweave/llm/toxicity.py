r"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (A-Z lower-cased) and their beginnings of 4 to 8
characters. The vocabulary is the terms whose share differs most between toxic and other examples
(|z| at least ``least_z``, ``max_terms`` at most), and one term that stands for all words. A text's
vector has (1 + ln count) * idf for its terms, with document frequencies counted over the whole
corpus, at length one; so a telling word among a thousand others weighs less than among ten.

Examples are at most ``fit_rows`` labelled rows of each class (a documented bound); those with words
are indexed. For every text the nearest ``k`` are found exactly: the index keeps each term's largest
weight in every block of examples; blocks are visited by falling upper bound until no block can hold
a nearer example than the k-th found. Their votes are weighted by inverse distance and by the share
of the class that was sampled, and a monotone curve fitted to votes among the examples themselves
(each without itself) maps votes to probabilities. ``evidence`` lists the nearest examples and
``terms`` the text's terms that weigh most.

Null texts and texts without words have no neighbour; their score is the share of toxic rows. Rows are scored one by one, so repeated rows
repeat their score. Ties in similarity go to the example with the lower place in the index, which is
sorted by content and id. Without examples of both classes the score is the share of label 1 (0.5
without any). An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logweave.llm import textbytes as tb
from logweave.llm.common import labelled_sample, read, remainder, removed

_U = np.uint64

#: Bytes between words, after A-Z are lower-cased.
GAP = np.zeros(256, bool)
GAP[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class Config:
    #: Labelled rows of each class, at most.
    fit_rows: int = 4000
    max_terms: int = 4096
    least_z: float = 5.0
    #: Labelled rows that a term of the vocabulary must occur in.
    least_rows: int = 4
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    k: int = 15
    block: int = 64
    #: Weight of the overall share in a vote.
    prior: float = 0.5
    threshold: float = 0.7
    evidence: int = 3


def terms(s: tb.Slice, c: Config) -> Iterator[tuple[np.ndarray, np.ndarray, tb.Spans]]:
    """Hash and row of every word, then of every beginning of each length, with their spans."""
    low = tb.Slice(s.first, s.rows, tb.LOWER[s.data], s.offs)
    w = tb.words(low, GAP)
    yield tb.hashes(low.data, w), w.row, w
    begins = np.flatnonzero((low.data & 0xC0) != 0x80)  # of characters
    first = np.searchsorted(begins, w.start)
    chars = np.searchsorted(begins, w.end) - first
    for k in c.prefixes:
        long = chars > k
        part = tb.Spans(w.start[long], begins[first[long] + k], w.row[long])
        yield tb.mix(tb.hashes(low.data, part) + _U(k)), part.row, part


def vocabulary(sample: DataFrame, totals: dict[int, int], c: Config) -> list[tuple[int, bytes]]:
    """(hash, text) of the terms that tell the classes apart, strongest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for s in tb.slices(batch.column(0)):
                low = tb.LOWER[s.data]
                for h, row, span in terms(s, c):
                    _, first = np.unique(tb.row_keys(h, row), return_index=True)
                    toxic = label[s.first + row[first]] == 1
                    keys, at, back = np.unique(h[first], return_index=True, return_inverse=True)
                    some = first[at]
                    text = [low[a:b].tobytes() for a, b in zip(span.start[some], span.end[some], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(text, pa.binary()), pa.array(np.bincount(back, toxic, len(keys)).astype(np.int64)), pa.array(np.bincount(back, ~toxic, len(keys)).astype(np.int64))], ["h", "term", "a", "b"])

    found = sample.select("text", "label").mapInArrow(run, "h long, term binary, a long, b long")
    by = found.groupBy("h").agg(F.any_value("term").alias("term"), F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") + F.col("b") >= c.least_rows)
    na, nb = float(totals[1] + 1), float(totals[0] + 1)
    pa_, pb_ = (F.col("a") + 0.5) / na, (F.col("b") + 0.5) / nb
    p = (F.col("a") + F.col("b") + 1) / (na + nb)
    z = F.abs(pa_ - pb_) / F.sqrt(p * (1 - p) * (1 / na + 1 / nb))
    best = by.withColumn("z", z).where(F.col("z") >= c.least_z).orderBy(F.desc("z"), "h").limit(c.max_terms)
    return [(r["h"], bytes(r["term"])) for r in best.collect()]


@dataclass
class Terms:
    """The vocabulary in order of hash, with idf weights."""

    hash: np.ndarray
    text: list[bytes]
    idf: np.ndarray

    def of(self, s: tb.Slice, c: Config) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, term and count of a slice's terms, in order of row; the term behind the last stands for all words."""
        keys, n = [], len(self.hash)
        for h, row, _ in terms(s, c):
            if not keys:
                words = np.bincount(row, minlength=s.rows)
                keys.append(np.zeros(0, np.int64))
            if n:
                at = np.minimum(np.searchsorted(self.hash, h), n - 1)
                ok = self.hash[at] == h
                keys.append(row[ok] * n + at[ok])
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        some = np.flatnonzero(words)
        row, term = np.concatenate([key // max(n, 1), some]), np.concatenate([key % max(n, 1), np.full(len(some), n)])
        order = np.lexsort((term, row))
        return row[order], term[order], np.concatenate([count, words[some]])[order]

    def vectors(self, s: tb.Slice, c: Config) -> list[tuple[np.ndarray, np.ndarray]]:
        row, term, count = self.of(s, c)
        weight = (1 + np.log(count)) * self.idf[term]
        ends = np.searchsorted(row, np.arange(s.rows + 1))
        out = []
        for k in range(s.rows):
            t, w = term[ends[k] : ends[k + 1]], weight[ends[k] : ends[k + 1]]
            out.append((t, w / max(np.sqrt(w @ w), 1e-12)))
        return out


class BlockMax:
    """An inverted index over unit vectors in blocks, with each term's largest weight by block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int) -> None:
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block)
        doc = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        order = np.lexsort((doc, term, doc // block))
        self.doc, self.term, self.weight = doc[order], term[order], weight[order]
        self.ends = np.searchsorted(self.doc // block, np.arange(self.blocks + 1))
        self.most = np.zeros((n_terms, max(self.blocks, 1)))
        np.maximum.at(self.most, (self.term, self.doc // block), self.weight)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest with a cosine above 0; ties by place."""
        bound = weight @ self.most[term] if len(term) else np.zeros(max(self.blocks, 1))
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        query = np.zeros(len(self.most))
        query[term] = weight
        for b in np.argsort(-bound, kind="stable"):
            most = np.round(bound[b], 9) + 1e-9
            if bound[b] <= 0 or (len(best) >= k and most < best[k - 1]):
                break
            if len(best) >= k and most <= best[k - 1] + 2e-9 and b * self.block > best_at[k - 1]:
                continue  # at best a tie, with a higher place
            at = slice(self.ends[b], self.ends[b + 1])
            base = b * self.block
            cosine = np.bincount(self.doc[at] - base, query[self.term[at]] * self.weight[at], min(self.block, self.n - base))
            places = np.flatnonzero(cosine > 0)
            if skip >= 0:
                places = places[places + base != skip]
            best_at, best = np.concatenate([best_at, places + base]), np.concatenate([best, np.round(cosine[places], 9)])
            order = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[order], best[order]
        return best_at, best


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y on x (pool adjacent violators): both ends of every pool. Small pools are drawn to the middle."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of y, weight, first and last x
    for xi, yi, wi in zip(x[order], y[order], w[order], strict=True):
        pools.append([yi * wi, wi, xi, xi])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            a, n, _, last = pools.pop()
            pools[-1][:2] = pools[-1][0] + a, pools[-1][1] + n
            pools[-1][3] = last
    value = np.maximum.accumulate([(a + 0.4) / (n + 1.0) for a, n, _, _ in pools])
    return np.array([v for p in pools for v in p[2:]]), np.repeat(value, 2)


@dataclass
class Model:
    terms: Terms
    index: BlockMax
    ids: list
    label: np.ndarray
    weight: np.ndarray
    share: float
    without: float
    knots: tuple[np.ndarray, np.ndarray]

    def vote(self, at: np.ndarray, cosine: np.ndarray, c: Config) -> float:
        w = self.weight[at] / (0.05 + np.sqrt(np.maximum(2 - 2 * cosine, 0)))
        scale = self.weight.mean() * c.prior
        return float((w @ self.label[at] + scale * self.share) / (w.sum() + scale))

    def score(self, at: np.ndarray, cosine: np.ndarray, c: Config) -> float:
        return float(np.clip(np.interp(self.vote(at, cosine, c), *self.knots), 0, 1)) if len(at) else self.without


def fit(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, c: Config = Config()) -> Model:
    """The index over labelled rows that are ``wanted``, with document frequencies over all of ``docs``."""
    sample, share = labelled_sample(docs, labels, label, wanted, {0: c.fit_rows, 1: c.fit_rows}, "toxicity-sample")
    totals = {0: 0, 1: 0} | {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    spark = docs.sparkSession
    words = sorted(vocabulary(sample, totals, c), key=lambda x: np.int64(x[0]).view(np.uint64))
    t = Terms(np.array([x for x, _ in words], np.int64).view(np.uint64), [x for _, x in words], np.ones(len(words)))
    shared = spark.sparkContext.broadcast(t)  # max_terms at most

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(shared.value.hash), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for s in tb.slices(batch.column(0)):
                total += np.bincount(shared.value.of(s, c)[1], minlength=len(total) + 1)[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(total)), -1)), pa.array(np.append(total, rows))], ["term", "n"])

    got = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n = got.get(-1, 0)
    df = np.array([*(got.get(k, 0) for k in range(len(words))), n])
    t.idf = np.log((n + 1) / (df + 1)) + 1

    ready = spark.sparkContext.broadcast(t)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                v = ready.value.vectors(s, c)
                cut = lambda k: batch.column(k).slice(s.first, s.rows)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([cut(0), cut(2), pa.array([x.astype(np.int64).tobytes() for x, _ in v], pa.binary()), pa.array([x.tobytes() for _, x in v], pa.binary())], ["doc_id", "label", "terms", "weights"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(vectors, f"doc_id {kind}, label int, terms binary, weights binary").collect()  # the sample's rows
    removed(sample)
    rows = sorted(rows, key=lambda r: (bytes(r["terms"]), bytes(r["weights"]), r["doc_id"], r["label"]))
    label_of, cost = np.array([r["label"] for r in rows], float), np.array([1 / share[r["label"]] for r in rows])
    overall = float((label_of * cost).sum() / cost.sum()) if len(rows) else 0.5
    full = np.array([len(r["terms"]) > 0 for r in rows], bool)
    used = [r for r, f in zip(rows, full, strict=True) if f]
    vec = [(np.frombuffer(r["terms"], np.int64), np.frombuffer(r["weights"])) for r in used]
    index = BlockMax(vec, len(words) + 1, c.block)
    m = Model(t, index, [r["doc_id"] for r in used], label_of[full], cost[full], overall, overall, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    if len(used):
        votes = np.array([m.vote(*index.nearest(*v, c.k, skip=i), c) for i, v in enumerate(vec)])
        m.knots = monotone(votes, m.label, m.weight)
    return m


def classify(docs: DataFrame, model: Model, held: Column, c: Config = Config()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, evidence (nearest examples), terms."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit_rows and max_terms
    like = pa.struct([("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), ("cosine", pa.float64()), ("label", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, {}
        for batch in batches:
            for s in tb.slices(batch.column(2)):
                out = []
                for t, w in m.terms.vectors(s, c):
                    key = (t.tobytes(), w.tobytes())
                    got = known.get(key)
                    if got is None:
                        at, cosine = m.index.nearest(t, w, c.k)
                        near = [{"doc_id": m.ids[a], "cosine": float(x), "label": int(m.label[a])} for a, x in zip(at[: c.evidence], cosine, strict=False)]
                        words = t < len(m.terms.text)
                        t, w = t[words], w[words]
                        top = [m.terms.text[t[j]].decode("utf-8", "replace") for j in np.argsort(-w, kind="stable")[: c.evidence]]
                        got = m.score(at, cosine, c), near, top
                        if len(known) > 20_000:
                            known.clear()
                        known[key] = got
                    out.append(got)
                p = np.array([x[0] for x in out])
                cut = lambda k: batch.column(k).slice(s.first, s.rows)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [cut(0), cut(1), pa.array(p, pa.float64()), pa.array((p >= c.threshold).astype(np.int32)), pa.array([x[1] for x in out], pa.list_(like)), pa.array([x[2] for x in out], pa.list_(pa.string()))],
                    ["doc_id", "held_out", "score", "predicted", "evidence", "terms"],
                )

    schema = f"doc_id {kind}, held_out boolean, score double, predicted int, evidence array<struct<doc_id:{kind},cosine:double,label:int>>, terms array<string>"
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = read(spark, sf_dir, "documents"), remainder("doc_id", 3)
    model = fit(docs, read(spark, sf_dir, "labels"), "toxic", rest != 1)
    return classify(docs, model, rest == 1)


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
