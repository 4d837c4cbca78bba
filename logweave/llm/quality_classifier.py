r"""Quality classifier: naive Bayes features in a linear support vector machine.

A text's n-grams are indicators: words (A-Z lower-cased), runs of 1, 3 and 4 symbols of its shape (letters,
digits and so on as classes of bytes, runs of letters as one), and runs of flags that say whether a
word equals the one before or the one before that. All are hashed into ``dims`` places. Each
indicator is scaled by its log-count ratio between the classes; a linear hinge-loss model over
these values is fitted by dual coordinate descent. A sigmoid fitted to cross-validated margins maps
margins to probabilities.

Everything is fitted on at most ``fit_rows`` labelled rows of each class (a documented bound; only
rows whose remainder allows it); scoring covers every row. Null and empty texts have no indicators
and get the model's bias. Rows are scored one by one, so repeated rows repeat their score.
Texts of any length are read whole; a score that ties with the threshold is predicted 1. Without
labelled rows of both classes every score is the share of label 1 (0.5 without any). An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import textbytes as tb
from logweave.llm.common import labelled_sample, read, remainder, removed

_U = np.uint64


@dataclass(frozen=True)
class Config:
    #: Rows of each class that the model is fitted on, at most.
    fit_rows: int = 3000
    word_bits: int = 17
    shape_bits: int = 16
    cost: float = 0.2
    epochs: int = 12
    folds: int = 3
    threshold: float = 0.3
    seed: int = 3

    @property
    def dims(self) -> int:
        return (1 << self.word_bits) + (1 << self.shape_bits) + 2 * 32


#: Class of each byte: letters 0 and 1, digits 2, then single symbols; bytes above 127 are letters.
SHAPE = np.full(256, 31, np.uint8)
SHAPE[97:123] = SHAPE[128:] = 0
SHAPE[65:91] = 1
SHAPE[48:58] = 2
for _k, _c in enumerate(b" \n.,!?*#$%&|<>@\"'()-_/\\:;=+"):
    SHAPE[_c] = 3 + _k


def features(s: tb.Slice, c: Config) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the distinct indicators of a slice, in order of row."""
    low = tb.Slice(s.first, s.rows, tb.LOWER[s.data], s.offs)
    w = tb.words(low)
    h = tb.hashes(low.data, w)
    parts = [w.row * c.dims + (h >> _U(64 - c.word_bits)).astype(np.int64)]

    flags = np.zeros((2, len(h)), np.int64)
    for back in (1, 2):
        flags[back - 1, back:] = (h[back:] == h[:-back]) & (w.row[back:] == w.row[:-back])
    for k in range(2 if len(h) > 4 else 0):
        run = sum(flags[k, 4 - j : len(h) - j] << j for j in range(5))
        same = w.row[4:] == w.row[:-4]
        parts.append(w.row[4:][same] * c.dims + (1 << c.word_bits) + (1 << c.shape_bits) + 32 * k + run[same])

    shape = SHAPE[s.data]
    keep = np.ones(len(shape), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | (shape[1:] > 2)
    keep[s.offs[:-1][s.offs[:-1] < len(shape)]] = True
    at = np.flatnonzero(keep)
    row, sym = tb.rows_of(s, at), shape[at].astype(np.uint64)
    for n in (1, 3, 4):
        if len(sym) >= n:
            with np.errstate(over="ignore"):
                g = np.full(len(sym) - n + 1, n, np.uint64)
                for j in range(n):
                    g = g * _U(37) + sym[j : len(sym) - n + 1 + j]
                g = (g * _U(0x9E3779B97F4A7C15)) >> _U(64 - c.shape_bits)
            fits = row[: len(row) - n + 1] == row[n - 1 :]
            parts.append(row[: len(row) - n + 1][fits] * c.dims + (1 << c.word_bits) + g[fits].astype(np.int64))
    flat = [distinct(p) for p in parts]
    key = distinct(np.concatenate(flat))
    return key // c.dims, key % c.dims


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]


def descend(rows: list[np.ndarray], y: np.ndarray, value: np.ndarray, c: Config) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over indicators scaled by ``value``, by dual coordinate descent."""
    rng, w, bias = np.random.default_rng(c.seed), np.zeros(len(value)), 0.0
    scaled = [value[r] / max(np.sqrt(len(r)), 1) for r in rows]
    norm = np.array([x @ x + 1 for x in scaled])
    alpha = np.zeros(len(rows))
    for _ in range(c.epochs):
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ scaled[i] + bias) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), c.cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
    return w, bias


def ratios(rows: list[np.ndarray], y: np.ndarray, dims: int) -> np.ndarray:
    """Log-count ratio of each indicator between the classes."""
    good, bad = np.ones(dims), np.ones(dims)
    for r, label in zip(rows, y, strict=True):
        (good if label > 0 else bad)[r] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def sigmoid_fit(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid by Newton steps on the weighted log loss."""
    a, b, target = 1.0, 0.0, np.where(y > 0, 0.999, 0.001)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, v = weight * (p - target), weight * p * (1 - p) + 1e-9
        g = np.array([(d * margin).sum() + 1e-3 * (a - 1), d.sum()])
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, s: tb.Slice, c: Config) -> np.ndarray:
        row, place = features(s, c)
        size = np.maximum(np.bincount(row, minlength=s.rows), 1)
        margin = np.bincount(row, self.weight[place], s.rows) / np.sqrt(size) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str, wanted, c: Config = Config()) -> Model:
    """The model for ``label`` from labelled rows that are ``wanted``."""
    sample, share = labelled_sample(docs, labels, label, wanted, {0: c.fit_rows, 1: c.fit_rows}, "quality-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                row, place = features(s, c)
                ends = np.searchsorted(row, np.arange(s.rows + 1))
                data = [place[ends[k] : ends[k + 1]].astype(np.int32).tobytes() for k in range(s.rows)]
                cut = lambda k: batch.column(k).slice(s.first, s.rows)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([cut(0), cut(2), pa.array(data, pa.binary())], ["doc_id", "label", "places"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sorted(sample.mapInArrow(run, f"doc_id {kind}, label int, places binary").collect(), key=lambda r: (r[0], r[2]))
    removed(sample)
    rows = [np.frombuffer(r["places"], np.int32) for r in got]
    y = np.array([1.0 if r["label"] else -1.0 for r in got])
    if len(set(y)) < 2:
        part = float((y > 0).mean()) if len(y) else 0.5
        return Model(np.zeros(c.dims), 0.0, 0.0, float(np.log(max(part, 1e-6) / max(1 - part, 1e-6))))
    fold = np.random.default_rng(c.seed).integers(0, c.folds, len(rows))
    margin = np.zeros(len(rows))
    for k in range(c.folds):
        mine = np.flatnonzero(fold != k)
        if len(set(y[mine])) < 2:
            continue
        sub = [rows[i] for i in mine]
        r = ratios(sub, y[mine], c.dims)
        w, b = descend(sub, y[mine], r, c)
        for i in np.flatnonzero(fold == k):
            margin[i] = (w[rows[i]] * r[rows[i]]).sum() / max(np.sqrt(len(rows[i])), 1) + b
    slope, shift = sigmoid_fit(margin, y, np.where(y > 0, 1 / share[1], 1 / share[0]))
    r = ratios(rows, y, c.dims)
    w, b = descend(rows, y, r, c)
    return Model(w * r, b, slope, shift)


def classify(docs: DataFrame, model: Model, held: F.Column, c: Config = Config()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dims weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tb.slices(batch.column(2)):
                p = shared.value.score(s, c)
                cut = lambda k: batch.column(k).slice(s.first, s.rows)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([cut(0), cut(1), pa.array(p), pa.array((p >= c.threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = read(spark, sf_dir, "documents"), remainder("doc_id", 5)
    model = fit(docs, read(spark, sf_dir, "labels"), "quality", rest != 0)
    return classify(docs, model, rest == 0)


QUERIES = {"op9_quality_classifier": op9_quality_classifier}
ORACLES: dict[str, str] = {}
