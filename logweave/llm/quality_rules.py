r"""Quality rules by compression bands.

The zstandard ratio (compressed by raw bytes) of a text is compared with a band that depends on its
length: below it the text repeats itself, above it the text is noise. The same holds for fixed
chunks of every text that fills one, of which only a small share, by bytes, may lie outside a band
of their own. What is left after the last full chunk is judged within the text's last
``chunk_bytes``; bytes in two chunks outside the band count once.

The default bands are wide. :func:`fitted` draws them closer from labelled rows: at every half
doubling of the length where enough good rows lie, the lower limit goes just below nearly all of
them, the upper one well above; likewise for chunks. Limits between two lengths are interpolated.
Without such labels, or at lengths without good rows, the default holds.

Base columns, over words ``[^\x20\x09-\x0D]+``: word_chars, n_symbols, n_dup_lines, n_repeat_words.
``base_failed``: n_words < 20 or 100 * n_repeat_words > 30 * n_words. ``kept`` is false for those,
else the bands' verdict.

Null and empty texts: no words, ratio null, not kept. Texts of any length are read whole; the counts
compare lines and windows by 64-bit hashes. Rows are judged one by one, so repeated and tied rows
repeat their result; an empty table gives an empty result. Other columns of the input, whatever
their names, are not read by :func:`quality_rules`.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import textbytes as tb
from logweave.llm.common import BROADCAST_ROWS, read, removed, written


@dataclass(frozen=True)
class Bands:
    """(bytes from which it holds, least ratio, greatest ratio), by length; and the chunks' band."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0),
        (64, 0.45, 1.25),
        (128, 0.42, 1.02),
        (256, 0.40, 0.92),
        (512, 0.37, 0.86),
        (1024, 0.33, 0.80),
        (2048, 0.30, 0.76),
        (4096, 0.27, 0.73),
        (16384, 0.24, 0.72),
        (65536, 0.20, 0.72),
    )
    #: (log2 of the bytes, least ratio, greatest ratio) as fitted; between neighbours at most one doubling apart it is interpolated and comes first.
    curve: tuple[tuple[float, float, float], ...] = ()
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.20, 0.75)
    #: Greatest share of the text's bytes in chunks outside their band.
    chunk_share: float = 0.34
    level: int = 3

    def limits(self, n: int) -> tuple[float, float]:
        """Least and greatest ratio of a text of ``n`` bytes."""
        if self.curve:
            x = math.log2(n)
            k = bisect_right(self.curve, x, key=lambda c: c[0])
            if 0 < k < len(self.curve) and self.curve[k][0] - self.curve[k - 1][0] <= 1:
                (x0, *a), (x1, *b) = self.curve[k - 1], self.curve[k]
                t = (x - x0) / (x1 - x0)
                return a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])
        return next(b for b in reversed(self.whole) if n >= b[0])[1:]


@dataclass(frozen=True)
class Fit:
    #: Share of good rows that may lie below the lower limit of a fitted curve, and above the upper one.
    loss: float = 0.002
    #: Good rows within three quarters of a doubling that a length needs for limits of its own; and good chunks for a chunks' band.
    least: int = 40
    #: Room below the lower quantile and above the upper one, in distances of that quantile from the median.
    room: tuple[float, float] = (0.15, 2.0)


SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, odd_chunks double, kept boolean"


def base_counts(s: tb.Slice) -> dict[str, np.ndarray]:
    """The base columns of the rows of a slice."""
    w = tb.words(s)
    n_words = np.bincount(w.row, minlength=s.rows)
    solid = ~tb.SPACE[s.data]
    chars = s.per_row(solid & ((s.data & 0xC0) != 0x80))

    ln = tb.lines(s)
    heads = np.searchsorted(w.start, ln.start)
    with_word = (heads < len(w)) & (np.append(w.start, [np.iinfo(np.int64).max])[heads] < ln.end)
    ln = tb.Spans(ln.start[with_word], ln.end[with_word], ln.row[with_word])
    dup = np.bincount(ln.row, minlength=s.rows)
    if len(ln):
        _, first = np.unique(tb.row_keys(tb.hashes(s.data, ln), ln.row), return_index=True)
        dup = dup - np.bincount(ln.row[first], minlength=s.rows)

    h, at = tb.windows(tb.hashes(s.data, w), w.row, 8)
    repeat = np.zeros(s.rows, np.int64)
    if len(at):
        keys = tb.row_keys(h, w.row[at])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        if twice.any():
            change = np.zeros(len(w) + 1, np.int64)
            np.add.at(change, at[twice], 1)
            np.add.at(change, at[twice] + 8, -1)
            repeat = np.bincount(w.row[np.cumsum(change[:-1]) > 0], minlength=s.rows)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": s.per_row(SYMBOL[s.data]), "n_dup_lines": dup, "n_repeat_words": repeat}


def ratios(text: bytes, pack: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks outside the chunks' band (0 for a text shorter than a chunk)."""
    n, size = len(text), bands.chunk_bytes
    whole = len(pack.compress(text)) / n
    if n < size:
        return whole, 0.0
    view, odd, reach = memoryview(text), 0, 0
    for at in range(0, n, size):
        end = min(at + size, n)
        r = len(pack.compress(view[end - size : end])) / size
        if not bands.chunk[0] <= r <= bands.chunk[1]:
            odd += end - max(reach, end - size)
            reach = end
    return whole, odd / n


def verdict(n: int, whole: float, odd: float, bands: Bands) -> bool:
    lo, hi = bands.limits(n)
    return lo <= whole <= hi and odd <= bands.chunk_share


def _room(values: np.ndarray, weight: np.ndarray, f: Fit) -> tuple[float, float, float]:
    """Median, lower limit and upper limit of values that occur ``weight`` times."""
    order = np.argsort(values)
    values, upto = values[order], np.cumsum(weight[order]) / weight.sum()
    lo, mid, hi = values[np.searchsorted(upto, [f.loss, 0.5, 1 - f.loss]).clip(0, len(values) - 1)]
    return mid, lo - f.room[0] * (mid - lo), hi + f.room[1] * (hi - mid)


def _median(values: np.ndarray, weight: np.ndarray) -> float:
    """Median of values that occur ``weight`` times."""
    order = np.argsort(values)
    upto = np.cumsum(weight[order])
    return float(values[order][[np.searchsorted(upto, upto[-1] / 2), np.searchsorted(upto, upto[-1] / 2, "right")]].mean())


def drawn(whole: np.ndarray, chunks: np.ndarray, bands: Bands, f: Fit) -> Bands:
    """``bands`` drawn closer to good rows: ``whole`` has (bytes, ratio) and, unless each counts once, times; ``chunks`` (ratio, times)."""
    x, r = np.log2(whole[:, 0]), whole[:, 1]
    times = whole[:, 2] if whole.shape[1] > 2 else np.ones(len(whole))
    knots = np.arange(math.floor(2 * x.min()), math.ceil(2 * x.max()) + 1) / 2 if len(x) else np.zeros(0)
    near = [(k, np.abs(x - k) <= 0.75) for k in knots]
    near = [(k, at) for k, at in near if times[at].sum() >= f.least]
    curve = []
    if near:
        # The ratio falls with the length: rows are moved along the medians' line to the knot.
        close = [at & (np.abs(x - k) <= 0.25) for k, at in near]
        middle = np.array([_median(r[c], times[c]) if c.any() else _median(r[at], times[at]) for c, (_, at) in zip(close, near, strict=True)])
        level = np.interp(x, [k for k, _ in near], middle)
        for (k, at), m in zip(near, middle, strict=True):
            lo, hi = _room(r[at] - level[at] + m, times[at], f)[1:]
            least, most = bands.limits(max(1, round(2**k)))
            curve.append((float(k), max(float(lo), least), min(float(hi), most)))
    chunk = bands.chunk
    if len(chunks) and chunks[:, 1].sum() >= f.least:
        lo, hi = _room(chunks[:, 0], chunks[:, 1], f)[1:]
        chunk = max(float(lo), chunk[0]), min(float(hi), chunk[1])
    return replace(bands, curve=tuple(curve), chunk=chunk)


def fitted(docs: DataFrame, labels: DataFrame, wanted: Column | None = None, bands: Bands = Bands(), f: Fit = Fit()) -> Bands:
    """Bands drawn from all labelled rows (labels.quality = 1) that pass the base; ``wanted`` is a condition on labels.doc_id.

    Tasks measure the rows; what reaches the driver is how many of them have a length, to a 32nd of a doubling, and a ratio, to a
    thousandth. Rows that share a labelled id all count. Ids are broadcast, after counting, or rows meet them by shuffle once they are measured.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    good = labels.where((F.col("quality") == 1) & (F.lit(True) if wanted is None else wanted)).select(F.col("doc_id").try_cast(kind).alias("doc_id")).where("doc_id is not null").distinct()
    few = good.count() <= BROADCAST_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                at, n, ratio, parts = np.flatnonzero(~failing(base_counts(s))), [], [], []
                for k in at:
                    text = s.text(k)
                    n.append(round(32 * math.log2(len(text))))
                    ratio.append(round(1000 * len(pack.compress(text)) / len(text)))
                    view = memoryview(text)
                    parts.append([round(1000 * len(pack.compress(view[i : i + bands.chunk_bytes])) / bands.chunk_bytes) for i in range(0, len(text) - bands.chunk_bytes + 1, bands.chunk_bytes)])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + s.first)), pa.array(n, pa.int32()), pa.array(ratio, pa.int32()), pa.array(parts, pa.list_(pa.int32()))], ["doc_id", "n", "ratio", "chunks"])

    rows = docs.select("doc_id", "text")
    rows = rows.join(F.broadcast(good), "doc_id", "left_semi") if few else rows
    seen = rows.mapInArrow(run, f"doc_id {kind}, n int, ratio int, chunks array<int>")
    seen = written(seen if few else seen.join(good, "doc_id", "left_semi"), "quality-ratios")
    whole = seen.groupBy("n", "ratio").count().collect()
    chunks = seen.select(F.explode("chunks").alias("r")).groupBy("r").count().collect()  # thousandths of a ratio
    removed(seen)
    return drawn(np.array([(2 ** (x["n"] / 32), x["ratio"] / 1000, x["count"]) for x in sorted(whole)], float).reshape(-1, 3), np.array([(x["r"] / 1000, x["count"]) for x in chunks], float).reshape(-1, 2), bands, f)


def bands_for(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Bands:
    """The bands for ``docs``, from the labels in ``sf_dir``; the default ones without a folder."""
    return fitted(docs, read(spark, sf_dir, "labels")) if sf_dir else Bands()


def failing(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base columns, ratio, share of odd chunks, verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                c = base_counts(s)
                failed = failing(c)
                whole, odd, good = [], [], []
                for k in range(s.rows):
                    text = s.text(k)
                    if not text:
                        whole.append(None)
                        odd.append(None)
                        good.append(False)
                        continue
                    a, b = ratios(text, pack, bands)
                    whole.append(a)
                    odd.append(b)
                    good.append(bool(not failed[k] and verdict(len(text), a, b, bands)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.first, s.rows),
                        *(pa.array(v, pa.int64()) for v in c.values()),
                        pa.array(failed),
                        pa.array(whole, pa.float64()),
                        pa.array(odd, pa.float64()),
                        pa.array(good, pa.bool_()),
                    ],
                    ["doc_id", *c, "base_failed", "ratio", "odd_chunks", "kept"],
                )

    schema = SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules(docs, bands_for(spark, docs, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, bands: Bands | None = None) -> DataFrame:
    """Pipeline stage: the documents whose verdict is kept, in one pass and with all their columns."""
    names, bands = docs.columns, bands or bands_for(spark, docs, sf_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=bands.level)
        at = names.index("text")
        for batch in batches:
            for s in tb.slices(batch.column(at)):
                c = base_counts(s)
                keep = ~failing(c)
                for k in np.flatnonzero(keep):
                    text = s.text(k)
                    keep[k] = verdict(len(text), *ratios(text, pack, bands), bands)
                yield batch.slice(s.first, s.rows).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES: dict[str, str] = {}
