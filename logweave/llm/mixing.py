"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of ``block_docs``. The target is a fluid mix: at every moment all
sources that have blocks left are served at once, in proportion to their weights, and a phase ends
when one runs out. A block is released at the slot in which the fluid mix begins to serve it and due
by the end of the slot in which it has served it (floor and ceiling of two moments; within phase 0,
floor(j / w) and ceil((j + 1) / w) for block j, from 0, and a share of w). In every slot the
released block with the earliest deadline goes next (ties: the later-split window first, then the
larger weight, then the name). The fluid mix is a fractional schedule within these windows, so
earliest deadline first meets every one of them, and at any slot of any phase a source has received
less than one block more or less than its target. No document is dropped or repeated.

Weights are not rounded: the moments are fractions of integers. One task walks the slots (documents
/ block_docs steps) and streams the place of each block into a table, which is joined to the
documents; it holds a few numbers for each source.

The number of a document within its source comes from counts of (source, hash bucket of id and text) and a
row_number within the bucket, so a source with a third of all rows is spread over many tasks.

:func:`mix` returns the rows of ``docs`` with phase, slot, block, release, deadline (slots of the
mix) and position: ordering by position gives the mix. Null sources are a source of their own,
named null; its weight is looked up under None. Null texts, null ids and repeated rows are rows
like others; rows that repeat an id and a text are ordered arbitrarily among themselves. An empty
table gives an empty result. Output columns that clash with columns of ``docs`` get a trailing "_".
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm.common import read, unused, written


@dataclass(frozen=True)
class Config:
    block_docs: int = 8
    #: Slots in a period of ``pattern``, for weights that are whole shares of it. The mix has no period.
    period: int = 1000
    #: Rows for each (source, bucket) that the numbering aims at.
    bucket_rows: int = 1_000


def shares(weights: Mapping, period: int) -> dict:
    """Whole shares of a period by largest remainder, one at least."""
    period = max(period, len(weights))
    total = float(sum(weights.values()))
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    k = 0
    while (rest := period - sum(out.values())) != 0:
        s = order[k % len(order)] if rest > 0 else max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -2, str(s)))
        out[s] += 1 if rest > 0 else -1
        k += 1
    return out


def window(j: int, share: int, period: int) -> tuple[int, int]:
    """Release and deadline of block ``j``."""
    return j * period // share, -(-(j + 1) * period // share)


def pattern(share: Mapping, period: int) -> dict:
    """Slots of each source's blocks within a period, by earliest deadline first among released blocks."""

    def entry(s, j: int) -> tuple:
        release, deadline = window(j, share[s], period)
        return release, (deadline, 0 if (j + 1) * period % share[s] else 1, -share[s], str(s), s is not None), s, j

    count = 0
    waiting: list = []
    ready: list = []
    for s in share:
        release, key, s, j = entry(s, 0)
        heapq.heappush(waiting, (release, key, count, s, j))
        count += 1
    slots: dict = {s: [] for s in share}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, key, n, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (key, n, s, j))
        _, n, s, j = heapq.heappop(ready)
        slots[s].append(slot)
        if j + 1 < share[s]:
            release, key, s, j = entry(s, j + 1)
            heapq.heappush(waiting, (release, key, n, s, j))
    return slots


def whole_weights(weights: Sequence[float]) -> list[int]:
    """Integers in the proportions of ``weights``, each read as the decimal number that it prints as."""
    exact = [Fraction(repr(float(w))) for w in weights]
    unit = math.lcm(*(w.denominator for w in exact))
    return [int(w * unit) for w in exact]


class Fluid:
    """The targets: sources served at once in proportion to whole weights, each until its blocks are given out.

    Time is in slots. With the sources in the order in which they run out, the first k done, it is
    done[k] + j * left[k] / w when a source of weight w has got j blocks: integers throughout.
    """

    def __init__(self, blocks: Sequence[int], weights: Sequence[int]) -> None:
        self.blocks, self.weights = blocks, weights
        self.order = sorted(range(len(blocks)), key=lambda s: Fraction(blocks[s], weights[s]))
        self.ends = [blocks[s] / weights[s] for s in self.order]
        self.done = list(accumulate((blocks[s] for s in self.order), initial=0))
        self.left = list(accumulate((-weights[s] for s in self.order), initial=sum(weights)))

    def time(self, s: int, j: int) -> tuple[int, bool]:
        """When source ``s`` has got ``j`` blocks, rounded down; and whether that cut a part off."""
        w, n = self.weights[s], len(self.order)
        k = bisect_left(self.ends, j / w)
        while k < n and self.blocks[self.order[k]] * w < j * self.weights[self.order[k]]:
            k += 1
        while k and self.blocks[self.order[k - 1]] * w > j * self.weights[self.order[k - 1]]:
            k -= 1
        slot, part = divmod(j * self.left[k], w)
        return self.done[k] + slot, part > 0

    def phase_ends(self) -> list[int]:
        """First slot after each phase, in order. A slot in which a source runs out before its end is of the next phase."""
        out, last = [], None
        for s in self.order:
            v = Fraction(self.blocks[s], self.weights[s])
            if v != last:
                out.append(self.time(s, self.blocks[s])[0])
            last = v
        return out


def places(blocks: Sequence[int], weights: Sequence[int]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(source, block, phase, slot, release, deadline) of all blocks in order of slots; sources by number, ties to the larger weight, then the lower number."""
    fluid = Fluid(blocks, weights)
    rank = [0] * len(blocks)
    for k, s in enumerate(sorted(range(len(blocks)), key=lambda s: -weights[s])):
        rank[s] = k
    ready: list = []
    ends, phase = fluid.phase_ends(), 0
    deadline = lambda s, j: fluid.time(s, j + 1)
    waiting: list = [(0, rank[s], s, 0) for s in range(len(blocks))]
    heapq.heapify(waiting)
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            release, r, s, j = heapq.heappop(waiting)
            whole, part = deadline(s, j)
            heapq.heappush(ready, (whole + part, not part, r, s, j, release, whole))
        due, _, r, s, j, release, after = heapq.heappop(ready)
        while phase < len(ends) and ends[phase] <= slot:
            phase += 1
        yield s, j, phase, slot, release, due
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (after, r, s, j + 1))


PLAN = "s string, block long, phase int, slot long, release long, deadline long"


def planned(rows: DataFrame, weights: Mapping | None, c: Config) -> DataFrame:
    """The place of every block, from the rows (n) of each source (s). One task walks the slots, and holds the sources only."""
    known = None if weights is None else {None if s is None else str(s): w for s, w in weights.items() if w > 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sorted(((s, n) for b in batches for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), key=lambda x: (x[0] is None, x[0] or ""))
        if not have:
            return
        least = min(known.values(), default=1.0) if known else 1.0
        w = whole_weights([n**0.5 if known is None else known.get(s, least) for s, n in have])
        names = pa.array([s for s, _ in have], pa.string())
        place = places([-(-n // c.block_docs) for _, n in have], w)
        while cut := list(islice(place, 20_000)):
            s, *rest = zip(*cut, strict=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(s)), *(pa.array(x, pa.int32() if k == 1 else pa.int64()) for k, x in enumerate(rest))], [x.split()[0] for x in PLAN.split(", ")])

    return written(rows.select("s", "n").repartition(1).mapInArrow(run, PLAN), "mix-plan")


def mix(docs: DataFrame, weights: Mapping | None = None, c: Config = Config(), source: str = "source") -> DataFrame:
    """``docs`` with its place in the mix. Weights default to the square root of the sources' rows; a source without a weight gets the least weight.

    The rows go through one shuffle, by source and bucket: there they are numbered, and meet the places of the blocks that their bucket holds.
    """
    key, bucket, number = (unused(docs, x) for x in ("key", "bucket", "number"))
    keyed = lambda s: F.when(s.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), s.cast("string")))
    n_buckets = max(1, -(-docs.count() // c.bucket_rows))
    text = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    d = docs.withColumn(key, keyed(F.col(source))).withColumn(bucket, F.pmod(F.xxhash64("doc_id", text, F.lit(7)), F.lit(n_buckets)))
    counts = d.groupBy(F.col(key).alias("k"), F.col(bucket).alias("b")).count()
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))), "mix-counts")
    rows = counts.groupBy("k").agg(F.sum("count").alias("n")).select(F.when(F.col("k") != "n", F.substring("k", 2, 1 << 30)).alias("s"), "n")
    plan = planned(rows, weights, c).withColumn("k", keyed(F.col("s")))
    block = lambda n: F.floor(n / c.block_docs).cast("long")
    held = counts.select("k", "b", "offset", F.explode(F.sequence(block(F.col("offset")), block(F.col("offset") + F.col("count") - 1))).alias("block"))
    place = F.struct("block", "phase", "slot", "release", "deadline")
    places = held.join(plan.drop("s"), ["k", "block"]).groupBy("k", "b", "offset").agg(F.sort_array(F.collect_list(place)).alias("places"))  # a bucket's blocks
    within = F.row_number().over(Window.partitionBy(key, bucket).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", text))
    d = d.withColumn(number, within - 1).alias("docs").join(places.alias("plan"), (F.col(f"docs.{key}") == F.col("plan.k")) & (F.col(f"docs.{bucket}") == F.col("plan.b")))
    at = F.col(f"docs.{number}") + F.col("plan.offset")
    mine = F.get(F.col("plan.places"), (block(at) - block(F.col("plan.offset"))).cast("int"))
    names = {x: unused(docs, x) for x in ("phase", "slot", "block", "release", "deadline", "position")}
    return d.select(
        *[F.col(f"docs.`{x}`").alias(x) for x in docs.columns],
        *[mine[x].alias(names[x]) for x in ("phase", "slot", "block", "release", "deadline")],
        (mine["slot"] * c.block_docs + at % c.block_docs).alias(names["position"]),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "source", F.xxhash64("text").alias("text"))).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: all documents with their place in the mix."""
    return mix(docs)


QUERIES = {"op5_mixing": op5_mixing}
ORACLES: dict[str, str] = {}
