r"""Packing documents into sequences: Martello-Toth reduction, then best fit.

A document is its token ids and an end id. One of more than ``capacity`` ids is cut into pieces of
that many; only its first piece may be shorter. What is packed is a histogram of the pieces'
lengths, at most ``capacity`` numbers whatever the corpus; only that and the plan made from it pass through the driver.

:func:`reduced` fixes bins that are provably in some best packing. Take a length j and the room that
it leaves. A set F with j *dominates* another if the other's members can be dealt out to members of
F that are as long as their share; any packing can then swap its bin of j for F. F is

- j alone, if nothing fits beside it;
- j and f, the longest that fits, if f fills the room, or no two others fit, or no three do and f is as long as any two that fit;
- j, f and b, the longest that fits beside both, if no three others fit, and no two of those longer than b.

Every fixed bin shrinks the instance, which makes more sets dominate, so lengths are gone through until
none has such a set. Fewer lengths left can only make the conditions truer, so a set is fixed as often as its members last.
:func:`best_fit` packs the rest, longest first, each piece where the least room stays. Bins that are
filled alike are one entry with a number of bins: a length adds at most four entries, so a plan has some
thousands, for any number of documents.

The k-th piece of a length gets the place that the plan has for it. Pieces are numbered within their length by
counts of (file, run of rows) of the written table and a row_number within the run, so a frequent
length is spread over many tasks, and repeated rows are told apart by their row.

Ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. Texts of characters below U+0180
without long runs of white space or names of special tokens are encoded by the same vocabulary's ranks
in a faster library, which gives the same ids there (tested); the others by the tokenizer itself.

:func:`pack` returns one row per piece: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32
(of the ids as little-endian unsigned 32-bit numbers), sequence_id, offset; with ``with_ids`` also ids. Null and empty texts are
the end id alone. Rows with a null id or that repeat another are documents of their own. An empty table gives
an empty result. Extra columns are not read. :func:`sequences` fills the sequences with ids.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm.common import read, written

#: Bins filled alike: their pieces as (length, number in each bin), and how many bins.
Bins = tuple[tuple[tuple[int, int], ...], int]


@dataclass(frozen=True)
class Config:
    capacity: int = 1024
    end_id: int = 2
    #: Files of public_tokenizers: the tokenizer, and its vocabulary as ranks (None: the tokenizer encodes everything).
    tokenizer: str = "byte_bpe_50k.json"
    ranks: str | None = "byte_bpe_50k.tiktoken"
    with_ids: bool = False
    #: Rows of a file that are numbered together.
    run_rows: int = 50_000


_encoders: dict[Config, Callable[[str], list[int]]] = {}


def encoder(c: Config) -> Callable[[str], list[int]]:
    """Text to ids, without the end id; loaded once in each worker."""
    if c not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(public_tokenizers.path(c.tokenizer))
        slow = lambda text: exact.encode(text, add_special_tokens=False).ids
        if c.ranks is None:
            _encoders[c] = slow
        else:
            import tiktoken

            with open(public_tokenizers.path(c.ranks), "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            fast = tiktoken.Encoding(c.ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            special = [t.content.encode() for t in exact.get_added_tokens_decoder().values()]
            _encoders[c] = lambda text: slow(text) if odd(text.encode(), special) else fast(text)
    return _encoders[c]


#: Bytes of the characters below U+0180, controls but for three left out; those of U+0080 to U+00A0 are looked for apart.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), *range(0xC2, 0xC6)])
LOW = re.compile(rb"\xc2[\x80-\xa0]").search
SPACES = bytes.maketrans(b"\t\n\r", b"   ")


def odd(text: bytes, special: list[bytes]) -> bool:
    """Whether only the tokenizer itself is sure to encode the text as it does."""
    return bool(text.translate(None, PLAIN) or LOW(text) or b" " * 1000 in text.translate(SPACES) or any(s in text for s in special))


def pieces(docs: DataFrame, c: Config) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(c)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[tuple] = []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = np.frombuffer(array("I", [*encode(text or ""), c.end_id]), np.uint32).astype("<u4")
                    cuts = [0, *range((len(ids) - 1) % c.capacity + 1, len(ids), c.capacity), len(ids)]
                    for n, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append((k, n, i, j - i, zlib.crc32(ids[i:j].tobytes()), ids[i:j].astype(np.int32) if c.with_ids else None))
                which, *rest, ids = zip(*rows, strict=True)
                columns = [part.column(0).take(pa.array(which)), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
                if c.with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, NAMES + ["ids"] * c.with_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * c.with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


class Left:
    """The lengths that are left: how many of each, and which, in order."""

    def __init__(self, count: Mapping[int, int]) -> None:
        self.count = {s: n for s, n in count.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def longest(self, room: int, *used: int) -> int | None:
        """The longest that fits, the used ones taken away."""
        for k in range(bisect_right(self.sizes, room) - 1, -1, -1):
            if self.count[self.sizes[k]] > used.count(self.sizes[k]):
                return self.sizes[k]
        return None

    def shortest(self, n: int, above: int, *used: int) -> list[int]:
        """Up to ``n`` shortest pieces longer than ``above``, the used ones taken away."""
        out: list[int] = []
        for k in range(bisect_right(self.sizes, above), len(self.sizes)):
            out += [self.sizes[k]] * min(n, self.count[self.sizes[k]] - used.count(self.sizes[k]))
            if len(out) >= n:
                break
        return out[:n]

    def best_pair(self, room: int, used: int) -> int:
        """The greatest length of two pieces together that fit; 0 if none do."""
        pairs = ((x, self.longest(room - x, used, x)) for x in self.sizes[: bisect_right(self.sizes, room)] if self.count[x] > (x == used))
        return max((x + y for x, y in pairs if y), default=0)


def dominant(left: Left, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with j that dominates every other set with j that fits, of three pieces at most; None if none was found."""
    room = capacity - j
    low = left.shortest(3, 0, j)
    if not low or low[0] > room:
        return (j,)
    f = left.longest(room, j)
    if f == room or sum(low[:2]) > room or len(low) == 1:
        return j, f
    if len(low) == 3 and sum(low) <= room:
        return None
    if f >= left.best_pair(room, j):
        return j, f
    b = left.longest(room - f, j, f)
    if b is None:
        return None
    between = left.shortest(2, b, j)
    return (j, f, b) if len(between) < 2 or sum(between) > room else None


def reduced(count: Mapping[int, int], capacity: int) -> tuple[list[Bins], dict[int, int]]:
    """Bins that are in some best packing of the lengths, and the lengths that are left."""
    left, fixed, more = Left(count), [], True
    while more:
        more = False
        for j in reversed(left.sizes.copy()):
            while j in left.count and (together := dominant(left, j, capacity)):
                need = Counter(together)
                n = min(left.count[s] // k for s, k in need.items())
                for s, k in need.items():
                    left.take(s, n * k)
                fixed.append((tuple(need.items()), n))
                more = True
    return fixed, left.count


def best_fit(count: Mapping[int, int], capacity: int) -> list[Bins]:
    """Best fit decreasing, bins that are filled alike together.

    A bin that gets a piece is the best fit for the next one of that length too, while it has room, so it takes as many as go in.
    """
    room: list[int] = []  # with open bins, in order
    bins: dict[int, list[Bins]] = defaultdict(list)

    def put(filled: tuple[tuple[int, int], ...], n: int, rest: int) -> None:
        if n:
            if not bins[rest]:
                insort(room, rest)
            bins[rest].append((filled, n))

    for s in sorted(count, reverse=True):
        n = count[s]
        while n:
            k = bisect_left(room, s)
            if k < len(room):
                r = room[k]
                filled, m = bins[r].pop()
                if not bins[r]:
                    del room[k]
            else:
                r, filled, m = capacity, (), n
            each = r // s
            full = min(m, n // each)
            put((*filled, (s, each)), full, r - each * s)
            n -= full * each
            if m > full:
                if n:
                    put((*filled, (s, n)), 1, r - n * s)
                if filled:
                    put(filled, m - full - bool(n), r)
                n = 0
    return [x for same in bins.values() for x in same]


def planned(count: Mapping[int, int], capacity: int) -> list[Bins]:
    fixed, rest = reduced(count, capacity)
    return fixed + best_fit(rest, capacity)


def runs(plan: list[Bins]) -> np.ndarray:
    """Rows (length, first number, sequence, offset, in each): pieces of a length from this number on go to bins from this sequence on, so many in each. In order."""
    given, out, sequence = Counter(), [], 0
    for filled, n in plan:
        offset = 0
        for s, each in filled:
            out.append((s, given[s], sequence, offset, each))
            given[s] += n * each
            offset += s * each
        sequence += n
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """One row per piece; see the module's text."""
    run = F.floor(F.col("_metadata.row_index") / c.run_rows).alias("run")
    cut = written(pieces(docs, c), "pieces").select("*", F.col("_metadata.file_name").alias("file"), run, F.col("_metadata.row_index").alias("row"))
    group = ["length", "file", "run"]
    before = Window.partitionBy("length").orderBy("file", "run").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(cut.groupBy(*group).count().withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))), "piece-counts")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most ``capacity`` rows
    table = runs(planned(hist, c.capacity))
    numbered = cut.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy("row")) - 1)
    numbered = numbered.join(counts.drop("count").hint("merge"), group).withColumn("number", F.col("first") + F.col("at"))
    names = NAMES + ["ids"] * c.with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.concatenate([[0], np.cumsum([hist[s] for s in sorted(hist)])])  # of each length among all pieces
        sizes = np.array(sorted(hist), np.int64)
        first = start[np.searchsorted(sizes, table[:, 0])] + table[:, 1]
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "number"))
            r = table[np.searchsorted(first, start[np.searchsorted(sizes, length)] + number, "right") - 1]
            far, within = np.divmod(number - r[:, 1], r[:, 4])
            kept = [batch.column(batch.schema.get_field_index(x)) for x in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(r[:, 2] + far), pa.array(r[:, 3] + within * length)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{x} {cut.schema[x].dataType.simpleString()}" for x in names) + ", sequence_id long, offset long"
    return numbered.select(*names, "number").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: what :func:`pack` with ``with_ids`` has put in each sequence, at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


QUERIES = {"op11_best_fit_packing": op11_best_fit_packing}
ORACLES: dict[str, str] = {}
