r"""Personal data: patterns as a base, and a character-level BiLSTM-CRF that adds spans.

Base, leftmost and non-overlapping for each kind: e-mail address, IPv4 address, payment card (13 to
19 digits passing Luhn), phone number (``+``, 9 to 15 digits). A match that fails its test is
dropped without another try.

The model tags characters of overlapping windows. Every form that it is trained on holds a digit, an
``@`` or an "at" or "dot" in brackets, so the windows within ``window`` of one of these are read,
over the whole text. Where windows overlap, a character's scores are averaged, the window in which
it lies farther from an edge weighing more; then one path of tags is decoded over all of a stretch
of windows, however many, so a span is whole or absent wherever windows begin. A span is added if
its marginals are high, if it is what its kind says (a card number passes Luhn, an address has four
numbers up to 255, a phone number 9 to 15 digits, a mail address an at and a dot) in whatever form,
and if it doesn't touch a base span. Training spans are made by :func:`examples` (labelled spans in
invented prose, with forms that the patterns miss and with look-alikes), ``Config.examples`` windows of them.

Null texts are empty. Rows are judged one by one: repeated rows repeat their result, texts of any length are read whole,
ties don't occur (spans are ordered by place), an empty table gives an empty result, extra columns
are not read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweave.llm.common import read
from logweave.llm.crf import Shape, Tagger

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behinds only spare the search the inner digits of a run that has failed from its start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    """Same matches as the pattern local@domain, found from each @ so that long runs cost nothing."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 13 <= len(d) <= 19 and luhn(d)


def is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def base_spans(text: str) -> dict[str, list[Span]]:
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if _DIGIT.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if octets(m[0].split("."))]
        out["card"] = [m.span() for m in _CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if is_phone(m[0])]
    return out


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


@dataclass(frozen=True)
class Config:
    window: int = 96
    stride: int = 48
    #: Bound of the training windows.
    examples: int = 6000
    epochs: int = 8
    batch: int = 96
    rate: float = 0.02
    seed: int = 5
    #: Least mean marginal of a span's characters.
    confidence: float = 0.7
    #: Windows read at once.
    decode: int = 512
    #: Characters whose outside score leads by this much can't be in a span; stretches are decoded between them.
    margin: float = 5.0


#: 0: outside or past the end; printable ASCII; then other letters and other characters.
ALPHABET = 98
_ASCII = np.full(128, 97, np.uint8)
_ASCII[32:127] = np.arange(1, 96)
_ASCII[[9, 10, 13]] = 1


def codes(text: str) -> np.ndarray:
    point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(point < 128, _ASCII[np.minimum(point, 127)], np.where(point < 0x2000, 96, 97)).astype(np.uint8)


def _luhn_digits(rng: np.random.Generator, n: int) -> str:
    body = "".join(map(str, rng.integers(0, 10, n - 1)))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


#: Words around spans in training texts, beside invented ones.
WORDS = "the a of to and in is it for at dot on with from by call mail phone card number server host address write reach me us my our new old please contact office desk account paid order".split()


def example(rng: np.random.Generator, length: int) -> tuple[str, list[tuple[str, int, int]]]:
    """A text of about ``length`` characters with labelled spans, and look-alikes that carry none."""
    pick = lambda *a: a[rng.integers(len(a))]
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    syllables = lambda: "".join(pick("th", "er", "on", "an", "re", "le", "ung", "eau", "ó", "ción", "é", "sch", "wh", "ing", "a", "o", "st", "mi", "ka") for _ in range(rng.integers(1, 4)))
    word = lambda: pick(*WORDS) if rng.random() < 0.3 else syllables()

    plain = lambda: "".join(pick("th", "er", "on", "an", "re", "le", "ung", "jo", "max", "li", "ber", "na", "wh", "ing", "sa", "o", "st", "mi", "ka") for _ in range(rng.integers(1, 4)))

    def email() -> str:
        user, host = plain() + pick("", f".{num(2)}", f"_{num(1)}", num(3), f".{plain()}", f"-{plain()}"), pick(plain(), plain(), "mail", "web", "post") + pick("", num(1), f"-{plain()}")
        at = pick("@", "@", " @ ", " [at] ", "(at)", " {at} ", " <at> ", "[AT]")
        dot = pick(".", ".", ".", " [dot] ", "(dot)", " {dot} ")
        return user + at + host + dot + pick("", "", f"{plain()}{dot}") + pick("com", "org", "net", "de", "fr", "io", "edu")

    def ip() -> str:
        return pick(".", ".", ".", "[.]", " . ").join(str(rng.integers(0, 256)) for _ in range(4))

    def card() -> str:
        d = _luhn_digits(rng, int(pick(16, 16, 16, 15, 13, 19)))
        return pick("", "", " ", "-", ".", "  ", "/").join(d[k : k + 4] for k in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return pick(f"+1 ({a}) {b}-{c}", f"+{num(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{num(2)} {a} {b}{num(2)}", f"+1/{a}/{b}/{c}")

    def other() -> str:
        return pick(
            f"{num(1)}.{num(1)}", num(2), num(4), f"{num(4)}-{num(2)}-{num(2)}", f"version {num(1)}.{num(1)}.", f"#{num(6)}", f"${num(3)}.{num(2)}", f"{num(2)}:{num(2)}",
            f"{num(4)}-{num(2)}-{num(2)} {num(2)}:{num(2)}:{num(2)}", f"{num(4)}/{num(2)}/{num(2)}", f"{num(3)}-{num(1)}-{num(2)}-{num(6)}-{num(1)}", f"({word()})", f"[{num(2)}]",
            f'token = "{rng.bytes(20).hex()}"', f"page {num(3)}", f"{num(1)},{num(3)},{num(3)}", f"300.{num(3)}.1.999", num(20), num(8), f"@{word()}", f"{word()}{num(2)}",
            f"{word()} [at] {word()}", f"({num(1)}, {num(2)})", f"http://{word()}.example.com/{num(4)}",
        )

    kinds = {"email": email, "ip": ip, "card": card, "phone": phone}
    text, spans = "", []
    while len(text) < length:
        roll = rng.random()
        if roll < 0.10:
            k = KINDS[rng.integers(4)]
            made = kinds[k]()
            spans.append((k, len(text), len(text) + len(made)))
        elif roll < 0.18:
            made = other()
        else:
            made = word()
            made = made.capitalize() if rng.random() < 0.15 else made
        text += made + pick(" ", " ", " ", " ", ", ", ". ", ".\n", "### ", "!! ", "&&& ", "*** ")
    return text, spans


def tags_of(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """0 outside; 1 + 2 * kind at a span's begin, one more within."""
    y = np.zeros(n, np.int64)
    for k, a, b in spans:
        y[a:b] = 2 + 2 * KINDS.index(k)
        y[a] -= 1
    return y


def examples(c: Config, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows cut at random from :func:`example` texts, whole spans or not."""
    rng = np.random.default_rng(seed)
    x, y = np.zeros((c.examples, c.window), np.uint8), np.zeros((c.examples, c.window), np.int64)
    for k in range(c.examples):
        text, spans = example(rng, c.window + 40)
        at, tags = int(rng.integers(0, 40)), tags_of(len(text), spans)
        row = codes(text)[at : at + c.window]
        cut = int(rng.integers(20, c.window)) if rng.random() < 0.1 else c.window
        row, tag = row[:cut], tags[at : at + c.window][:cut]
        if len(tag) and tag[0] and tag[0] % 2 == 0:
            tag[0] -= 1
        x[k, : len(row)], y[k, : len(tag)] = row, tag
    return x, y


@lru_cache(maxsize=4)
def trained(c: Config = Config()) -> Tagger:
    n = 1 + 2 * len(KINDS)
    allowed, first = np.ones((n, n), bool), np.ones(n, bool)
    for within in range(2, n, 2):
        allowed[:, within] = False
        allowed[[within - 1, within], within] = True
    model = Tagger.fresh(Shape(ALPHABET, n), allowed, first, c.seed)
    x, y = examples(c, c.seed)
    model.train(x, y, c.epochs, c.batch, c.rate, c.seed)
    return model


#: In every form of training: digits, @, and at or dot in brackets.
_TRIGGER = re.compile(r"[0-9@]|[\[({<]\s*(?:at|dot)\s*[\])}>]", re.IGNORECASE)
_AT = re.compile(r"@|[\[({<]\s*at\s*[\])}>]", re.IGNORECASE)
_DOT = re.compile(r"\.|[\[({<]\s*dot\s*[\])}>]", re.IGNORECASE)


def passes(kind: str, text: str) -> bool:
    """Whether a span that the model proposes is what its kind says; its form is the model's to judge."""
    if kind == "email":
        parts = _AT.split(text)
        return len(parts) == 2 and re.search(r"\w", parts[0]) is not None and re.search(r"\w", _DOT.split(parts[1])[0]) is not None and _DOT.search(parts[1]) is not None
    if any(x.isalpha() for x in text):
        return False
    if kind == "ip":
        numbers = re.findall(r"[0-9]+", text)
        return len(numbers) == 4 and octets(numbers)
    return is_card(text) if kind == "card" else is_phone(text)


#: Windows of a stretch that are read together, and those read again on both sides of a cut of a longer one.
PART, AROUND = 256, 4


def parts_of(text: str, c: Config) -> list[tuple[int, int, int, int]]:
    """The windows to read: (first, last, characters from, to), stretches cut into parts; spans that begin in the characters are the part's."""
    trigger = np.fromiter((m.start() for m in _TRIGGER.finditer(text)), np.int64)
    if not len(trigger):
        return []
    n = max(0, -(-(len(text) - c.window) // c.stride)) + 1
    near = range(-(-(-2 * c.window) // c.stride), c.window // c.stride + 1)
    every = np.unique(np.concatenate([trigger // c.stride + k for k in near]).clip(0, n - 1))
    out = []
    for run in np.split(every, np.flatnonzero(np.diff(every) > 1) + 1):
        for at in range(0, len(run), PART):
            first, last = int(run[at]), int(run[min(at + PART, len(run)) - 1])
            low = first * c.stride if at else 0
            high = (last + 1) * c.stride if at + PART < len(run) else len(text)
            out.append((max(first - AROUND, int(run[0])), min(last + AROUND, int(run[-1])), low, high))
    return out


def scores_of(text: str, first: int, last: int, e: np.ndarray, c: Config) -> np.ndarray:
    """Averaged scores of the characters that windows ``first`` to ``last`` read; ``e`` is [windows, steps, tags]."""
    weight = (1.0 + np.minimum(np.arange(c.window), np.arange(c.window)[::-1])).astype(np.float32)
    total = np.zeros(((last - first) * c.stride + c.window, e.shape[2]), np.float32)
    mass = np.zeros(len(total), np.float32)
    for k in range(last - first + 1):
        at = slice(k * c.stride, k * c.stride + c.window)
        total[at] += e[k] * weight[:, None]
        mass[at] += weight
    return (total / mass[:, None])[: len(text) - first * c.stride]


def decoded(segments: list[np.ndarray], model: Tagger) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, tags, marginals of the tags) of the segments of scores in which the best path has a span."""
    order = sorted(range(len(segments)), key=lambda k: len(segments[k]))
    while order:
        size = max(1, 50_000 // len(segments[order[-1]]))
        some, order = order[-size:], order[:-size]
        e = np.full((len(segments[some[-1]]), len(some), segments[some[0]].shape[1]), -1e4, np.float32)
        e[:, :, 0] = 0
        for r, k in enumerate(some):
            e[: len(segments[k]), r] = segments[k]
        e[0, :, 2::2] = -1e4  # a span can't begin within
        tags = model.decode(e)
        hit = np.flatnonzero(tags.any(1))
        if len(hit):
            m = model.marginals(e[:, hit])[0]
            sure = np.take_along_axis(m, tags[hit].T[:, :, None].astype(np.int64), 2)[:, :, 0].T
            for r, p in zip(hit, sure, strict=True):
                n = len(segments[some[r]])
                yield some[r], tags[r, :n], p[:n]


def added_spans(texts: list[str], base: list[dict[str, list[Span]]], model: Tagger, c: Config) -> list[dict[str, list[Span]]]:
    """The model's spans for each text, beside the base spans."""
    parts = [(i, *p) for i, text in enumerate(texts) if text for p in parts_of(text, c)]
    arrays: dict[int, np.ndarray] = {}
    segments: list[np.ndarray] = []
    where: list[tuple[int, int, int, int]] = []
    at = 0
    while at < len(parts):
        to, n = at, 0
        while to < len(parts) and (to == at or n + parts[to][2] - parts[to][1] < c.decode):
            n += parts[to][2] - parts[to][1] + 1
            to += 1
        x, r = np.zeros((n, c.window), np.uint8), 0
        for i, first, last, _, _ in parts[at:to]:
            if i not in arrays:
                arrays = {i: codes(texts[i])}
            for w in range(first, last + 1):
                cut = arrays[i][w * c.stride : w * c.stride + c.window]
                x[r, : len(cut)] = cut
                r += 1
        e, r = model.emissions(x).transpose(1, 0, 2), 0
        for i, first, last, low, high in parts[at:to]:
            score = scores_of(texts[i], first, last, e[r : r + last - first + 1], c)
            r += last - first + 1
            live = np.flatnonzero(score[:, 1:].max(1) > score[:, 0] - c.margin)
            for run in np.split(live, np.flatnonzero(np.diff(live) > 16) + 1) if len(live) else ():
                begin, end = max(0, int(run[0]) - 8), min(len(score), int(run[-1]) + 9)
                segments.append(score[begin:end])
                where.append((i, first * c.stride + begin, low, high))
        at = to
    found: dict[int, list[tuple[int, int, str]]] = {}
    for k, tags, sure in decoded(segments, model):
        i, begin, low, high = where[k]
        for b in np.flatnonzero(tags % 2 == 1):
            kind, end = KINDS[(tags[b] - 1) // 2], b + 1
            while end < len(tags) and tags[end] == tags[b] + 1:
                end += 1
            if low <= begin + b < high and sure[b:end].mean() >= c.confidence:
                found.setdefault(i, []).append((begin + int(b), begin + int(end), kind))
    out: list[dict[str, list[Span]]] = [{k: [] for k in KINDS} for _ in texts]
    for i, spans in found.items():
        taken = sorted(x for k in KINDS for x in base[i][k])
        starts, reach, last = [x for x, _ in taken], list(accumulate((y for _, y in taken), max)), 0
        for a, b, kind in sorted(spans):
            before = bisect_left(starts, b)
            if a >= last and (before == 0 or reach[before - 1] <= a) and passes(kind, texts[i][a:b]):
                out[i][kind].append((a, b))
                last = b
    return out


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about 4 MB."""
    at, run, size = 0, [], 0
    for k, v in enumerate(column):
        run.append(v.as_py() or "")
        size += len(run[-1])
        if size >= 4_000_000:
            yield at, run
            at, run, size = k + 1, [], 0
    if run:
        yield at, run


def find_pii(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added. Counts are of base spans."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trained(c))  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _texts(batch.column(1)):
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, base, model.value, c)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        *(pa.array([len(b[k]) for b in base], pa.int64()) for k in KINDS),
                        pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()),
                        pa.array([listed({k: b[k] + m[k] for k in KINDS}) for b, m in zip(base, more, strict=True)], pa.string()),
                        pa.array([sum(map(len, m.values())) for m in more], pa.int64()),
                    ],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: dict[str, list[Span]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans go together."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k in KINDS for a, b in spans[k]):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, c: Config = Config()) -> DataFrame:
    """Pipeline stage: all documents, personal data replaced; n_chars follows the text where it changes."""
    names, model = docs.columns, spark.sparkContext.broadcast(trained(c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = names.index("text")
        for batch in batches:
            for at, texts in _texts(batch.column(t)):
                part = batch.slice(at, len(texts))
                base = [base_spans(x) for x in texts]
                more = added_spans(texts, base, model.value, c)
                new = [redacted(x, {k: b[k] + m[k] for k in KINDS}) for x, b, m in zip(texts, base, more, strict=True)]
                changed = [x != y for x, y in zip(texts, new, strict=True)]
                if any(changed):
                    columns, old = part.columns, part.column(t).to_pylist()
                    columns[t] = pa.array([y if z else x for x, y, z in zip(old, new, changed, strict=True)], part.schema.field(t).type)
                    if "n_chars" in names:
                        n = names.index("n_chars")
                        columns[n] = pa.array([len(y) if z else x for x, y, z in zip(part.column(n).to_pylist(), new, changed, strict=True)], part.schema.field(n).type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)


QUERIES = {"op6_pii": op6_pii}
ORACLES: dict[str, str] = {}
