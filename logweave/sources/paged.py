"""A Spark data source over paged JSON endpoints: ranked lists, listings by user, single records.

Options: ``fetch`` (``module:function``, called as fetch(url) and returning parsed JSON; by default HTTP GET), ``url``
(with ``{key}`` and ``{page}``), ``keys`` (comma-joined; one input partition for each), ``page_size`` (a shorter page is
the last; 0: a single request), ``field`` (name of the list in a page; empty: the page is the list or record), ``attempts``.

Rows: key, pos (place within the key), record (JSON text), error (null if fetched). A key that fails after all attempts
is one row with its error, so nothing is lost silently.

``spark.readStream`` follows listings that only grow, at their end. The offset of a key is its number of records; a micro-batch takes
what is new, one partition for each ``pages_per_task`` pages, and reads the same records again if it is repeated. The
end of a listing is found by doubling steps and halving them, so that looking costs a few requests for each key. A page that can't be fetched fails its task, which Spark
tries again; a key whose end can't be found keeps its offset until the next batch, but fails the stream when that has just begun, since where it was isn't known then.
"""

from __future__ import annotations

import importlib
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RETRY = frozenset((429, 500, 502, 503, 504))


class RetryLater(Exception):
    """A failure worth another attempt, after some seconds if the server says so."""

    def __init__(self, message: str, after: float | None = None) -> None:
        super().__init__(message)
        self.after = after


def http_json(url: str) -> object:
    try:
        with urllib.request.urlopen(url, timeout=30) as r:  # noqa: S310
            return json.load(r)
    except urllib.error.HTTPError as e:
        if e.code in RETRY:
            wait = e.headers.get("Retry-After") or ""
            raise RetryLater(str(e), float(wait) if wait.isdigit() else None) from e
        raise
    except OSError as e:
        raise RetryLater(str(e)) from e


def attempt(fetch: Callable[[str], object], url: str, attempts: int, pause: Callable[[float], None] = time.sleep) -> object:
    """Up to ``attempts`` tries, waiting twice as long each time (and a random part more), or as told."""
    for k in range(attempts):
        try:
            return fetch(url)
        except RetryLater as e:
            if k + 1 == attempts:
                raise
            pause(e.after if e.after is not None else 2.0**k + random.random())
    raise AssertionError


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "key string, pos int, record string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return PagedStream(dict(self.options))


class Key(InputPartition):
    def __init__(self, key: str) -> None:
        self.key = key


class Records(InputPartition):
    """Records ``first`` to before ``end`` of a key."""

    def __init__(self, key: str, first: int, end: int) -> None:
        self.key, self.first, self.end = key, first, end


class Pages:
    """Requests for pages of a listing."""

    def __init__(self, options: dict) -> None:
        self.options = o = {k.lower(): v for k, v in options.items()}
        module, _, function = o.get("fetch", "logweave.sources.paged:http_json").partition(":")
        self.fetch = getattr(importlib.import_module(module), function)
        self.size, self.field, self.attempts = int(o.get("page_size", 0)), o.get("field", ""), int(o.get("attempts", 3))
        self.keys = o.get("keys", "").split(",")

    def page(self, key: str, number: int) -> list:
        """Records of a page, from 1."""
        got = attempt(self.fetch, self.options["url"].format(key=key, page=number), self.attempts)
        rows = got.get(self.field, []) if self.field and isinstance(got, dict) else got
        return rows if isinstance(rows, list) else [rows]

    def end(self, key: str, known: int) -> int:
        """Records that the key has, of which ``known`` are known."""
        low, step = known // self.size, 1  # so many pages are full
        while (n := len(self.page(key, low + step))) == self.size:
            low, step = low + step, step * 2
        high = low + step  # a page that isn't full, with n records
        while high - low > 1:
            at = (low + high) // 2
            m = len(self.page(key, at))
            low, high, n = (at, high, n) if m == self.size else (low, at, m)
        return max(known, low * self.size + n)


class PagedStream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.pages = Pages(options)
        if not self.pages.size:
            raise ValueError("a stream needs a page_size")
        self.most = int(self.pages.options.get("pages_per_task", 100))
        self.told: dict = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return dict.fromkeys(self.pages.keys, 0)

    def latestOffset(self) -> dict:  # noqa: N802
        for key in self.pages.keys:
            try:
                self.told[key] = self.pages.end(key, self.told.get(key, 0))
            except Exception:
                if key not in self.told:
                    raise
        return dict(self.told)

    def partitions(self, start: dict, end: dict) -> list[Records]:
        size = self.most * self.pages.size
        return [Records(k, max(first, start.get(k, 0)), min(first + size, n)) for k, n in end.items() for first in range(start.get(k, 0) // size * size, n, size) if n > start.get(k, 0)]

    def read(self, partition: Records) -> Iterator[tuple]:
        size = self.pages.size
        for number in range(partition.first // size, -(-partition.end // size)):
            for k, r in enumerate(self.pages.page(partition.key, number + 1)):
                pos = number * size + k
                if partition.first <= pos < partition.end:
                    yield partition.key, pos, json.dumps(r), None

    def commit(self, end: dict) -> None:
        pass


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Key]:
        return [Key(k) for k in self.options.get("keys", "").split(",")]

    def read(self, partition: Key) -> Iterator[tuple]:
        o = self.options
        module, _, function = o.get("fetch", "logweave.sources.paged:http_json").partition(":")
        fetch, size, field = getattr(importlib.import_module(module), function), int(o.get("page_size", 0)), o.get("field", "")
        page = pos = 0
        while True:
            try:
                got = attempt(fetch, o["url"].format(key=partition.key, page=page + 1), int(o.get("attempts", 3)))
            except Exception as e:  # noqa: BLE001  (becomes a dead letter)
                yield partition.key, pos, None, f"{type(e).__name__}: {e}"
                return
            rows = got.get(field, []) if field and isinstance(got, dict) else got
            rows = rows if isinstance(rows, list) else [rows]
            for r in rows:
                yield partition.key, pos, json.dumps(r), None
                pos += 1
            page += 1
            if not size or len(rows) < size:
                return
