"""``routed_json``: one pass that writes good rows and dead letters to two places, seen together or not at all.

``df.write.format("routed_json").option("ok", "is_good").mode("append").save(path)`` sends rows whose ``is_good`` is true to ``good``, all others (null too) to
``dead``, as JSON lines of the other columns. A task writes new files and tells the driver their names and
row counts; the commit puts a manifest of them in place by a rename. If the job is aborted its files are removed, and
nothing was ever seen. Overwriting replaces what all manifests before have named.

``spark.read.format("routed_json").option("route", "dead").schema(...).load(path)`` reads the files that manifests name, one partition for each file;
without a schema it has the columns route, file and rows: what was committed.

Files are opened by tasks themselves, through Arrow, so the path must be one that executors reach that way: a shared folder, S3, HDFS.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

ROUTES = ("good", "dead")
COMMITTED = "route string, file string, rows long"


@dataclass
class Files(WriterCommitMessage):
    """Name and rows of a task's files, by route."""

    files: dict[str, tuple[str, int]]


@dataclass
class File(InputPartition):
    route: str
    name: str
    rows: int


def opened(path: str) -> tuple[fs.FileSystem, str]:
    store, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store, base.rstrip("/")


def manifests(path: str) -> list[dict]:
    """In order of commit."""
    store, base = opened(path)
    if store.get_file_info(f"{base}/manifests").type == fs.FileType.NotFound:
        return []
    found = []
    for f in store.get_file_info(fs.FileSelector(f"{base}/manifests")):
        if f.base_name.endswith(".json"):
            with store.open_input_stream(f.path) as s:
                found.append(json.loads(s.read()))
    found.sort(key=lambda m: (m["at"], m["id"]))
    last = max((k for k, m in enumerate(found) if m["overwrite"]), default=0)
    return found[last:]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, ok: str, overwrite: bool) -> None:
        self.path, self.ok, self.overwrite, self.id = path, ok, overwrite, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Files:
        store, base = opened(self.path)
        name = f"{self.id}-{uuid.uuid4().hex}.jsonl"
        out, n = {}, dict.fromkeys(ROUTES, 0)
        try:
            for batch in batches:
                at = batch.schema.get_field_index(self.ok)
                data = batch.select([c for c in batch.schema.names if c != self.ok]).to_pylist()
                for good, row in zip(batch.column(at).to_pylist(), data, strict=True):
                    route = ROUTES[0] if good else ROUTES[1]
                    if route not in out:
                        store.create_dir(f"{base}/{route}")
                        out[route] = store.open_output_stream(f"{base}/{route}/{name}")
                    out[route].write((json.dumps(row, ensure_ascii=False, default=str) + "\n").encode())
                    n[route] += 1
        finally:
            for s in out.values():
                s.close()
        return Files({r: (name, n[r]) for r in out})

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = opened(self.path)
        files = [(r, *x) for m in messages if m for r, x in m.files.items()]
        store.create_dir(f"{base}/manifests")
        staged = f"{base}/manifests/.{self.id}"
        with store.open_output_stream(staged) as s:
            s.write(json.dumps({"id": self.id, "at": time.time_ns(), "overwrite": self.overwrite, "files": files}).encode())
        store.move(staged, f"{base}/manifests/{self.id}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Every file of this job goes, also those of tasks that never told of theirs."""
        store, base = opened(self.path)
        for route in ROUTES:
            if store.get_file_info(f"{base}/{route}").type != fs.FileType.NotFound:
                for f in store.get_file_info(fs.FileSelector(f"{base}/{route}")):
                    if f.base_name.startswith(self.id):
                        store.delete_file(f.path)


class Reader(DataSourceReader):
    def __init__(self, path: str, route: str | None, schema: StructType) -> None:
        self.path, self.route, self.names = path, route, schema.names

    def partitions(self) -> list[InputPartition]:
        found = [File(*f) for m in manifests(self.path) for f in m["files"] if self.route in (None, f[0])]
        return found or [File("", "", 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.name:
            return
        if self.route is None:
            yield partition.route, partition.name, partition.rows
            return
        store, base = opened(self.path)
        with store.open_input_stream(f"{base}/{partition.route}/{partition.name}") as s, pa.PythonFile(s, "r") as f:
            left = b""
            while piece := f.read(1 << 20):
                *lines, left = (left + piece).split(b"\n")
                for line in lines:
                    row = json.loads(line)
                    yield tuple(row.get(c) for c in self.names)


class RoutedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "routed_json"

    def schema(self) -> str:
        return COMMITTED

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options["path"], self.options.get("route"), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self.options["path"], self.options.get("ok", "ok"), overwrite)
