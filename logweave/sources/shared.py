"""Files that driver and executors share: the folder, and the few operations on single files that a commit needs, on any store that Hadoop reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one that spark.checkpoint.dir names; where that is unset, as in tests, below a local one, but not on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(base or f'file://{tempfile.mkdtemp(prefix="shared-")}').rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Store:
    """Small files below a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(self._path("")).toUri(), conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> dict[str, int]:
        """Entries of a folder with the milliseconds of their last change; none if it isn't there."""
        if not self.fs.exists(self._path(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(self._path(name))}

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Writes a file that isn't there yet: whole, by a rename that replaces nothing. False if somebody else was first."""
        staged = self._path(f"{name.rpartition('/')[0]}/.staged-{uuid.uuid4().hex}")
        stream = self.fs.create(staged, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.context.rename(staged, self._path(name), self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:  # noqa: BLE001
            if "FileAlreadyExists" not in str(e):
                raise
            self.fs.delete(staged, False)
            return False
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
