"""Tables whose changes are seen whole or not at all.

A change is written to a new folder first, and nobody reads it. Then a manifest that names every folder that counts takes the
place of the last one: it gets the next version's name by a rename that fails if that name is taken, so of
two writers one is first, and the other tries again on top of it. Readers open the last
manifest and see its folders only; what a lost job left behind is never read, and :meth:`Committed.vacuum` removes it.

A change carries its writer's name and a number that grows. A number that the writer has committed before, or a
smaller one, changes nothing, so a retried job or micro-batch is written once.

With a ``group`` a change can replace whole groups (:meth:`Committed.replace`): the older rows of its groups stay in their files but are no
longer seen, by a join with the groups that were replaced; :meth:`Committed.compact` writes what is seen anew. Null is a group like others.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.sources.shared import Store

#: Rows of replaced groups up to which they are broadcast, after counting.
BROADCAST_ROWS = 200_000


class Committed:
    def __init__(self, spark: SparkSession, path: str, group: str | None = None) -> None:
        self.spark, self.path, self.group = spark, path.rstrip("/"), group
        self.store = Store(spark, self.path)

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.store.names("manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """parts in order (folder, groups: whether it replaces groups), numbers by writer, schema, version."""
        last = version if version is not None else max(self.versions(), default=0)
        return json.loads(self.store.text(f"manifests/{last:012}.json")) if last else {"version": 0, "parts": [], "numbers": {}, "schema": None}

    def last_number(self, writer: str) -> int:
        return self.manifest()["numbers"].get(writer, -1)

    def append(self, df: DataFrame, writer: str, number: int) -> bool:
        """Adds rows. False if the writer has committed this number."""
        return self._commit(df, writer, number, None)

    def replace(self, df: DataFrame, writer: str, number: int, groups: DataFrame | None = None) -> bool:
        """Puts ``df`` in the place of all rows of its groups, and of ``groups``, which may have no rows any more."""
        if not self.group:
            raise ValueError("the table has no group")
        named = df.select(self.group)
        return self._commit(df, writer, number, (named if groups is None else named.union(groups.select(self.group))).distinct())

    def _commit(self, df: DataFrame, writer: str, number: int, groups: DataFrame | None) -> bool:
        if self.last_number(writer) >= number:
            return False
        folder = uuid.uuid4().hex
        self._stage(df, folder, groups)
        while True:
            old = self.manifest()
            if old["numbers"].get(writer, -1) >= number:
                self._drop(folder)
                return False
            if old["schema"] and T.StructType.fromJson(old["schema"]).simpleString() != df.schema.simpleString():
                self._drop(folder)
                raise ValueError(f"the table has {T.StructType.fromJson(old['schema']).simpleString()}, not {df.schema.simpleString()}")
            new = {"version": old["version"] + 1, "parts": [*old["parts"], {"folder": folder, "groups": groups is not None}], "numbers": old["numbers"] | {writer: number}, "schema": df.schema.jsonValue()}
            if self._swap(new):
                return True

    def _stage(self, df: DataFrame, folder: str, groups: DataFrame | None) -> None:
        df.write.parquet(f"{self.path}/data/part={folder}")
        if groups is not None:
            groups.write.parquet(f"{self.path}/groups/part={folder}")

    def _swap(self, manifest: dict) -> bool:
        return self.store.put(f"manifests/{manifest['version']:012}.json", json.dumps(manifest))

    def _drop(self, folder: str) -> None:
        for kind in ("data", "groups"):
            self.store.remove(f"{kind}/part={folder}")

    def _parts(self, kind: str, folders: list[str], schema: T.StructType, order: DataFrame) -> DataFrame:
        read = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("part", T.StringType())])).option("basePath", f"{self.path}/{kind}")
        return read.parquet(*[f"{self.path}/{kind}/part={f}" for f in folders]).join(F.broadcast(order), "part").drop("part")  # one row for each part

    def read(self, version: int | None = None) -> DataFrame:
        """The rows that count, now or at a version."""
        m = self.manifest(version)
        if not m["parts"]:
            raise ValueError(f"nothing has been committed to {self.path}")
        schema = T.StructType.fromJson(m["schema"])
        order = self.spark.createDataFrame([(p["folder"], k) for k, p in enumerate(m["parts"])], "part string, __order int")
        rows = self._parts("data", [p["folder"] for p in m["parts"]], schema, order)
        replacing = [p["folder"] for p in m["parts"][1:] if p["groups"]]  # the first replaces nothing
        if not replacing:
            return rows.drop("__order")
        last = self._parts("groups", replacing, T.StructType([schema[self.group]]), order).groupBy(F.col(self.group).alias("__group")).agg(F.max("__order").alias("__last"))
        last = F.broadcast(last) if last.count() <= BROADCAST_ROWS else last
        seen = rows.join(last, F.col(self.group).eqNullSafe(F.col("__group")), "left").where("__last IS NULL OR __order >= __last")
        return seen.select(*schema.names)

    def compact(self) -> bool:
        """Writes what is seen as one part. False if somebody else committed meanwhile; then nothing has changed."""
        old, folder = self.manifest(), uuid.uuid4().hex
        self._stage(self.read(old["version"]), folder, None)
        done = self._swap(old | {"version": old["version"] + 1, "parts": [{"folder": folder, "groups": False}]})
        if not done:
            self._drop(folder)
        return done

    def vacuum(self, older_seconds: float = 7 * 24 * 3600) -> int:
        """Removes folders that the last manifest doesn't name and that are older; returns how many."""
        named = {f"part={p['folder']}" for p in self.manifest()["parts"]}
        gone = [f for kind in ("data", "groups") for f, at in self.store.names(kind).items() if f not in named and at < (time.time() - older_seconds) * 1000 + 1]
        for f in set(gone):
            self._drop(f.removeprefix("part="))
        return len(set(gone))

    def sink(self, writer: str) -> Callable[[DataFrame, int], None]:
        """For foreachBatch: every micro-batch once, whatever is retried."""
        return lambda batch, number: self.append(batch, writer, number) and None
