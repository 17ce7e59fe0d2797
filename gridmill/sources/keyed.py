"""Tables with one row per key, kept in parts that are rewritten alone (rows S15, X03, X04).

A table lies in parts: hash buckets of its keys, or the values of an expression over them
(the day of an hour, say). An upsert reads and writes only the parts that its rows fall
into; each new part is a folder of its own version, and a manifest says which version of
each part holds. The manifest is swapped by a rename, so a reader sees the table before
or after an upsert and never between, and of two writers that start from one version the
second fails. A manifest also holds the last batch of each source that was applied, so a
batch that comes again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridmill.operators.dedupe import dedupe
from gridmill.operators.guards import require_columns

BUCKETS = 32
PART = "_part"


class Conflict(RuntimeError):
    """Another writer was first."""


class Folder:
    """Small files under a path in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path
        self._at = self._path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at)] if self._fs.exists(self._at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """A file that was not there; it appears whole or not at all."""
        draft, final = self._path(f"{self.path}/.{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"{final.toString()} is there already")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


class KeyedTable:
    """A table of one row per key, the last by ``order``.

    ``part`` is a SQL expression over the keys that gives a row's part as text; without
    it the keys' hash gives one of ``buckets`` parts. Both are fixed when the table is
    first written. A part is written by one task, so ``buckets`` is to be chosen by the
    size the table is to have (some hundred megabytes a part).
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str, part: str | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), order
        self.rule = part or f"cast(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {buckets}) as string)"
        self._log = Folder(spark, f"{self.path}/manifest")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        """A table that is there, with the keys, order and parts it was written with."""
        found = _newest(Folder(spark, f"{path.rstrip('/')}/manifest"))
        if found is None:
            raise ValueError("no such table")
        table = cls(spark, path, found["keys"], found["order"])
        table.rule = found["rule"]
        return table

    def manifest(self) -> dict | None:
        """The newest manifest: version, rule, keys, order, schema, parts (the folder of each), applied (the last batch of each source)."""
        found = _newest(self._log)
        if found and any(found[k] != v for k, v in (("rule", self.rule), ("keys", self.keys), ("order", self.order))):
            raise ValueError("the table was written with other keys, parts or order")
        return found

    def _read(self, manifest: dict, parts: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        files = [f"{self.path}/data/{folder}" for p, folder in sorted(manifest["parts"].items()) if parts is None or p in parts]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The table as it is now, or some of its parts alone."""
        manifest = self.manifest()
        if manifest is None:
            raise ValueError("no such table")
        return self._read(manifest, None if parts is None else [_named(p) for p in parts])

    def upsert(self, rows: DataFrame, source: str | None = None, batch: int | None = None) -> dict:
        """Puts rows in, the last of each key kept. Gives the version and the parts rewritten: none if the batch of this source was applied before.

        Columns must be those of the table. Rows with a null key are a key like others.
        Rows combine by key before the shuffle, which deals them out by part once.
        """
        require_columns(rows, *self.keys, self.order)
        old = self.manifest()
        if old and batch is not None and old["applied"].get(source, -1) >= batch:
            return {"version": old["version"], "parts": []}
        schema = StructType.fromJson(old["schema"]) if old else rows.schema
        if set(schema.names) != set(rows.columns):
            raise ValueError("the columns of both sides must be the same")
        version = old["version"] + 1 if old else 0
        # A null part has a name that no value has.
        named = F.coalesce(F.concat(F.lit("p"), F.expr(self.rule)), F.lit("null"))
        fresh = dedupe(rows.select(*schema.names), self.keys, self.order, "last").withColumn(PART, named).persist()
        folder, parts = f"{self.path}/data/{version}", dict(old["parts"]) if old else {}
        try:
            touched = sorted(r[0] for r in fresh.select(PART).distinct().collect())
            both = fresh
            if known := [p for p in touched if p in parts]:
                both = self._read(old, known).withColumn(PART, named).unionByName(fresh)
            if touched:
                dealt = both.repartition(min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))), PART)
                # A writer that failed here before left a folder that no manifest names; it is written over.
                dedupe(dealt, [PART, *self.keys], self.order, "last").select(*schema.names, PART).write.mode("overwrite").option("compression", "zstd").partitionBy(PART).parquet(folder)
        finally:
            fresh.unpersist()
        parts |= {unquote(n[len(PART) + 1 :]): f"{version}/{n}" for n in (Folder(self.spark, folder).names() if touched else []) if n.startswith(f"{PART}=")}
        applied = dict(old["applied"]) if old else {}
        if batch is not None:
            applied[source] = batch
        made = {"version": version, "rule": self.rule, "keys": self.keys, "order": self.order, "schema": json.loads(schema.json()), "parts": parts, "applied": applied}
        self._log.write_new(str(version), json.dumps(made))
        return {"version": version, "parts": [None if p == "null" else p[1:] for p in touched]}

    def vacuum(self) -> int:
        """Removes versions of parts that the newest manifest does not name, and older manifests. Readers of older versions must be done. Gives the number of part folders removed."""
        manifest, removed = self.manifest(), 0
        if manifest is None:
            return 0
        data, named = Folder(self.spark, f"{self.path}/data"), set(manifest["parts"].values())
        for version in data.names():
            folder = Folder(self.spark, f"{self.path}/data/{version}")
            for part in folder.names():
                if part.startswith(f"{PART}=") and f"{version}/{part}" not in named:
                    folder.remove(part)
                    removed += 1
        for n in self._log.names():
            if n.isdigit() and int(n) < manifest["version"]:
                self._log.remove(n)
        return removed


def _newest(log: Folder) -> dict | None:
    versions = [int(n) for n in log.names() if n.isdigit()]
    return json.loads(log.read(str(max(versions)))) if versions else None


def _named(part: str | None) -> str:
    return "null" if part is None else f"p{part}"
