"""Tables in a folder of any file system that change by whole commits: all of a commit is seen, or none of it.

A commit stages its rows as Parquet below a folder of its own. Only then a manifest, one small file, is renamed into place; it lists the
folders that count, in order, and the commits that are done. Readers go by the latest manifest, so a job that dies on the way leaves
everything as it was, and running it again ends the work. A rename onto a manifest that is there fails, so of two commits at once one
is told that it came late.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS, DATA = "manifests", "data"


class Conflict(Exception):
    """Another commit came first; read the tables again and commit anew."""


class Commits:
    """tables: name -> (schema, key columns). A later row of the same key replaces the earlier one."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[str, list[str]]]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._options = jvm.org.apache.hadoop.fs.Options
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self._conf)
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # --- manifests ---

    def version(self) -> int:
        """The number of the latest manifest; 0 if there is none."""
        folder = self._path(f"{self.root}/{MANIFESTS}")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{"done": names of commits, "parts": folders in order, each with its tables}."""
        n = self.version() if version is None else version
        if not n:
            return {"done": [], "parts": []}
        return json.loads(self.spark.read.text(f"{self.root}/{MANIFESTS}/{n:08d}.json", wholetext=True).first()[0])

    def _publish(self, manifest: dict, version: int) -> None:
        staged = self._path(f"{self.root}/{MANIFESTS}/_{uuid.uuid4().hex}")
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._options.Rename, 1)
        options[0] = self._options.Rename.NONE
        try:
            self._files.rename(staged, self._path(f"{self.root}/{MANIFESTS}/{version:08d}.json"), options)
        except Exception as e:
            if self.version() >= version:
                raise Conflict(f"version {version} of {self.root} is taken") from e
            raise

    # --- tables ---

    def _part(self, part: dict, table: str) -> DataFrame:
        return self.spark.read.schema(f"{self.tables[table][0]}, gone boolean").parquet(f"{self.root}/{DATA}/{part['folder']}/{table}")

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The table as the latest manifest, or the one of the version, has it."""
        schema, key = self.tables[table]
        parts = [self._part(p, table).withColumn("part", F.lit(i)) for i, p in enumerate(self.manifest(version)["parts"]) if table in p["tables"]]
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            rows = rows.groupBy(*key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (*key, "part"))), "part").alias("x")).select(*key, "x.*")
        return rows.filter("not gone").select(*self.spark.createDataFrame([], schema).columns)

    def commit(self, name: str, changes: dict[str, DataFrame], removals: dict[str, DataFrame] | None = None) -> bool:
        """Stage all changes (rows in the tables' columns) and removals (rows of keys), then publish; False if the commit is done already.

        A key has one row at most in a commit.
        """
        seen = self.version()
        manifest = self.manifest(seen)
        if name in manifest["done"]:
            return False
        folder, written = uuid.uuid4().hex, []
        for table in self.tables:
            rows = self._staged(table, changes.get(table), (removals or {}).get(table))
            if rows is not None:
                rows.write.parquet(f"{self.root}/{DATA}/{folder}/{table}")
                written.append(table)
        self._publish({"done": [*manifest["done"], name], "parts": [*manifest["parts"], {"folder": folder, "tables": written}]}, seen + 1)
        return True

    def _staged(self, table: str, changed: DataFrame | None, removed: DataFrame | None) -> DataFrame | None:
        schema, key = self.tables[table]
        empty = self.spark.createDataFrame([], schema)
        parts = [] if changed is None else [empty.unionByName(changed.select(*empty.columns)).withColumn("gone", F.lit(False))]
        if removed is not None:
            parts.append(empty.unionByName(removed.select(*key), allowMissingColumns=True).withColumn("gone", F.lit(True)))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def compact(self) -> None:
        """Put the tables as they stand into one folder, so that readers needn't go through all commits."""
        seen = self.version()
        manifest, folder = self.manifest(seen), uuid.uuid4().hex
        held = [t for t in self.tables if any(t in p["tables"] for p in manifest["parts"])]
        for table in held:
            self.read(table, seen).withColumn("gone", F.lit(False)).write.parquet(f"{self.root}/{DATA}/{folder}/{table}")
        self._publish({"done": manifest["done"], "parts": [{"folder": folder, "tables": held}] if held else []}, seen + 1)
