"""Stored tables with keys: upserts that rewrite only the hash buckets they fall in, under versions.

A table lies in a fixed number of buckets by the hash of its keys. A version names one folder for
each bucket that holds rows. An upsert reads and rewrites the buckets of its keys alone, names them
together with all other folders in the next version, and makes that visible by a rename that fails
if another writer was first; then it is tried again on the newer version. Readers keep the version
that they began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.graph import cut
from ..operators.merge import replace_upserts

BUCKETS = 64


class KeyedTable:
    """A table below ``root`` whose rows are unique by ``keys``; all columns keep the types of the first upsert."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def _put(self, below: str, payload: dict) -> None:
        out = self._fs.create(self._path(below), False)
        out.write(bytearray(json.dumps(payload).encode()))
        out.close()

    def versions(self) -> list[int]:
        folder = self._path("versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v"))

    def manifest(self, version: int | None = None) -> dict:
        """A version's ``schema`` and folder by bucket; an empty one before the first upsert."""
        found = self.versions()
        if version is None and not found:
            return {"version": 0, "schema": None, "folders": {}}
        stream = self._fs.open(self._path(f"versions/v{found[-1] if version is None else version:08d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, base: dict, schema: StructType, folders: dict[str, str]) -> bool:
        """Whether the version after ``base`` is now this one."""
        version = base["version"] + 1
        temporary, final = f"versions/.{uuid.uuid4().hex}.tmp", self._path(f"versions/v{version:08d}.json")
        self._put(temporary, {"version": version, "schema": json.loads(schema.json()), "folders": folders})
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(temporary), final, none)
            return True
        except Exception:
            self._fs.delete(self._path(temporary), False)
            if self._fs.exists(final):
                return False
            raise

    def _read(self, manifest: dict, buckets: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        folders = [f"{self.root}/{f}" for b, f in manifest["folders"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the newest; None before the first upsert has no columns to give."""
        return self._read(self.manifest(version))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, order: Column | None = None, fold: Callable[[DataFrame], DataFrame] | None = None) -> dict:
        """Put rows in; gives the new version and the buckets that were rewritten.

        Of rows with the same keys the last by ``order`` stays; arrivals come after what is stored.
        Another ``fold`` gets stored and arriving rows, told apart by ``_new`` (0, 1), and gives one row
        for each key with the table's columns. A key with many arrivals is folded before the shuffle.
        """
        if not self.keys or set(self.keys) - set(rows.columns):
            raise ValueError(f"rows lack keys {sorted(set(self.keys) - set(rows.columns))}")
        arriving = cut(rows)
        touched = sorted(str(r[0]) for r in arriving.select(self._bucket()).distinct().collect())
        while True:
            base = self.manifest()
            if not touched and base["version"]:
                return {"version": base["version"], "rewritten": []}
            schema = StructType.fromJson(base["schema"]) if base["schema"] else arriving.schema
            if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in arriving.select(*schema.names).schema.fields] or len(schema.names) != len(arriving.columns):
                raise ValueError("arriving columns differ from the stored ones")
            both = arriving.select(*schema.names).withColumn("_new", F.lit(1))
            if base["version"]:
                both = self._read(base, touched).withColumn("_new", F.lit(0)).unionByName(both)
            at = F.struct(F.col("_new"), order) if order is not None else F.col("_new")
            folded = fold(both) if fold is not None else replace_upserts(both.withColumn("_at", at), self.keys, F.col("_at")).drop("_at")
            folder = f"data/{uuid.uuid4().hex}"
            out = folded.select(*schema.names).withColumn("_bucket", self._bucket())
            out.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
            made = {b: f"{folder}/_bucket={b}" for b in touched if self._fs.exists(self._path(f"{folder}/_bucket={b}"))}
            kept = {b: f for b, f in base["folders"].items() if b not in touched}
            if self._commit(base, schema, kept | made):
                return {"version": base["version"] + 1, "rewritten": [int(b) for b in touched]}
