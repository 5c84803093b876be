"""Size-tiered compaction of immutable shards under an atomically committed, versioned manifest.

A store is a folder with ``data/`` (immutable Parquet files, one folder per write) and ``manifest/``
(a small JSON file per version, and parts). Arrivals are appended as small shards. Compaction takes
the shards of a size tier, once there are enough of them, and merges them into files of about the
target size. A version lists parts, and a part lists shards; parts are immutable, so a commit writes
those that it changes and names the others. A version is written under a temporary name and becomes
visible by one rename that fails if the version exists, so readers and rival writers see whole
versions only.

Rows are read, merged and written by DataFrame operations alone; only file names and sizes pass
through the driver. The target bounds their number: at 100 TB take 1 GiB, which makes 100,000 files.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows of an arriving shard, bytes of a merged file, ratio of sizes of neighbouring tiers, and shards of a tier that start a merge.
ARRIVAL_ROWS = 2000
TARGET_BYTES = 64 << 20
TIER_BASE = 4
FAN_IN = 4
MiB = 1 << 20
#: Shards of a part, versions that stay readable, and seconds that files of no version are left alone, as a writer may be about to commit them.
PART_SHARDS = 5000
KEPT_VERSIONS = 2
GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Shard:
    """A live file: its path below the store, and its bytes."""

    path: str
    bytes: int

    @property
    def tier(self) -> int:
        """Tier 0 holds files below 1 MiB; each further tier holds sizes up to ``TIER_BASE`` times larger."""
        return 0 if self.bytes < MiB else 1 + int(math.log(self.bytes / MiB, TIER_BASE))


class Conflict(Exception):
    """Another writer has committed this version first."""


def merged_schema(stored: dict | None, arriving: StructType) -> StructType:
    """The stored columns and then new ones of the arrivals, all nullable; names differ in more than case."""
    fields = {} if not stored else {f.name.lower(): f for f in StructType.fromJson(stored).fields}
    for f in arriving.fields:
        known = fields.get(f.name.lower())
        if known is not None and (known.dataType != f.dataType or known.name != f.name):
            raise ValueError(f"column {f.name} {f.dataType.simpleString()} arrives where {known.name} {known.dataType.simpleString()} is stored")
        fields.setdefault(f.name.lower(), StructField(f.name, f.dataType, True))
    return StructType(list(fields.values()))


class ShardStore:
    """A compacted table below ``root``, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.root, self.target_bytes, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        folder = self._path("manifest")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _json(self, below: str) -> dict:
        stream = self._fs.open(self._path(below))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, below: str, payload: dict) -> None:
        out = self._fs.create(self._path(below), False)
        out.write(bytearray(json.dumps(payload).encode()))
        out.close()

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the newest; an empty one before the first commit."""
        found = self.versions()
        if version is None and not found:
            return {"version": 0, "schema": None, "parts": []}
        return self._json(f"manifest/v{version or found[-1]:08d}.json")

    def _part(self, name: str) -> list[Shard]:
        return [Shard(**s) for s in self._json(f"manifest/parts/{name}.json")["shards"]]

    def shards(self, version: int | None = None) -> list[Shard]:
        return [s for p in self.manifest(version)["parts"] for s in self._part(p["name"])]

    def _parts(self, shards: list[Shard]) -> list[dict]:
        """New parts that list the shards."""
        made = []
        for at in range(0, len(shards), PART_SHARDS):
            name, some = uuid.uuid4().hex, sorted(shards[at : at + PART_SHARDS], key=lambda s: s.path)
            self._put(f"manifest/parts/{name}.json", {"shards": [asdict(s) for s in some]})
            made.append({"name": name, "shards": len(some), "bytes": sum(s.bytes for s in some)})
        return made

    def commit(self, base: dict, schema: str, added: list[Shard], removed: set[str] = frozenset()) -> int:
        """Make the version after ``base`` visible by one rename; ``Conflict`` if another writer was first.

        Parts that lose shards are written anew, and parts that are less than half full go together
        once there are enough of them; all others are only named.
        """
        version = base["version"] + 1
        kept, loose = [], list(added)
        small = [p for p in base["parts"] if p["shards"] < PART_SHARDS / 2]
        fold = {p["name"] for p in small} if len(small) >= self.fan_in else set()
        for part in base["parts"]:
            shards = self._part(part["name"]) if removed or part["name"] in fold else []
            if part["name"] in fold or any(s.path in removed for s in shards):
                loose += [s for s in shards if s.path not in removed]
            else:
                kept.append(part)
        temporary, final = f"manifest/.{uuid.uuid4().hex}.tmp", f"manifest/v{version:08d}.json"
        self._put(temporary, {"version": version, "schema": json.loads(schema), "parts": [*kept, *self._parts(loose)]})
        target = self._path(final)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(temporary), target, none)  # without OVERWRITE it fails if the version exists
        except Exception as error:
            self._fs.delete(self._path(temporary), False)
            if self._fs.exists(target):
                raise Conflict(f"version {version} is taken") from error
            raise
        return version

    def _write(self, df: DataFrame, rows: int | None = None) -> list[Shard]:
        """Write immutable files in a folder of their own and list them."""
        below = f"data/{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        (writer.option("maxRecordsPerFile", rows) if rows else writer).parquet(f"{self.root}/{below}")
        files = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._path(below))]
        return [Shard(f"{below}/{name}", size) for name, size in files if name.endswith(".parquet")]

    def append(self, df: DataFrame, rows: int = ARRIVAL_ROWS) -> int:
        """Add arrivals as shards of at most ``rows`` rows, and commit, after other writers if they were first.

        The table has the columns of all arrivals, in order of first appearance; rows of arrivals
        without a column read as null there. A column of another type than before is refused
        (``ValueError``) before anything is listed.
        """
        merged_schema(self.manifest().get("schema"), df.schema)
        added = self._write(df, rows)
        while True:
            base = self.manifest()
            try:
                return self.commit(base, merged_schema(base.get("schema"), df.schema).json(), added)
            except Conflict:  # the rows are written, so they only have to be listed in a later version
                continue

    def due(self) -> list[Shard]:
        """Shards of the lowest tier that has enough of them and whose files are still below half the target."""
        tiers: dict[int, list[Shard]] = {}
        for s in self.shards():
            if s.bytes < self.target_bytes / 2:
                tiers.setdefault(s.tier, []).append(s)
        return next((shards for _, shards in sorted(tiers.items()) if len(shards) >= self.fan_in), [])

    def compact_once(self) -> bool:
        """Merge the shards that are due and commit; False if none are.

        Files of one tier are alike in size, so cutting their list into equal runs gives files of
        about the target size without a shuffle: each task reads its run and writes one file.
        """
        now = self.manifest()
        due = self.due()
        if not due:
            return False
        runs = max(1, round(sum(s.bytes for s in due) / self.target_bytes))
        merged, gone = self._write(self._read(now, due).coalesce(runs)), {s.path for s in due}
        while True:
            try:
                self.commit(now, json.dumps(now["schema"]), merged, gone)
                return True
            except Conflict:
                now = self.manifest()
                if not gone <= {s.path for s in self.shards()}:  # another writer has merged some of them
                    for s in merged:
                        self._fs.delete(self._path(s.path), False)
                    return True

    def compact(self) -> int:
        """Compact until no tier is due; the number of merges. Each merge lifts its rows by a tier, so it ends."""
        merges = 0
        while self.compact_once():
            merges += 1
        return merges

    def vacuum(self, keep: int = KEPT_VERSIONS, grace: float = GRACE_SECONDS) -> int:
        """Delete what none of the newest ``keep`` versions lists and nobody has touched for ``grace`` seconds; the number of data files.

        That is what readers of older versions used, and what writers left that failed before their commit.
        """
        versions = self.versions()
        before = time.time() - grace
        live, parts = set(), set()
        for version in versions[-keep:]:
            for part in self.manifest(version)["parts"]:
                parts.add(f"{part['name']}.json")
                live |= {s.path for s in self._part(part["name"])}
        for version in versions[:-keep]:
            self._fs.delete(self._path(f"manifest/v{version:08d}.json"), False)
        gone = 0
        for folder in self._fs.listStatus(self._path("data")) if self._fs.exists(self._path("data")) else []:
            below = f"data/{folder.getPath().getName()}"
            files = [s for s in self._fs.listStatus(folder.getPath()) if s.getPath().getName().endswith(".parquet")]
            stale = [s for s in files if f"{below}/{s.getPath().getName()}" not in live and s.getModificationTime() / 1000 <= before]
            if len(stale) == len(files) and folder.getModificationTime() / 1000 <= before:
                gone += len(files)
                self._fs.delete(folder.getPath(), True)
            else:
                gone += sum(bool(self._fs.delete(s.getPath(), False)) for s in stale)
        for s in self._fs.listStatus(self._path("manifest/parts")) if self._fs.exists(self._path("manifest/parts")) else []:
            if s.getPath().getName() not in parts and s.getModificationTime() / 1000 <= before:
                self._fs.delete(s.getPath(), False)
        return gone

    def _read(self, manifest: dict, shards: list[Shard]) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(manifest["schema"])
        if not shards:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{s.path}" for s in shards))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise ValueError("nothing has been committed yet")
        return self._read(manifest, self.shards(manifest["version"]))


def compacted(df: DataFrame, root: str, arrivals: int = ARRIVAL_ROWS, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``df`` appended to a new store below ``root``, compacted, cleared of replaced files, and read from its newest version.

    Nulls, empty and very long texts, repeated rows and columns of any name are kept as they are; an
    empty table gives an empty version.
    """
    store = ShardStore(df.sparkSession, root, target_bytes)
    store.append(df, arrivals)
    store.compact()
    store.vacuum(keep=1, grace=0)  # the store is new and nobody else uses it
    return store.read()


def digests(df: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``text_sha256`` of the rows of a store, null for null texts."""
    return df.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
