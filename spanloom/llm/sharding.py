"""Sharding: size-tiered compaction under a versioned manifest.

Arrivals are appended as immutable runs of small Parquet shards.  Runs whose sizes lie within one factor of
FAN_IN form a tier; as soon as a tier has FAN_IN runs they become one run.  Shards of target size go into it
as they are; only smaller ones are rewritten, grouped by their bytes so that each group fills a target-sized
shard and is one task (no shuffle), all groups in one job.  So a row is rewritten once per tier until it is in
a shard of target size, then never again.

A manifest lists every shard by path and bytes; readers open these files and look into no folder, so a shard
that no manifest lists (of a writer that failed, or that hasn't committed yet) doesn't exist for them.  A
commit renames a whole manifest file to its version's name, which fails if that version is there: of two
writers one has to try again.  Older versions stay readable until `vacuum`, which removes the manifests before
the last ones, and the shards that none of the kept ones lists and that are older than a grace period.

Null columns and repeated rows are kept as they are; an empty arrival is a run without rows, and a store
without runs can't be read.  All arrivals have the columns of the first; others are an error.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_dir

TARGET_BYTES, SMALL_BYTES, FAN_IN = 128 << 20, 1 << 20, 4
#: Shards from this part of the target on aren't rewritten.
FULL = 0.6


def groups_of(sizes: Sequence[int], target: int) -> list[list[int]]:
    """Places of the sizes in groups whose sums are near the target, each from largest to smallest into the fullest group that has room."""
    groups: list[list] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        room = [g for g in groups if g[0] + sizes[k] <= target]
        if room:
            best = max(room, key=lambda g: g[0])
        else:
            best = [0]
            groups.append(best)
        best[0] += sizes[k]
        best.append(k)
    return [g[1:] for g in groups]


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> None:
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path("manifest").getFileSystem(self._conf).mkdirs(self._path("manifest"))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self._conf)

    # manifest

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path("manifest"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """version, schema and runs, each a list of shards (path, bytes)."""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "runs": []}
        stream = self._fs().open(self._path(f"manifest/v{version:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, runs: list[list[dict]], schema: dict, base: int) -> int:
        """Makes runs the next version after base; an error if another writer was faster."""
        done, draft = self._path(f"manifest/v{base + 1:010d}.json"), self._path(f"manifest/.{uuid.uuid4().hex}")
        stream = self._fs().create(draft, False)
        stream.write(bytearray(json.dumps({"version": base + 1, "schema": schema, "runs": runs}).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context.rename(draft, done, how)
        return base + 1

    # runs

    def write(self, df: DataFrame) -> list[dict]:
        """df as new shards, which no manifest lists yet."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs().listStatus(self._path(folder))]
        return [{"path": f"{folder}/{name}", "bytes": n} for name, n in sorted(found) if name.endswith(".parquet")]

    def tier(self, run: list[dict]) -> int:
        return max(0, math.floor(math.log(max(sum(s["bytes"] for s in run), 1) / SMALL_BYTES, self.fan_in)))

    def append(self, df: DataFrame) -> int:
        now = self.manifest()
        schema = json.loads(df.schema.json())
        names = lambda s: [(f["name"], f["type"]) for f in s["fields"]]
        if now["schema"] and names(now["schema"]) != names(schema):
            raise ValueError("an arrival's columns differ from the store's")
        return self.commit([*now["runs"], self.write(df)], now["schema"] or schema, now["version"])

    def merged(self, runs: list[list[dict]], schema: dict) -> list[dict]:
        """The runs' shards as one run: full ones as they are, smaller ones rewritten by groups."""
        shards = [s for run in runs for s in run]
        full = [s for s in shards if s["bytes"] >= FULL * self.target]
        less = [s for s in shards if s["bytes"] < FULL * self.target]
        if len(less) < 2:
            return shards
        parts = [self.read_shards([less[k] for k in g], schema).coalesce(1) for g in groups_of([s["bytes"] for s in less], self.target)]
        return [*full, *self.write(reduce(DataFrame.union, parts))]

    def compact(self) -> int:
        """Merges tiers until none has FAN_IN runs; returns the number of merges."""
        merges = 0
        while True:
            now = self.manifest()
            tiers: dict[int, list[list[dict]]] = {}
            for run in now["runs"]:
                tiers.setdefault(self.tier(run), []).append(run)
            full = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fan_in), None)
            if full is None:
                return merges
            old = tiers[full]
            new = self.merged(old, now["schema"])
            self.commit([*(r for r in now["runs"] if r not in old), new], now["schema"], now["version"])
            merges += 1

    def vacuum(self, keep: int = 2, grace: float = 3600.0) -> int:
        """Removes all but the last `keep` manifests, then the shards that these don't list and that are over `grace` seconds old, also those of writers that failed; returns how many shards."""
        fs, gone = self._fs(), 0
        for v in self.versions()[:-keep]:
            fs.delete(self._path(f"manifest/v{v:010d}.json"), False)
        listed = {s["path"] for v in self.versions() for run in self.manifest(v)["runs"] for s in run}
        if not fs.exists(self._path("data")):
            return 0
        for folder in fs.listStatus(self._path("data")):
            name = f"data/{folder.getPath().getName()}"
            old = [s for s in fs.listStatus(folder.getPath()) if s.getModificationTime() / 1000 <= time.time() - grace]
            unlisted = [s for s in old if f"{name}/{s.getPath().getName()}" not in listed]
            shards = [s for s in unlisted if s.getPath().getName().endswith(".parquet")]
            if not any(x.startswith(f"{name}/") for x in listed) and folder.getModificationTime() / 1000 <= time.time() - grace:
                fs.delete(folder.getPath(), True)
            else:
                for s in shards:
                    fs.delete(s.getPath(), False)
            gone += len(shards)
        return gone

    def read_shards(self, shards: list[dict], schema: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(schema)).parquet(*[f"{self.root}/{s['path']}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the newest by default."""
        now = self.manifest(version)
        if not now["runs"]:
            raise ValueError("the store has no runs")
        return self.read_shards([s for run in now["runs"] for s in run], now["schema"])


def op7(documents: DataFrame, arrivals: int = 8) -> DataFrame:
    """The query: documents arrive in ranges of their ids (null ids first), each range is appended and tiers are compacted; then every row is read back through the manifest, with the number of its arrival, which was written along."""
    spark = documents.sparkSession
    store = ShardStore(spark, f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}")
    rows = documents.select("doc_id", "text")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    edges = [low + (high - low + 1) * k // arrivals for k in range(1, arrivals)]
    number = sum((F.coalesce(F.col("doc_id") >= e, F.lit(False)).cast("long") for e in edges), F.lit(0).cast("long"))
    for k in range(arrivals):
        part = [F.col("doc_id") >= edges[k - 1]] if k else []
        part += [F.col("doc_id") < edges[k]] if k < arrivals - 1 else []
        wanted = reduce(lambda a, b: a & b, part, F.lit(True))
        store.append(rows.filter(wanted if k else wanted | F.col("doc_id").isNull()).withColumn("arrival", number))
        store.compact()
        store.vacuum(grace=0)  # the only writer, and nobody reads yet
    return store.read().select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"), "arrival")


#: Every row once, with its arrival by the ranges of ids.
OP7_SQL = """
WITH r AS (SELECT COALESCE(min(doc_id), 0) AS low, COALESCE(max(doc_id), 0) AS high FROM documents)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256,
  CAST(len(list_filter(range(1, 8), lambda k: COALESCE(doc_id >= low + (high - low + 1) * k // 8, false))) AS BIGINT) AS arrival
FROM documents, r
"""
