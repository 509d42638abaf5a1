"""Shards by size-tiered compaction, under a versioned manifest.

Arrivals are appended as small immutable shards, a file for each task that holds any. Compaction puts shards into tiers of
similar size and merges runs of a tier, in order of arrival, into files of the target size; a shard of at least half the
target is left alone. Either step ends with a new manifest version, written beside the old ones and moved into place in
one rename that fails if the version exists: readers see a version whole or not at all, and of two writers one takes the
other's version and commits after it. That asks for a file system whose rename is atomic and does not overwrite, as HDFS
and local ones have; an object store without one needs a single writer. What a writer that died has left behind, and what
only older versions name, is removed by vacuum(). Only file names and sizes, never rows, come to the driver: a manifest of
about 100 bytes for each shard of target size.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._common import packed, shared_dir, unpacked

#: Bytes of a finished shard, the ratio between neighbouring tiers, and how many shards of a tier make a run.
TARGET, TIER, RUN = 128 << 20, 4, 2
#: Runs that one job merges, and manifest entries that are broadcast to readers.
AT_ONCE, KNOWN = 64, 100_000


class Conflict(RuntimeError):
    """Another writer has committed this version."""


class _Lost(RuntimeError):
    """The shards to be replaced are gone."""


def _next(shards: list[dict]) -> int:
    return max((s["shard"] for s in shards), default=-1) + 1


class Store:
    """A folder of immutable shards and its manifests."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self, folder: str) -> list[tuple[str, int]]:
        found = self.fs.globStatus(self._path(f"{folder}/*.parquet")) or []
        return sorted((f"{folder}/{s.getPath().getName()}", s.getLen()) for s in found)

    def version(self) -> int:
        """The newest version; 0 before the first."""
        found = self.fs.globStatus(self._path("manifest/v*.json")) or []
        return max((int(s.getPath().getName()[1:-5]) for s in found), default=0)

    def manifest(self, version: int | None = None) -> list[dict]:
        """shard, file, bytes, arrival and tier of each shard, in order."""
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self.fs.open(self._path(f"manifest/v{version:08d}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def commit(self, shards: list[dict], before: int) -> int:
        """Make shards the version after before, or raise Conflict."""
        name = f"manifest/v{before + 1:08d}.json"
        draft = self._path(f"manifest/.draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(shards).encode()))
        stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(draft, self._path(name)):
            self.fs.delete(draft, False)
            raise Conflict(name)
        return before + 1

    def _entries(self, files: list[tuple[str, int]], first: int, arrival: int) -> list[dict]:
        return [{"shard": first + k, "file": f, "bytes": n, "arrival": arrival, "tier": tier(n)} for k, (f, n) in enumerate(files)]

    def _commit_after(self, change, retries: int = 20) -> int:
        """Commit change(manifest, next version) on the newest version, on a newer one if another writer was first."""
        for _ in range(retries):
            before = self.version()
            try:
                return self.commit(change(self.manifest(before), before + 1), before)
            except Conflict:
                continue
        raise Conflict(self.root)

    def append(self, arrivals: DataFrame) -> int:
        """Write arrivals as small shards and commit them; the version. Empty arrivals change nothing but the version."""
        folder = f"data/{uuid.uuid4().hex}"
        arrivals.write.parquet(f"{self.root}/{folder}")
        files = self._files(folder)
        return self._commit_after(lambda now, version: now + self._entries(files, _next(now), version))

    def compact(self, target: int = TARGET) -> int:
        """Merge runs of similar shards into shards of about target bytes and commit; the version. Nothing to merge: no commit.

        Shards that came meanwhile stay as they are. If another writer has merged the same shards, what was written here is
        deleted, nothing is committed, and Conflict is raised.
        """
        before = self.version()
        runs = plan(self.manifest(before), target)
        if not runs:
            return before
        folder = f"data/{uuid.uuid4().hex}"
        for k in range(0, len(runs), AT_ONCE):  # a task for each run, which reads its shards and writes one file: nothing is shuffled
            merged = [self.read_files([s["file"] for s in run]).coalesce(1) for run in runs[k : k + AT_ONCE]]
            reduce(DataFrame.unionAll, merged).write.parquet(f"{self.root}/{folder}/{k:08d}")
        files = sorted(x for k in range(0, len(runs), AT_ONCE) for x in self._files(f"{folder}/{k:08d}"))
        gone = {s["file"] for run in runs for s in run}

        def change(now: list[dict], version: int) -> list[dict]:
            if not gone <= {s["file"] for s in now}:
                self.fs.delete(self._path(folder), True)
                raise _Lost(folder)
            return [s for s in now if s["file"] not in gone] + self._entries(files, _next(now), version)

        try:
            return self._commit_after(change)
        except _Lost as e:
            raise Conflict("another writer has merged these shards") from e

    def compact_all(self, target: int = TARGET) -> int:
        """compact() until there is nothing to merge; the version."""
        version = self.compact(target)
        while plan(self.manifest(version), target):
            version = self.compact(target)
        return version

    def vacuum(self, grace_s: float = 86400.0) -> int:
        """Delete files that the newest version doesn't name and older manifests, both older than grace_s; how many files.

        The grace is for readers of older versions and for writers that have not committed yet.
        """
        latest = int((time.time() - grace_s) * 1000)
        version = self.version()
        named = {s["file"] for s in self.manifest(version)}
        prefix, n = self._path("").toUri().getPath().rstrip("/") + "/", 0
        walk = self.fs.listFiles(self._path("data"), True) if self.fs.exists(self._path("data")) else None
        while walk is not None and walk.hasNext():
            found = walk.next()
            name = found.getPath().toUri().getPath().removeprefix(prefix)
            if name.endswith(".parquet") and name not in named and found.getModificationTime() <= latest:
                n += bool(self.fs.delete(found.getPath(), False))
        for found in self.fs.globStatus(self._path("manifest/*")) or []:
            if found.getPath().getName() != f"v{version:08d}.json" and found.getModificationTime() <= latest:
                self.fs.delete(found.getPath(), False)
        return n

    def read_files(self, files: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "false").parquet(*[f"{self.root}/{f}" for f in files])

    def read(self, version: int | None = None, shard: str = "_shard", size: str = "_shard_bytes") -> DataFrame | None:
        """All rows of a version, with the number and bytes of their shard; None if it has no shard.

        Columns of the rows pass through, whatever their names, but for those called as shard and size say, which are replaced.
        """
        shards = self.manifest(version)
        if not shards:
            return None
        names = [("/".join(s["file"].rsplit("/", 2)[-2:]), s["shard"], s["bytes"]) for s in shards]
        known = self.spark.createDataFrame(names, "known string, shard int, size long")
        rows = self.read_files([s["file"] for s in shards])
        own = packed(rows, file=F.regexp_extract(F.input_file_name(), r"[^/]+/[^/]+$", 0))
        joined = own.join(F.broadcast(known) if len(names) <= KNOWN else known, F.col("file") == F.col("known"))
        return unpacked(joined, rows.columns, **{shard: F.col("shard"), size: F.col("size")})


def tier(size: int) -> int:
    """0 for up to 64 KB, then one more for each factor of TIER."""
    return max(0, math.ceil(math.log(max(1, size) / 65536, TIER)))


def plan(shards: list[dict], target: int = TARGET) -> list[list[dict]]:
    """Runs to merge: shards of one tier in order of arrival, up to about target bytes; single shards stay."""
    tiers: dict[int, list[dict]] = {}
    for s in shards:
        if s["bytes"] * 2 < target:
            tiers.setdefault(tier(s["bytes"]), []).append(s)
    runs = []
    for _, held in sorted(tiers.items()):
        run: list[dict] = []
        size = 0
        for s in held:
            if run and size + s["bytes"] > target:
                runs.append(run)
                run, size = [], 0
            run.append(s)
            size += s["bytes"]
        runs.append(run)
    return [r for r in runs if len(r) >= RUN]


def shard(docs: DataFrame, arrivals: int = 4, target: int = TARGET, key: str = "doc_id") -> tuple[Store, int]:
    """A new store in the shared folder, filled with docs in several arrivals, compacted after each; and the version.

    Every row is kept as it is, nulls, repeated rows and all columns included; rows with a null key arrive first. An empty
    table gives a store without rows.
    """
    spark = docs.sparkSession
    store = Store(spark, f"{shared_dir(spark)}/corpusloom-shards-{uuid.uuid4().hex}")
    for k in range(arrivals):
        store.append(docs.where(F.coalesce(F.pmod(F.xxhash64(key), F.lit(arrivals)), F.lit(0)) == k))
        store.compact_all(target)
    return store, store.version()
