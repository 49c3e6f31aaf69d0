"""Sharding with size-tiered compaction and a versioned manifest.

A store is a folder of immutable shards and of manifests. Each arrival is appended as a small shard. Compaction puts
shards of one size tier (sizes within a factor of `fan_in`) together, `fan_in` of them at a time, into files of the
target size, until no tier has enough left. A shard that has no others to go with, or is as large as the target by
itself, is rewritten where it is in many small files. A manifest names the shards of one version; it is written aside and then
renamed to its number, which fails if that version is there already, so that readers see a whole version or none and
of two writers one wins; the other takes its arrival to the next version. That holds where a rename is atomic and does
not replace (HDFS; on a local disk the writers of one driver are kept apart by a lock); an object store without such a rename
needs a lock around commit(). Several compactions may run at once: one whose shards another has replaced meanwhile
drops what it made and plans anew. Texts are read and written by Spark without a shuffle, the merges of a step side by
side; the driver handles names and sizes.

Defined results: rows stay as they are, nulls, repeats and all; an empty arrival gives a shard without rows; column
names of the store are those of the first arrival; a column named __terravane_arrival is refused by append_by().
"""

from __future__ import annotations

import json
import math
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET = 128 << 20
FAN_IN = 4
SMALLEST = 1 << 20
#: Jobs that compact() has the cluster run at a time.
AT_A_TIME = 8
#: How often a writer that comes second tries the next version.
RETRIES = 20
#: Seconds for which vacuum() spares shards that no manifest names yet.
SPARED = 24 * 3600
_COMMITS = threading.Lock()


@dataclass(frozen=True)
class Shard:
    name: str
    size: int
    full: bool  # in files of the target size already
    small: int | None = None  # files below half the target size; not known of shards in older manifests


class Store:
    """Shards under root, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fan_in: int = FAN_IN):
        self.spark, self.root, self.target, self.fan_in = spark, root, target, fan_in
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    # Files

    def _size(self, folder: str) -> int:
        return self._fs.getContentSummary(self._path(folder)).getLength()

    def _small(self, folder: str) -> int:
        files = self._fs.listStatus(self._path(folder))
        return sum(x.getPath().getName().endswith(".parquet") and x.getLen() < self.target / 2 for x in files)

    def _shard(self, name: str) -> Shard:
        folder = f"{self.root}/shards/{name}"
        return Shard(name, self._size(folder), False, self._small(folder))

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.root}/manifests") if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard]]:
        """A version (the newest by default) and its shards; version 0 is empty."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else 0)
        if version == 0:
            return 0, []
        said = self._fs.open(self._path(f"{self.root}/manifests/v{version:08d}.json"))
        try:
            text = bytes(said.readAllBytes()).decode()
        finally:
            said.close()
        return version, [Shard(**x) for x in json.loads(text)["shards"]]

    def commit(self, base: int, shards: list[Shard]) -> int:
        """Make shards the version after base; FileExistsError if another writer was first."""
        jvm = self.spark._jvm
        aside = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps({"version": base + 1, "shards": [asdict(s) for s in shards]}).encode()))
        out.close()
        final = self._path(f"{self.root}/manifests/v{base + 1:08d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            with _COMMITS:
                context.rename(aside, final, options)
        except Py4JJavaError as e:
            self._fs.delete(aside, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise FileExistsError(f"version {base + 1} is there already") from e
        return base + 1

    # Shards

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.option("compression", "zstd").parquet(f"{self.root}/shards/{name}")

    def _put(self, fresh: list[Shard], gone: set[str] = frozenset()) -> int | None:
        """The version after the newest one, with fresh shards in place of those in gone, whoever else commits meanwhile.

        None, and no version, if the newest one does not hold all of gone any more.
        """
        for k in range(RETRIES):
            version, shards = self.manifest()
            if not gone <= {s.name for s in shards}:
                return None
            try:
                return self.commit(version, [*(s for s in shards if s.name not in gone), *fresh])
            except FileExistsError:
                if k == RETRIES - 1:
                    raise
        raise AssertionError

    def append(self, arrival: DataFrame) -> int:
        """One arrival as a shard; the new version."""
        name = uuid.uuid4().hex
        self._write(arrival, name)
        return self._put([self._shard(name)])

    def append_by(self, rows: DataFrame, arrival: Column) -> int:
        """Many arrivals written in one pass, a shard for each value of arrival, committed together."""
        batch, tag = uuid.uuid4().hex, "__terravane_arrival"
        if tag in rows.columns:
            raise ValueError(f"{tag} names the folders of arrivals; rename that column")
        at = f"{self.root}/shards/{batch}"
        rows.withColumn(tag, arrival).write.option("compression", "zstd").partitionBy(tag).parquet(at)
        return self._put([self._shard(f"{batch}/{n}") for n in self._names(at) if n.startswith(tag)])

    def read(self, version: int | None = None, shards: list[Shard] | None = None, schema=None) -> DataFrame:
        """The rows of a version or of some shards."""
        shards = self.manifest(version)[1] if shards is None else shards
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        # A partition folder's own column is not one of the rows'.
        return reader.option("recursiveFileLookup", "true").parquet(*(f"{self.root}/shards/{s.name}" for s in shards))

    def tier(self, shard: Shard) -> int:
        return max(0, math.floor(math.log(max(shard.size, 1) / SMALLEST, self.fan_in)))

    def runs(self, shards: list[Shard]) -> list[list[Shard]]:
        """Groups of `fan_in` shards of one tier, the smallest tiers first, and large shards of many small files.

        Where no group is left, the other shards of many small files follow, each alone.
        """
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if not s.full and s.size < self.target:
                tiers.setdefault(self.tier(s), []).append(s)
        scattered = [s for s in shards if not s.full and (self._small(f"{self.root}/shards/{s.name}") if s.small is None else s.small) > 1]
        out = [[s] for s in scattered if s.size >= self.target]
        for t in sorted(tiers):
            some = sorted(tiers[t], key=lambda s: (s.size, s.name))
            out += [some[i : i + self.fan_in] for i in range(0, len(some) - self.fan_in + 1, self.fan_in)]
        return out or [[s] for s in scattered]

    def compact(self, schema=None) -> int:
        """Merge runs until none is left; the version that holds the result.

        All runs of a step that don't share a shard are merged, then one manifest replaces their shards. Where another
        compaction has replaced one of a run's shards first, that run's own copy is deleted and the rest is planned anew;
        arrivals that come meanwhile stay beside what is merged.
        """

        def merged(run: list[Shard]) -> Shard:
            files = max(1, round(sum(s.size for s in run) / self.target))
            name = uuid.uuid4().hex
            self._write(self.read(shards=run, schema=schema).coalesce(files), name)
            made = self._shard(name)
            return replace(made, full=made.size >= self.target)

        while runs := self.runs(self.manifest()[1]):
            with ThreadPoolExecutor(AT_A_TIME) as pool:
                fresh = list(pool.map(merged, runs))
            if self._put(fresh, {s.name for run in runs for s in run}) is None:
                for run, made in zip(runs, fresh, strict=True):
                    if self._put([made], {s.name for s in run}) is None:
                        self._fs.delete(self._path(f"{self.root}/shards/{made.name}"), True)
        return self.manifest()[0]

    def vacuum(self, spared: float = SPARED) -> None:
        """Delete shards that the newest version doesn't name and that were written more than `spared` seconds ago.

        What another writer has written and not committed yet is younger, so it stays. Readers of older versions must
        be done.
        """
        named = {s.name for s in self.manifest()[1]}
        latest = self.spark._jvm.System.currentTimeMillis() - int(spared * 1000)
        for batch in self._names(f"{self.root}/shards"):
            inner = [f"{batch}/{n}" for n in self._names(f"{self.root}/shards/{batch}") if n.startswith("__terravane_arrival")]
            for name in inner or [batch]:
                at = self._path(f"{self.root}/shards/{name}")
                if name not in named and self._fs.getFileStatus(at).getModificationTime() <= latest:
                    self._fs.delete(at, True)
