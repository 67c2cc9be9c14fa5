"""Keys that a table holds, kept so that a micro-batch reads only the few files that may hold its own.

The index is a folder of runs. A run has the 128-bit key hashes of a batch, in one file a bucket, and small
Bloom filters, one or more a bucket. A micro-batch probes the filters of all runs and reads the hashes of just
those runs and buckets that may hold one of its keys: none at all for new keys, but for one in five thousand.

When ``fan`` runs of a level have come together they are merged into one of the next level, so there are at most
``fan`` runs a level, and a hash is rewritten once a level. The newest batch of each stream stays by itself, as
it alone can be run again.

One stream at a time checks and adds: it holds the file ``_owner`` meanwhile. A stream that is lost while it
writes keeps holding it until it has run its batch again; others wait, then fail and name the file.
"""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.workspace import delete_folder

KEYS = "h1 bigint, h2 bigint, load string, batch_id bigint"
FILTERS = "bucket int, parts int, part int, bits binary"
# Bits of a filter (those of one bitmap), probes a key, and keys a filter is meant for: 2 in 10,000 others pass.
BITS, PROBES, KEYS_PER_FILTER = 32_768, 6, 1_500
# Files that are named one by one; beyond these the runs' folders are read.
NAMED_FILES = 10_000


class IndexOwned(RuntimeError):
    """Another stream holds the index."""


def key_hashes(key: Sequence[str]) -> dict[str, Column]:
    """The columns h1 and h2 of a key."""
    cells = [F.col(f"`{c}`").cast("string") for c in key]
    return {"h1": F.xxhash64(*cells), "h2": F.xxhash64(F.lit(1), *cells)}


def _positions() -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), "h1", "h2"), F.lit(BITS)).cast("int") for k in range(2, 2 + PROBES)]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position % 8) == 1


@dataclass(frozen=True)
class KeyIndex:
    folder: str
    buckets: int = 64
    fan: int = 16
    wait_seconds: float = 600

    def create(self, spark: SparkSession, earlier: str | None = None) -> None:
        """Make the index if it is not there, with the hashes (h1, h2, load, batch_id) of the folder ``earlier``."""
        if self._fs(spark).exists(self._path(spark, f"{self.folder}/filters")):
            return
        if earlier and self._fs(spark).exists(self._path(spark, earlier)):
            self._write_run(spark.read.schema(KEYS).parquet(earlier), "1-imported")
        spark.createDataFrame([], FILTERS).write.mode("ignore").parquet(f"{self.folder}/filters/run=none")

    def runs(self, spark: SparkSession) -> list[str]:
        """The names of all runs: level and batch, or level and a random name."""
        return sorted(r.run for r in self._filters(spark).select("run").distinct().collect())

    def places(self, keys: DataFrame) -> list[tuple[str, int]]:
        """(run, bucket) of the files that may hold one of ``keys`` (h1, h2); at most runs x buckets."""
        filters = self._filters(keys.sparkSession)
        sizes = sorted(r.parts for r in filters.select("parts").distinct().collect())  # powers of two
        if not sizes:
            return []
        probes = keys.select(
            "h1", "h2", self._bucket(), F.explode(F.array(*map(F.lit, sizes))).alias("parts")
        ).withColumn("part", F.pmod("h2", "parts").cast("int"))
        hits = probes.join(filters, ["bucket", "parts", "part"])
        for position in _positions():
            hits = hits.where(_is_set(F.col("bits"), position))
        return sorted((r.run, r.bucket) for r in hits.select("run", "bucket").distinct().collect())

    def held(self, keys: DataFrame, load: str, batch_id: int) -> DataFrame | None:
        """Hashes (h1, h2) in the files that may hold one of ``keys``, but for those of the batch itself; none if
        there are no such files."""
        spark, places = keys.sparkSession, self.places(keys)
        if not places:
            return None
        files = [f"{self.folder}/keys/run={run}/bucket={bucket}" for run, bucket in places]
        if len(files) > NAMED_FILES:
            files = [f"{self.folder}/keys/run={run}" for run in sorted({run for run, _ in places})]
        found = spark.read.schema(KEYS).option("recursiveFileLookup", "true").parquet(*files)
        return found.where(~((F.col("load") == load) & (F.col("batch_id") == batch_id))).select("h1", "h2")

    def unseen(self, rows: DataFrame, load: str, batch_id: int) -> DataFrame:
        """The rows (with h1, h2) whose key no other batch has; ``rows`` is read twice."""
        held = self.held(rows.select("h1", "h2"), load, batch_id)
        return rows if held is None else rows.join(held, ["h1", "h2"], "left_anti")

    def add(self, keys: DataFrame, load: str, batch_id: int) -> None:
        """Note the keys (h1, h2) of a batch; a repeated run of the batch replaces them."""
        noted = keys.select("h1", "h2", F.lit(load).alias("load"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write_run(noted, f"0-{load}-{batch_id:012d}")
        self.merge(keys.sparkSession)

    def merge(self, spark: SparkSession) -> None:
        """Merge the runs of each level that has ``fan`` of them which are sure to stay as they are."""
        names = self.runs(spark)
        newest: dict[str, str] = {}
        for name in names:
            if name.startswith("0-"):
                newest[name.split("-")[1]] = name  # names are in order of batches
        levels = defaultdict(list)
        for name in names:
            if name not in newest.values():
                levels[int(name.split("-")[0])].append(name)
        for level, members in sorted(levels.items()):
            if len(members) >= self.fan:
                parts = [f"{self.folder}/keys/run={m}" for m in members]
                rows = spark.read.schema(KEYS).option("recursiveFileLookup", "true").parquet(*parts)
                self._write_run(rows, f"{level + 1}-{uuid.uuid4().hex}")
                for m in members:  # the filters go first, as they lead to the hashes
                    delete_folder(spark, f"{self.folder}/filters/run={m}")
                    delete_folder(spark, f"{self.folder}/keys/run={m}")

    @contextmanager
    def owned(self, spark: SparkSession, load: str) -> Iterator[None]:
        """Holds the index for the stream ``load``; lets go at the end of the block unless it fails."""
        self.claim(spark, load)
        yield
        self.release(spark)

    def claim(self, spark: SparkSession, load: str) -> None:
        """Wait until nobody else holds the index, then hold it; what an earlier run of ``load`` holds is its own."""
        fs, path, until = self._fs(spark), self._path(spark, f"{self.folder}/_owner"), time.monotonic() + self.wait_seconds
        while self.owner(spark) != load:
            try:
                out = fs.create(path, False)
                try:
                    out.write(bytearray(load.encode()))
                finally:
                    out.close()
            except Py4JJavaError as problem:
                if not fs.exists(path):
                    continue  # let go in the meantime
                if time.monotonic() > until:
                    raise IndexOwned(f"{self.owner(spark)!r} holds {path}; delete it only if that stream is given up") from problem
                time.sleep(0.2)

    def release(self, spark: SparkSession) -> None:
        delete_folder(spark, f"{self.folder}/_owner")

    def owner(self, spark: SparkSession) -> str | None:
        """The stream that holds the index, if one does."""
        fs, path = self._fs(spark), self._path(spark, f"{self.folder}/_owner")
        if not fs.exists(path):
            return None
        try:
            stream = fs.open(path)
        except Py4JJavaError:
            return None  # let go in the meantime
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _bucket(self) -> Column:
        return F.pmod("h1", F.lit(self.buckets)).cast("int").alias("bucket")

    def _filters(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{FILTERS}, run string").parquet(f"{self.folder}/filters")

    def _write_run(self, keys: DataFrame, run: str) -> None:
        """The hashes, one file a bucket, then their filters."""
        spark, place = keys.sparkSession, f"{self.folder}/keys/run={run}"
        placed = keys.select("h1", "h2", "load", "batch_id", self._bucket())
        placed.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(place)
        written = spark.read.schema(f"{KEYS}, bucket int").parquet(place)
        parts, total = 1, written.count()
        while parts * self.buckets * KEYS_PER_FILTER < total:
            parts *= 2
        each = written.select(
            "bucket", F.pmod("h2", F.lit(parts)).cast("int").alias("part"), F.explode(F.array(*_positions())).alias("at")
        )
        bits = each.groupBy("bucket", "part").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))
        bits.select("bucket", F.lit(parts).alias("parts"), "part", "bits").write.mode("overwrite").parquet(
            f"{self.folder}/filters/run={run}"
        )

    def _path(self, spark: SparkSession, path: str):
        return spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, spark: SparkSession):
        return self._path(spark, self.folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
