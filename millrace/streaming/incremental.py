"""Loading only what is new with Structured Streaming.

A stream of rows (:func:`csv_stream`) reads files that all have the named columns in the named order, and fails
on others. A stream of files (:func:`file_stream`) brings paths; each micro-batch then reads its files by their
own headers (:class:`ByHeader`), which a registry keeps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import null_if
from millrace.operators.clean import clean_table, usable_key
from millrace.sources.csv import HEADERS, READER_DEFAULTS, CsvFormat, file_headers, read_by_headers
from millrace.spec import TableSpec
from millrace.streaming.key_index import KeyIndex, key_hashes
from millrace.workspace import scratch_tables


def csv_stream(
    spark: SparkSession, folder: str, names: Sequence[str], fmt: CsvFormat = READER_DEFAULTS,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as they arrive, every column as text, null tokens as null.

    Columns go by position; a file whose header says otherwise fails the batch.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = (
        spark.readStream.schema(schema)
        .options(**fmt.reader_options())
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv*")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.csv(folder).select(*[null_if(F.col(f"`{n}`"), fmt.null_tokens).alias(n) for n in names])


# The schema of the source that lists files; a fixed value.
FILE_SCHEMA = "path string, modificationTime timestamp_ltz, length bigint, content binary"


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 5_000, glob: str = "*.csv*") -> DataFrame:
    """(path, modified, size) of the files of a folder as they arrive; their content is not read."""
    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(files_per_batch)).load(folder)
    )
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


class UnknownLayout(ValueError):
    """A file lacks a column, or has one that nobody expects."""


@dataclass(frozen=True)
class ByHeader:
    """Reads the files of a micro-batch, each by its own header.

    ``registry`` is a folder that keeps the header of every file ever read: what it says of the batch's files
    is joined to their rows by path. A file's columns may come in any order. With ``new_columns`` as ``fail``
    they must be ``columns``, with ``add`` columns may be missing (null) and others are taken along.
    """

    registry: str
    columns: tuple[str, ...]
    fmt: CsvFormat = READER_DEFAULTS
    new_columns: str = "fail"

    def read(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        own = f"{self.registry}/batch_id={batch_id}"
        paths = [r.path for r in batch.select("path").collect()]  # at most the stream's files_per_batch
        if not paths:
            return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in self.columns]))
        file_headers(spark, paths, self.fmt).write.mode("overwrite").parquet(own)
        headers = spark.read.schema(HEADERS).parquet(own)
        layouts = headers.groupBy("names").agg(F.min("path").alias("path")).collect()
        found = [n for r in sorted(layouts) for n in r.names]
        if self.new_columns != "add":
            for layout in layouts:
                if sorted(layout.names) != sorted(self.columns):
                    raise UnknownLayout(f"{layout.path} has the columns {layout.names}, not {list(self.columns)}")
        return read_by_headers(spark, paths, headers, list(dict.fromkeys([*self.columns, *found])), self.fmt)

    def known(self, spark: SparkSession) -> DataFrame:
        """(path, line, names) of all files read so far."""
        return spark.read.schema(f"{HEADERS}, batch_id bigint").parquet(self.registry).select("path", "line", "names")


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand what ``checkpoint`` has not seen to ``write`` batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_new_files_by_header(files: DataFrame, reading: ByHeader, target: str, checkpoint: str) -> None:
    """Append the rows of the files not seen by ``checkpoint`` to the parquet folder ``target``, then stop.

    Each batch has a folder of its own, which a repeated run of the batch replaces. Where batches bring
    new columns, read the target with ``mergeSchema``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        reading.read(batch, batch_id).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_batches(files, write, checkpoint)


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the files not seen by ``checkpoint`` to the parquet folder ``target``, then stop.

    The checkpoint and the sink's own log make each file count once, also after a restart.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def clean_new_files(
    stream: DataFrame, spec: TableSpec, target: str, checkpoint: str, reading: ByHeader | None = None,
    index: KeyIndex | None = None,
) -> None:
    """Clean each micro-batch and append the rows whose key ``target`` does not hold yet.

    ``stream`` brings rows, or with ``reading`` files, which are read by their headers.

    A batch is written to a folder of its own, named by stream (its checkpoint) and batch: a repeated
    run of a batch replaces that folder and nothing else, and several streams may fill one target, also at
    the same time. Every batch is checked against all earlier ones by the 128-bit key hashes of ``index``, which
    lies beside the target in ``{target}_index``: neither rows nor, but for a few files, hashes are read again.
    """
    spark = stream.sparkSession
    load = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    index = index or KeyIndex(f"{target}_index")
    index.create(spark, earlier=f"{target}_keys")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = reading.read(batch, batch_id) if reading else batch
        rows = clean_table(batch, spec)
        key = [spec.renames.get(c, c) for c in usable_key(batch, spec.key_columns)]
        own = f"{target}/load={load}/batch_id={batch_id}"
        if not key:
            rows.write.mode("overwrite").parquet(own)
            return
        with scratch_tables(spark) as keep:
            hashed = keep(rows.withColumns(key_hashes(key)))
            with index.owned(spark, load):
                fresh = index.unseen(hashed, load, batch_id)
                fresh.select(*[F.col(f"`{c}`") for c in rows.columns]).write.mode("overwrite").parquet(own)
                index.add(fresh.select("h1", "h2"), load, batch_id)

    run_batches(stream, write_batch, checkpoint)
