"""File listings: which files lie in a folder, which one a logical name means, row provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.operators.verify import digest_sum
from millrace.session import few_listings
from millrace.workspace import cut_lineage

# Patterns a load selects files with.
ANY_CSV = r".*\.csv"
DATED_CSV = r".*[0-9]{4}-[0-9]{2}-[0-9]{2}\.csv"
CSV_OR_JSON = r".*\.(csv|json)"
RAW_SUFFIX = "_raw.csv"
# So many splits (some 25 TB of files) make a table of a few tens of MB.
BROADCAST_SPLITS = 200_000


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv*") -> DataFrame:
    """(path, name, size, modified) of the files below ``folder``; no file content is read."""
    with few_listings(spark):
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(folder)
        )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
    )


def matches(path: Column, pattern: str) -> Column:
    """True where the whole path matches ``pattern``."""
    return path.rlike(f"^(?:{pattern})$")


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key=value`` in a path."""
    return F.regexp_extract(path, f"/{key}=([^/]*)/", 1)


def resolve_files(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """For each ``request`` the file it means in ``listing`` (``name``, ``ordinal``), or null.

    The exact name wins, then the name with ``.csv``, then either of them in any case, the first
    in listing order. Listing and requests meet in one equi-join on every spelling a request can
    match; the listing is first reduced to one entry per spelling.
    """
    entry = F.struct("ordinal", "name")
    spellings = listing.select(
        entry.alias("entry"),
        F.explode(
            F.array(
                F.struct(F.lit("exact").alias("kind"), F.col("name").alias("spelling")),
                F.struct(F.lit("folded").alias("kind"), F.lower("name").alias("spelling")),
            )
        ).alias("s"),
    )
    known = spellings.groupBy("s.kind", "s.spelling").agg(F.min("entry").alias("entry"))

    def candidate(rank: int, kind: str, spelling: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), spelling.alias("spelling")
        )

    name = F.col("request")
    wanted = requests.select("request").distinct().select(
        "request",
        F.explode(
            F.array(
                candidate(1, "exact", name),
                candidate(2, "exact", F.concat(name, F.lit(".csv"))),
                candidate(3, "folded", F.lower(name)),
                candidate(3, "folded", F.concat(F.lower(name), F.lit(".csv"))),
            )
        ).alias("c"),
    ).select("request", "c.*")
    found = wanted.join(known, ["kind", "spelling"], "left")
    best = F.min(F.when(F.col("entry").isNotNull(), F.struct("rank", "entry")))
    return found.groupBy("request").agg(best.alias("best")).select(
        "request", F.col("best.entry.name").alias("file"), F.col("best.rank").alias("match_rank")
    )


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """Add ``file_row_number``, counting from 1 in each file, also when a file is split.

    ``rows`` must come straight from a file read and carry ``file_path``, ``file_block_start`` and
    ``row_id`` (see :func:`provenance`). Row ids rise within a split, so a row's number is its
    distance from the split's first id plus the rows of the splits before it.
    """
    split = ["file_path", "file_block_start"]
    splits = rows.groupBy(*split).agg(
        F.min("row_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = (
        Window.partitionBy("file_path")
        .orderBy("file_block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = splits.select(
        *split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # One row per split, written so that counting them does not read the files again.
    starts = cut_lineage(starts, "splits")
    numbered = rows.join(
        F.broadcast(starts) if starts.count() <= BROADCAST_SPLITS else starts, split
    )
    number = F.col("_before") + F.col("row_id") - F.col("_first") + 1
    return numbered.withColumn("file_row_number", number).drop("_first", "_before")


def provenance() -> list[Column]:
    """Where a row came from: select these next to the columns of a file read."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.current_timestamp().alias("scan_started"),
    ]


def content_keys(spark: SparkSession, folder: str, glob: str = "*.csv*") -> DataFrame:
    """(file_path, file_size, file_modified, lines, content_key): a checksum of each file's lines in order.

    Built from the numbered lines rather than from the whole file, so one large file spreads over tasks.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(folder)
        .select("value", *provenance())
    )
    numbered = with_row_numbers(lines)
    digest = F.md5(F.concat_ws(":", F.col("file_row_number").cast("string"), "value"))
    facts = numbered.select("file_path", "file_size", "file_modified", digest.alias("_digest"))
    return facts.groupBy("file_path", "file_size", "file_modified").agg(
        F.count(F.lit(1)).alias("lines"), digest_sum(F.col("_digest")).alias("content_key")
    )
