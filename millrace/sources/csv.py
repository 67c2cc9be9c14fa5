"""Reading and writing delimited text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from csv import reader
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.names import header_names
from millrace.functions.text import NULL_TOKENS, null_if
from millrace.sources.files import provenance, with_row_numbers
from millrace.workspace import cut_lineage


@dataclass(frozen=True)
class CsvFormat:
    """How a delimited file is written.

    Rows with too few fields are filled with nulls and surplus fields are dropped. ``multi_line``
    lets quoted values hold line breaks, at the price that a file is read by one task: land such
    data as many files of moderate size. A ``.gz`` file cannot be split either.
    """

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    trim: bool = False
    multi_line: bool = False
    null_tokens: tuple[str, ...] = NULL_TOKENS

    def reader_options(self) -> dict[str, str]:
        return {
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.quote,
            "header": str(self.header).lower(),
            "multiLine": str(self.multi_line).lower(),
            "ignoreLeadingWhiteSpace": str(self.trim).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim).lower(),
            "mode": "PERMISSIVE",
            "encoding": "UTF-8",
        }


# Reader defaults, and the bulk-load format with its own null tokens and trimming.
READER_DEFAULTS = CsvFormat()
# The null tokens of a bulk load.
BULK_LOAD = CsvFormat(trim=True, null_tokens=("NULL", "null", ""))
MULTI_LINE = replace(READER_DEFAULTS, multi_line=True)


# Where a checked read leaves the text of a line that cannot be read, and the line's number in its file.
RECORD, LINE = "_record", "_line"


def first_line(spark: SparkSession, path: str, fmt: CsvFormat = READER_DEFAULTS) -> list[str | None]:
    """The cells of the first line of the first file."""
    options = {**fmt.reader_options(), "header": "false"}
    first = spark.read.options(**options).option("recursiveFileLookup", "true").csv(path).head()
    return list(first) if first is not None else []


def csv_header(spark: SparkSession, path: str, fmt: CsvFormat = READER_DEFAULTS) -> list[str]:
    """The column names of the first file: blanks and repeats made usable."""
    return header_names(first_line(spark, path, fmt))


def read_csv(
    spark: SparkSession,
    path: str,
    fmt: CsvFormat = READER_DEFAULTS,
    names: list[str] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """All columns as text, null tokens as null.

    With ``names`` the columns go by position. Without, the first file's header names them, and a file
    with another header fails the read: :func:`read_csv_by_name` reads such folders. A header with
    blank or repeated names cannot be compared by the reader; there the first lines of all files are compared
    before, and ValueError names a file that differs.
    Partition folders (``key=value``) below ``path`` become text columns after the file's own.
    """
    by_position = names is not None
    if names is None:
        raw = first_line(spark, path, fmt)
        names = header_names(raw)
        by_position = not fmt.header or names != raw
        if fmt.header and by_position and raw:
            require_one_header(spark, path, fmt, glob)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    files = spark.read.schema(schema).options(**fmt.reader_options())
    files = files.option("enforceSchema", str(by_position).lower())
    if glob:
        files = files.option("pathGlobFilter", glob)
    df = files.csv(path)
    texts = [null_if(F.col(f"`{c}`"), fmt.null_tokens).alias(c) for c in names]
    return df.select(*texts, *df.columns[len(names):])


def first_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, line): the first line of each file that is not blank."""
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    first = lines.filter((F.col("_start") == 0) & (F.trim("value") != "")).groupBy("path")
    return first.agg(F.min(F.struct("_id", "value"))["value"].alias("line"))


def require_one_header(spark: SparkSession, path: str | list[str], fmt: CsvFormat, glob: str | None = None) -> None:
    """ValueError unless all files begin with the same line."""
    files = first_lines(spark, path, glob)
    line = F.trim("line") if fmt.trim else F.col("line")
    seen = files.groupBy(line.alias("line")).agg(F.min("path").alias("path")).orderBy("line").limit(2).collect()
    if len(seen) > 1:
        raise ValueError(f"{seen[0].path} and {seen[1].path} have different headers: {seen[0].line!r}, {seen[1].line!r}")


HEADERS = "path string, line string, names array<string>"


def file_headers(spark: SparkSession, path: str | list[str], fmt: CsvFormat = READER_DEFAULTS) -> DataFrame:
    """(path, line, names): the column names of each file, blanks and repeats made usable.

    Headers are single lines. The names are found once for each different line, of which there are as many as
    there are layouts; finding the lines is a pass over the files.
    """
    first = cut_lineage(first_lines(spark, path), "headers")
    lines = [r.line for r in first.select("line").distinct().collect()]
    layouts = [
        (line, header_names([c or None for c in next(reader([line], delimiter=fmt.delimiter, quotechar=fmt.quote))]))
        for line in sorted(lines)
    ]
    known = spark.createDataFrame(layouts, "line string, names array<string>")
    return first.join(F.broadcast(known), "line").select("path", "line", "names")


def read_by_headers(
    spark: SparkSession, path: str | list[str], headers: DataFrame, names: Sequence[str], fmt: CsvFormat = READER_DEFAULTS
) -> DataFrame:
    """``names`` from files whose headers are known; a file without a column has nulls there.

    One scan reads all files by position; each row finds its file's names by the file's path and picks its cells.
    """
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    cells = [f"_{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    rows = (
        spark.read.schema(schema).options(**fmt.reader_options()).option("enforceSchema", "true")
        .option("recursiveFileLookup", "true").csv(path)
        .select(F.array(*cells).alias("_cells"), F.col("_metadata.file_path").alias("_path"))
    )
    placed = rows.join(headers.select(F.col("path").alias("_path"), F.col("names").alias("_names")), "_path")

    def cell(name: str) -> Column:
        place = F.array_position("_names", name).cast("int") - 1
        return null_if(F.get("_cells", place), fmt.null_tokens).alias(name)

    return placed.select(*[cell(n) for n in names])


def read_csv_by_name(spark: SparkSession, path: str | list[str], fmt: CsvFormat = READER_DEFAULTS) -> DataFrame:
    """Files whose headers differ, each read by its own header, as one table of all their columns.

    Column names keep the order in which the headers, sorted, bring them up.
    """
    headers = file_headers(spark, path, fmt)
    layouts = headers.select("line", "names").distinct().collect()
    names = list(dict.fromkeys(n for r in sorted(layouts) for n in r.names))
    return read_by_headers(spark, path, headers, names, fmt)


def is_well_formed(line: Column, fmt: CsvFormat = READER_DEFAULTS) -> Column:
    """Whether each quoted value of a line is closed, and followed by a delimiter or the line's end.

    A quote within an unquoted value is a character like others. Too few or too many values are no fault.
    """
    q, d = re.escape(fmt.quote), re.escape(fmt.delimiter)
    gap = "[ \\t]*+" if fmt.trim else ""
    quoted = f"{gap}{q}(?:[^{q}]++|{q}{q})*+{q}{gap}"
    value = f"(?:{quoted}|(?!{gap}{q})[^{d}]*+)"
    # Most lines have no quote at all.
    return ~line.contains(fmt.quote) | line.rlike(f"^{value}(?:{d}{value})*+$")


def read_csv_checked(
    spark: SparkSession, path: str | list[str], names: list[str], fmt: CsvFormat = BULK_LOAD
) -> DataFrame:
    """The cells of each line by position, with ``file_path``, the line's number and its text if it is malformed.

    A line whose quotes are broken has nulls for cells and its text in ``_record``; the plain reader would take
    the rest of the line for one value without a word. Values do not span lines here. The first line of a
    file is its header if the format has one. Blank lines are no records.
    """
    if fmt.multi_line:
        raise ValueError("lines can be checked only where no value spans lines")
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", *provenance())
    numbered = with_row_numbers(lines).filter(F.trim("value") != "")
    if fmt.header:
        numbered = numbered.filter(F.col("file_row_number") > 1)
    good = is_well_formed(F.col("value"), fmt)
    cells = ", ".join(f"`{n}` string" for n in names)
    options = {k: v for k, v in fmt.reader_options().items() if k not in ("header", "multiLine", "encoding")}
    parsed = F.from_csv(F.when(good, F.col("value")), cells, options)
    # Cells are unfolded, not picked from the parsed line, else a filter on them would parse the line once for each mention.
    places = [f"_{i}" for i in range(len(names))]
    return numbered.select(
        "file_path", F.col("file_row_number").alias(LINE), F.when(~good, F.col("value")).alias(RECORD),
        F.inline(F.array(parsed)).alias(*places),
    ).select("file_path", LINE, RECORD, *[null_if(F.col(p), fmt.null_tokens).alias(n) for p, n in zip(places, names, strict=True)])


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Redistribute the rows of files that cannot be split, over all cores unless told otherwise."""
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def write_csv(
    df: DataFrame,
    path: str,
    compression: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """UTF-8 with a header, replacing what was there; blank texts and nulls are both empty."""
    writer = df.write.mode("overwrite").options(
        header="true", quote='"', escape='"', emptyValue="", nullValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
