"""Column types from names and data: one pass of statistics, then a rule set."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions.casts import (
    FALSE_TEXTS, LEADING_ZERO, TRUE_TEXTS, cast_to, changed_by_cast, changed_by_double, fraction_digits, is_integer,
    is_number, text_of, try_time, whole_digits,
)

# Words in a column name that hint at its type.
DATE_WORDS = ("date", "created", "modified", "updated", "timestamp", "time")
NUMBER_WORDS = (
    "amount", "price", "cost", "budget", "total", "sum", "count", "number", "id", "quantity", "qty",
)
FLAG_WORDS = ("flag", "is_", "has_", "active", "enabled", "status", "boolean", "bool")
EMAIL_WORDS = ("email", "mail")
PHONE_WORDS = ("phone", "tel")
LINK_WORDS = ("url", "link", "website")
NAME_WORDS = ("name",)
TEXT_WORDS = ("description", "desc", "notes")
CODE_WORDS = ("code", "id")
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Digits of a whole number below each bound, and above all of them.
DIGITS = ((10, 1), (100, 2), (1_000, 4), (10_000, 5), (100_000, 6), (1_000_000, 7))
MORE_DIGITS = 10
MAX_TEXT = 16_777_216

STATISTICS = (
    "rows", "filled", "numbers", "integers", "min_number", "max_number", "times", "days", "flag_mask",
    "flags", "emails", "max_length", "exponents", "inexact", "zero_led", "max_whole", "max_scale",
)
COUNTS = [
    "rows", "filled", "numbers", "integers", "times", "days", "flags", "emails", "exponents", "inexact", "zero_led",
]
KEPT_SCHEMA = (
    "table_name string, file_name string, size bigint, modified timestamp_ntz, ordinal int, column_name string, "
    + ", ".join(
        f"{c} {'double' if c.endswith('_number') else 'int' if c in ('flag_mask', 'max_length', 'max_whole', 'max_scale') else 'bigint'}"
        for c in STATISTICS
    )
)
_FLAG_TEXTS = (*TRUE_TEXTS, *FALSE_TEXTS)


def _flag_bit(text: Column) -> Column:
    low = F.lower(text)
    return reduce(
        lambda chain, i: chain.when(low == _FLAG_TEXTS[i], 1 << i),
        range(1, len(_FLAG_TEXTS)),
        F.when(low == _FLAG_TEXTS[0], 1),
    )


def sample_rows(df: DataFrame, rows: int) -> DataFrame:
    """A repeatable sample: the rows with the smallest hashes."""
    return df.orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).limit(rows)


def _judged(text: Column) -> list[Column]:
    number = F.when(is_number(text), text)
    return [
        number.try_cast("double").alias("number"),
        number.alias("digits"),
        try_time(text).alias("time"),
        is_integer(text).alias("integer"),
        _flag_bit(text).alias("flag"),
        (text.contains("@") & text.rlike(EMAIL)).alias("email"),
    ]


def _aggregates() -> list[Column]:
    digits = F.col("digits")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count("text").alias("filled"),
        F.count("number").alias("numbers"),
        F.count_if("integer").alias("integers"),
        F.min("number").alias("min_number"),
        F.max("number").alias("max_number"),
        F.count("time").alias("times"),
        F.count_if(F.col("time") == F.date_trunc("day", "time").cast("timestamp_ntz")).alias("days"),
        F.bit_or("flag").alias("flag_mask"),
        F.count("flag").alias("flags"),
        F.count_if("email").alias("emails"),
        F.max(F.length("text")).alias("max_length"),
        F.count_if(digits.isNotNull() & whole_digits(digits).isNull()).alias("exponents"),
        # Most numbers are too short to lose anything.
        F.count_if((F.length(digits) > 15) & changed_by_double(digits)).alias("inexact"),
        F.count_if(digits.rlike(LEADING_ZERO)).alias("zero_led"),
        F.max(whole_digits(digits)).alias("max_whole"),
        F.max(fraction_digits(digits)).alias("max_scale"),
    ]


def column_statistics(df: DataFrame, table: str, sample: int | None = None) -> DataFrame:
    """One row per column: counts of what its texts look like.

    One scan of the rows: each row unfolds into its cells, and the cells are aggregated by
    column within the map tasks, so only one small row per task and column is shuffled. Unlike a
    set of aggregates for every column this stays compact code for tables of any width.
    """
    source = sample_rows(df, sample) if sample else df
    cells = source.select(F.posexplode(F.array(*[text_of(df, c) for c in df.columns])).alias("ordinal", "text"))
    counted = cells.select("ordinal", "text", *_judged(F.col("text"))).groupBy("ordinal").agg(*_aggregates())
    # A table without rows has columns all the same. Both sides hold one row per column.
    columns = df.sparkSession.createDataFrame(
        [(table, i, c) for i, c in enumerate(df.columns)],
        "table_name string, ordinal int, column_name string",
    )
    found = columns.join(F.broadcast(counted), "ordinal", "left")
    return found.fillna(0, COUNTS).select("table_name", "ordinal", "column_name", *STATISTICS)


def file_statistics(df: DataFrame, table: str, file_column: str) -> DataFrame:
    """The statistics of each file's columns: rows that :func:`merge_statistics` adds up.

    One scan as for :func:`column_statistics`, aggregated by file and column. Kept beside the table, they let
    a later delivery be judged by its own files and these rows (:func:`statistics_with_new_files`).
    """
    names = [c for c in df.columns if c != file_column]
    cells = df.select(
        F.col(f"`{file_column}`").cast("string").alias("file_name"),
        F.posexplode(F.array(*[F.struct(F.lit(c).alias("column_name"), text_of(df, c).alias("text")) for c in names])).alias("ordinal", "cell"),
    ).select("file_name", "ordinal", "cell.column_name", "cell.text")
    counted = cells.select("file_name", "ordinal", "column_name", "text", *_judged(F.col("text"))).groupBy(
        "file_name", "ordinal", "column_name"
    ).agg(*_aggregates())
    return counted.select(F.lit(table).alias("table_name"), "file_name", "ordinal", "column_name", *STATISTICS)


def merge_statistics(statistics: DataFrame) -> DataFrame:
    """One row per table and column from the rows of its files; equal to one pass over all of them.

    Columns meet by name without regard to case, as they do in a table, and take the place they have in the first
    file by name that has them. A file without a column counts its rows as nulls there.
    """
    rows = statistics.groupBy("table_name", "file_name").agg(F.max("rows").alias("_rows"))
    total = rows.groupBy("table_name").agg(F.sum("_rows").alias("_total"))
    least = {"min_number": F.min, "flag_mask": F.bit_or}
    greatest = ("max_number", "max_length", "max_whole", "max_scale")
    first = F.min(F.struct("file_name", "ordinal", "column_name"))
    merged = statistics.groupBy("table_name", F.lower("column_name").alias("_key")).agg(
        first["file_name"].alias("_file"), first["ordinal"].alias("ordinal"), first["column_name"].alias("column_name"),
        *[(least.get(c) or (F.max if c in greatest else F.sum))(c).alias(c) for c in STATISTICS],
    )
    whole = merged.join(F.broadcast(total), "table_name").withColumn("rows", F.col("_total"))
    order = Window.partitionBy("table_name").orderBy("_file", "ordinal", "_key")  # one row per column
    return whole.withColumn("ordinal", F.row_number().over(order) - 1).select("table_name", "ordinal", "column_name", *STATISTICS)


def statistics_with_new_files(
    spark: SparkSession, table: str, kept_in: str, listing: DataFrame, read: Callable[[list[str]], DataFrame],
    file_column: str, batch: int = 5_000,
) -> DataFrame:
    """The statistics of all files of ``listing``, of which only those that ``kept_in`` lacks are read.

    ``kept_in`` is a catalog table of statistics rows with each file's size and time of change, made if it is
    not there. ``read`` gets paths and gives rows with their path in ``file_column``. Files are read in batches, and a
    batch's rows are added in one write. A file that has changed is read again; its newest rows hold. Rows of
    files that have gone are left out.
    """
    if not spark.catalog.tableExists(kept_in):
        spark.createDataFrame([], KEPT_SCHEMA).write.saveAsTable(kept_in)
    facts = listing.select(F.col("path").alias("file_name"), "size", "modified")
    kept = spark.table(kept_in).filter(F.col("table_name") == table)
    missing = facts.join(kept.select("file_name", "size", "modified").distinct(), ["file_name", "size", "modified"], "left_anti")
    paths = sorted(r.file_name for r in missing.select("file_name").collect())
    for at in range(0, len(paths), batch):
        part = paths[at : at + batch]
        found = file_statistics(read(part), table, file_column)
        noted = found.join(F.broadcast(facts.filter(F.col("file_name").isin(part))), "file_name")
        noted.select(*[f.name for f in spark.table(kept_in).schema]).write.mode("append").saveAsTable(kept_in)
    current = spark.table(kept_in).filter(F.col("table_name") == table).join(facts, ["file_name", "size", "modified"], "left_semi")
    return merge_statistics(current)


def _names(words: Sequence[str], whole_word: bool) -> Column:
    name = F.lower("column_name")
    if whole_word:
        options = "|".join(w.strip("_") for w in words)
        return name.rlike(f"(^|[^a-z])({options})([^a-z]|$)")
    return reduce(lambda a, b: a | b, [name.contains(w) for w in words])


def _all(count: str) -> Column:
    return (F.col("filled") > 0) & (F.col(count) == F.col("filled"))


def _whole_numbers() -> Column:
    # A reader gives a whole-number column with a missing value the type double.
    return _all("integers") & (F.col("filled") == F.col("rows"))


def _varchar(*sizes: tuple[int, int], largest: int) -> Column:
    chain = F.lit(f"VARCHAR({largest})")
    for longest, size in reversed(sizes):
        chain = F.when(F.col("max_length") <= longest, f"VARCHAR({size})").otherwise(chain)
    return chain


def _exact_number(kind: Column, text: Column) -> Column:
    """``kind``, unless it would change digits: then a decimal that holds them all, or text.

    Leading zeros make a column text. A column of numbers of which a double loses digits gets the digits before
    and the scale after the point that its values need, as long as 38 digits are enough.
    """
    digits = F.col("max_whole") + F.col("max_scale")
    whole = F.concat(F.lit("NUMBER("), F.greatest(digits, F.lit(1)).cast("string"), F.lit(")"))
    scaled = F.concat(F.lit("NUMBER("), digits.cast("string"), F.lit(","), F.col("max_scale").cast("string"), F.lit(")"))
    decimal = F.when((digits > 38) | (F.col("exponents") > 0), text).when(F.col("max_scale") > 0, scaled).otherwise(whole)
    return F.when(F.col("zero_led") > 0, text).when((kind == "FLOAT") & (F.col("inexact") > 0), decimal).otherwise(kind)


def infer_by_name_and_data(
    statistics: DataFrame, whole_word: bool = False, widest: bool = False, exact: bool = False
) -> DataFrame:
    """Dates, numbers and flags by name and data, then kinds of text; later findings win.

    Differences to a sampling reader: all values count, whole numbers are not dates, values with a time
    of day make a ``TIMESTAMP``, and only whole numbers make a ``NUMBER``.
    Words match anywhere in a name (``paid`` holds ``id``) unless ``whole_word`` is set. The
    digits of a number follow from its largest value, or with ``widest`` from the value furthest
    from zero, which also makes room for negative numbers. With ``exact`` no number loses a digit: columns with
    leading zeros are text, and those that a double would round are decimals (``NUMBER(p,s)``).
    """
    def has(words: Sequence[str]) -> Column:
        return _names(words, whole_word)

    size = F.abs("max_number")
    if widest:
        size = F.greatest(size, F.abs("min_number"))
    digits = F.lit(f"NUMBER({MORE_DIGITS})")
    for bound, width in reversed(DIGITS):
        digits = F.when(size < bound, f"NUMBER({width})").otherwise(digits)
    # Whole numbers beyond ten digits do not fit the widest size.
    digits = F.when(size >= 10.0**MORE_DIGITS, "NUMBER(38)").otherwise(digits)
    text = _varchar((50, 50), (100, 100), (255, 255), (500, 500), largest=1000)
    whole = _whole_numbers()
    flags = _all("flags") & (F.bit_count("flag_mask") <= 4) & (whole | ~_all("integers"))

    first = F.when(has(DATE_WORDS) & _all("times"), F.when(_all("days"), "DATE").otherwise("TIMESTAMP"))
    number = F.when(has(NUMBER_WORDS) & _all("numbers"), F.when(whole, digits).otherwise("FLOAT"))
    flag = F.when(has(FLAG_WORDS) & flags, "BOOLEAN")
    longest = F.greatest(F.abs("max_number"), F.abs("min_number"))
    code = F.when(
        _all("integers"),
        F.when(longest >= 10.0**MORE_DIGITS, "NUMBER(38)").otherwise(f"NUMBER({MORE_DIGITS})"),
    ).otherwise(F.when(_all("numbers"), "FLOAT").otherwise("VARCHAR(50)"))
    if exact:
        number, code = _exact_number(number, text), _exact_number(code, text)
    earlier = F.coalesce(flag, number, first, text)
    inferred = (
        F.when(F.col("filled") == 0, "VARCHAR(255)")
        .when(has(EMAIL_WORDS), F.when(_all("emails"), "VARCHAR(255)").otherwise(earlier))
        .when(has(PHONE_WORDS), "VARCHAR(20)")
        .when(has(LINK_WORDS), "VARCHAR(500)")
        .when(has(NAME_WORDS), "VARCHAR(100)")
        .when(has(TEXT_WORDS), "VARCHAR(1000)")
        .when(has(CODE_WORDS), code)
        .otherwise(earlier)
    )
    return statistics.withColumn("inferred_type", inferred)


def _number_or(text: Column, whole_word: bool) -> Column:
    numeric = (F.col("filled") == 0) | _all("numbers")
    kind = F.when(_whole_numbers(), "NUMBER(15)").otherwise("FLOAT")
    return F.when(_names(NUMBER_WORDS, whole_word), F.when(numeric, kind).otherwise(text))


def infer_generous(statistics: DataFrame, whole_word: bool = False) -> DataFrame:
    """Dates stay text, numbers by name and data, other texts get ample room."""
    def has(words: Sequence[str]) -> Column:
        return _names(words, whole_word)

    roomy = _varchar((100, 255), (500, 1000), largest=2000)
    inferred = (
        F.when(has(DATE_WORDS), "VARCHAR(100)")
        .when(has(NUMBER_WORDS), _number_or(F.lit("VARCHAR(255)"), whole_word))
        .when(has(EMAIL_WORDS), "VARCHAR(255)")
        .when(has(PHONE_WORDS), "VARCHAR(50)")
        .when(has(NAME_WORDS), "VARCHAR(255)")
        .when(has((*TEXT_WORDS, "comments")), "VARCHAR(2000)")
        .when(has(LINK_WORDS), "VARCHAR(1000)")
        .otherwise(F.when(F.col("filled") == 0, "VARCHAR(255)").otherwise(roomy))
    )
    return statistics.withColumn("inferred_type", inferred)


def infer_max_text(statistics: DataFrame, whole_word: bool = False) -> DataFrame:
    """Numbers by name and data, everything else text of the largest size."""
    text = F.lit(f"VARCHAR({MAX_TEXT})")
    inferred = F.coalesce(_number_or(text, whole_word), text)
    return statistics.withColumn("inferred_type", inferred)


def infer_by_data(statistics: DataFrame) -> DataFrame:
    """The type a CSV reader finds: whole number, number, flag or text. Texts of dates stay text,
    as do whole numbers too long for a 64-bit integer."""
    too_long = F.greatest(F.abs("max_number"), F.abs("min_number")) >= 1e18
    complete = F.col("filled") == F.col("rows")
    only_words = F.col("flag_mask").bitwiseAND(
        F.lit((1 << _FLAG_TEXTS.index("true")) | (1 << _FLAG_TEXTS.index("false")))
    ) == F.col("flag_mask")
    inferred = (
        F.when(F.col("filled") == 0, "FLOAT")
        .when(_all("integers") & too_long, "VARCHAR")
        .when(_whole_numbers(), "NUMBER")
        .when(_all("numbers"), "FLOAT")
        .when(_all("flags") & only_words & complete, "BOOLEAN")
        .otherwise("VARCHAR")
    )
    return statistics.withColumn("inferred_type", inferred)


def mapping_of(inferred: DataFrame) -> dict[str, str]:
    """``{column: type}`` on the driver; one entry per column."""
    rows = inferred.select("ordinal", "column_name", "inferred_type").collect()
    return {r.column_name: r.inferred_type for r in sorted(rows)}


def apply_types(
    df: DataFrame, types: dict[str, str], names: dict[str, str] | None = None
) -> DataFrame:
    """Cast text columns to their inferred types under their clean names.

    ``_bad_cells`` counts the values of a row that became null although they were not, and
    ``_changed_cells`` those that a cast keeps in another form (a fraction, leading zeros or a time of
    day goes).
    """
    names = names or {}
    casts, lost, changed = [], [], []
    for column, kind in types.items():
        text = F.col(f"`{column}`")
        value = cast_to(text, kind)
        casts.append(value.alias(names.get(column, column)))
        if not kind.startswith("VARCHAR"):
            lost.append((text.isNotNull() & value.isNull()).cast("int"))
            changed.append(F.coalesce(changed_by_cast(text, kind), F.lit(False)).cast("int"))
    bad = reduce(lambda a, b: a + b, lost, F.lit(0))
    other = reduce(lambda a, b: a + b, changed, F.lit(0))
    return df.select(*casts, bad.alias("_bad_cells"), other.alias("_changed_cells"))


MAPPING_SCHEMA = (
    "table_name string, position bigint, status string, ordinal int, column_name string, clean_name string,"
    " inferred_type string, created timestamp_ntz"
)


def saved_mapping(mappings: DataFrame, table: str) -> tuple[dict[str, str], dict[str, str]]:
    """(types, clean names) of the columns of ``table`` from a mapping table, its newest entry."""
    own = mappings.filter((F.col("table_name") == table) & (F.col("status") == "success"))
    newest = own.agg(F.max("position")).first()[0]
    rows = sorted(own.filter(F.col("position") == newest).collect(), key=lambda r: r.ordinal) if newest is not None else []
    return {r.column_name: r.inferred_type for r in rows}, {r.column_name: r.clean_name for r in rows}


def save_mapping(inferred: DataFrame, clean_names: dict[str, str], table: str, mapping_table: str) -> None:
    """Append the inferred types of one table, one row per column, to ``mapping_table``."""
    spark = inferred.sparkSession
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    position = int(now.timestamp() * 1_000_000)
    rows = [
        (table, position, "success", r.ordinal, r.column_name, clean_names.get(r.column_name, r.column_name), r.inferred_type, now)
        for r in inferred.select("ordinal", "column_name", "inferred_type").collect()
    ]
    spark.createDataFrame(rows, MAPPING_SCHEMA).write.mode("append").saveAsTable(mapping_table)


def read_typed(df: DataFrame) -> DataFrame:
    """Text columns with the types a CSV reader would give them."""
    kinds = {"NUMBER": "NUMBER(18)"}
    found = mapping_of(infer_by_data(column_statistics(df, "csv")))
    return apply_types(df, {c: kinds.get(t, t) for c, t in found.items()}).drop("_bad_cells", "_changed_cells")
