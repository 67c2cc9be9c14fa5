"""Reconciliation: counts, presence, contents, checksums and keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.workspace import cut_lineage


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, all counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def existing_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}


def _match() -> Column:
    return F.coalesce(F.col("row_count") == F.col("expected_rows"), F.lit(False))


def verify_estimate(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual rows against ``expected`` (table_name, expected_rows): success, warning, or failed for a
    table that is not there."""
    status = F.when(F.col("row_count").isNull(), "failed").when(_match(), "success").otherwise("warning")
    return expected.join(counts, "table_name", "left").select(
        "table_name", "expected_rows", F.col("row_count").alias("actual_rows"), status.alias("status")
    )


def verify_source(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual rows against the rows of the source, with the share that arrived."""
    percent = F.col("actual_rows") / F.col("expected_rows") * 100
    return (
        expected.join(counts, "table_name", "left")
        .withColumn("row_count_match", _match())
        .select(
            "table_name",
            "expected_rows",
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("actual_rows"),
            "row_count_match",
            F.coalesce("column_count", F.lit(0)).alias("column_count"),
        )
        .withColumn(
            "match_percentage",
            F.when(F.col("expected_rows") > 0, percent).otherwise(F.lit(0.0)),
        )
        .withColumn("verification_passed", F.col("row_count_match"))
    )


def verify_all(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Per expected table: exists, has data, count matches; ``overall_success`` needs all of them.

    The window spans the list of tables, one row each.
    """
    passed = F.col("table_exists") & F.col("count_match")
    tables = expected.join(counts, "table_name", "left").select(
        "table_name",
        "expected_rows",
        F.col("row_count").isNotNull().alias("table_exists"),
        (F.coalesce("row_count", F.lit(0)) > 0).alias("has_data"),
        _match().alias("count_match"),
    )
    return tables.withColumn("overall_success", F.bool_and(passed).over(Window.partitionBy()))


def verify_nonempty(counts: DataFrame, names: DataFrame) -> DataFrame:
    """success with rows, warning without, error for a table that cannot be counted."""
    status = (
        F.when(F.col("row_count").isNull(), "error")
        .when(F.col("row_count") > 0, "success")
        .otherwise("warning")
    )
    return names.join(counts, "table_name", "left").select(
        "table_name",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        status.alias("status"),
    )


def verify_outputs(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Each expected file name with whether the listing has it."""
    present = listing.select("name").distinct().withColumn("_found", F.lit(True))
    return expected.join(present, "name", "left").select(
        "name", F.col("_found").isNotNull().alias("present")
    )


def _row_hashes(df: DataFrame) -> list[Column]:
    """128 bits of hash of a row; the hash passes over nulls, so whether a value is null goes in as well."""
    cells = [cell for c in df.columns for cell in (_quoted(c), _quoted(c).isNull())]
    return [F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(1), *cells).alias("_h2")]


BUCKETS = 4096


def bucket_checksums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sums): the rows of a table in buckets by their hash, each with the sums of its hashes' parts.

    One narrow scan; map tasks hand on a row a bucket. Kept beside a table, they let :func:`table_diff` compare it
    without reading it, as long as it has the same columns in the same order.
    """
    h1, h2 = F.col("_h1"), F.col("_h2")
    parts = [F.shiftrightunsigned(h1, 32), h1.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h2, 32), h2.bitwiseAND(F.lit(0xFFFFFFFF))]
    return df.select(*_row_hashes(df)).groupBy(F.pmod(h1, F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.sum(p) for p in parts]).alias("sums")
    )


def differing_buckets(left: DataFrame, right: DataFrame) -> list[int]:
    """The buckets whose checksums differ; at most as many as there are buckets."""
    other = right.select("bucket", F.col("rows").alias("_rows"), F.col("sums").alias("_sums"))
    both = left.join(other, "bucket", "full_outer")
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("sums").eqNullSafe(F.col("_sums"))
    return [r.bucket for r in both.filter(~same).select("bucket").collect()]


def table_diff(
    left: DataFrame, right: DataFrame, left_sums: DataFrame | None = None, right_sums: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows that two tables do not share, with ``side`` and how many more ``copies`` that side has.

    First the checksums of both sides' buckets are compared: one narrow scan of each side, or none where its
    checksums (with ``buckets`` buckets) are given. Only rows of buckets that differ are then added up by
    row hash, +1 on the left and -1 on the right, in one shuffle; equal tables are not read again. Where more than a
    quarter of the buckets differ, hashes alone are shuffled, and whole rows are fetched for those that differ.
    """
    columns = left.columns
    right = right.select(*[_quoted(c) for c in columns])
    found = differing_buckets(
        bucket_checksums(left, buckets) if left_sums is None else left_sums,
        bucket_checksums(right, buckets) if right_sums is None else right_sums,
    )
    if len(found) > buckets // 4:
        return _diff_by_hashes(left, right)
    of_bucket = F.pmod(F.col("_h1"), F.lit(buckets)).cast("int")

    def signed(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*_row_hashes(df), F.lit(sign).alias("_sign"), F.struct(*[_quoted(c) for c in columns]).alias("_row"))
        return rows.filter(of_bucket.isin(found))

    balance = signed(left, 1).unionByName(signed(right, -1)).groupBy("_h1", "_h2").agg(
        F.sum("_sign").alias("_balance"), F.any_value("_row").alias("_row")
    ).filter("_balance <> 0")
    side = F.when(F.col("_balance") > 0, "only_left").otherwise("only_right")
    return balance.select("_row.*", side.alias("side"), F.abs("_balance").alias("copies"))


def _diff_by_hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    """The same over all rows: hashes are added up first, whole rows only fetched for those that differ."""
    columns = left.columns
    signs = left.select(*_row_hashes(left), F.lit(1).alias("_sign")).unionByName(
        right.select(*_row_hashes(right), F.lit(-1).alias("_sign"))
    )
    balance = signs.groupBy("_h1", "_h2").agg(F.sum("_sign").alias("_balance")).filter("_balance <> 0")
    balance = cut_lineage(balance, "balance")

    def only(df: DataFrame, side: str, more: Column) -> DataFrame:
        wanted = balance.filter(more > 0).select("_h1", "_h2", more.alias("copies"))
        rows = df.select("*", *_row_hashes(df)).join(wanted, ["_h1", "_h2"]).dropDuplicates(["_h1", "_h2"])
        return rows.select(*[_quoted(c) for c in columns], F.lit(side).alias("side"), "copies")

    return only(left, "only_left", F.col("_balance")).unionByName(only(right, "only_right", -F.col("_balance")))


def compare_tables(left: DataFrame, right: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Whether one table equals another: a row per check with how much differs.

    Checks are missing, additional and retyped columns, rows of one side only over the columns both
    have, and null or repeated keys on the right. ``passed`` is true where nothing differs.
    """
    spark = left.sparkSession
    schema = schema_diff(left, right)
    counts = [
        ("missing_columns", sum(b is None for _, _, b in schema), [c for c, _, b in schema if b is None]),
        ("additional_columns", sum(a is None for _, a, _ in schema), [c for c, a, _ in schema if a is None]),
        ("retyped_columns", sum(None not in (a, b) for _, a, b in schema), [c for c, a, b in schema if None not in (a, b)]),
    ]
    facts = spark.createDataFrame(
        [(check, n, ", ".join(names) or None) for check, n, names in counts], "check string, differences bigint, detail string"
    )
    differing = {c for c, _, _ in schema}
    known = {c.lower(): c for c in right.columns}
    shared = [c for c in left.columns if c.lower() not in differing]
    found = [facts]
    no_detail = F.lit(None).cast("string").alias("detail")
    if shared:
        renamed = right.select(*[_quoted(known[c.lower()]).alias(c) for c in shared])
        diff = cut_lineage(table_diff(left.select(*[_quoted(c) for c in shared]), renamed).select("side", "copies"), "diff")
        for side in ("only_left", "only_right"):
            total = F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("differences")
            found.append(diff.filter(F.col("side") == side).agg(total).select(F.lit(f"rows_{side}").alias("check"), "differences", no_detail))
    if key:
        broken = pk_violations(right, key).groupBy().agg(F.count(F.lit(1)).alias("differences"))
        found.append(broken.select(F.lit("key_violations").alias("check"), "differences", no_detail))
    report = reduce(DataFrame.unionByName, found)
    return report.withColumn("passed", F.col("differences") == 0)


def schema_diff(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """Columns whose name or type differs: (column, left type, right type)."""
    a = {f.name.lower(): f.dataType.simpleString() for f in left.schema}
    b = {f.name.lower(): f.dataType.simpleString() for f in right.schema}
    return [(c, a.get(c), b.get(c)) for c in dict.fromkeys([*a, *b]) if a.get(c) != b.get(c)]


def digest_sum(digest: Column) -> Column:
    """The sums of both 64-bit halves of 128-bit hexadecimal digests, as one text."""
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return F.concat_ws("-", *[F.coalesce(F.sum(h), F.lit(0)).cast("string") for h in halves])


def table_checksum(texts: DataFrame, table: str) -> DataFrame:
    """Rows and a checksum that does not depend on row order.

    ``texts`` holds text columns; nulls and column borders count. Every row adds both 64-bit halves of
    its digest to a wide decimal each, which 10^18 rows would not overflow.
    """
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`")), F.lit("~")) for c in texts.columns]
    return texts.select(F.md5(F.concat_ws("|", *cells)).alias("_digest")).agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        digest_sum(F.col("_digest")).alias("checksum"),
    )


def fast_checksum(df: DataFrame) -> DataFrame:
    """The same idea with a cheaper 64-bit hash of the typed values, for Spark-to-Spark checks.

    The hash passes over nulls, so whether a value is null goes in as well.
    """
    cells = [cell for c in df.columns for cell in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    row = F.xxhash64(*cells).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row).cast("string").alias("checksum"))


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are null or held by several rows, with the number of rows."""
    has_null = reduce(lambda a, b: a | b, [_quoted(c).isNull() for c in key])
    counted = df.groupBy(*[_quoted(c) for c in key]).agg(F.count(F.lit(1)).alias("row_count"))
    violation = F.when(has_null, "null_key").when(F.col("row_count") > 1, "duplicate_key")
    return counted.withColumn("violation", violation).filter(F.col("violation").isNotNull())
