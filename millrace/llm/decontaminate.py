"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are short, documents long, so the question is containment: the share of an item's shingles
(five words) that a document has. Items are partitioned by size into classes (8 to 15 shingles, 16 to 31,
...). In a class with at most u shingles an item's sketch is its k = floor((1 - t) u) + 1 smallest MinHash
values. A document that holds t of the item's q shingles misses at most floor((1 - t) q) of them, so at
least k - floor((1 - t) q) >= 1 of the sketch are among its own: the search loses nothing, whatever the
document's length. Candidates are then verified by the exact shingle containment.

The sketches are joined to the documents' shingles as these are read. That side is broadcast behind a
check of its size; a larger one takes a shuffled join. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import broadcast_if_small, free_name, lower_ascii, named, require, words_of
from millrace.workspace import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
# Rows of a table that may be broadcast: about 50 MB of ids and hashes.
BROADCAST_ROWS = 1_000_000


def shingled(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(_key, shingle) for each word window, A-Z lower-cased; a text with fewer words is one, none has none.

    The outer explode keeps Spark from testing the array's size below the projections that make it,
    which would split each text again for every window.
    """
    words = df.select(named(key).alias("_key"), words_of(lower_ascii(named(text))).alias("_words"))
    hashed = words.select("_key", F.transform("_words", lambda w: F.xxhash64(w)).alias("_words"))
    window = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_words") - size, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(size)]),
    )
    windows = hashed.select("_key", F.when(F.size("_words") > 0, window).alias("_shingles"))
    return windows.select("_key", F.explode_outer("_shingles").alias("shingle")).where(F.col("shingle").isNotNull())


def item_table(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item, shingle, shingles of the item) without repetition."""
    shingles = shingled(items.where(named(item_id).isNotNull()), item_id, text, size)
    each = shingles.withColumnRenamed("_key", "item").distinct()
    counts = each.groupBy("item").agg(F.count("*").alias("item_shingles"))
    return each.join(counts, "item")


def may_miss(shingles, threshold: float):
    """Shingles of an item that a document may lack and still reach the threshold."""
    # The smallest share that counts is rounded as the final comparison is: shared >= threshold * shingles.
    return F.floor(shingles - F.ceil(F.lit(threshold) * shingles - 1e-9))


def sketches(each: DataFrame, threshold: float) -> DataFrame:
    """The smallest hashes of each item, as many as the upper size of its class asks for."""
    from pyspark.sql import Window

    upper = F.pow(F.lit(2.0), F.floor(F.log2("item_shingles")) + 1) - 1
    length = F.floor((1 - threshold) * upper + 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("item").orderBy("shingle"))
    kept = each.withColumn("_rank", rank).withColumn("_length", F.least(length, F.col("item_shingles")))
    needed = F.greatest(F.col("_length") - may_miss(F.col("item_shingles"), threshold), F.lit(1))
    return kept.where(F.col("_rank") <= F.col("_length")).select("item", "shingle", "item_shingles", needed.alias("needed"))


def contaminations(
    documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE,
    doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs (doc_id, item_id, item_shingles, shared, containment) with containment >= ``threshold``.

    Null and blank texts have no shingles and are in no pair. Rows with a null id are in no pair, as
    nothing names them. Rows that repeat an id are one document (item): its shingles are those of all
    its rows, so repeated rows change nothing. Other columns are ignored. Empty tables give no pairs.
    The result's id columns have the names of the inputs' ids, the item's with ``item_`` in front if
    both are equal.
    """
    require(documents, doc_id, doc_text)
    require(items, item_id, item_text)
    each = cut_lineage(item_table(items, item_id, item_text, size), "items")
    sketch = cut_lineage(sketches(each, threshold), "sketches")
    texts = documents.select(named(doc_id).alias("_id"), named(doc_text).alias("_text")).where("_id IS NOT NULL")
    found = (
        shingled(texts, "_id", "_text", size)
        .join(broadcast_if_small(sketch, BROADCAST_ROWS), "shingle")
        .groupBy("_key", "item", "needed").agg(F.count_distinct("shingle").alias("hits"))
    )
    candidates = cut_lineage(found.where("hits >= needed").select("_key", "item"), "candidates")
    suspects = candidates.select("_key").distinct()
    again = (
        texts.join(broadcast_if_small(suspects, BROADCAST_ROWS), F.col("_id") == F.col("_key"), "left_semi")
    )
    shared = (
        shingled(again, "_id", "_text", size)
        .join(broadcast_if_small(each, BROADCAST_ROWS), "shingle")
        .join(broadcast_if_small(candidates, BROADCAST_ROWS), ["_key", "item"], "left_semi")
        .groupBy("_key", "item", "item_shingles").agg(F.count_distinct("shingle").alias("shared"))
    )
    containment = F.col("shared") / F.col("item_shingles")
    second = item_id if item_id != doc_id else f"item_{item_id}"
    return shared.withColumn("containment", containment).where(F.col("containment") >= threshold).select(
        F.col("_key").alias(doc_id), F.col("item").alias(second), "item_shingles", "shared", "containment"
    )


def decontaminate(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no item, with all their columns; rows with a null id stay."""
    name = free_name(documents, "_held")
    held = contaminations(documents, items, doc_id=doc_id, **options).select(named(doc_id).alias(name))
    flagged = cut_lineage(held.distinct(), "contaminated")
    return documents.join(
        broadcast_if_small(flagged, BROADCAST_ROWS), named(doc_id) == F.col(name), "left_anti"
    )
