"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites of each line is built per line hash and merged by aggregation, in the
map tasks first, so a line that stands in a third of all documents arrives as one small sketch per task.
Lines whose estimate is clearly above the threshold are boilerplate; lines near the threshold (within
``BAND`` of it, four standard errors) get their exact number of distinct sites. Boilerplate lines are
removed from all documents but the first that has them, so no text is lost altogether.

Sketches, exact counts and removal read all lines of all documents; only lines near or above the
threshold go on after the first aggregation.

The threshold is one number for all lines, or falls with a line's length (``by_length``): long lines do not
meet by chance, so from ``LONG_WORDS`` words on ``LONG_SITES`` sites are enough, and between ``FALLS_FROM``
words and these the number falls evenly. Lines of fewer than ``min_words`` words do, so there they need
``SHORT_FACTOR`` times the sites; without ``by_length`` they are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import broadcast_if_small, free_name, named, require
from millrace.workspace import cut_lineage

MIN_SITES = 10
MIN_WORDS = 3
FALLS_FROM = 10  # words up to which a line needs ``min_sites`` sites, where the number falls with the length
LONG_WORDS, LONG_SITES = 50, 3
SHORT_FACTOR = 2  # times the sites that a line of fewer than ``min_words`` words needs there
# Registers of a sketch as a power of two; the standard error is 1.04 / sqrt(2 ** 8) = 6.5 per cent.
SKETCH_BITS = 8
BAND = 0.26
# Rows of a table that may be broadcast: about 50 MB of hashes.
BROADCAST_ROWS = 1_000_000
EDGES = "\t\n\x0b\x0c\r "


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(EDGES))


def hashes(*parts: Column) -> list[Column]:
    """128 bits of hash in two columns."""
    return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *parts).alias("_h2")]


def sites_needed(words: Column, min_sites: int, min_words: int, by_length: bool) -> Column:
    """The distinct sites that make a line of so many words boilerplate."""
    if not by_length:
        return F.lit(min_sites)
    least = min(LONG_SITES, min_sites)
    fall = F.floor((words - FALLS_FROM) * (min_sites - least) / (LONG_WORDS - FALLS_FROM))
    enough = F.greatest(F.lit(least), F.least(F.lit(min_sites), min_sites - fall))
    return F.when(words < min_words, SHORT_FACTOR * min_sites).otherwise(enough).cast("int")


def lines_of(
    documents: DataFrame, doc_id: str, text: str, site: str, min_sites: int, min_words: int, by_length: bool
) -> DataFrame:
    """All lines that may be boilerplate: place (document key, id, position), site, sites needed and line hash."""
    rows = documents.select(
        named(doc_id).alias("_doc"), named(site).cast("string").alias("_site"),
        *[h.alias(n) for h, n in zip(hashes(named(doc_id), named(text)), ("_d1", "_d2"))],
        F.posexplode_outer(F.split(named(text), "\n")).alias("_pos", "_line"),
    )
    line = rows.withColumn("_line", trimmed(F.col("_line")))
    words = F.size(F.split("_line", r"[\x20\x09-\x0D]+"))
    counted = F.col("_line") != "" if by_length else words >= min_words
    return line.where(counted).select(
        "_doc", "_site", "_d1", "_d2", "_pos", sites_needed(words, min_sites, min_words, by_length).alias("_needed"),
        *hashes(F.col("_line"))
    )


def boilerplate_lines(
    documents: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
    doc_id: str = "doc_id", text: str = "text", site: str = "source", by_length: bool = False,
) -> DataFrame:
    """Hashes (_h1, _h2) of the lines that stand on as many distinct sites as they need."""
    lines = lines_of(documents, doc_id, text, site, min_sites, min_words, by_length)
    spread = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS))).alias("_sites"),
        F.max("_needed").alias("_needed"),
    )
    wide = cut_lineage(spread.where(F.col("_sites") >= (1 - BAND) * F.col("_needed")), "spread")
    sure = wide.where(F.col("_sites") > (1 + BAND) * F.col("_needed")).select("_h1", "_h2")
    near = wide.where(F.col("_sites") <= (1 + BAND) * F.col("_needed")).select("_h1", "_h2")
    exact = (
        lines.join(broadcast_if_small(near, BROADCAST_ROWS), ["_h1", "_h2"], "left_semi")
        .groupBy("_h1", "_h2").agg(F.count_distinct("_site").alias("_sites"), F.max("_needed").alias("_needed"))
        .where(F.col("_sites") >= F.col("_needed"))
    )
    return cut_lineage(sure.unionByName(exact.select("_h1", "_h2")), "boilerplate")


def remove_boilerplate(
    documents: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
    doc_id: str = "doc_id", text: str = "text", site: str = "source", removed: str = "n_removed",
    by_length: bool = False,
) -> DataFrame:
    """``documents`` without boilerplate lines; ``removed`` has the number of lines each text lost.

    A line is what stands between line feeds, without white space at its edges; lines of fewer than
    ``min_words`` words are never boilerplate, as short sentences meet by chance. With ``by_length`` the
    sites that a line needs fall with its length and short lines need more, empty ones aside; else all
    need ``min_sites``. The first occurrence stays (smallest id, null first, then position). A null site adds no site; a null text stays null and
    loses nothing; an empty text stays empty. Rows with equal id and text are one document: they lose
    the same lines and all stay. Other columns pass through; one named like ``removed`` gives way to it.
    An empty table gives an empty table.
    """
    require(documents, doc_id, text, site)
    boilerplate = boilerplate_lines(documents, min_sites, min_words, doc_id, text, site, by_length)
    marked = broadcast_if_small(boilerplate, BROADCAST_ROWS)
    lines = lines_of(documents, doc_id, text, site, min_sites, min_words, by_length)
    # Written once: the first occurrences and all others are found from it, without splitting the texts again.
    hits = cut_lineage(lines.drop("_site", "_needed").join(marked, ["_h1", "_h2"]), "hits")
    first = hits.groupBy("_h1", "_h2").agg(F.min(F.struct("_doc", "_pos", "_d1", "_d2")).alias("_first"))
    first = cut_lineage(first.select("_h1", "_h2", "_first.*"), "first").toDF("_h1", "_h2", "_f0", "_f1", "_f2", "_f3")
    others = hits.join(broadcast_if_small(first, BROADCAST_ROWS), ["_h1", "_h2"]).where(
        ~((F.col("_pos") == F.col("_f1")) & (F.col("_d1") == F.col("_f2")) & (F.col("_d2") == F.col("_f3")))
    )
    # Names that no column of ``documents`` has, in any case.
    d1, d2, lost, pieces = (free_name(documents, n) for n in ("_d1", "_d2", "_lost", "_lines"))
    positions = others.groupBy(F.col("_d1").alias(d1), F.col("_d2").alias(d2)).agg(F.collect_set("_pos").alias(lost))
    kept = [c for c in documents.columns if c.lower() != removed.lower()]
    keys = [h.alias(n) for h, n in zip(hashes(named(doc_id), named(text)), (d1, d2))]
    joined = documents.select(*map(named, kept), *keys).join(positions, [d1, d2], "left")
    rest = F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(F.col(pieces)) - 1), F.col(lost)),
            lambda i: F.get(pieces, i),
        ), "\n",
    )
    split = joined.withColumn(pieces, F.when(F.col(lost).isNotNull(), F.split(named(text), "\n")))
    return split.select(
        *[F.when(F.col(lost).isNull(), named(c)).otherwise(rest).alias(c) if c == text else named(c) for c in kept],
        F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(removed),
    )
