"""Similarity join of texts by the Jaccard similarity of their word n-grams, with Bayesian pruning.

1. Each text becomes its set of shingles (hashes of five words) and a MinHash signature. Texts with the
   same set are one class; only one member of a class goes on, so copies are never paired.
2. Signatures are cut into bands; classes that agree in a band are a bucket. Pairs within a bucket are
   compared MinHash value by value: after every ``STEP`` values a pair is dropped when the posterior
   probability that its similarity reaches the threshold is below ``TOLERANCE``. What is left is emitted
   as a forest (one edge per member), not as pairs. Its components are clusters.
3. Each cluster's classes meet once, with signatures and shingle sets. Pairs are pruned in the same way
   and the rest is verified exactly on the sets. The result is a count of links per class and a forest.

Buckets and clusters of more than ``BLOCK`` members are cut into blocks, and pairs of blocks go to
different tasks, so the size of a group never decides what one task holds; every pair of blocks is
compared, so nothing is lost. At the threshold of 0.8 a pair misses all 40 bands of 6 values with a
probability of 5e-6, less above it, and then mostly meets in its cluster all the same. Set equality and
verification use 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import broadcast_if_small, free_name, named, require
from millrace.llm.graph import components
from millrace.workspace import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
VALUES = BANDS * ROWS
STEP = 24
TOLERANCE = 1e-9
BLOCK = 1024
# Shingles in a block; bounds a task's memory where texts are long.
BLOCK_SHINGLES = 2_000_000
# Rows of a table that may be broadcast: some 25 MB as a hash table.
BROADCAST_ROWS = 250_000


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, step: int = 30) -> np.ndarray:
    """A finalizer over 64 bits."""
    x = (x ^ (x >> np.uint64(step))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word windows; A-Z lower-cased, a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # white space: U+0020, U+0009 to U+000D
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    windows = max(len(each) - size + 1, 1)
    rolled = np.full(windows, len(each) if len(each) < size else size, np.uint64)
    for k in range(min(size, len(each))):
        rolled = rolled * _MULTIPLIER + each[k : k + windows]
    return np.unique(mixed(rolled))


@lru_cache(1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    return (
        draw.integers(0, 2**32, (VALUES, 1), np.uint32) | np.uint32(1),
        draw.integers(0, 2**32, (VALUES, 1), np.uint32),
    )


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (one row per set) of non-empty sets, in pieces of bounded size."""
    a, b = permutations()
    out = np.full((len(sets), VALUES), 2**32 - 1, np.uint32)
    piece, owners, total = [], [], 0

    def flush():
        nonlocal piece, owners, total
        if piece:
            x = np.concatenate(piece)
            starts = np.cumsum([0] + [len(p) for p in piece[:-1]])
            least = np.minimum.reduceat(a * x + b, starts, axis=1)
            for k, owner in enumerate(owners):  # a long set comes in several pieces
                np.minimum(out[owner], least[:, k], out=out[owner])
        piece, owners, total = [], [], 0

    for owner, hashes in enumerate(sets):
        narrow = (hashes >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(narrow), 4096):
            piece.append(narrow[at : at + 4096])
            owners.append(owner)
            total += len(piece[-1])
            if total >= 4096:
                flush()
    flush()
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    cut = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), cut.shape[:2]).copy()
    for r in range(ROWS):
        key = mixed(key * _MULTIPLIER + cut[:, :, r])
    return key


def sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, set identity, number of shingles, signature, band keys)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(t or "", size) for t in part.column(1).to_pylist()]
            values = signatures(sets)
            keys = band_keys(values).view(np.int64)
            for k, s in enumerate(sets):
                if not len(s):
                    values[k] = 0
            short = values.astype(np.uint16)
            filled = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([int(s.sum(dtype=np.uint64)) - 2**63 for s in sets], pa.int64()),
                    pa.array([int(mixed(s, 27).sum(dtype=np.uint64)) - 2**63 for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([v.tobytes() for v in short], pa.binary()),
                    pa.array([k if f else [] for k, f in zip(keys, filled)], pa.list_(pa.int64())),
                ],
                names=["_id", "_s1", "_s2", "_n", "_sig", "_bands"],
            )


@lru_cache(8)
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For STEP, 2 STEP, ... compared values: the fewest matches with which a pair stays.

    With a uniform prior the posterior probability of similarity >= t after m matches in n values is
    that of at most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def surviving(values: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the posterior does not rule out."""
    kept_i, kept_j = [], []
    for at in range(0, len(i), 100_000):
        x, y = i[at : at + 100_000], j[at : at + 100_000]
        matches = np.zeros(len(x), np.int32)
        for k, least in enumerate(least_matches(threshold, TOLERANCE)):
            columns = slice(k * STEP, (k + 1) * STEP)
            matches += (values[x, columns] == values[y, columns]).sum(1, dtype=np.int32)
            stay = matches >= least
            if not stay.all():
                x, y, matches = x[stay], y[stay], matches[stay]
        kept_i.append(x)
        kept_j.append(y)
    return (np.concatenate(kept_i), np.concatenate(kept_j)) if kept_i else (i[:0], j[:0])


@lru_cache(64)
def small_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def pairs_of(
    starts: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within groups of rows; where a group joins two blocks, the pairs across them only.

    A block that meets an empty one makes no pairs: those within it belong to its group with itself.
    """
    left, right = [], []
    for s, e in zip(starts.tolist(), ends.tolist()):
        if lo[s] == hi[s]:
            i, j = small_pairs(e - s) if e - s <= 64 else np.triu_indices(e - s, 1)
        else:
            first = side[s:e] == 0
            one, other = np.flatnonzero(first), np.flatnonzero(~first)
            i, j = np.repeat(one, len(other)), np.tile(other, len(one))
        left.append(i + s)
        right.append(j + s)
    return np.concatenate(left), np.concatenate(right)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index in the component of each of ``n`` nodes."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables that end where a group ends, with the groups' starts and the end."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = new if held is None else pa.concat_tables([held, new])
        starts = group_starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
            held = table.slice(starts[-1])
        else:
            held = table
    if held is not None:
        yield held, np.append(group_starts(held, keys), held.num_rows)


def group_starts(table: pa.Table, keys: int) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def signature_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def bucket_forest(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, lo, hi, side, node, signature) sorted by bucket -> forest of the surviving pairs."""
    for table, starts in whole_groups(batches, 3):
        ends = np.append(starts[1:], table.num_rows)
        many = ends - starts > 1
        if not many.any():
            continue
        lo, hi, side, node = (table.column(k).to_numpy() for k in (1, 2, 3, 4))
        i, j = pairs_of(starts[many], ends[many], lo, hi, side)
        i, j = surviving(signature_rows(table.column(5)), i, j, threshold)
        names, place = np.unique(node, return_inverse=True)
        used = np.unique(np.concatenate([i, j]))
        root = local_roots(len(names), place[i], place[j])
        child = np.unique(place[used])
        child = child[root[child] != child]
        yield pa.RecordBatch.from_arrays([pa.array(names[child]), pa.array(names[root[child]])], names=["a", "b"])


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of one group reach the threshold exactly."""
    sizes = np.array([len(s) for s in sets])
    if len(i) <= 8 * len(sets):
        shared = np.array([len(np.intersect1d(sets[x], sets[y], True)) for x, y in zip(i.tolist(), j.tolist())], int)
    else:  # many pairs of few sets: count what all pairs share, some columns at a time
        everything = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, times = np.unique(everything, return_inverse=True, return_counts=True)
        often = times[column] > 1
        _, column = np.unique(column[often], return_inverse=True)
        owner, order = owner[often], np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        table, width = np.zeros((len(sets), len(sets)), np.float32), 2048
        edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
        for k in range(len(edges) - 1):
            part = slice(edges[k], edges[k + 1])
            has = np.zeros((len(sets), width), np.float32)
            has[owner[part], column[part] - k * width] = 1
            table += has @ has.T
        shared = np.rint(table[i, j]).astype(int)
    return shared >= threshold * (sizes[i] + sizes[j] - shared) - 1e-9


def cluster_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, lo, hi, side, node, signature, shingles) -> (node, root, links) per group."""
    for table, starts in whole_groups(batches, 3):
        ends = np.append(starts[1:], table.num_rows)
        lo, hi, side, node = (table.column(k).to_numpy() for k in (1, 2, 3, 4))
        nodes, roots, links = [], [], []
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s < 2:
                continue
            i, j = pairs_of(np.array([0]), np.array([e - s]), lo[s:e], hi[s:e], side[s:e])
            part = table.slice(s, e - s)
            i, j = surviving(signature_rows(part.column(5)), i, j, threshold)
            sets = [np.frombuffer(x, np.uint64) for x in part.column(6).to_pylist()]
            true = verified(sets, i, j, threshold)
            i, j, own = i[true], j[true], node[s:e]
            count = np.bincount(np.concatenate([i, j]), minlength=e - s)
            linked = np.flatnonzero(count)
            root = local_roots(e - s, i, j)
            nodes.append(own[linked])
            roots.append(own[root[linked]])
            links.append(count[linked])
        if nodes:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (nodes, roots, links)], names=["node", "root", "links"]
            )


def in_blocks(members: DataFrame, keys: list[str], blocks: str) -> DataFrame:
    """Adds ``_lo``, ``_hi`` and ``_side``: the pairs of blocks that a row takes part in."""
    own = F.pmod(F.xxhash64("_node"), F.col(blocks)).cast("int")
    spread = members.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    )
    return spread.select(
        "*", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"),
        (F.col("_own") > F.col("_other")).cast("int").alias("_side"),
    ).drop("_own", "_other")


def sketched(documents: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    rows = documents.select(named(doc_id).cast("long").alias("_id"), named(text).alias("_text"))
    schema = "_id long, _s1 long, _s2 long, _n int, _sig binary, _bands array<long>"
    return cut_lineage(rows.mapInArrow(lambda batches: sketch(batches, size), schema), "sketch")


def class_table(sketches: DataFrame) -> DataFrame:
    """(_s1, _s2, _node): the smallest id of each set, or a negative hash where no row has an id."""
    own = F.coalesce(F.min("_id"), -F.abs(F.xxhash64(F.first("_s1"), F.first("_s2"))))
    return cut_lineage(sketches.groupBy("_s1", "_s2").agg(own.alias("_node")), "classes")


def links_between(
    documents: DataFrame, sketches: DataFrame, classes: DataFrame, doc_id: str, text: str, threshold: float, size: int
) -> DataFrame:
    """(node, root, links) from each group of a cluster, written."""
    spark = documents.sparkSession
    one = sketches.where("_n > 0").join(classes, ["_s1", "_s2"]).where(
        (F.col("_id") == F.col("_node")) | F.col("_id").isNull()
    )
    nodes = one.groupBy("_node").agg(F.min(F.struct("_n", "_sig", "_bands")).alias("_one"))
    nodes = cut_lineage(nodes.select("_node", "_one.*"), "nodes")
    banded = nodes.select("_node", F.explode("_bands").alias("_bucket"))
    buckets = banded.groupBy("_bucket").agg(F.count("*").alias("_members")).where("_members > 1")
    buckets = cut_lineage(buckets.withColumn("_blocks", F.ceil(F.col("_members") / BLOCK)), "buckets")
    members = cut_lineage(banded.join(broadcast_if_small(buckets, BROADCAST_ROWS), "_bucket"), "members")
    grouped = (
        in_blocks(members, ["_bucket"], "_blocks")
        .join(nodes.select("_node", "_sig"), "_node")
        .select("_bucket", "_lo", "_hi", "_side", "_node", "_sig")
        .repartition("_bucket", "_lo", "_hi").sortWithinPartitions("_bucket", "_lo", "_hi")
    )
    forest = grouped.mapInArrow(lambda batches: bucket_forest(batches, threshold), "a long, b long")
    clusters = cut_lineage(components(forest).toDF("_node", "_cluster"), "clusters")
    texts = (
        documents.select(named(doc_id).cast("long").alias("_id"), named(text).alias("_text"))
        .join(broadcast_if_small(clusters.select(F.col("_node").alias("_id")), BROADCAST_ROWS), "_id", "left_semi")
    )

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t or "", size).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["_node", "_set"])

    sets = texts.mapInArrow(shingles, "_node long, _set binary").dropDuplicates(["_node"])
    sizes = clusters.join(nodes.select("_node", "_n"), "_node").groupBy("_cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("_n") / BLOCK_SHINGLES)).alias("_blocks")
    )
    placed = in_blocks(clusters.join(sizes, "_cluster"), ["_cluster"], "_blocks")
    together = (
        placed.join(nodes.select("_node", "_sig"), "_node").join(sets, "_node")
        .select("_cluster", "_lo", "_hi", "_side", "_node", "_sig", "_set")
        .repartition("_cluster", "_lo", "_hi").sortWithinPartitions("_cluster", "_lo", "_hi")
    )
    links = together.mapInArrow(lambda batches: cluster_links(batches, threshold), "node long, root long, links long")
    return cut_lineage(links, "links")


def similar_documents(
    documents: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) for each row of ``documents``.

    ``copy_of`` is the smallest id among the rows with the same shingle set, ``n_links`` the number of
    other such classes with a similarity of at least ``threshold``, ``class_id`` the smallest id of the
    component that these links make.

    Null and blank texts have no shingles: they are one class without links. Repeated rows are copies
    and all stay. Ids are whole numbers; rows that share an id are one document, for which one of its texts
    stands where they differ. Rows without an id are
    classed by their text like all others; where a class has no id at all, a negative number stands for
    it, and its links are not looked for, as nothing names its text. Other columns are ignored. An empty
    table gives an empty table.
    """
    require(documents, doc_id, text)
    sketches = sketched(documents, doc_id, text, size)
    classes = class_table(sketches)
    links = links_between(documents, sketches, classes, doc_id, text, threshold, size)
    counted = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = components(links, "node", "root")
    found = counted.join(groups, "node").withColumnRenamed("node", "_node")
    rows = sketches.select("_id", "_s1", "_s2").join(classes, ["_s1", "_s2"]).join(found, "_node", "left")
    return rows.select(
        F.col("_id").alias(doc_id), F.coalesce("component", "_node").alias("class_id"),
        F.col("_node").alias("copy_of"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def drop_similar(documents: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each class, the one with the smallest id, with all columns; repeated rows go too.

    Rows without an id stay: their copies cannot be told apart by name.
    """
    found = similar_documents(documents, doc_id=doc_id, **options)
    # Names that no column of ``documents`` has, in any case.
    smallest, repeated, held = (free_name(documents, n) for n in ("_first", "_again", "held"))
    first = cut_lineage(
        found.where(named(doc_id) == F.col("class_id")).select(named(doc_id).alias(smallest)).distinct(), "first"
    )
    # Rows of one id are rare; only they are put in order, so the other texts are not shuffled.
    again = found.groupBy(named(doc_id).alias(repeated)).count().where((F.col("count") > 1) & F.col(repeated).isNotNull())
    again = broadcast_if_small(cut_lineage(again.select(repeated), "repeated"), BROADCAST_ROWS)
    kept = documents.join(broadcast_if_small(first, BROADCAST_ROWS), named(doc_id) == F.col(smallest), "left_semi")
    single = kept.join(again, named(doc_id) == F.col(repeated), "left_anti")
    one = Window.partitionBy(named(doc_id)).orderBy(*[F.xxhash64(named(c)) for c in documents.columns])
    several = kept.join(again, named(doc_id) == F.col(repeated), "left_semi").withColumn(held, F.row_number().over(one))
    nameless = documents.where(named(doc_id).isNull())
    return single.unionByName(several.where(named(held) == 1).drop(held)).unionByName(nameless)
