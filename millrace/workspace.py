"""Shared scratch folders for staged tables, checkpoints and landed files.

Executors on other machines must see what one of them wrote, so the folder comes from
``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own, which
goes when the program ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
# The copies that the innermost block of ``temporary_copies`` has to delete, if there is one.
_copies: ContextVar[list[str] | None] = ContextVar("copies", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later stages start from files.

    The copy stays, as lazy results read it, unless the call stands in a block of :func:`temporary_copies`.
    """
    return _copied(df, label, _copies.get())


def _copied(df: DataFrame, label: str, held: list[str] | None) -> DataFrame:
    """A copy of ``df``, noted in ``held`` where there is such a list."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system holds it; false where it was not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes at its end all copies that :func:`cut_lineage` made within the block.

    Gives a function that writes a result, which outlives the block, and reads it back; what else still reads
    a copy later fails. Blocks may be nested: each deletes its own copies, also when it fails, and results belong
    to the block around it. Other threads' copies are not touched.
    """
    held: list[str] = []
    around = _copies.get()
    token = _copies.set(held)
    try:
        yield lambda df, label: _copied(df, label, around)
    finally:
        _copies.reset(token)
        for path in held:
            delete_folder(spark, path)


def fresh_database(spark: SparkSession, label: str = "wh") -> str:
    """A new catalog database whose tables live below the shared root."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_root(spark)}/millrace/{name}.db'")
    return name


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes a frame and reads it back; all copies are deleted at the end.

    For steps that are done when the block ends: what still reads a copy later fails.
    """
    database = fresh_database(spark, "scratch")
    number = 0

    def keep(df: DataFrame) -> DataFrame:
        nonlocal number
        number += 1
        name = f"{database}.t{number}"
        df.write.saveAsTable(name)
        return spark.table(name)

    try:
        yield keep
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
