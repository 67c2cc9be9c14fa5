"""Column-name policies, for a schema (plain Python) and for a catalogue of names (Columns)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import WHITE_SPACE, strip
from millrace.workspace import cut_lineage

# What the strict policy falls back to.
DIGIT_PREFIX = "COL_"
UNNAMED = "UNNAMED_COLUMN"

# Characters that make a name awkward in SQL.
SPECIAL_CLASS = r"""["' \-.()\[\]]"""


class NamePolicy(Enum):
    """STRICT: ASCII identifier. LIGHT: only space and ``-`` change. PREFIXED: ``_`` in front of
    whatever is not yet a word."""

    STRICT = "strict"
    LIGHT = "light"
    PREFIXED = "prefixed"


def clean_name(name: str, policy: NamePolicy = NamePolicy.STRICT) -> str:
    """One column name under a policy."""
    name = name.strip(WHITE_SPACE)
    if policy is NamePolicy.LIGHT:
        return re.sub("[ -]", "_", name)
    if policy is NamePolicy.PREFIXED:
        plain = name[:1].isalpha() and re.fullmatch(r"[\w :.-]+", name)
        return ("" if plain else "_") + re.sub(r"\W", "_", name)
    name = re.sub("[^A-Za-z0-9]+", "_", name).strip("_")
    return re.sub("^(?=[0-9])", DIGIT_PREFIX, name) or UNNAMED


def clean_name_column(name: Column, policy: NamePolicy = NamePolicy.STRICT) -> Column:
    """The same policies over a column of names."""
    name = strip(name)
    if policy is NamePolicy.LIGHT:
        return F.translate(name, " -", "__")
    if policy is NamePolicy.PREFIXED:
        name = F.translate(name, " -:.", "____")
        fixed = F.concat(F.lit("_"), F.regexp_replace(name, r"[^\p{L}\p{N}_]", "_"))
        return F.when(name.rlike(r"^\p{L}[\p{L}\p{N}_]*$"), name).otherwise(fixed)
    name = F.btrim(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return (
        F.when(name == "", F.lit(UNNAMED))
        .when(name.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), name))
        .otherwise(name)
    )


def unique_names(names: Sequence[str], case_sensitive: bool = False) -> list[str]:
    """Append ``_{position}`` to a name already used, until it is new.

    Spark resolves names without regard to case, so ``a`` and ``A`` count as the same by default.
    """
    used: set[str] = set()
    result = []
    for position, name in enumerate(names):
        while (name if case_sensitive else name.lower()) in used:
            name = f"{name}_{position}"
        used.add(name if case_sensitive else name.lower())
        result.append(name)
    return result


def clean_columns(df: DataFrame, policy: NamePolicy = NamePolicy.STRICT) -> DataFrame:
    """Rename every column of ``df`` to a clean and unique name."""
    return df.toDF(*unique_names([clean_name(c, policy) for c in df.columns]))


def unique_names_in_catalogue(
    catalogue: DataFrame, table: str, ordinal: str, name: str
) -> DataFrame:
    """:func:`unique_names` over a catalogue with one row per (table, ordinal).

    In each round the lowest position holding a name keeps it and the others get their position
    appended; rounds end when no name is held twice. The holder is found by an aggregation and
    joined back, so a name shared by very many columns is never gathered in one task.
    """
    current = catalogue.withColumn("_folded", F.lower(name))
    while True:
        holders = current.groupBy(table, "_folded").agg(
            F.min(ordinal).alias("_holder"), F.count(F.lit(1)).alias("_uses")
        )
        if holders.filter("_uses > 1").isEmpty():
            return current.drop("_folded")
        renamed = current.join(holders, [table, "_folded"]).withColumn(
            name,
            F.when(F.col(ordinal) == F.col("_holder"), F.col(name)).otherwise(
                F.concat_ws("_", F.col(name), F.col(ordinal).cast("string"))
            ),
        )
        renamed = renamed.drop("_holder", "_uses").withColumn("_folded", F.lower(name))
        current = cut_lineage(renamed.select(*current.columns), "names")


def has_special_characters(name: Column) -> Column:
    """True for names with quotes, blanks, dots, dashes, parentheses or brackets."""
    return name.rlike(SPECIAL_CLASS)


def header_names(tokens: Sequence[str | None]) -> list[str]:
    """Names for a CSV header: ``Unnamed: {position}`` for a blank one, ``a.1`` for a second ``a``."""
    taken: set[str] = set()
    seen: dict[str, int] = {}
    result = []
    for position, token in enumerate(tokens):
        base = name = token or f"Unnamed: {position}"
        while name in taken:
            seen[base] = seen.get(base, 0) + 1
            name = f"{base}.{seen[base]}"
        taken.add(name)
        result.append(name)
    return result
