"""Merging two related boards into one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.names import unique_names


def merge_boards(
    left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_sales", "_delivery")
) -> DataFrame:
    """Full outer join on the item key, with ``origin`` telling where an item comes from.

    Columns both boards have, in any case, get a suffix, and names that then still clash are made unique. Items are unique per board, as the cleaner leaves them. An
    item without a key matches nothing and stays, marked with the side it is on.
    """
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    sides = ((left, "a", suffixes[0]), (right, "b", suffixes[1]))
    wanted = [c + suffix if c.lower() in shared else c for df, _, suffix in sides for c in df.columns if c.lower() != key.lower()]
    names = iter(unique_names([key, "origin", *wanted])[2:])
    # Both sides by position: the names of one may differ by case only from those of the other.
    a, b = (
        df.select(*[F.col(f"`{c}`").alias(f"_{side}{i}") for i, c in enumerate(df.columns)]).withColumn(f"_{side}", F.lit(True))
        for df, side, _ in sides
    )
    keys = [f"_{side}{[c.lower() for c in df.columns].index(key.lower())}" for df, side, _ in sides]
    joined = a.join(b, F.col(keys[0]) == F.col(keys[1]), "full_outer")
    columns = [F.coalesce(*keys).alias(key)]
    for df, side, _ in sides:
        columns += [F.col(f"_{side}{i}").alias(next(names)) for i, c in enumerate(df.columns) if c.lower() != key.lower()]
    origin = F.when(F.col("_b").isNull(), "left").when(F.col("_a").isNull(), "right").otherwise("both")
    return joined.select(*columns, origin.alias("origin"))
