"""Per-key values without sending a whole key to one task.

Each helper aggregates first (partial results are combined on the map side, so
a hot key costs one row per task) and joins the small result back when the
detail rows are needed. Keys travel as one struct: struct equality treats null
fields as equal, and aggregate, window and join then share one partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_struct(*cols: Column | str) -> Column:
    """Columns as one struct, usable as a null-safe key."""
    return F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in cols])


def nulls_last(col: Column) -> list[Column]:
    """Order keys that put nulls after all values, for use in an order struct."""
    return [col.isNull(), col]


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The first row (or the last) of every key by ascending ``order``, nulls first.

    An aggregate, not a window: no key is gathered or sorted as a group.
    """
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(True)
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick(row, F.struct(*order)).alias("_row"))
    return picked.select(
        *[
            F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c)
            for c in df.columns
        ]
    )


def with_group_values(df: DataFrame, keys: Sequence[str], whole: bool = False, **values: Column) -> DataFrame:
    """Add aggregates over each key to every row of the key (``agg OVER (PARTITION BY keys)``).

    ``whole`` says that no key is large (``by_size``): then it is that window, and the rows are read once.
    """
    if whole:
        key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
        kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
        return df.select(*kept, *[v.over(key).alias(n) for n, v in values.items()])
    keyed = df.withColumn("_group", key_struct(*keys))
    totals = keyed.groupBy("_group").agg(*[v.alias(n) for n, v in values.items()])
    replaced = keyed.drop(*values)
    return replaced.join(totals, "_group", "left").drop("_group")


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Null-safe semi join on equal key names; ``how='left_anti'`` for the complement.

    Keys of ``right`` are made distinct before they are shuffled: repeats of a
    hot key stay where they are.
    """
    k = "_semi_key"
    return (
        left.withColumn(k, key_struct(*keys))
        .join(right.select(key_struct(*keys).alias(k)).distinct(), k, how)
        .drop(k)
    )


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys, nulls included, are not in ``right``."""
    return semi(left, right, keys, "left_anti")


KEY_ROWS = 100_000  # a key of more rows is not brought together in one task


def by_size(
    df: DataFrame, keys: Sequence[str], steps: Callable[[DataFrame, bool], DataFrame], limit: int = KEY_ROWS
) -> DataFrame:
    """``steps(rows, whole)``: once for the keys of up to ``limit`` rows, with ``whole`` true, once for larger ones.

    Steps must treat every key by itself. With ``whole`` they may use plain
    windows, which share one shuffle where their keys begin alike; without it
    they must spread a key. Runs a job that counts the rows of the keys.
    """
    counts = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.filter(F.col("_rows") > limit).drop("_rows")
    if large.isEmpty():
        return steps(df, True)
    return steps(anti(df, large, keys), True).unionByName(steps(semi(df, large, keys), False))
