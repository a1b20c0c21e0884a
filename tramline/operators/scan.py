"""Ordered windows over keys of any size.

A plain window sends every row of a key to one task. Here each key is cut into
stretches of its order column (an hour of time, a block of sequence numbers):

1. windows run inside each (key, stretch);
2. one summary row per (key, stretch) carries what the neighbours need;
3. a window over the summaries finds each stretch's carry, and a join on
   (key, stretch) hands it to the rows.

A key that holds a third of all rows is spread over its stretches, and the
summary has one row per stretch. Results equal those of the plain window.
Steps 1 and 2 share one shuffle key; step 3 joins on it, so the rows are not
moved again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.groups import key_struct
from tramline.session import cut_lineage


@dataclass(frozen=True)
class Ordered:
    """One window column; build it with the functions below."""

    kind: str
    value: Column | None = None


def lag(value: Column) -> Ordered:
    """Value of the row before."""
    return Ordered("lag", value)


def lag_at() -> Ordered:
    """First order column of the row before: its carry is a plain maximum, the cheapest there is."""
    return Ordered("lag_at")


def lead(value: Column) -> Ordered:
    """Value of the row after."""
    return Ordered("lead", value)


def last_before(value: Column) -> Ordered:
    """Last non-null value of the rows before."""
    return Ordered("last_before", value)


def first_after(value: Column) -> Ordered:
    """First non-null value of the rows after."""
    return Ordered("first_after", value)


def first_in_key(value: Column) -> Ordered:
    """First non-null value of the whole key."""
    return Ordered("first_in_key", value)


def max_before(value: Column) -> Ordered:
    """Highest value of the rows before."""
    return Ordered("max_before", value)


def sum_before(value: Column) -> Ordered:
    """Sum of the rows before, null counting as zero."""
    return Ordered("sum_before", value)


def min_from(value: Column) -> Ordered:
    """Lowest value of this row and all after it."""
    return Ordered("min_from", value)


def row_number() -> Ordered:
    return Ordered("row_number")


def rank() -> Ordered:
    return Ordered("rank")


def dense_rank() -> Ordered:
    return Ordered("dense_rank")


def is_first() -> Ordered:
    """True on the first row of the key."""
    return Ordered("is_first")


def is_last() -> Ordered:
    """True on the last row of the key."""
    return Ordered("is_last")


def stretch(order: Column, width: int) -> Column:
    """Stretch number of a numeric order column; rises with it, null staying null."""
    return F.floor(order / F.lit(width)).cast("long")


def time_stretch(ts: Column, seconds: int) -> Column:
    """Stretch number of a timestamp."""
    return stretch(F.unix_timestamp(ts), seconds)


def fine_stretch(first: Column, second: Column, width: int) -> Column:
    """Stretches for orders whose first column repeats without bound: each value of it, cut by the second column."""
    return F.struct(first.alias("first"), stretch(second, width).alias("block"))


def even_stretches(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Add ``_stretch``, which cuts the rows by ``order`` into about even parts, whatever the values look like.

    The cuts are quantiles that Spark takes from a sample of the order columns, so texts with common prefixes or
    suffixes and repeated values spread as well as numbers do. Rows equal in all order columns share a stretch, and
    stretches rise with the order, nulls first. The rows are written once: the cuts are drawn once.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(max(2, parts), *order)
    return cut_lineage(dealt.withColumn("_stretch", F.spark_partition_id().cast("long")), "stretches")


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    split: Column,
    whole: bool = False,
    **columns: Ordered,
) -> DataFrame:
    """Add window columns over ``keys`` by ascending ``order``, nulls first.

    ``split`` names the stretches: any orderable column that rises with the
    order, so rows that tie on every order column share a stretch. ``whole``
    says that no key is large (``groups.by_size``): keys are not cut then.
    """
    if whole:
        kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
        return df.select(*kept, *[c.alias(n) for n, c in whole_windows(keys, order, columns).items()])
    work = df.select(
        "*",
        F.struct(key_struct(*keys).alias("_key"), split.alias("_split")).alias("_part"),
        (F.struct(*order) if len(order) > 1 else order[0]).alias("_order"),
        order[0].alias("_at_"),
        *[c.value.alias(f"_v_{n}") for n, c in columns.items() if c.value is not None],
    )

    here = Window.partitionBy("_part").orderBy("_order")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    # frames that look ahead run backwards: a frame up to UNBOUNDED FOLLOWING
    # is evaluated anew for every row, one from UNBOUNDED PRECEDING is not
    back = Window.partitionBy("_part").orderBy(F.col("_order").desc())
    onward = back.rowsBetween(Window.unboundedPreceding, 0)
    after = back.rowsBetween(Window.unboundedPreceding, -1)

    # numbers as order of max_by / min_by keep the summary in hash aggregation;
    # a bare null would be passed over there, so it becomes the lowest number
    place = F.col("_order")
    if isinstance(work.schema["_order"].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        place = F.coalesce(place.cast("long"), F.lit(-(2**63)))
    elif len(order) == 1:
        place = F.struct("_order")

    inside: dict[str, Column] = {}
    kinds = {c.kind for c in columns.values()}
    if kinds & {"lag", "lag_at", "row_number", "is_first"}:
        inside["_number"] = F.row_number().over(here)
    if kinds & {"lead", "is_last"}:
        inside["_more"] = F.lead(F.lit(True)).over(here)
    summary: dict[str, Column] = {}
    for n, c in columns.items():
        v = F.col(f"_v_{n}")
        if c.kind == "lag_at":
            inside[f"_w_{n}"] = F.lag("_at_").over(here)
            summary[n] = F.max("_at_")
        elif c.kind == "lag":
            inside[f"_w_{n}"] = F.lag(v).over(here)
            summary[n] = F.max_by(v, place)
        elif c.kind == "lead":
            inside[f"_w_{n}"] = F.lead(v).over(here)
            summary[n] = F.min_by(v, place)
        elif c.kind == "last_before":
            inside[f"_w_{n}"] = F.last(v, ignorenulls=True).over(before)
            summary[n] = F.max_by(v, F.when(v.isNotNull(), place))
        elif c.kind == "first_after":
            inside[f"_w_{n}"] = F.last(v, ignorenulls=True).over(after)
            summary[n] = F.min_by(v, F.when(v.isNotNull(), place))
        elif c.kind == "first_in_key":
            summary[n] = F.min_by(v, F.when(v.isNotNull(), place))
        elif c.kind == "max_before":
            inside[f"_w_{n}"] = F.max(v).over(before)
            summary[n] = F.max(v)
        elif c.kind == "sum_before":
            inside[f"_w_{n}"] = F.sum(v).over(before)
            summary[n] = F.sum(v)
        elif c.kind == "min_from":
            inside[f"_w_{n}"] = F.min(v).over(onward)
            summary[n] = F.min(v)
        elif c.kind == "row_number":
            summary[n] = F.count(F.lit(1))
        elif c.kind == "rank":
            inside[f"_w_{n}"] = F.rank().over(here)
            summary[n] = F.count(F.lit(1))
        elif c.kind == "dense_rank":
            inside[f"_w_{n}"] = F.dense_rank().over(here)
            summary[n] = F.count_distinct(F.col("_order"))
        elif c.kind in ("is_first", "is_last"):
            summary[n] = F.lit(True)
        else:
            raise ValueError(f"unknown window column {c.kind!r}")

    stretches = work.groupBy("_part").agg(*[v.alias(f"_s_{n}") for n, v in summary.items()])
    along = Window.partitionBy("_part._key").orderBy("_part._split")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy("_part._key").orderBy(F.col("_part._split").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carries = []
    for n, c in columns.items():
        s = F.col(f"_s_{n}")
        if c.kind in ("lag", "lag_at", "is_first"):
            carry = F.lag(s).over(along)
        elif c.kind in ("lead", "is_last"):
            carry = F.lead(s).over(along)
        elif c.kind == "last_before":
            carry = F.last(s, ignorenulls=True).over(earlier)
        elif c.kind == "first_after":
            carry = F.last(s, ignorenulls=True).over(later)
        elif c.kind == "first_in_key":
            carry = F.first(s, ignorenulls=True).over(whole)
        elif c.kind == "max_before":
            carry = F.max(s).over(earlier)
        elif c.kind == "min_from":
            carry = F.min(s).over(later)
        else:
            carry = F.sum(s).over(earlier)
        carries.append(carry.alias(f"_c_{n}"))
    carried = stretches.select("_part", *carries)

    joined = work.select("*", *[w.alias(n) for n, w in inside.items()]).join(carried, "_part", "left")

    def combined(n: str, c: Ordered) -> Column:
        local, carry = F.col(f"_w_{n}"), F.col(f"_c_{n}")
        if c.kind == "first_in_key":
            return carry
        if c.kind in ("lag", "lag_at"):
            return F.when(F.col("_number") == 1, carry).otherwise(local)
        if c.kind == "lead":
            return F.when(F.col("_more").isNull(), carry).otherwise(local)
        if c.kind in ("last_before", "first_after"):
            return F.coalesce(local, carry)
        if c.kind == "max_before":
            return F.greatest(local, carry)
        if c.kind == "min_from":
            return F.least(local, carry)
        if c.kind == "sum_before":
            return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        if c.kind == "row_number":
            return (F.col("_number") + F.coalesce(carry, F.lit(0))).cast("long")
        if c.kind in ("rank", "dense_rank"):
            return (local + F.coalesce(carry, F.lit(0))).cast("long")
        if c.kind == "is_first":
            return (F.col("_number") == 1) & carry.isNull()
        return F.col("_more").isNull() & carry.isNull()

    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return joined.select(*kept, *[combined(n, c).alias(n) for n, c in columns.items()])


def whole_windows(keys: Sequence[str], order: Sequence[Column], columns: dict[str, Ordered]) -> dict[str, Column]:
    """The columns of ``ordered`` as plain windows over the keys."""
    key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    here, back = key.orderBy(*order), key.orderBy(*[o.desc() for o in order])
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    every = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    made = {
        "lag": lambda v: F.lag(v).over(here),
        "lag_at": lambda v: F.lag(order[0]).over(here),
        "lead": lambda v: F.lead(v).over(here),
        "last_before": lambda v: F.last(v, ignorenulls=True).over(before),
        "first_after": lambda v: F.last(v, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)),
        "first_in_key": lambda v: F.first(v, ignorenulls=True).over(every),
        "max_before": lambda v: F.max(v).over(before),
        "sum_before": lambda v: F.coalesce(F.sum(v).over(before), F.lit(0)),
        "min_from": lambda v: F.min(v).over(back.rowsBetween(Window.unboundedPreceding, 0)),
        "row_number": lambda v: F.row_number().over(here).cast("long"),
        "rank": lambda v: F.rank().over(here).cast("long"),
        "dense_rank": lambda v: F.dense_rank().over(here).cast("long"),
        "is_first": lambda v: F.row_number().over(here) == 1,
        "is_last": lambda v: F.lead(F.lit(True)).over(here).isNull(),
    }
    return {n: made[c.kind](c.value) for n, c in columns.items()}


def filled(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], split: Column, cols: Sequence[str], whole: bool = False
) -> DataFrame:
    """Fill nulls forward, then backward, along ``order`` within each key."""
    specs: dict[str, Ordered] = {}
    for c in cols:
        specs[f"_b_{c}"] = last_before(F.col(c))
        # with nothing before, the next value is the first of the key
        specs[f"_a_{c}"] = first_in_key(F.col(c))
    scanned = ordered(df, keys, order, split, whole, **specs)
    return scanned.select(
        *[
            F.coalesce(F.col(c), F.col(f"_b_{c}"), F.col(f"_a_{c}")).alias(c) if c in cols else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
