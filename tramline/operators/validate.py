"""Rules, valid rows and quarantine.

A rule is a boolean column over the row; a null result passes. Uniqueness and
per-group rules add their columns first, then take part like any other rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.rows import row_sum
from tramline.operators.groups import with_group_values
from tramline.operators.scan import lag, ordered, stretch

Rules = dict[str, Column]


def not_null(*columns: str) -> Rules:
    return {f"{c}|nullability": F.col(c).isNotNull() for c in columns}


def in_range(column: str, low=None, high=None) -> Rules:
    rules: Rules = {}
    if low is not None:
        rules[f"{column}|min"] = F.col(column) >= low
    if high is not None:
        rules[f"{column}|max"] = F.col(column) <= high
    return rules


def matches(column: str, pattern: str) -> Rules:
    return {f"{column}|regex": F.col(column).rlike(pattern)}


def every_item(column: str, name: str, test) -> Rules:
    """``test`` holds for every item of a list column; null lists pass."""
    return {f"{column}|{name}": F.forall(F.col(column), lambda x: F.coalesce(test(x), F.lit(True)))}


def min_length(column: str, n: int) -> Rules:
    return {f"{column}|min_length": F.size(column) >= n}


def with_reasons(df: DataFrame, rules: Rules, unique: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """Add ``reasons``: names of the rules a row breaks. A repeated ``unique`` key breaks all its rows."""
    checked = with_group_values(df, unique, whole, _copies=F.count(F.lit(1))) if unique else df
    tests = dict(rules)
    if unique:
        tests["primary_key"] = F.col("_copies") == 1
    broken = [F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in tests.items()]
    return checked.withColumn("reasons", F.array_compact(F.array(*broken))).drop("_copies")


def valid(df: DataFrame, rules: Rules, unique: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """Rows that break no rule."""
    return with_reasons(df, rules, unique, whole).filter(F.size("reasons") == 0).drop("reasons")


def quarantined(df: DataFrame, rules: Rules, unique: Sequence[str] = ()) -> DataFrame:
    """Rows that break a rule, with the reasons."""
    return with_reasons(df, rules, unique).filter(F.size("reasons") > 0)


def reason_counts(df: DataFrame, rules: Rules, unique: Sequence[str] = ()) -> DataFrame:
    """How many rows break each rule."""
    return (
        quarantined(df, rules, unique)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# Transit rules -------------------------------------------------------------


def first_stop_has_departure(seq: str = "gtfs_stop_sequence", departure: str = "gtfs_departure_dt") -> Rules:
    return {"first_stop_has_departure_dt": F.when(F.col(seq) == 1, F.col(departure).isNotNull())}


def final_stop_has_arrival() -> Rules:
    ends = (F.col("point_type") == "end") & F.col("gtfs_last_in_transit_dt").isNotNull()
    return {"final_stop_has_arrival_dt": F.when(ends, F.col("gtfs_arrival_dt").isNotNull())}


def plain_trip_id(column: str = "trip_id") -> Rules:
    c = F.col(column)
    return {
        "no_ol_trip_ids": ~c.contains("OL"),
        "no_split_trips1": ~c.endswith("_1"),
        "no_split_trips2": ~c.endswith("_2"),
    }


def departure_after_arrival(arrival: str = "stop_arrival_dt", departure: str = "stop_departure_dt") -> Rules:
    return {"departure_after_arrival": F.col(arrival) <= F.col(departure)}


def with_previous(
    df: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str], width: int = 256, whole: bool = False
) -> DataFrame:
    """Add ``_prev_<column>``, the value at the stop before."""
    return ordered(
        df,
        keys,
        [F.col(s) for s in seq],
        stretch(F.col(seq[0]), width),
        whole,
        **{f"_prev_{c}": lag(F.col(c)) for c in columns},
    )


def not_before_previous(*columns: str) -> Rules:
    """Values that never fall below the stop before (needs ``with_previous``)."""
    return {f"{c}_order": F.col(c) >= F.col(f"_prev_{c}") for c in columns}


def with_trip_total(df: DataFrame, keys: Sequence[str], seconds_between, whole: bool = False) -> DataFrame:
    """Add ``_total_ok``: travel plus stopped seconds of the trip equal its whole time."""
    last = F.max(F.coalesce("stop_departure_dt", "stop_arrival_dt"))
    first = F.min(F.coalesce("stop_arrival_dt", "stop_departure_dt"))
    taken = F.sum(row_sum(F.col("travel_time_seconds"), F.col("stopped_duration_seconds")))
    totals = with_group_values(df, keys, whole, _taken=taken, _last=last, _first=first)
    ok = F.col("_taken") == seconds_between(F.col("_last"), F.col("_first"))
    return totals.withColumn("_total_ok", ok).drop("_taken", "_last", "_first")


def trip_total() -> Rules:
    return {"travel_time_plus_stopped_duration_equals_total_trip": F.col("_total_ok")}


# Patterns of the event-bus payloads.
DATE_PATTERN = r"^[0-9]{4}-[01][0-9]-[0-3][0-9]"
DATETIME_PATTERN = DATE_PATTERN + r"[T ][012][0-9]:[0-5][0-9]:[0-6][0-9](.[0-9]*)?(Z|[+-][012][0-9]:[0-5][0-9])$"
CLOCK_PATTERN = r"^([0-9]{2}):([0-5][0-9]):([0-5][0-9])$"
CHANGE_PATTERN = r"start|stop"
REVENUE_PATTERN = r"(non)?revenue"


def schedule_order_rules() -> Rules:
    """Optional audit rules of a combined schedule (need ``with_previous`` on gtfs_stop_sequence).

    Own sequences rise along the common one, and sequence 1 comes first.
    """
    own, common = F.col("gtfs_stop_sequence"), F.col("stop_sequence")
    return {
        "consecutive_null_stop_sequences_ordered_correctly": own > F.col("_prev_gtfs_stop_sequence"),
        "first_stop_sequence_has_gtfs_record": ((own == 1) & (common == 1)) | own.isNull() | (own > 1),
    }


def one_to_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when a merge on them is one to one."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def schedule_audit(
    df: DataFrame,
    trip: Sequence[str],
    never_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    constant: Sequence[str] = (),
    planned: str | None = None,
) -> DataFrame:
    """Per trip: columns without nulls, without repeats, with one value, and the planned row count.

    Distinct counts group by (trip, value) first, so a long trip is not gathered.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [(F.count_if(F.col(c).isNull()) == 0).alias(f"{c}_not_null") for c in never_null]
    aggs += [
        (F.min(F.col(c)).eqNullSafe(F.max(F.col(c))) & ((F.count(c) == F.count(F.lit(1))) | (F.count(c) == 0))).alias(
            f"{c}_constant"
        )
        for c in constant
    ]
    if planned:
        aggs.append((F.count(F.lit(1)) == F.max(planned)).alias("row_count_as_planned"))
    audited = df.groupBy(*trip).agg(*aggs)
    for c in unique:
        repeats = (
            df.filter(F.col(c).isNotNull())
            .groupBy(*trip, c)
            .agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*trip)
            .agg((F.max("_n") == 1).alias(f"{c}_unique"))
        )
        audited = audited.join(repeats, list(trip), "left").withColumn(
            f"{c}_unique", F.coalesce(f"{c}_unique", F.lit(True))
        )
    return audited


def all_of(rules: Sequence[Rules]) -> Rules:
    return reduce(lambda a, b: {**a, **b}, rules, {})
