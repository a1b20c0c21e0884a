"""Travel, dwell and headway measures.

Trip windows run in blocks of stop sequences, station windows in blocks of
time (see ``scan``), so neither a long trip nor a busy station gathers in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import wall_seconds_since
from tramline.operators.groups import key_struct, with_group_values
from tramline.operators.scan import (
    filled,
    is_first,
    is_last,
    lag,
    lag_at,
    last_before,
    lead,
    max_before,
    ordered,
    rank,
    row_number,
    stretch,
)

# Widths of one stretch: stop sequences of a trip, seconds at a station.
SEQUENCE_BLOCK = 256
STATION_SECONDS = 900
UNTIMED_STRETCHES = 1 << 16  # stretches that rows without a time are dealt over


def plan_travel_time(
    stops: DataFrame, keys: Sequence[str], seq: str, tie: Sequence[str] = (), split: Column | None = None
) -> DataFrame:
    """Scheduled seconds from the previous departure of the trip to this arrival."""
    scanned = ordered(
        stops,
        keys,
        [F.col(seq), *[F.col(t) for t in tie]],
        stretch(F.col(seq), SEQUENCE_BLOCK) if split is None else split,
        _left=lag(F.col("departure_seconds")),
    )
    return scanned.withColumn("plan_travel_time_seconds", F.col("arrival_seconds") - F.col("_left")).drop("_left")


def headway(
    df: DataFrame,
    keys: Sequence[str],
    at: Column,
    name: str,
    tie: Sequence[str],
    positive_only: bool = False,
    split: Column | None = None,
    whole: bool = False,
) -> DataFrame:
    """Seconds since the previous vehicle at the same place.

    ``at`` is a time in seconds; rows order by it and then by ``tie``. Where
    very many rows can share a second, ``split`` cuts finer (``fine_stretch``).
    Rows without a time have no headway and give none, so they may lie in any
    order before the others: they are dealt over stretches of their own.
    """
    work = df.withColumn("_at", at)
    untimed = F.pmod(F.xxhash64(*[F.col(t) for t in tie]), F.lit(UNTIMED_STRETCHES)) - 2 * UNTIMED_STRETCHES - (1 << 40)
    timed = stretch(F.col("_at"), STATION_SECONDS)
    scanned = ordered(
        work,
        keys,
        [F.col("_at"), *[F.col(t) for t in tie]],
        F.when(F.col("_at").isNull(), untimed).otherwise(timed) if split is None else split,
        whole,
        _previous=lag_at(),
    )
    gap = F.col("_at") - F.col("_previous")
    if positive_only:
        gap = F.when(gap > 0, gap)
    return scanned.withColumn(name, gap).drop("_at", "_previous")


def trip_neighbours(events: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns of the previous or next stop of the trip: ``new=("previous"|"next", column)``."""
    specs = {
        new: (lag if side == "previous" else lead)(F.col(column)) for new, (side, column) in columns.items()
    }
    return ordered(
        events, keys, [F.col(o) for o in order], stretch(F.col(order[0]), SEQUENCE_BLOCK), **specs
    )


def first_last_rank(events: DataFrame, keys: Sequence[str], order: Sequence[str], prefix: str) -> DataFrame:
    """First-stop and last-stop flags and the rank of each stop in its trip."""
    return ordered(
        events,
        keys,
        [F.col(o) for o in order],
        stretch(F.col(order[0]), SEQUENCE_BLOCK),
        **{
            f"{prefix}_first_stop": is_first(),
            f"{prefix}_last_stop": is_last(),
            f"{prefix}_stop_rank": rank(),
        },
    )


def fill_trip_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Trip-level columns filled forward, then backward, along the trip."""
    return filled(df, keys, [F.col(o) for o in order], stretch(F.col(order[0]), SEQUENCE_BLOCK), cols)


def stop_sequence_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], at: Column, name: str) -> DataFrame:
    """Rank of each stop within its trip by time and the sequences, nulls first."""
    return ordered(df, keys, [at, *[F.col(o) for o in order]], stretch(at, STATION_SECONDS), **{name: rank()})


def point_type(df: DataFrame, trip: Sequence[str], seq: str, is_timepoint: Column, whole: bool = False) -> DataFrame:
    """start, end or mid (a checkpoint or timepoint) by place in the trip."""
    ranked = with_group_values(df, trip, whole, _last=F.max(seq))
    kind = (
        F.when(F.col(seq) == 1, "start").when(F.col(seq) == F.col("_last"), "end").when(is_timepoint, "mid")
    )
    return ranked.withColumn("point_type", kind).drop("_last")


def timepoint_order(df: DataFrame, pattern: Sequence[str], trip: Sequence[str], seq: str) -> DataFrame:
    """Dense rank of each sequence in its pattern, and the trip's lowest and highest sequence."""
    ranked = dense_rank_of_values(df, pattern, seq, "timepoint_order")
    return with_group_values(
        ranked, trip, tm_planned_sequence_start=F.min(seq), tm_planned_sequence_end=F.max(seq)
    )


def dense_rank_of_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Dense rank by a value that many rows of a key share.

    Values are ranked once each and joined back, so the rows of a key are never
    brought together.
    """
    values = df.select(key_struct(*keys, value).alias("_value"), *keys, value).distinct()
    ranked = ordered(
        values, keys, [F.col(value)], stretch(F.col(value), SEQUENCE_BLOCK), **{name: row_number()}
    ).select("_value", name)
    return df.withColumn("_value", key_struct(*keys, value)).join(ranked, "_value", "left").drop("_value")


def full_trip_flag(df: DataFrame, keys: Sequence[str], whole: bool = False) -> DataFrame:
    """True where the trip has both a start and an end point."""
    kind = F.col("point_type")
    ends = with_group_values(df, keys, whole, _starts=F.bool_or(kind == "start"), _ends=F.bool_or(kind == "end"))
    full = F.coalesce("_starts", F.lit(False)) & F.coalesce("_ends", F.lit(False))
    return ends.withColumn("is_full_trip", full).drop("_starts", "_ends")


def observed_times(df: DataFrame) -> DataFrame:
    """Stop arrival and departure from two sources.

    First stops depart when the feed says (else the vehicle log); other stops
    at the earlier of both. Arrival is the later of both but not after the
    departure. The last stop departs when it arrives.
    """
    departure = F.when(
        F.col("stop_sequence") == 1, F.coalesce("gtfs_departure_dt", "tm_actual_departure_dt")
    ).otherwise(F.least("tm_actual_departure_dt", "gtfs_departure_dt"))
    arrival = F.least(F.greatest("gtfs_arrival_dt", "tm_actual_arrival_dt"), F.col("stop_departure_dt"))
    return (
        df.withColumn("stop_departure_dt", departure)
        .withColumn("stop_arrival_dt", arrival)
        .withColumn(
            "stop_departure_dt",
            F.when(F.col("stop_sequence") == F.col("stop_count"), F.col("stop_arrival_dt")).otherwise(
                F.col("stop_departure_dt")
            ),
        )
    )


def clamp_to_earlier_stops(
    df: DataFrame, keys: Sequence[str], seq: Sequence[str], cols: Sequence[str], also: Sequence[str] = ()
) -> DataFrame:
    """Raise times that fall before an earlier stop's latest time; nulls stay null."""
    latest = F.greatest(*[F.col(c) for c in (*cols, *also)]) if len((*cols, *also)) > 1 else F.col(cols[0])
    scanned = ordered(
        df, keys, [F.col(s) for s in seq], stretch(F.col(seq[0]), SEQUENCE_BLOCK), _floor=max_before(latest)
    )
    for c in cols:
        scanned = scanned.withColumn(c, F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.col("_floor"))))
    return scanned.drop("_floor")


def travel_time(
    df: DataFrame, keys: Sequence[str], seq: Sequence[str], arrival: str, departure: str, seconds=None
) -> DataFrame:
    """Seconds from the last known time at an earlier stop to this stop."""
    gap = seconds or (lambda later, earlier: later - earlier)
    scanned = ordered(
        df,
        keys,
        [F.col(s) for s in seq],
        stretch(F.col(seq[0]), SEQUENCE_BLOCK),
        _left=last_before(F.coalesce(departure, arrival)),
    )
    return scanned.withColumn(
        "travel_time_seconds", gap(F.coalesce(arrival, departure), F.col("_left"))
    ).drop("_left")


def service_seconds(df: DataFrame, columns: dict[str, str], date: str = "service_date") -> DataFrame:
    """Seconds after midnight of the service date for wall-clock columns: ``new=column``."""
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in columns],
        *[wall_seconds_since(F.col(date), F.col(col)).alias(new) for new, col in columns.items()],
    )


def rail_travel_time(move: Column, stop: Column) -> Column:
    """Seconds from leaving the previous station to stopping here; null unless positive."""
    return F.when(stop > move, stop - move)


def rail_dwell_time(stops: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Seconds from stopping to the trip's next move.

    First stops and one-stop trips do not take part (they neither get a dwell
    nor end another stop's); only positive values stay.
    """
    sort = F.coalesce("move_timestamp", "stop_timestamp")
    counted = stops.filter(~F.col("first_stop_flag") & (F.col("stop_count") > 1)).withColumn("_sort", sort)
    scanned = ordered(
        counted,
        keys,
        [F.col("_sort"), *[F.col(t) for t in tie]],
        stretch(F.col("_sort"), STATION_SECONDS),
        _leaves=lead(F.col("move_timestamp")),
    )
    dwell = F.col("_leaves") - F.col("stop_timestamp")
    return scanned.withColumn("dwell_time_seconds", F.when(dwell > 0, dwell)).drop("_sort", "_leaves")


def next_station_move(stops: DataFrame, trip: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """When each revenue trip moves on from a station: the move time of its next stop."""
    sort = F.coalesce("vp_move_timestamp", "vp_stop_timestamp")
    counted = stops.filter((F.col("stop_count") > 1) & F.col("revenue")).withColumn("_sort", sort)
    return ordered(
        counted,
        trip,
        [F.col("_sort"), *[F.col(t) for t in tie]],
        stretch(F.col("_sort"), STATION_SECONDS),
        next_station_move=lead(F.col("vp_move_timestamp")),
    ).drop("_sort")


def rail_headway(departures: DataFrame, line: str, name: str, trip: Sequence[str]) -> DataFrame:
    """Seconds between departures from a station, per branch or trunk and direction."""
    on_line = departures.filter(F.col(line).isNotNull())
    return headway(
        on_line,
        ["parent_station", line, "direction_id"],
        F.col("next_station_move"),
        name,
        trip,
        positive_only=True,
    )


def sequence_gaps(
    df: DataFrame, keys: Sequence[str], seq: str, tie: Sequence[str], split: Column | None = None
) -> DataFrame:
    """Step from each sequence number to the next one of the trip."""
    scanned = ordered(
        df,
        keys,
        [F.col(seq), *[F.col(t) for t in tie]],
        stretch(F.col(seq), SEQUENCE_BLOCK) if split is None else split,
        _next=lead(F.col(seq)),
    )
    return scanned.withColumn("sequence_diff", F.col("_next") - F.col(seq)).drop("_next")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], split: Column, name: str) -> DataFrame:
    return ordered(df, keys, order, split, **{name: row_number()})


