"""From positions and predictions to stop events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.nested import join_labels
from tramline.functions.times import clock_seconds, scheduled_at
from tramline.operators.groups import by_size, first_row, with_group_values
from tramline.operators.scan import min_from, ordered, time_stretch

# Unique trip-stop of the rail model.
TRIP_STOP = ("service_date", "route_id", "trip_id", "parent_station")


def drop_out_of_order(
    positions: DataFrame, keys: Sequence[str], seq: str, order: Sequence[Column], split: Column, whole: bool = False
) -> DataFrame:
    """Keep a record only if no later record of its key has a lower sequence."""
    scanned = ordered(positions, keys, order, split, whole, _lowest_from_here=min_from(F.col(seq)))
    return scanned.filter(F.col(seq) <= F.col("_lowest_from_here")).drop("_lowest_from_here")


EVENT_KEYS = ("service_date", "trip_id", "vehicle_label", "gtfs_stop_sequence")
EVENT_DETAILS = ("route_id", "stop_id", "direction_id", "start_time", "vehicle_id")


def pivot_positions(positions: DataFrame) -> DataFrame:
    """One row per trip, vehicle and stop sequence: in-transit span, arrival, departure, first place.

    ``current_status`` is IN_TRANSIT_TO or STOPPED_AT; the last in-transit time
    is capped at the arrival.
    """
    ts, status = F.col("vehicle_timestamp"), F.col("current_status")
    moving = F.when(status == "IN_TRANSIT_TO", ts)
    stopped = F.when(status == "STOPPED_AT", ts)
    at_first = F.struct(ts, F.col("latitude"), F.col("longitude"))
    return (
        positions.withColumnRenamed("stop_sequence", "gtfs_stop_sequence")
        .groupBy(*EVENT_KEYS, *EVENT_DETAILS)
        .agg(
            F.min(moving).alias("gtfs_first_in_transit_dt"),
            F.max(moving).alias("_last_moving"),
            F.min(stopped).alias("gtfs_arrival_dt"),
            F.max(stopped).alias("gtfs_departure_dt"),
            F.min_by("latitude", at_first).alias("latitude"),
            F.min_by("longitude", at_first).alias("longitude"),
        )
        .withColumn("gtfs_last_in_transit_dt", F.least("_last_moving", "gtfs_arrival_dt"))
        .drop("_last_moving")
    )


def positions_to_events(positions: DataFrame, stretch_seconds: int = 3600) -> DataFrame:
    """Bus positions -> stop events: out-of-order records out, pivot, start and stop count."""
    keys = ["service_date", "trip_id", "vehicle_label"]
    order = [F.col("vehicle_timestamp"), F.col("stop_sequence")]
    split = time_stretch(F.col("vehicle_timestamp"), stretch_seconds)
    ordered_positions = by_size(
        positions, keys, lambda rows, whole: drop_out_of_order(rows, keys, "stop_sequence", order, split, whole)
    )
    events = pivot_positions(ordered_positions.withColumn("start_time", clock_seconds(F.col("start_time"))))
    counted = with_group_values(
        events, ["service_date", "trip_id", "vehicle_id"], stop_count=F.count("gtfs_stop_sequence")
    )
    return counted.withColumn("start_dt", scheduled_at(F.col("service_date"), F.col("start_time")))


def rail_position_types(positions: DataFrame) -> DataFrame:
    """Typed rail positions: moving flag, revenue (null counts as true), start in seconds."""
    return positions.select(
        *[c for c in positions.columns if c not in ("current_status", "revenue", "start_time", "start_date")],
        (F.col("current_status") != "STOPPED_AT").alias("is_moving"),
        F.coalesce(F.col("revenue"), F.lit(True)).alias("revenue"),
        clock_seconds(F.col("start_time")).alias("start_time"),
        F.col("start_date").try_cast("long").alias("service_date"),
    )


def move_stop_pivot(positions: DataFrame, details: Sequence[str], keys: Sequence[str] = TRIP_STOP) -> DataFrame:
    """Earliest moving and earliest stopped time per trip-stop; details of the earliest record."""
    ts = F.col("vehicle_timestamp")
    detail = F.struct(*[F.col(d) for d in details])
    pivoted = positions.groupBy(*keys).agg(
        F.min(F.when(F.col("is_moving"), ts)).alias("vp_move_timestamp"),
        F.min(F.when(~F.col("is_moving"), ts)).alias("vp_stop_timestamp"),
        F.min_by(detail, F.struct(ts, *[F.col(d) for d in details])).alias("_detail"),
    )
    return pivoted.select(
        *keys, "vp_move_timestamp", "vp_stop_timestamp", *[F.col("_detail").getField(d).alias(d) for d in details]
    )


def vehicle_consist(consist: Column, carriages: Column) -> Column:
    """Car labels joined by a pipe, from the older field or else the newer one."""
    return F.coalesce(join_labels(consist), join_labels(carriages))


def near_predictions(updates: DataFrame, horizon_seconds: int = 120) -> DataFrame:
    """Predictions made less than two minutes ahead and not about the past."""
    made = F.coalesce("timestamp", "feed_timestamp")
    ahead = F.col("tu_stop_timestamp") - made
    return (
        updates.filter((F.col("tu_stop_timestamp") > 0) & (ahead >= 0) & (ahead < horizon_seconds))
        .withColumn("timestamp", made)
        .drop("feed_timestamp")
    )


def latest_prediction(updates: DataFrame, keys: Sequence[str] = TRIP_STOP) -> DataFrame:
    """The last prediction of every trip-stop; a tie takes the later arrival."""
    rest = [F.col(c) for c in updates.columns if c not in keys and c not in ("timestamp", "tu_stop_timestamp")]
    return first_row(updates, keys, [F.col("timestamp"), F.col("tu_stop_timestamp"), *rest], last=True)


def upsert_events(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored events brought up to date with new ones.

    Move and stop times take the earliest; a prediction takes the newest. The
    stop (sequence, id) follows whichever row brought an earlier time. New
    events are inserted. Repeated keys of a batch are made one event first.
    """
    value_cols = [c for c in new.columns if c not in keys]
    new = one_event_per_key(new, keys)
    s = stored.select(*keys, *[F.col(c).alias(f"s_{c}") for c in value_cols], F.lit(True).alias("_s"))
    n = new.select(*keys, *[F.col(c).alias(f"n_{c}") for c in value_cols], F.lit(True).alias("_n"))
    both = s.join(n, list(keys), "full")
    flags = change_flags()
    moved, stopped = flags["move"], flags["stop"]
    out = {
        "vp_move_timestamp": F.when(moved, F.col("n_vp_move_timestamp")).otherwise(F.col("s_vp_move_timestamp")),
        "vp_stop_timestamp": F.when(stopped, F.col("n_vp_stop_timestamp")).otherwise(F.col("s_vp_stop_timestamp")),
        "tu_stop_timestamp": F.coalesce("n_tu_stop_timestamp", "s_tu_stop_timestamp"),
    }
    for c in value_cols:
        if c not in out:
            take_new = F.col("_s").isNull() | moved | stopped
            out[c] = F.when(take_new, F.col(f"n_{c}")).otherwise(F.col(f"s_{c}"))
    return both.select(*keys, *[out[c].alias(c) for c in value_cols])


def one_event_per_key(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Earliest move and stop, latest prediction; other columns of the row with the earliest time."""
    times = ("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    rest = [c for c in events.columns if c not in keys and c not in times]
    earliest = F.least("vp_move_timestamp", "vp_stop_timestamp")
    by_time = F.struct(earliest.isNull(), earliest, *[F.col(c) for c in rest])
    merged = events.groupBy(*keys).agg(
        F.min("vp_move_timestamp").alias("vp_move_timestamp"),
        F.min("vp_stop_timestamp").alias("vp_stop_timestamp"),
        F.max("tu_stop_timestamp").alias("tu_stop_timestamp"),
        F.min_by(F.struct(F.lit(True), *[F.col(c) for c in rest]), by_time).alias("_rest"),
    )
    return merged.select(
        *[F.col("_rest").getField(c).alias(c) if c in rest else F.col(c) for c in events.columns]
    )


def change_flags() -> dict[str, Column]:
    """What a new event (``n_``) changes about a stored one (``s_``)."""

    def earlier(name: str) -> Column:
        n, s = F.col(f"n_{name}"), F.col(f"s_{name}")
        return F.coalesce(n.isNotNull() & (s.isNull() | (s > n)), F.lit(False))

    return {
        "move": earlier("vp_move_timestamp"),
        "stop": earlier("vp_stop_timestamp"),
        "prediction": F.col("n_tu_stop_timestamp").isNotNull(),
    }


def insert_update_flags(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New events with ``do_insert`` / ``do_update``; events that change nothing are left out."""
    times = ("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    s = stored.select(*keys, *[F.col(t).alias(f"s_{t}") for t in times], F.lit(True).alias("_s"))
    n = new.select(*keys, *[F.col(t).alias(f"n_{t}") for t in times])
    joined = n.join(s, list(keys), "left")
    flags = change_flags()
    known = F.col("_s").isNotNull()
    update = known & (flags["move"] | flags["stop"] | flags["prediction"])
    return joined.select(
        *keys, (~known).alias("do_insert"), update.alias("do_update")
    ).filter(F.col("do_insert") | F.col("do_update"))
