"""Rail events, trips and measures.

A trip is keyed by (service_date, route_id, trip_id); an event by that and its
station. Jobs recompute whole service dates; tables are partitioned by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import fill_service_date, int_date, local_from_epoch, scheduled_at
from tramline.operators import aggregates, calendar, changes, events, filters, joins, metrics
from tramline.session import cut_lineage

TRIP = ("service_date", "route_id", "trip_id")
EVENT = (*TRIP, "parent_station")
DETAILS = (
    "start_time", "direction_id", "vehicle_id", "revenue", "stop_id", "stop_sequence", "vehicle_label",
    "vehicle_consist", "static_version_key",
)


def placed(df: DataFrame, feeds: DataFrame, stops: DataFrame, epoch: str) -> DataFrame:
    """Service date, schedule version and station of each record; records without a version leave."""
    dated = df.withColumn("service_date", fill_service_date(F.col("service_date"), F.col(epoch)))
    versions = calendar.version_for_dates(dated, feeds).filter(F.col("static_version_key").isNotNull())
    return joins.parent_station(dated.join(versions, "service_date"), stops)


def position_events(positions: DataFrame, routes, feeds: DataFrame, stops: DataFrame) -> DataFrame:
    """Vehicle positions -> first move and first stop per trip and station."""
    typed = events.rail_position_types(filters.rail_positions(positions, routes))
    typed = typed.withColumnRenamed("current_stop_sequence", "stop_sequence").withColumn(
        "vehicle_consist", events.vehicle_consist(F.col("vehicle_consist"), F.col("multi_carriage_details"))
    ).drop("multi_carriage_details")
    return events.move_stop_pivot(placed(typed, feeds, stops, "vehicle_timestamp"), DETAILS)


def prediction_events(updates: DataFrame, routes: Sequence[str], feeds: DataFrame, stops: DataFrame) -> DataFrame:
    """Trip updates -> last near prediction per trip and station."""
    usable = updates.filter(
        F.col("direction_id").isin(0, 1)
        & F.col("trip_id").isNotNull()
        & F.col("vehicle_id").isNotNull()
        & F.col("route_id").isin(*routes)
    )
    near = placed(events.near_predictions(usable), feeds, stops, "timestamp")
    return (
        events.latest_prediction(near)
        .drop("timestamp")
        .withColumns(
            {
                "stop_sequence": F.lit(None).cast("long"),
                "vehicle_label": F.lit(None).cast("string"),
                "vehicle_consist": F.lit(None).cast("string"),
                "revenue": F.lit(True),
            }
        )
    )


def rail_events(position_rows: DataFrame, prediction_rows: DataFrame) -> DataFrame:
    """Events of both feeds in one row per trip and station."""
    return joins.outer_merge_events(position_rows, prediction_rows, EVENT, DETAILS)


def exact_trip_match(rt: DataFrame, static_trips: DataFrame, static_stops: DataFrame) -> DataFrame:
    """Realtime trips whose id is in their schedule version, with the planned stop count."""
    version = ["static_version_key", "trip_id"]
    counts = static_stops.groupBy(*version).agg(F.count("stop_sequence").alias("static_stop_count"))
    return (
        rt.filter(F.col("start_time").isNotNull())
        .distinct()
        .join(static_trips.select(*version).distinct(), version)
        .join(counts, version)
        .withColumns(
            {
                "static_trip_id_guess": F.col("trip_id"),
                "first_last_station_match": F.lit(True),
                "static_start_time": F.col("start_time"),
            }
        )
        .distinct()
    )


def static_trip_summary(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per scheduled trip: stops, earliest arrival, branch as route."""
    counts = aggregates.trip_stop_counts(calls, keys, "arrival_seconds").withColumnsRenamed(
        {"stop_count": "static_stop_count", "start_time": "static_start_time"}
    )
    branch = aggregates.branch_and_trunk(calls, keys, otherwise_braintree=True)
    return counts.join(branch.select(*keys, F.col("branch_route_id").alias("route_id")), list(keys))


def nearest_trip_match(trips: DataFrame, static: DataFrame, width: int = 3600) -> DataFrame:
    """Trips without an exact match -> the scheduled trip nearest in start time.

    Same version, direction and branch (trunk where there is no branch).
    """
    return joins.asof_nearest(
        trips.withColumn("match_route", F.coalesce("branch_route_id", "trunk_route_id")),
        static.select(
            "service_date", "direction_id", F.col("route_id").alias("match_route"), "static_start_time",
            "static_trip_id", "static_stop_count",
        ),
        ["service_date", "direction_id", "match_route"],
        "start_time",
        "static_start_time",
        "static_trip_id",
        width,
    ).drop("match_route")


def rail_trips(stored_events: DataFrame, static: dict[str, DataFrame]) -> DataFrame:
    """Trips of all events with branch, counts, schedule match, start time and directions.

    ``static``: stop_times (seconds, parent_station), trips, directions, all with
    ``static_version_key``; ``trip_summary`` with service_date for the nearest match.
    """
    trip_cols = ["direction_id", "start_time", "vehicle_id", "vehicle_label", "vehicle_consist", "static_version_key", "revenue"]
    tie = [F.col(c) for c in trip_cols]
    newest = changes.distinct_on_latest(
        stored_events.select(*TRIP, "stop_sequence", *trip_cols), TRIP, "stop_sequence", tie
    ).drop("stop_sequence")
    trips = calendar.max_version_per_day(newest, stored_events.select("service_date", "static_version_key"))
    branch = aggregates.branch_and_trunk(stored_events, ["service_date", "trip_id"])
    counted = (
        stored_events.filter(F.col("vp_move_timestamp").isNotNull() | F.col("vp_stop_timestamp").isNotNull())
        .groupBy(*TRIP)
        .agg(F.count(F.lit(1)).alias("stop_count"))
    )
    trips = cut_lineage(trips.join(branch, list(TRIP), "left").join(counted, list(TRIP), "left"), "trips")
    exact = exact_trip_match(
        trips.select("service_date", "route_id", "trip_id", "static_version_key", "start_time"),
        static["trips"],
        static["stop_times"],
    ).select(
        *TRIP, "static_trip_id_guess", "first_last_station_match", "static_stop_count", "static_start_time"
    )
    planned = trips.filter(F.col("start_time").isNull()).join(
        static["stop_times"].select("static_version_key", "trip_id", "departure_time"), ["static_version_key", "trip_id"]
    )
    started = aggregates.backfill_start_times(trips, planned.select(*TRIP, "departure_time"), stored_events, TRIP)
    directed = started.join(
        static["directions"].select("static_version_key", "route_id", "direction_id", "direction", "direction_destination"),
        ["static_version_key", "route_id", "direction_id"],
        "left",
    )
    matched = cut_lineage(directed.join(exact, list(TRIP), "left"), "trips-exact")
    open_trips = matched.filter(F.col("static_trip_id_guess").isNull()).drop(
        "static_trip_id_guess", "static_start_time", "static_stop_count", "first_last_station_match"
    )
    guessed = (
        nearest_trip_match(open_trips, static["trip_summary"])
        .withColumnRenamed("static_trip_id", "static_trip_id_guess")
        .withColumn("first_last_station_match", F.lit(False))
    )
    return matched.filter(F.col("static_trip_id_guess").isNotNull()).unionByName(guessed)


def canonical_stops(static: dict[str, DataFrame]) -> DataFrame:
    """Station numbers per version, route and direction, from the typical trips."""
    patterns = static["route_patterns"].join(
        static["trips"].select(
            "static_version_key",
            F.col("trip_id").alias("representative_trip_id"),
            "trunk_route_id",
            F.coalesce("branch_route_id", "trunk_route_id").alias("_route"),
        ),
        ["static_version_key", "representative_trip_id"],
    )
    return aggregates.canonical_sequences(
        patterns.drop("route_id").withColumnRenamed("_route", "route_id"),
        static["stop_times"].select("static_version_key", "trip_id", "stop_sequence", "parent_station"),
    )


def numbered_events(stored_events: DataFrame, trips: DataFrame, static: dict[str, DataFrame]) -> DataFrame:
    """Events with canonical and trunk-wide station numbers and their trip's columns."""
    canon = cut_lineage(canonical_stops(static), "canon")
    sync = aggregates.sync_sequences(canon)
    wide = stored_events.drop("direction_id", "start_time", "vehicle_id", "vehicle_label", "vehicle_consist", "static_version_key", "revenue").join(
        trips, list(TRIP)
    )
    numbered = wide.withColumn("_line", F.coalesce("branch_route_id", "trunk_route_id")).join(
        canon.select(
            "static_version_key", "direction_id", F.col("route_id").alias("_line"), "parent_station",
            F.col("stop_sequence").alias("canonical_stop_sequence"),
        ),
        ["static_version_key", "direction_id", "_line", "parent_station"],
        "left",
    )
    return numbered.join(
        sync, ["static_version_key", "direction_id", "trunk_route_id", "parent_station"], "left"
    ).drop("_line")


def rail_metrics(wide: DataFrame, static_calls: DataFrame) -> DataFrame:
    """Travel, dwell and headways for events that carry their trip's columns.

    ``static_calls``: static_version_key, static_trip_id, parent_station, stop_sequence.
    """
    trip = list(TRIP)
    seen = wide.filter(F.col("vp_move_timestamp").isNotNull() | F.col("vp_stop_timestamp").isNotNull())
    rt = cut_lineage(metrics.first_last_rank(seen, trip, ["stop_sequence", "parent_station"], "rt"), "rt-rank")
    static = metrics.first_last_rank(
        static_calls, ["static_version_key", "static_trip_id"], ["stop_sequence", "parent_station"], "static"
    ).drop("stop_sequence")
    matched = joins.match_static_stop(
        rt.select(*trip, "parent_station", "stop_sequence", "static_version_key", "static_trip_id_guess", "stop_count",
                  "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp", "rt_first_stop", "rt_stop_rank"),
        static,
        trip,
    )
    stops = cut_lineage(
        matched.select(
            *trip,
            "parent_station",
            "stop_count",
            F.col("vp_move_timestamp").alias("move_timestamp"),
            F.coalesce("vp_stop_timestamp", "tu_stop_timestamp").alias("stop_timestamp"),
            F.coalesce("static_first_stop", "rt_first_stop").alias("first_stop_flag"),
        ),
        "metric-stops",
    )
    travel = stops.select(
        *trip, "parent_station", metrics.rail_travel_time(F.col("move_timestamp"), F.col("stop_timestamp")).alias("travel_time_seconds")
    )
    dwell = metrics.rail_dwell_time(stops, trip, ["parent_station"]).select(*trip, "parent_station", "dwell_time_seconds")
    leaving = cut_lineage(metrics.next_station_move(rt, trip, ["stop_sequence", "parent_station"]), "leaving")
    one = joins.first_row(
        leaving.select(*trip, "parent_station", "direction_id", "branch_route_id", "trunk_route_id", "next_station_move", "stop_sequence"),
        [*trip, "parent_station"],
        [F.col("stop_sequence")],
    )
    branch = metrics.rail_headway(one, "branch_route_id", "headway_branch_seconds", trip)
    trunk = metrics.rail_headway(one, "trunk_route_id", "headway_trunk_seconds", trip)
    key = [*trip, "parent_station"]
    return (
        wide.join(travel, key, "left")
        .join(dwell, key, "left")
        .join(branch.select(*key, "headway_branch_seconds"), key, "left")
        .join(trunk.select(*key, "headway_trunk_seconds"), key, "left")
    )


def scheduled_rail_metrics(stop_times: DataFrame) -> DataFrame:
    """Planned travel times and branch and trunk headways of rail stop times.

    ``stop_times``: static_version_key, trip_id, stop_sequence, arrival_time,
    departure_time (seconds), parent_station, service_id, direction_id,
    branch_route_id, trunk_route_id.
    """
    work = stop_times.withColumnsRenamed({"arrival_time": "arrival_seconds", "departure_time": "departure_seconds"})
    timed = cut_lineage(
        metrics.plan_travel_time(work, ["static_version_key", "trip_id"], "stop_sequence"), "rail-plan"
    )
    place = ["static_version_key", "parent_station", "service_id", "direction_id"]
    out = timed
    for line in ("branch", "trunk"):
        on_line = timed.filter(F.col(f"{line}_route_id").isNotNull())
        gaps = metrics.headway(
            on_line, [*place, f"{line}_route_id"], F.col("departure_seconds"), f"schedule_headway_{line}_seconds",
            ["trip_id", "stop_sequence"],
        )
        out = out.join(
            gaps.select("static_version_key", "trip_id", "stop_sequence", f"schedule_headway_{line}_seconds"),
            ["static_version_key", "trip_id", "stop_sequence"],
            "left",
        )
    return out.withColumnRenamed("plan_travel_time_seconds", "schedule_travel_time_seconds")


def daily_flat_table(measured: DataFrame, scheduled: DataFrame, routes: DataFrame) -> DataFrame:
    """The published table: revenue subway events with schedule values, one row per event."""
    plan = scheduled.select(
        "static_version_key",
        F.col("trip_id").alias("static_trip_id_guess"),
        "parent_station",
        F.col("arrival_seconds").alias("scheduled_arrival_time"),
        F.col("departure_seconds").alias("scheduled_departure_time"),
        F.col("schedule_travel_time_seconds").alias("scheduled_travel_time"),
        F.col("schedule_headway_branch_seconds").alias("scheduled_headway_branch"),
        F.col("schedule_headway_trunk_seconds").alias("scheduled_headway_trunk"),
    )
    subway = routes.filter(F.col("route_type") < 2).select("static_version_key", "route_id")
    return (
        measured.filter(
            F.col("revenue") & (F.col("vp_move_timestamp").isNotNull() | F.col("vp_stop_timestamp").isNotNull())
        )
        .join(subway, ["static_version_key", "route_id"], "left_semi")
        .join(plan, ["static_version_key", "static_trip_id_guess", "parent_station"], "left")
        .select(
            "stop_sequence", "stop_id", "parent_station", F.col("vp_move_timestamp").alias("move_timestamp"),
            F.coalesce("vp_stop_timestamp", "tu_stop_timestamp").alias("stop_timestamp"),
            "travel_time_seconds", "dwell_time_seconds", "headway_trunk_seconds", "headway_branch_seconds", "service_date",
            "route_id", "direction_id", "start_time", "vehicle_id", "branch_route_id", "trunk_route_id", "stop_count",
            "trip_id", "vehicle_label", "vehicle_consist", "direction", "direction_destination", "scheduled_arrival_time",
            "scheduled_departure_time", "scheduled_travel_time", "scheduled_headway_branch", "scheduled_headway_trunk",
        )
    )


def rail_wide_table(
    measured: DataFrame, stops: DataFrame, routes: DataFrame, route_types: Sequence[int], scheduled: DataFrame | None = None
) -> DataFrame:
    """The wide extract: each event with its previous and next stop, clocks and names.

    With ``scheduled`` (``scheduled_rail_metrics``), also the planned arrival and departure, travel time and headways
    of the same stop of the same trip, as the commuter extract has them.
    """
    linked = metrics.trip_neighbours(
        measured,
        list(TRIP),
        ["stop_sequence", "parent_station"],
        {
            "previous_canonical_stop_sequence": ("previous", "canonical_stop_sequence"),
            "previous_sync_stop_sequence": ("previous", "sync_stop_sequence"),
            "previous_stop_id": ("previous", "stop_id"),
            "previous_parent_station": ("previous", "parent_station"),
            "next_move_timestamp": ("next", "vp_move_timestamp"),
        },
    )
    wanted = routes.filter(F.col("route_type").isin(*route_types)).select("static_version_key", "route_id")
    names = stops.select("static_version_key", "stop_id", "stop_name")
    day = int_date(F.col("service_date"))
    arrival = F.coalesce("vp_stop_timestamp", "tu_stop_timestamp")

    def wall(epoch):
        return local_from_epoch(epoch)

    def seconds(epoch):
        return F.unix_timestamp(wall(epoch)) - F.unix_timestamp(day.cast("timestamp"))

    kept = linked.filter(
        (F.col("canonical_stop_sequence").isNull() | (F.col("canonical_stop_sequence") > 1))
        & (F.col("vp_stop_timestamp").isNotNull() | F.col("vp_move_timestamp").isNotNull())
    )
    planned = []
    if scheduled is not None:
        call = ["static_version_key", "trip_id", "stop_sequence"]
        plan = scheduled.select(
            *call,
            F.struct(
                "arrival_seconds", "departure_seconds", "schedule_travel_time_seconds", "schedule_headway_branch_seconds",
                "schedule_headway_trunk_seconds",
            ).alias("plan"),
        )
        kept = kept.join(plan, call, "left")
        planned = [
            scheduled_at(day, F.col("plan.arrival_seconds")).alias("scheduled_arrival_time"),
            scheduled_at(day, F.col("plan.departure_seconds")).alias("scheduled_departure_time"),
            F.col("plan.schedule_travel_time_seconds").alias("scheduled_travel_time"),
            F.col("plan.schedule_headway_branch_seconds").alias("scheduled_headway_branch"),
            F.col("plan.schedule_headway_trunk_seconds").alias("scheduled_headway_trunk"),
        ]
    return (
        kept.join(wanted, ["static_version_key", "route_id"], "left_semi")
        .join(names, ["static_version_key", "stop_id"], "left")
        .join(
            names.withColumnsRenamed({"stop_id": "previous_stop_id", "stop_name": "previous_stop_name"}),
            ["static_version_key", "previous_stop_id"],
            "left",
        )
        .select(
            day.alias("service_date"),
            scheduled_at(day, F.col("start_time")).alias("start_datetime"),
            scheduled_at(day, F.col("static_start_time")).alias("static_start_datetime"),
            "stop_sequence", "canonical_stop_sequence", "previous_canonical_stop_sequence", "sync_stop_sequence",
            "previous_sync_stop_sequence", "stop_id", "previous_stop_id", "parent_station", "previous_parent_station",
            "stop_name", "previous_stop_name",
            wall(F.col("vp_move_timestamp")).alias("previous_stop_departure_datetime"),
            wall(arrival).alias("stop_arrival_datetime"),
            wall(F.col("next_move_timestamp")).alias("stop_departure_datetime"),
            seconds(F.col("vp_move_timestamp")).alias("previous_stop_departure_sec"),
            seconds(arrival).alias("stop_arrival_sec"),
            seconds(F.col("next_move_timestamp")).alias("stop_departure_sec"),
            F.col("revenue").alias("is_revenue"), F.col("direction_id").cast("int").alias("direction_id"),
            "route_id", "branch_route_id", "trunk_route_id", "start_time", "vehicle_id", "stop_count", "trip_id",
            "vehicle_label", "vehicle_consist", "direction", "direction_destination", "static_trip_id_guess",
            "static_start_time", "static_stop_count", F.col("first_last_station_match").alias("exact_static_trip_match"),
            "static_version_key", "travel_time_seconds", "dwell_time_seconds", "headway_trunk_seconds", "headway_branch_seconds",
            *planned,
        )
    )


