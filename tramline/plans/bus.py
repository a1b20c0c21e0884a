"""Bus performance of service days.

All times are UTC instants: schedule and vehicle-log times are local clocks and
are converted, feed times are UTC already. Columns ending in ``_seconds`` or
``_sam`` are local seconds after midnight of the service date. The service date
is part of every key, so one run may cover any number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions import texts
from tramline.functions.rows import row_sum
from tramline.functions.times import (
    calendar_date,
    clock_seconds,
    local_wall_clock,
    utc_from_local_seconds,
    wall_seconds_since,
)
from tramline.operators import aggregates, calendar, events, filters, joins, metrics
from tramline.operators import validate as V
from tramline.operators.groups import by_size, with_group_values
from tramline.operators.scan import (
    filled,
    first_in_key,
    lag,
    last_before,
    max_before,
    ordered,
    rank,
    row_number,
    stretch,
)
from tramline.session import cut_lineage

NO_PULLOUT = "____"
DAY_TRIP = ["service_date", "trip_id"]


def written(df: DataFrame, name: str, whole: bool) -> DataFrame:
    """A stage that the next step reads twice is written; plain windows read it once."""
    return df if whole else cut_lineage(df, name)


# Schedules -----------------------------------------------------------------


def gtfs_schedule(tables: dict[str, DataFrame], service_date: int) -> DataFrame:
    """Scheduled bus stops of a date from the archive tables, with planned travel times and headways."""
    valid = {name: calendar.as_of(df, service_date) for name, df in tables.items()}
    services = calendar.service_ids_for_date(valid["calendar"], valid["calendar_dates"], service_date)
    trips = (
        valid["trips"]
        .join(valid["routes"].filter(F.col("route_type") == 3).select("route_id"), "route_id")
        .join(services, "service_id")
        .join(valid["directions"], ["route_id", "direction_id"])
        .join(valid["route_patterns"].select("route_pattern_id", "route_pattern_typicality"), "route_pattern_id")
        .select(
            "trip_id", "block_id", "route_id", "service_id", "route_pattern_id", "route_pattern_typicality",
            "direction_id", "direction", "direction_destination",
        )
    )
    times = valid["stop_times"].select(
        "trip_id",
        "stop_id",
        "checkpoint_id",
        F.col("stop_sequence").alias("gtfs_stop_sequence"),
        clock_seconds(F.col("arrival_time")).alias("arrival_seconds"),
        clock_seconds(F.col("departure_time")).alias("departure_seconds"),
    )
    counts = (
        aggregates.trip_stop_counts(times, ["trip_id"], "arrival_seconds")
        .withColumnsRenamed({"stop_count": "plan_stop_count", "start_time": "plan_start_time"})
    )
    date = scheduled_date(service_date)
    stops = (
        times.join(trips, "trip_id")
        .join(valid["stops"].select("stop_id", "stop_name"), "stop_id", "left")
        .join(counts, "trip_id", "left")
        .withColumn("service_date", date)
        .withColumn("plan_start_dt", utc_from_local_seconds(F.col("service_date"), F.col("plan_start_time")))
        .withColumn("plan_stop_departure_dt", utc_from_local_seconds(F.col("service_date"), F.col("departure_seconds")))
    )
    return schedule_metrics(cut_lineage(stops, "gtfs-schedule"))


def scheduled_date(service_date: int):
    return F.to_date(F.lit(str(service_date)), "yyyyMMdd")


def schedule_metrics(stops: DataFrame) -> DataFrame:
    """Planned travel time along the trip, planned headways at the stop."""
    timed = metrics.plan_travel_time(stops, ["service_date", "trip_id"], "gtfs_stop_sequence")
    tie = ("trip_id", "gtfs_stop_sequence")
    left = F.col("departure_seconds")
    by_route = metrics.headway(
        cut_lineage(timed, "plan-times"),
        ["service_date", "stop_id", "direction_id", "route_id"],
        left,
        "plan_route_direction_headway_seconds",
        tie,
    )
    both = metrics.headway(
        cut_lineage(by_route, "plan-route-headways"),
        ["service_date", "stop_id", "direction_destination"],
        left,
        "plan_direction_destination_headway_seconds",
        tie,
    )
    unique = ["service_date", "trip_id", "route_id", "gtfs_stop_sequence"]
    needed = V.not_null("trip_id", "stop_id", "route_id", "gtfs_stop_sequence", "plan_stop_departure_dt")
    return V.valid(cut_lineage(both, "plan-headways"), needed, unique).drop("arrival_seconds", "departure_seconds")


def av_schedule(crossings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Timepoints of the vehicle-location system's schedule.

    ``dims``: trip, geo_node, route, vehicle, time_point, waiver tables.
    """
    waivers = dims["waiver"].filter(F.col("MISSED_ALLOWED_FLAG") == 1).select(
        "WAIVER_ID", texts.waiver_code(F.col("REMARK")).alias("waiver_remark")
    )
    lookups = [
        (waivers, "WAIVER_ID"),
        (dims["trip"].filter("TRIP_SERIAL_NUMBER is not null and PATTERN_ID is not null")
         .select("TRIP_ID", "TRIP_SERIAL_NUMBER", "PATTERN_ID").distinct(), "TRIP_ID"),
        (dims["geo_node"].filter("GEO_NODE_ABBR is not null").select("GEO_NODE_ID", "GEO_NODE_ABBR").distinct(), "GEO_NODE_ID"),
        (dims["time_point"].select("TIME_POINT_ID", "TIME_POINT_ABBR", "TIME_PT_NAME"), "TIME_POINT_ID"),
        (dims["route"].filter("ROUTE_ABBR is not null").select("ROUTE_ID", "ROUTE_ABBR").distinct(), "ROUTE_ID"),
        (dims["vehicle"].filter("PROPERTY_TAG is not null").select("VEHICLE_ID", "PROPERTY_TAG").distinct(), "VEHICLE_ID"),
    ]
    star = crossings.filter("ROUTE_ID is not null and GEO_NODE_ID is not null and TRIP_ID is not null")
    for lookup, key in lookups:
        star = star.join(lookup, key, "left")
    date = calendar_date(F.col("CALENDAR_ID"))
    named = cut_lineage(
        star.select(
            date.alias("service_date"),
            F.col("TRIP_SERIAL_NUMBER").cast("string").alias("trip_id"),
            F.col("GEO_NODE_ABBR").alias("stop_id"),
            F.col("PATTERN_GEO_NODE_SEQ").cast("long").alias("tm_stop_sequence"),
            F.col("TIME_POINT_ID").cast("long").alias("timepoint_id"),
            F.col("TIME_POINT_ABBR").cast("string").alias("timepoint_abbr"),
            F.col("TIME_PT_NAME").cast("string").alias("timepoint_name"),
            F.col("PATTERN_ID").cast("long").alias("pattern_id"),
            utc_from_local_seconds(date, F.col("SCHEDULED_TIME")).alias("tm_stop_departure_dt"),
            texts.strip_leading_zeros(F.col("ROUTE_ABBR")).alias("route_id"),
            F.col("PROPERTY_TAG").cast("string").alias("vehicle_label"),
            "waiver_remark",
            "STOP_CROSSING_ID",
            "PULLOUT_ID",
        ),
        "av-star",
    )
    seq = F.col("tm_stop_sequence")
    block = stretch(seq, metrics.SEQUENCE_BLOCK)
    order = cut_lineage(
        metrics.dense_rank_of_values(named, ["service_date", "pattern_id"], "tm_stop_sequence", "timepoint_order"), "av-order"
    )
    labelled = ordered(
        order,
        ["service_date", "PULLOUT_ID", "trip_id"],
        [seq, F.col("STOP_CROSSING_ID")],
        block,
        _before=last_before(F.col("vehicle_label")),
        _first=first_in_key(F.col("vehicle_label")),
    ).withColumn("vehicle_label", F.coalesce("vehicle_label", "_before", "_first")).drop("_before", "_first")
    spanned = with_group_values(
        cut_lineage(labelled, "av-labels"),
        ["service_date", "trip_id"],
        tm_planned_sequence_start=F.min(seq),
        tm_planned_sequence_end=F.max(seq),
    )
    rules = {
        **V.not_null("trip_id", "stop_id", "route_id", "tm_stop_sequence", "tm_stop_departure_dt", "STOP_CROSSING_ID", "PULLOUT_ID"),
        **V.matches("waiver_remark", r"^(\p{Alpha}{1,5}|Unrecognized Code)$"),
    }
    return V.valid(spanned, rules, ["service_date", "trip_id", "route_id", "tm_stop_sequence", "PULLOUT_ID"])


def av_events(crossings: DataFrame, schedule: DataFrame) -> DataFrame:
    """Actual arrivals and departures of the vehicle-location system, as UTC."""
    seen = crossings.filter(
        "ROUTE_ID is not null and GEO_NODE_ID is not null and TRIP_ID is not null and VEHICLE_ID is not null "
        "and (ACT_ARRIVAL_TIME is not null or ACT_DEPARTURE_TIME is not null)"
    ).select("STOP_CROSSING_ID", "ACT_ARRIVAL_TIME", "ACT_DEPARTURE_TIME")
    date = F.col("service_date")
    return seen.join(schedule, "STOP_CROSSING_ID").select(
        "service_date",
        "trip_id",
        "stop_id",
        "route_id",
        "vehicle_label",
        "tm_stop_sequence",
        F.col("PULLOUT_ID").cast("string").alias("tm_pullout_id"),
        utc_from_local_seconds(date, F.col("ACT_ARRIVAL_TIME")).alias("tm_actual_arrival_dt"),
        utc_from_local_seconds(date, F.col("ACT_DEPARTURE_TIME")).alias("tm_actual_departure_dt"),
        F.col("ACT_ARRIVAL_TIME").cast("long").alias("tm_actual_arrival_time_sam"),
        F.col("ACT_DEPARTURE_TIME").cast("long").alias("tm_actual_departure_time_sam"),
    )


# trip-level columns a stop inherits from the other stops of its trip
TRIP_COLUMNS = (
    "block_id", "route_id", "service_id", "route_pattern_id", "route_pattern_typicality", "direction_id", "direction",
    "direction_destination", "plan_stop_count", "plan_start_time", "plan_start_dt", "pattern_id",
)


def combined_schedule(gtfs: DataFrame, tm: DataFrame) -> DataFrame:
    """Both schedules as one: stops of either, joined where trip, stop and departure agree.

    Rows say where they came from (TM, GTFS, JOIN), get a common sequence and a
    point type. Sequences order by departure, then the two own sequences.
    """
    cleaned = gtfs.withColumn("gtfs_trip_suffix", texts.trip_suffix(F.col("trip_id"))).withColumn(
        "trip_id", texts.strip_variant_suffix(F.col("trip_id"))
    )
    day_trip = DAY_TRIP
    tm = tm.withColumn("PULLOUT_ID", F.col("PULLOUT_ID").cast("string"))
    departures = (
        tm.select(*day_trip, "tm_stop_sequence", F.col("tm_stop_departure_dt").alias("plan_stop_departure_dt"))
        .distinct()
        .join(tm.select(*day_trip, "stop_id", "tm_stop_sequence", "PULLOUT_ID"), [*day_trip, "tm_stop_sequence"])
    )
    known = cleaned.join(tm.select(*day_trip).distinct(), day_trip, "left_semi").join(
        departures, [*day_trip, "stop_id", "plan_stop_departure_dt"], "left"
    )
    joined = joins.full_outer_coalesce(
        known, tm, [*day_trip, "PULLOUT_ID", "stop_id", "tm_stop_sequence"], suffix="_tm"
    )
    rows = (
        joins.split_enrich_union(cleaned, tm, day_trip, joined)
        .withColumn("plan_stop_departure_dt", F.coalesce("tm_stop_departure_dt", "plan_stop_departure_dt"))
        .withColumn("route_id", F.coalesce("route_id", "route_id_tm"))
        .drop("route_id_tm")
    )
    return by_size(cut_lineage(rows, "schedules"), day_trip, common_sequence)


def common_sequence(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Combined schedule rows with their trip's columns, a common sequence and a point type; only valid ones."""
    day_trip = DAY_TRIP
    order = [
        F.col("plan_stop_departure_dt"), F.col("tm_stop_sequence"), F.col("gtfs_stop_sequence"), F.col("stop_id"),
    ]
    by_time = stretch(F.unix_timestamp("plan_stop_departure_dt"), metrics.STATION_SECONDS)

    def fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
        return filled(df, keys, order, by_time, cols, whole)

    pulled = written(fill(rows, day_trip, ["PULLOUT_ID"]), "pullouts", whole)
    inherited = written(fill(pulled, [*day_trip, "PULLOUT_ID"], TRIP_COLUMNS), "trip-columns", whole)
    named = inherited.withColumn(
        "schedule_joined",
        texts.provenance(F.col("gtfs_stop_sequence"), F.col("tm_stop_sequence"), "GTFS", "TM", "JOIN"),
    ).withColumn("plan_stop_departure_sam", local_seconds("plan_stop_departure_dt"))
    ranked = ordered(
        named,
        [*day_trip, "PULLOUT_ID"],
        [F.col("plan_stop_departure_dt"), F.col("tm_stop_sequence"), F.col("gtfs_stop_sequence"), F.col("plan_start_dt")],
        by_time,
        whole,
        stop_sequence=rank(),
    ).withColumn("tm_pullout_id", F.coalesce("PULLOUT_ID", F.lit(NO_PULLOUT)))
    is_timepoint = F.coalesce("checkpoint_id", "timepoint_abbr").isNotNull()
    pointed = metrics.point_type(written(ranked, "ranked", whole), day_trip, "stop_sequence", is_timepoint, whole)
    rules = {
        **V.not_null("trip_id", "stop_id", "route_id", "plan_stop_departure_dt", "service_date"),
        **V.in_range("stop_sequence", low=1),
    }
    unique = ["service_date", "trip_id", "route_id", "stop_sequence", "tm_pullout_id"]
    return V.valid(written(pointed, "points", whole), rules, unique, whole).drop("PULLOUT_ID")


def local_seconds(column: str, date: str = "service_date"):
    """Local seconds after midnight of the service date for a UTC column."""
    return wall_seconds_since(F.col(date), local_wall_clock(F.col(column)))


# Realtime ------------------------------------------------------------------


def rt_events(positions: DataFrame, bus_routes: DataFrame, service_date: str) -> DataFrame:
    """Stop events of one day's bus positions, first stops without a departure left out."""
    usable = filters.bus_positions(positions, bus_routes, service_date).withColumn(
        "service_date", F.to_date("start_date", "yyyyMMdd")
    ).withColumn("vehicle_timestamp", F.timestamp_seconds("timestamp"))
    found = cut_lineage(events.positions_to_events(usable), "bus-events")
    needed = V.not_null("trip_id", "stop_id", "route_id", "vehicle_label", "gtfs_stop_sequence")
    return V.valid(
        found,
        {**needed, **V.first_stop_has_departure()},
        ["service_date", "trip_id", "route_id", "gtfs_stop_sequence", "vehicle_label"],
    )


def static_work_pieces(pieces: DataFrame, blocks: DataFrame, runs: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips of every piece of work: same block and timetable, trip end within the piece."""
    version = "TIME_TABLE_VERSION_ID"
    named = (
        pieces.distinct()
        .join(blocks.distinct(), ["BLOCK_ID", version])
        .join(runs.distinct(), ["RUN_ID", version])
    )
    return joins.interval_join(
        trips.distinct(), named, ["BLOCK_ID", version], "TRIP_END_TIME", "BEGIN_TIME", "END_TIME", 3600
    )


def operator_assignment(
    daily: DataFrame, operators: DataFrame, vehicles: DataFrame, static: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Who drove which vehicle on which trip: daily pieces with operator, vehicle and static piece."""
    date = calendar_date(F.col("CALENDAR_ID"))
    named = (
        daily.filter(F.col("WORK_PIECE_ID").isNotNull())
        .join(operators.withColumnRenamed("OPERATOR_ID", "CURRENT_OPERATOR_ID").distinct(), "CURRENT_OPERATOR_ID", "left")
        .join(vehicles.withColumnRenamed("VEHICLE_ID", "CURRENT_VEHICLE_ID").distinct(), "CURRENT_VEHICLE_ID", "left")
        .join(static, ["WORK_PIECE_ID", "RUN_ID"], "left")
    )
    return named.select(
        *keep,
        date.alias("service_date"),
        F.col("BLOCK_ABBR").cast("string").alias("tm_block_id"),
        F.col("RUN_DESIGNATOR").cast("string").alias("tm_run_id"),
        F.col("TRIP_SERIAL_NUMBER").cast("string").alias("tm_trip_id"),
        F.col("ONBOARD_LOGON_ID").cast("string").alias("operator_badge_number"),
        F.col("PROPERTY_TAG").cast("string").alias("tm_vehicle_label"),
        utc_from_local_seconds(date, F.col("ACTUAL_LOGON_TIME")).alias("logon_time"),
        utc_from_local_seconds(date, F.col("ACTUAL_LOGOFF_TIME")).alias("logoff_time"),
    )


def public_operator_ids(work: DataFrame, seed: str, date: str = "service_date", trip: str = "tm_trip_id") -> DataFrame:
    """A public id per date and trip: the date and a number of five digits or more that no other trip of the date has.

    Trips are numbered in the order of a seeded hash: reproducible, without
    repeats, and telling nothing about the operator.
    """
    digest = F.md5(F.concat(F.lit(seed), F.col(trip)))
    one = work.filter(F.col(trip).isNotNull() & F.col(date).isNotNull()).select(date, trip).distinct()
    block = F.conv(F.substring("_digest", 1, 4), 16, 10).cast("long")
    numbered = ordered(
        one.withColumn("_digest", digest), [date], [block, F.col("_digest"), F.col(trip)], block, _n=row_number()
    )
    return numbered.select(date, trip, texts.dated_id(F.col(date), F.col("_n") + 9999).alias("public_operator_id"))


def join_rt_to_schedule(schedule: DataFrame, gtfs: DataFrame, tm: DataFrame, operators: DataFrame) -> DataFrame:
    """Observed events on the combined schedule.

    Vehicle-log events join by trip, pullout, sequence and vehicle; feed events
    by the matching vehicle of the trip. End stops fall back to the last time
    in transit; rows without any vehicle get a placeholder.
    """
    feed = gtfs.withColumn("trip_id_gtfs", F.col("trip_id")).withColumn(
        "trip_id", texts.strip_trip_suffix(F.col("trip_id"))
    )
    dated = F.concat_ws("|", F.date_format("service_date", "yyyyMMdd"), "trip_id")
    match = joins.trip_vehicle_match(
        schedule.withColumn("trip_id", dated), feed.withColumn("trip_id", dated)
    ).select(
        F.to_date(F.split_part("trip_id", F.lit("|"), F.lit(1)), "yyyyMMdd").alias("service_date"),
        F.split_part("trip_id", F.lit("|"), F.lit(2)).alias("trip_id"),
        "tm_pullout_id",
        "vehicle_label",
        "vehicle_label_gtfs",
    )
    keys = ["service_date", "trip_id", "tm_pullout_id", "vehicle_label"]
    logged = schedule.join(
        tm.select(
            *keys, "tm_stop_sequence", "tm_actual_arrival_dt", "tm_actual_departure_dt",
            "tm_actual_arrival_time_sam", "tm_actual_departure_time_sam",
        ),
        [*keys, "tm_stop_sequence"],
        "left",
    )
    matched = joins.null_safe_join(cut_lineage(logged, "logged"), match, keys, "full")
    feed_columns = [
        "service_date", "trip_id", "gtfs_stop_sequence", "route_id", F.col("vehicle_label").alias("vehicle_label_gtfs"),
        "gtfs_first_in_transit_dt", "gtfs_last_in_transit_dt", "gtfs_arrival_dt", "gtfs_departure_dt", "start_time",
        "start_dt", "latitude", "longitude", "trip_id_gtfs",
    ]
    seen = matched.join(
        feed.select(*feed_columns),
        ["service_date", "gtfs_stop_sequence", "trip_id", "vehicle_label_gtfs", "route_id"],
        "left",
    ).withColumn("vehicle_label", F.coalesce("vehicle_label", "vehicle_label_gtfs", F.lit(NO_PULLOUT)))
    who = operators.select(
        "service_date", F.col("tm_trip_id").alias("trip_id"), F.col("tm_vehicle_label").alias("vehicle_label"), "public_operator_id"
    ).distinct()

    def finished(rows: DataFrame, whole: bool) -> DataFrame:
        counted = with_group_values(
            rows, ["service_date", "trip_id", "tm_pullout_id"], whole, stop_count=F.max("stop_sequence")
        ).withColumn(
            "gtfs_arrival_dt",
            F.coalesce("gtfs_arrival_dt", F.when(F.col("point_type") == "end", F.col("gtfs_last_in_transit_dt"))),
        )
        driven = counted.join(who, ["service_date", "trip_id", "vehicle_label"], "left")
        return checked_bus_events(written(driven, "bus-joined", whole), whole)

    return by_size(cut_lineage(seen, "observed"), DAY_TRIP, finished)


def checked_bus_events(df: DataFrame, whole: bool = False) -> DataFrame:
    """Rows that keep the rules of joined bus events."""
    previous = V.with_previous(
        df, ["service_date", "trip_id", "vehicle_label", "route_id", "tm_pullout_id"], ["stop_sequence"], ["tm_stop_sequence"], whole=whole
    )
    rules = {
        **V.not_null("trip_id", "stop_id", "route_id", "vehicle_label", "tm_pullout_id", "stop_sequence"),
        **V.final_stop_has_arrival(),
        **V.plain_trip_id(),
        **V.not_before_previous("tm_stop_sequence"),
    }
    unique = ["service_date", "trip_id", "route_id", "vehicle_label", "stop_sequence", "tm_pullout_id"]
    return V.valid(written(previous, "bus-previous", whole), rules, unique, whole).drop("_prev_tm_stop_sequence")


def trip_times(bus: DataFrame, whole: bool = False) -> DataFrame:
    """Arrival, departure, travel and stopped time of joined bus events."""
    trip = ["service_date", "tm_pullout_id", "trip_id", "vehicle_label"]
    seq = F.col("stop_sequence")
    block = stretch(seq, metrics.SEQUENCE_BLOCK)
    timed = metrics.observed_times(metrics.full_trip_flag(bus, trip, whole))
    arrival, departure = F.col("stop_arrival_dt"), F.col("stop_departure_dt")
    scanned = ordered(
        written(timed, "bus-times", whole),
        trip,
        [seq],
        block,
        whole,
        _floor=max_before(F.greatest(departure, arrival, F.col("gtfs_last_in_transit_dt"))),
        previous_stop_id=lag(F.col("stop_id")),
    )
    for c in ("stop_departure_dt", "stop_arrival_dt"):
        scanned = scanned.withColumn(c, F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.col("_floor"))))
    clamped = written(
        scanned.drop("_floor")
        .withColumn("gtfs_first_in_transit_seconds", local_seconds("gtfs_first_in_transit_dt"))
        .withColumn("stop_arrival_seconds", local_seconds("stop_arrival_dt"))
        .withColumn("stop_departure_seconds", local_seconds("stop_departure_dt"))
        .withColumn("plan_stop_departure_seconds", local_seconds("plan_stop_departure_dt")),
        "bus-clamped",
        whole,
    )
    along = ordered(
        clamped,
        trip,
        [seq],
        block,
        whole,
        _left=last_before(F.coalesce(departure, arrival)),
        _prev_stop_arrival_dt=lag(arrival),
        _prev_stop_departure_dt=lag(departure),
    )
    return (
        along.withColumn(
            "travel_time_seconds",
            F.unix_timestamp(F.coalesce(arrival, departure)) - F.unix_timestamp("_left"),
        )
        .withColumn("stopped_duration_seconds", F.col("stop_departure_seconds") - F.col("stop_arrival_seconds"))
        .drop("_left")
    )


def derived_metrics(bus: DataFrame) -> DataFrame:
    """Arrival, departure, travel, stopped time and headways of joined bus events."""
    travelled = by_size(bus, DAY_TRIP, trip_times)
    at = F.coalesce("stop_departure_seconds", "stop_arrival_seconds", "plan_stop_departure_seconds")
    tie = ("trip_id", "vehicle_label", "tm_pullout_id", "stop_sequence")

    def between(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return by_size(rows, keys, lambda own, whole: metrics.headway(own, keys, at, name, tie, whole=whole))

    by_route = between(
        cut_lineage(travelled, "bus-travel"),
        ["service_date", "stop_id", "direction_id", "route_id"],
        "imputed_route_direction_headway_seconds",
    )
    both = between(
        cut_lineage(by_route, "bus-route-headways"),
        ["service_date", "stop_id", "direction_destination"],
        "imputed_direction_destination_headway_seconds",
    )
    return by_size(cut_lineage(both, "bus-headways"), DAY_TRIP, kept_metrics)


def kept_metrics(both: DataFrame, whole: bool = False) -> DataFrame:
    """Rows that keep the rules of measured bus events."""
    totalled = V.with_trip_total(
        both,
        ["service_date", "trip_id", "vehicle_label"],
        lambda later, earlier: F.unix_timestamp(later) - F.unix_timestamp(earlier),
        whole,
    )
    rules = {
        **V.departure_after_arrival(),
        **V.not_before_previous("stop_arrival_dt", "stop_departure_dt"),
        **V.in_range("imputed_route_direction_headway_seconds", low=0),
        **V.in_range("imputed_direction_destination_headway_seconds", low=0),
        **V.trip_total(),
    }
    return V.valid(totalled, rules).drop("_total_ok", "_prev_stop_arrival_dt", "_prev_stop_departure_dt")


def bus_performance(
    service_date: int,
    archive: dict[str, DataFrame],
    positions: DataFrame,
    crossings: DataFrame,
    dims: dict[str, DataFrame],
    work: DataFrame,
) -> DataFrame:
    """The whole bus day: schedules, events, join, measures."""
    gtfs = cut_lineage(gtfs_schedule(archive, service_date), "gtfs")
    tm = cut_lineage(av_schedule(crossings, dims), "tm")
    schedule = cut_lineage(combined_schedule(gtfs, tm), "combined")
    routes = calendar.as_of(archive["routes"], service_date).filter(F.col("route_type") == 3)
    seen = cut_lineage(rt_events(positions, routes, str(service_date)), "rt")
    logged = cut_lineage(av_events(crossings, tm), "av-events")
    return derived_metrics(cut_lineage(join_rt_to_schedule(schedule, seen, logged, work), "bus"))
