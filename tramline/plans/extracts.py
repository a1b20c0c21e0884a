"""Published extracts: which rows, over how many days, in which columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.times import local_from_epoch, local_wall_clock
from tramline.operators import filters
from tramline.operators.groups import with_group_values
from tramline.sinks.tables import extract, rolling_window, signed_and_zoneless
from tramline.sources.feeds import struct

POSITION_COLUMNS = (
    "id string, trip_id string, route_id string, direction_id int, start_time string, start_date string, revenue boolean, "
    "vehicle_id string, vehicle_label string, timestamp timestamp, feed_timestamp timestamp, stop_id string, last_trip boolean, "
    "schedule_relationship string, bearing int, latitude double, longitude double, speed double, current_stop_sequence long, "
    "occupancy_status string, occupancy_percentage long, current_status string"
)
TERMINAL_POSITION_COLUMNS = (
    "id string, route_id string, direction_id int, start_time string, start_date string, vehicle_id string, vehicle_label string, "
    "timestamp timestamp, stop_id string, trip_id string, revenue boolean, feed_timestamp timestamp"
)
UPDATE_COLUMNS = (
    "id string, trip_id string, route_id string, direction_id int, start_time string, start_date string, schedule_relationship string, "
    "revenue boolean, vehicle_id string, vehicle_label string, timestamp timestamp, feed_timestamp timestamp, stop_id string, "
    "departure_time timestamp, departure_uncertainty int, stop_schedule_relationship string, boarding_status string, "
    "feed_timestamp_first_prediction timestamp, feed_timestamp_last_prediction timestamp"
)


def prediction_validity(updates: DataFrame) -> DataFrame:
    """First and last feed time that carried the same prediction of a trip."""
    return with_group_values(
        updates,
        ["trip_id", "timestamp", "departure_time"],
        feed_timestamp_first_prediction=F.min("feed_timestamp"),
        feed_timestamp_last_prediction=F.max("feed_timestamp"),
    )


def local_clocks(df: DataFrame, columns) -> DataFrame:
    """Epoch columns as local wall clocks."""
    return df.withColumns({c: local_from_epoch(F.col(c)) for c in columns if c in df.columns})


_POSITION_CLOCKS = ("timestamp", "feed_timestamp")
_UPDATE_CLOCKS = (
    "departure_time", "arrival_time", "timestamp", "feed_timestamp", "feed_timestamp_first_prediction", "feed_timestamp_last_prediction",
)


def light_rail_terminal_positions(df: DataFrame) -> DataFrame:
    stops = filters.LIGHT_RAIL_NEXT_TO_TERMINALS + filters.LIGHT_RAIL_TERMINALS
    return local_clocks(filters.terminal_positions(df, stops), _POSITION_CLOCKS)


def heavy_rail_terminal_positions(df: DataFrame) -> DataFrame:
    near = df.filter(F.col("timestamp").isNotNull() & F.col("stop_id").isin(*filters.HEAVY_RAIL_NEXT_TO_TERMINALS))
    return local_clocks(near, _POSITION_CLOCKS)


def all_positions(df: DataFrame) -> DataFrame:
    return local_clocks(df, _POSITION_CLOCKS)


def light_rail_terminal_updates(df: DataFrame) -> DataFrame:
    at_terminals = df.filter(F.col("stop_id").isin(*filters.LIGHT_RAIL_TERMINALS))
    return local_clocks(prediction_validity(at_terminals), _UPDATE_CLOCKS)


def heavy_rail_terminal_updates(df: DataFrame) -> DataFrame:
    at_terminals = df.filter(
        F.col("departure_time").isNotNull() & F.col("stop_id").isin(*filters.HEAVY_RAIL_TERMINALS)
    )
    return local_clocks(at_terminals, _UPDATE_CLOCKS)


def usable_light_rail_updates(df: DataFrame) -> DataFrame:
    kept = filters.terminal_predictions(df, filters.LIGHT_RAIL_TERMINALS)
    return local_clocks(prediction_validity(kept), _UPDATE_CLOCKS)


def usable_heavy_rail_updates(df: DataFrame) -> DataFrame:
    kept = filters.terminal_predictions(df, filters.HEAVY_RAIL_TERMINALS)
    return local_clocks(prediction_validity(kept), _UPDATE_CLOCKS)


# The bus table's instants, published as local clocks, and seconds after midnight made of them.
_BUS_CLOCKS = (
    "stop_arrival_dt", "stop_departure_dt", "gtfs_first_in_transit_dt", "gtfs_last_in_transit_dt", "tm_actual_arrival_dt",
    "tm_actual_departure_dt", "gtfs_departure_dt", "gtfs_arrival_dt", "plan_start_dt", "plan_stop_departure_dt",
)
_BUS_SECONDS = {
    "gtfs_first_in_transit_seconds": "gtfs_first_in_transit_dt",
    "stop_arrival_seconds": "stop_arrival_dt",
    "stop_departure_seconds": "stop_departure_dt",
}


def bus_metrics(df: DataFrame) -> DataFrame:
    """Bus events as published: instants as local clocks, seconds counted from the service date's local midnight."""
    local = df.withColumns({c: local_wall_clock(F.col(c)) for c in _BUS_CLOCKS if c in df.columns})
    midnight = F.unix_timestamp(F.to_date("service_date").cast("timestamp"))
    return local.withColumns(
        {s: F.unix_timestamp(F.col(c).cast("timestamp")) - midnight for s, c in _BUS_SECONDS.items() if c in df.columns}
    )


def bus_metrics_schema(stored: T.StructType) -> T.StructType:
    """The stored columns in types without zones, and the seconds where their instants are stored."""
    names = set(stored.fieldNames())
    more = [T.StructField(s, T.LongType()) for s, c in _BUS_SECONDS.items() if c in names and s not in names]
    return signed_and_zoneless(T.StructType([*stored.fields, *more]))


# Texts of event-bus tables that are published as local clocks, and as dates.
RECORD_CLOCKS = {
    "trip_updates": ("data_metadata_inputTimestamp",),
    "operator_sign_ins": ("data_metadata_inputTimestamp", "data_signedInAt"),
}
RECORD_DATES = {
    "trip_updates": ("data_tripUpdates_previousTripKey_serviceDate", "data_tripUpdates_tripKey_serviceDate"),
    "operator_sign_ins": (),
}


def event_bus_extract(table: DataFrame, kind: str) -> DataFrame:
    """An event-bus table as published: UTC texts and the record's time as local clocks, date texts as dates.

    Texts that do not parse become null; the row stays.
    """

    def clock(utc):
        return local_wall_clock(utc).cast("timestamp_ntz")

    parsed = {c: clock(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))) for c in RECORD_CLOCKS[kind]}
    parsed |= {c: F.try_to_date(c, "yyyy-MM-dd") for c in RECORD_DATES[kind]}
    return table.withColumns({**parsed, "time": clock(F.col("time"))})


@dataclass(frozen=True)
class Extract:
    """One published extract over a day-partitioned table."""

    source: str
    days: int | None
    columns: str | None
    convert: object = None
    routes: str | None = None
    span: tuple[str, str] | None = None


EXTRACTS: dict[str, Extract] = {
    "vehicle_positions_light_rail_terminals_60_day": Extract("RT_VEHICLE_POSITIONS", 60, TERMINAL_POSITION_COLUMNS, light_rail_terminal_positions, "light_rail"),
    "trip_updates_light_rail_terminals_60_day": Extract("TERMINAL_PREDICTIONS_TRIP_UPDATES", 60, UPDATE_COLUMNS, light_rail_terminal_updates, "light_rail"),
    "vehicle_positions_heavy_rail_terminals_60_day": Extract("RT_VEHICLE_POSITIONS", 60, POSITION_COLUMNS, heavy_rail_terminal_positions, "heavy_rail"),
    "trip_updates_heavy_rail_terminals_30_day": Extract("TERMINAL_PREDICTIONS_TRIP_UPDATES", 30, UPDATE_COLUMNS, heavy_rail_terminal_updates, "heavy_rail"),
    "vehicle_positions_light_rail_7_day": Extract("RT_VEHICLE_POSITIONS", 7, POSITION_COLUMNS, all_positions, "light_rail"),
    "dev_green_vehicle_positions_light_rail_terminals_60_day": Extract("DEV_GREEN_RT_VEHICLE_POSITIONS", 60, TERMINAL_POSITION_COLUMNS, light_rail_terminal_positions, "light_rail"),
    "dev_green_trip_updates_light_rail_terminals_60_day": Extract("DEV_GREEN_RT_TRIP_UPDATES", 60, UPDATE_COLUMNS, usable_light_rail_updates, "light_rail"),
    "dev_green_vehicle_positions_heavy_rail_terminals_60_day": Extract("DEV_GREEN_RT_VEHICLE_POSITIONS", 60, POSITION_COLUMNS, heavy_rail_terminal_positions, "heavy_rail"),
    "dev_green_trip_updates_heavy_rail_terminals_60_day": Extract("DEV_GREEN_RT_TRIP_UPDATES", 60, UPDATE_COLUMNS, usable_heavy_rail_updates, "heavy_rail"),
    "bus_operator_map_7_day": Extract("BUS_OPERATOR_MAP", 7, None),
    "bus_operator_map_60_day": Extract("BUS_OPERATOR_MAP", 60, None),
    "bus_metrics_7_day": Extract("BUS_EVENTS", 7, None, bus_metrics),
    "bus_metrics_all": Extract("BUS_EVENTS", None, None, bus_metrics),
    "bus_metrics_fall_2025": Extract("BUS_EVENTS", None, None, bus_metrics, span=("2025-08-24", "2025-12-13")),
    "bus_operator_map_fall_2025": Extract("BUS_OPERATOR_MAP", None, None, span=("2025-08-24", "2025-12-13")),
}


def run_extract(name: str, table: DataFrame, date: str = "service_date") -> DataFrame:
    """The rows of a named extract from its source table (``date`` is its day column)."""
    spec = EXTRACTS[name]
    where = filters.route_filters(F.col("route_id"))[spec.routes] if spec.routes else None
    schema = struct(spec.columns) if spec.columns else table.schema
    if spec.convert is bus_metrics:
        schema = bus_metrics_schema(table.schema)
    if spec.span:
        first, last = (F.lit(d).cast("date") for d in spec.span)
        table = table.filter(F.col(date).between(first, last))
    if spec.days:
        return rolling_window(table, date, spec.days, schema, where, spec.convert)
    return extract(table, schema, where, spec.convert)
