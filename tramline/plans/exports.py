"""Exports of the rail tables: columns and types of each, and how a stored export grows.

Events and trips are replaced from the day before the newest exported one on. Schedule tables only ever gain versions,
so an update adds the folders of newer versions and opens no other.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.times import int_date, local_from_epoch
from tramline.sinks.versions import DatedTable
from tramline.sources.tables import conform

VERSION = "static_version_key"


@dataclass(frozen=True)
class Export:
    """Columns of one export; ``dates`` maps its date columns to ``YYYYMMDD`` columns, ``clocks`` are epochs."""

    columns: str
    dates: dict[str, str] = field(default_factory=dict)
    clocks: tuple[str, ...] = ()
    by: str = VERSION
    whole: bool = False  # a newer version renews all versions

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# Columns of the exports, by table.
EXPORTS: dict[str, Export] = {
    "vehicle_events": Export(
        "pm_event_id long, service_date date, pm_trip_id long, stop_id string, stop_sequence smallint, canonical_stop_sequence smallint, "
        "sync_stop_sequence smallint, parent_station string, previous_trip_stop_pm_event_id long, next_trip_stop_pm_event_id long, "
        "vp_move_timestamp timestamp_ntz, vp_stop_timestamp timestamp_ntz, tu_stop_timestamp timestamp_ntz, travel_time_seconds int, "
        "dwell_time_seconds int, headway_trunk_seconds int, headway_branch_seconds int, updated_on timestamp_ntz",
        {"service_date": "service_date"},
        ("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp"),
        by="service_date",
    ),
    "vehicle_trips": Export(
        "pm_trip_id long, direction_id boolean, route_id string, branch_route_id string, trunk_route_id string, service_date date, "
        "start_time long, vehicle_id string, stop_count smallint, trip_id string, vehicle_label string, vehicle_consist string, "
        "direction string, direction_destination string, revenue boolean, static_trip_id_guess string, static_start_time long, "
        "static_stop_count smallint, first_last_station_match boolean, static_version_key long, updated_on timestamp_ntz",
        {"service_date": "service_date"},
        by="service_date",
    ),
    "service_id_by_date_and_route": Export(
        "route_id string, service_id string, service_date long, service_date_calc date, static_version_key long",
        {"service_date_calc": "service_date"},
        whole=True,
    ),
    "static_trips": Export(
        "pk_id long, route_id string, branch_route_id string, trunk_route_id string, service_id string, trip_id string, "
        "direction_id tinyint, block_id string, static_version_key long",
    ),
    "static_stops": Export(
        "pk_id long, stop_id string, stop_name string, stop_desc string, platform_code string, platform_name string, "
        "parent_station string, static_version_key long",
    ),
    "static_calendar": Export(
        "pk_id long, service_id string, monday boolean, tuesday boolean, wednesday boolean, thursday boolean, friday boolean, "
        "saturday boolean, sunday boolean, start_date date, end_date date, static_version_key long",
        {"start_date": "start_date", "end_date": "end_date"},
    ),
    "static_calendar_dates": Export(
        "pk_id long, service_id string, date long, calendar_date date, exception_type tinyint, holiday_name string, "
        "static_version_key long",
        {"calendar_date": "date"},
    ),
    "static_routes": Export(
        "pk_id long, route_id string, agency_id tinyint, route_short_name string, route_long_name string, route_desc string, "
        "route_type tinyint, route_sort_order int, route_fare_class string, line_id string, static_version_key long",
    ),
    "static_feed_info": Export(
        "pk_id long, feed_start_date date, feed_end_date date, feed_version string, feed_active_date date, static_version_key long",
        {"feed_start_date": "feed_start_date", "feed_end_date": "feed_end_date", "feed_active_date": "feed_active_date"},
    ),
    "static_stop_times": Export(
        "pk_id long, trip_id string, arrival_time int, departure_time int, schedule_travel_time_seconds int, "
        "schedule_headway_trunk_seconds int, schedule_headway_branch_seconds int, stop_id string, stop_sequence smallint, "
        "static_version_key long",
    ),
}


def events_of_trips(events: DataFrame, trips: DataFrame) -> DataFrame:
    """Events whose trip is known, on the trip's service date (``pm_trip_id`` names one trip)."""
    return events.drop("service_date").join(trips.select("pm_trip_id", "service_date"), "pm_trip_id")


def export(name: str, table: DataFrame) -> DataFrame:
    """A table in the columns and types of its export: dates for numbers, local clocks for epochs, absent columns null."""
    spec = EXPORTS[name]
    changed = {new: int_date(F.col(old)) for new, old in spec.dates.items() if old in table.columns}
    changed |= {c: local_from_epoch(F.col(c)) for c in spec.clocks if c in table.columns}
    return conform(table.withColumns(changed), spec.schema)


def stored(spark: SparkSession, name: str, path: str) -> DatedTable:
    """The stored export: a folder for each service date, or for each schedule version."""
    spec = EXPORTS[name]
    return DatedTable(spark, path, spec.schema, spec.by)


def update(spark: SparkSession, name: str, table: DataFrame, path: str) -> list[str]:
    """Bring a stored export up to its table; the dates or versions written, none where nothing is new."""
    spec, kept = EXPORTS[name], stored(spark, name, path)
    rows = export(name, table)
    if spec.by != VERSION:
        return kept.replace_recent(rows)
    versions = [int(v) for v in kept.parts() if v.isdigit()]
    newer = rows.filter(F.col(VERSION) > max(versions)) if versions else rows
    if not versions or not spec.whole:
        return [] if newer.isEmpty() else kept.write(newer, kept.next_number())
    if newer.isEmpty():
        return []
    gone = set(kept.parts()) - set(kept.dates(rows))
    return kept.write(rows, kept.next_number(), sorted(gone))
