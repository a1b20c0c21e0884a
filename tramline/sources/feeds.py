"""Realtime feed documents: declared schemas, reading, splitting into rows.

A feed file is one JSON document with a header and a list of entities. Files
are small and many, so Spark spreads them over tasks; a damaged file becomes a
row in the error set, not a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.nested import explode_keep_null, flatten_structs, quoted
from tramline.functions.times import clock_seconds

# Message layouts, as DDL.
_TRIP = (
    "trip_id string, route_id string, direction_id int, start_time string, start_date string, schedule_relationship string, "
    "route_pattern_id string, tm_trip_id string, overload_id long, overload_offset long, revenue boolean, last_trip boolean"
)
_VEHICLE = "id string, label string, license_plate string, consist array<struct<label string>>, assignment_status string"
_POSITION = "bearing int, latitude double, longitude double, speed double, odometer double"
_STOP_EVENT = "delay int, time long, uncertainty int"
_STOP_UPDATE = (
    f"stop_sequence long, stop_id string, arrival struct<{_STOP_EVENT}>, departure struct<{_STOP_EVENT}>, schedule_relationship string"
)
_CARRIAGE = "id string, label string, occupancy_status string, occupancy_percentage int, carriage_sequence long"
POSITIONS_ENTITY = (
    f"id string, vehicle struct<trip struct<{_TRIP}>, vehicle struct<{_VEHICLE}>, position struct<{_POSITION}>, "
    "current_stop_sequence long, stop_id string, timestamp long, occupancy_status string, occupancy_percentage long, "
    f"current_status string, congestion_level string, multi_carriage_details array<struct<{_CARRIAGE}>>>"
)
UPDATES_ENTITY = (
    f"id string, trip_update struct<trip struct<{_TRIP}>, vehicle struct<{_VEHICLE}>, "
    f"stop_time_update array<struct<{_STOP_UPDATE}, boarding_status string>>, "
    "trip_properties struct<trip_headsign string>, timestamp long, delay int>"
)
BUS_POSITIONS_ENTITY = (
    f"id string, is_deleted boolean, vehicle struct<position struct<{_POSITION}>, location_source string, timestamp long, "
    f"trip struct<{_TRIP}>, vehicle struct<{_VEHICLE}>, "
    "operator struct<id string, first_name string, last_name string, name string, logon_time long>, block_id string, "
    "run_id string, stop_id string, current_stop_sequence long, revenue boolean, current_status string, load int, capacity int, "
    "occupancy_percentage int, occupancy_status string, state_of_charge_percentage int, state_of_charge_timestamp long>"
)
BUS_UPDATES_ENTITY = (
    f"id string, trip_update struct<timestamp long, delay int, trip struct<{_TRIP}>, vehicle struct<{_VEHICLE}>, "
    f"stop_time_update array<struct<{_STOP_UPDATE}, cause_id int, cause_description string, remark string>>>"
)
_TEXT = "struct<translation array<struct<text string, language string>>>"
_ALERT_TAIL = (
    "severity_level string, severity int, alert_lifecycle string, duration_certainty string, "
    f"header_text {_TEXT}, description_text {_TEXT}, service_effect_text {_TEXT}, timeframe_text {_TEXT}, recurrence_text {_TEXT}, "
    "created_timestamp long, last_modified_timestamp long, last_push_notification_timestamp long, closed_timestamp long, "
    "active_period array<struct<start long, end long>>, "
    "informed_entity array<struct<route_id string, route_type int, direction_id int, stop_id string, facility_id string, activities array<string>>>"
)
ALERTS_ENTITY = f"id string, alert struct<cause string, cause_detail string, effect string, effect_detail string, {_ALERT_TAIL}>"
# second layout: the two details are translated texts
ALERTS_ENTITY_TRANSLATED = (
    f"id string, alert struct<cause string, cause_detail {_TEXT}, effect string, effect_detail {_TEXT}, {_ALERT_TAIL}>"
)
# what the stored feed keeps of an alert beyond the published table
_STORED_ENTITY = (
    f"agency_id string, route_id string, route_type int, direction_id int, trip struct<{_TRIP}>, stop_id string, "
    "facility_id string, activities array<string>"
)
ALERTS_STORED_ENTITY = ALERTS_ENTITY[:-1].replace(
    "struct<route_id string, route_type int, direction_id int, stop_id string, facility_id string, activities array<string>>",
    f"struct<{_STORED_ENTITY}>",
) + f", url {_TEXT}, short_header_text {_TEXT}, reminder_times array<long>>"


@dataclass(frozen=True)
class Feed:
    """How a feed's documents become rows: layout, the column its files are sorted by, a list with a row for each item."""

    entity: str
    sort: str
    repeated: str | None = None


_POSITIONS = Feed(POSITIONS_ENTITY, "vehicle.trip.route_id")
_UPDATES = Feed(UPDATES_ENTITY, "trip_update.trip.route_id", "trip_update.stop_time_update")
FEEDS = {
    "RT_VEHICLE_POSITIONS": _POSITIONS,
    "RT_TRIP_UPDATES": _UPDATES,
    "RT_ALERTS": Feed(ALERTS_STORED_ENTITY, "alert.cause"),
    "BUS_VEHICLE_POSITIONS": Feed(BUS_POSITIONS_ENTITY, "vehicle.trip.route_id"),
    "BUS_TRIP_UPDATES": Feed(BUS_UPDATES_ENTITY, "trip_update.trip.route_id", "trip_update.stop_time_update"),
    "DEV_GREEN_RT_TRIP_UPDATES": _UPDATES,
    "DEV_GREEN_RT_VEHICLE_POSITIONS": _POSITIONS,
}

# The analyses' columns, the stored columns they come from, and their types.
_VEHICLE_COLUMNS = (
    ("current_status", "vehicle.current_status", "string"),
    ("stop_id", "vehicle.stop_id", "string"),
    ("direction_id", "vehicle.trip.direction_id", "long"),
    ("route_id", "vehicle.trip.route_id", "string"),
    ("start_date", "vehicle.trip.start_date", "string"),
    ("start_time", "vehicle.trip.start_time", "string"),
    ("revenue", "vehicle.trip.revenue", "boolean"),
    ("vehicle_id", "vehicle.vehicle.id", "string"),
    ("trip_id", "vehicle.trip.trip_id", "string"),
    ("vehicle_label", "vehicle.vehicle.label", "string"),
)
RAIL_POSITION_COLUMNS = (
    *_VEHICLE_COLUMNS,
    ("current_stop_sequence", "vehicle.current_stop_sequence", "long"),
    ("vehicle_timestamp", "vehicle.timestamp", "long"),
    ("vehicle_consist", "vehicle.vehicle.consist", "array<struct<label string>>"),
    ("multi_carriage_details", "vehicle.multi_carriage_details", f"array<struct<{_CARRIAGE}>>"),
)
BUS_POSITION_COLUMNS = (
    *_VEHICLE_COLUMNS,
    ("stop_sequence", "vehicle.current_stop_sequence", "long"),
    ("timestamp", "vehicle.timestamp", "long"),
    ("latitude", "vehicle.position.latitude", "double"),
    ("longitude", "vehicle.position.longitude", "double"),
)
PREDICTION_COLUMNS = (
    ("timestamp", "trip_update.timestamp", "long"),
    ("stop_id", "trip_update.stop_time_update.stop_id", "string"),
    ("tu_stop_timestamp", "trip_update.stop_time_update.arrival.time", "long"),
    ("direction_id", "trip_update.trip.direction_id", "long"),
    ("route_id", "trip_update.trip.route_id", "string"),
    ("service_date", "trip_update.trip.start_date", "long"),
    ("start_time", "trip_update.trip.start_time", "string"),
    ("vehicle_id", "trip_update.vehicle.id", "string"),
    ("trip_id", "trip_update.trip.trip_id", "string"),
    ("feed_timestamp", "feed_timestamp", "long"),
)


def analysis_columns(stored: DataFrame, columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows of a stored feed under the analyses' names and types; columns that older files lack are null."""
    known = set(stored.columns)
    return stored.select(
        *[(F.col(quoted(source)) if source in known else F.lit(None)).cast(kind).alias(name) for name, source, kind in columns]
    )


def rail_position_rows(stored: DataFrame) -> DataFrame:
    """Stored vehicle positions as ``plans.rail.position_events`` takes them."""
    return analysis_columns(stored, RAIL_POSITION_COLUMNS)


def bus_position_rows(stored: DataFrame) -> DataFrame:
    """Stored bus positions as ``plans.bus.rt_events`` takes them."""
    return analysis_columns(stored, BUS_POSITION_COLUMNS)


def prediction_rows(stored: DataFrame) -> DataFrame:
    """Stored trip updates as ``plans.rail.prediction_events`` takes them; without a time of their own, the feed's."""
    rows = analysis_columns(stored, PREDICTION_COLUMNS)
    return rows.withColumns(
        {"timestamp": F.coalesce("timestamp", "feed_timestamp"), "start_time": clock_seconds(F.col("start_time"))}
    )


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def document_schema(entity: str) -> str:
    return f"header struct<timestamp long>, entity array<struct<{_colons(entity)}>>"


def _colons(ddl: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in struct(ddl).fields)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed files as (path, document text); ``.gz`` is opened by its name."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("document")
    )


def parse_documents(documents: DataFrame, entity: str) -> DataFrame:
    """Parse document text; damaged ones, or ones without a timestamp, have a null ``message``."""
    message = F.from_json("document", document_schema(entity), {"mode": "PERMISSIVE"})
    return documents.select(
        *[c for c in documents.columns if c != "document"],
        message.alias("message"),
    )


def damaged(parsed: DataFrame) -> DataFrame:
    """Documents that could not be used."""
    return parsed.filter(F.col("message.header.timestamp").isNull()).drop("message")


def entity_rows(parsed: DataFrame) -> DataFrame:
    """One row per entity with feed_timestamp and its UTC year, month and day."""
    ts = F.col("message.header.timestamp")
    usable = parsed.filter(ts.isNotNull())
    at = F.timestamp_seconds("feed_timestamp")
    return (
        usable.select(ts.alias("feed_timestamp"), F.explode("message.entity").alias("entity"))
        .select("entity.*", "feed_timestamp")
        .select("*", F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"))
    )


def flat_rows(rows: DataFrame, feed: str) -> DataFrame:
    """Entities of a feed with dotted leaf columns, one row per item of the feed's list if it has one."""
    flat, repeated = flatten_structs(rows), FEEDS[feed].repeated
    return flatten_structs(explode_keep_null(flat, repeated)) if repeated else flat


def flat_positions(rows: DataFrame) -> DataFrame:
    """Vehicle positions with dotted leaf columns."""
    return flatten_structs(rows)


def flat_updates(rows: DataFrame) -> DataFrame:
    """Trip updates with one row per predicted stop, dotted leaf columns."""
    return flatten_structs(explode_keep_null(flatten_structs(rows), "trip_update.stop_time_update"))


def parse_alerts(documents: DataFrame, document: str = "document") -> DataFrame:
    """Alert entities by whichever of the two layouts fits.

    ``cause_detail``/``effect_detail`` stay plain text; the translated layout
    adds ``cause_detail_translation``/``effect_detail_translation``.
    """
    plain = F.from_json(document, document_schema(ALERTS_ENTITY))
    translated = F.from_json(document, document_schema(ALERTS_ENTITY_TRANSLATED))
    parsed = documents.select(plain.alias("p"), translated.alias("t")).filter(
        F.coalesce("p.header.timestamp", "t.header.timestamp").isNotNull()
    )
    pairs = parsed.select(
        F.coalesce("p.header.timestamp", "t.header.timestamp").alias("feed_timestamp"),
        F.explode(F.arrays_zip(F.col("p.entity").alias("p"), F.col("t.entity").alias("t"))).alias("e"),
    )
    fields = [f.name for f in struct(ALERTS_ENTITY).fields[1].dataType.fields]

    def field(name: str) -> Column:
        if name in ("cause_detail", "effect_detail"):
            # a JSON object read as text is not the plain form
            value = F.col("e.p.alert").getField(name)
            return F.when(~value.startswith("{"), value).alias(name)
        return F.coalesce(F.col("e.p.alert").getField(name), F.col("e.t.alert").getField(name)).alias(name)

    return pairs.select(
        F.coalesce(F.col("e.p.id"), F.col("e.t.id")).try_cast("long").alias("id"),
        *[field(n) for n in fields],
        F.col("e.t.alert.cause_detail.translation").alias("cause_detail_translation"),
        F.col("e.t.alert.effect_detail.translation").alias("effect_detail_translation"),
        "feed_timestamp",
    )
