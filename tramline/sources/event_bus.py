"""Event-bus records: four payload kinds told apart by their distinguishing key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.nested import explode_keep_null, flatten_structs, underscore_names
from tramline.operators import validate as V

# Payload layouts, as DDL.
_LOCATION = "struct<gtfsId string, todsId string>"
_USER = "struct<emailAddress string, badgeNumber string>"
_METADATA = f"struct<location {_LOCATION}, author {_USER}, inputType string, inputTimestamp string, uiVersion string>"
_TRIP_KEY = (
    f"struct<serviceDate string, tripId string, startLocation {_LOCATION}, endLocation {_LOCATION}, "
    "startTime string, endTime string, revenue string, glidesId string>"
)
PAYLOADS = {
    "editor_changes": f"metadata {_METADATA}, changes array<struct<type string, location {_LOCATION}, editor {_USER}>>",
    "operator_sign_ins": f"metadata {_METADATA}, operator struct<badgeNumber string>, signedInAt string, signature struct<type string, version int>",
    # cars, dropped and scheduled are of uneven shape: kept as JSON text
    "trip_updates": (
        f"metadata {_METADATA}, tripUpdates array<struct<previousTripKey {_TRIP_KEY}, type string, tripKey {_TRIP_KEY}, "
        f"comment string, startLocation {_LOCATION}, endLocation {_LOCATION}, startTime string, endTime string, "
        "automaticStartTime string, automaticEndTime string, cars string, revenue string, dropped string, scheduled string>>"
    ),
    "vehicle_trip_assignment": "vehicleId string, tripKey struct<serviceDate string, tripId string, scheduled string>, revenue string",
}
# the key in ``data`` that only this kind has; the first match wins
DISTINGUISHING = (
    ("changes", "editor_changes"),
    ("operator", "operator_sign_ins"),
    ("tripUpdates", "trip_updates"),
    ("tripKey", "vehicle_trip_assignment"),
)
LISTS = {"editor_changes": "data.changes", "trip_updates": "data.tripUpdates"}

ENVELOPE = "id string, type string, time string, source string, specversion string, dataschema string, data string"


def route_records(records: DataFrame, column: str = "value") -> DataFrame:
    """JSON text -> envelope columns, ``data`` as text, and the payload ``kind`` (``unknown`` if none fits)."""
    parsed = records.select(F.from_json(column, ENVELOPE).alias("_r")).select("_r.*")
    keys = F.json_object_keys("data")
    kind = None
    for key, name in DISTINGUISHING:
        has = F.array_contains(keys, key)
        kind = F.when(has, name) if kind is None else kind.when(has, name)
    return parsed.withColumn("time", F.try_to_timestamp("time")).withColumn(
        "kind", F.coalesce(kind, F.lit("unknown"))
    )


def typed_table(routed: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind, flattened: structs apart, one row per list item, underscore names."""
    rows = routed.filter(F.col("kind") == kind).drop("kind")
    table = flatten_structs(rows.withColumn("data", F.from_json("data", PAYLOADS[kind])))
    if kind in LISTS:
        table = flatten_structs(explode_keep_null(table, LISTS[kind]))
    return underscore_names(table)


def rules(kind: str) -> V.Rules:
    """Patterns and mandatory columns of each typed table."""
    common = V.not_null("id", "type", "time", "source", "specversion")
    if kind == "editor_changes":
        return {**common, **V.matches("data_changes_type", V.CHANGE_PATTERN)}
    if kind == "operator_sign_ins":
        return {**common, **V.not_null("data_operator_badgeNumber"), **V.matches("data_signedInAt", V.DATETIME_PATTERN)}
    if kind == "trip_updates":
        return {
            **common,
            **V.matches("data_tripUpdates_tripKey_serviceDate", V.DATE_PATTERN),
            **V.matches("data_tripUpdates_tripKey_startTime", V.CLOCK_PATTERN),
        }
    return {
        **common,
        **V.not_null("data_vehicleId"),
        **V.matches("data_tripKey_serviceDate", V.DATE_PATTERN),
        **V.matches("data_revenue", V.REVENUE_PATTERN),
    }
