"""Named predicates over realtime feeds and the schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Routes and terminal stops of the published extracts.
GREEN_ROUTES = ("Green-B", "Green-C", "Green-D", "Green-E")
LIGHT_RAIL_ROUTES = (*GREEN_ROUTES, "Mattapan")
HEAVY_RAIL_ROUTES = ("Orange", "Red", "Blue")
SUBWAY_ROUTES = (*HEAVY_RAIL_ROUTES, *LIGHT_RAIL_ROUTES)

LIGHT_RAIL_TERMINALS = (
    "70106", "70160", "70161", "70238", "70276", "70503", "70504", "70511", "70512",
    "Union Square-01", "Union Square-02",
)
LIGHT_RAIL_NEXT_TO_TERMINALS = ("70110", "70162", "70236", "70274", "70502", "70510")
HEAVY_RAIL_TERMINALS = (
    "70001", "Forest Hills-01", "Forest Hills-02",
    "70036", "Oak Grove-01", "Oak Grove-02",
    "70038",
    "70059",
    "70061", "Alewife-01", "Alewife-02",
    "70094",
    "70105", "Braintree-01", "Braintree-02",
)
HEAVY_RAIL_NEXT_TO_TERMINALS = ("70003", "70034", "70040", "70057", "70063", "70092", "70104")


def route_filters(route: Column) -> dict[str, Column]:
    """Predicates by line and by mode."""
    filters = {name.lower().replace("-", "_"): route == name for name in SUBWAY_ROUTES}
    filters["green"] = route.isin(*GREEN_ROUTES)
    filters["light_rail"] = route.isin(*LIGHT_RAIL_ROUTES)
    filters["heavy_rail"] = route.isin(*HEAVY_RAIL_ROUTES)
    filters["rail"] = route.isin(*SUBWAY_ROUTES)
    return filters


def bus_positions(positions: DataFrame, bus_routes: DataFrame, service_date: str) -> DataFrame:
    """Positions of bus routes on one service day, with the approach status folded in.

    ``service_date`` is ``YYYYMMDD`` text, compared raw so that it is pushed
    down to the files.
    """
    needed = ("current_status", "stop_id", "trip_id", "vehicle_id", "timestamp", "start_time")
    kept = positions.filter(F.col("start_date") == service_date)
    for c in needed:
        kept = kept.filter(F.col(c).isNotNull())
    return fold_incoming(kept.join(bus_routes.select("route_id"), "route_id", "left_semi"))


def fold_incoming(df: DataFrame, status: str = "current_status") -> DataFrame:
    """INCOMING_AT counts as IN_TRANSIT_TO."""
    return df.withColumn(
        status, F.when(F.col(status) == "INCOMING_AT", "IN_TRANSIT_TO").otherwise(F.col(status))
    )


def rail_positions(positions: DataFrame, routes: Sequence[str] | DataFrame) -> DataFrame:
    """Usable rail positions: complete, of a known direction, of a rail route."""
    kept = positions.filter(
        F.col("current_status").isNotNull()
        & (F.col("current_stop_sequence") >= 0)
        & F.col("stop_id").isNotNull()
        & (F.col("vehicle_timestamp") > 0)
        & F.col("direction_id").isin(0, 1)
        & F.col("vehicle_id").isNotNull()
        & F.col("trip_id").isNotNull()
    )
    if isinstance(routes, DataFrame):
        return kept.join(routes.select("route_id"), "route_id", "left_semi")
    return kept.filter(F.col("route_id").isin(*routes))


def terminal_predictions(updates: DataFrame, stops: Sequence[str]) -> DataFrame:
    """Departure predictions at terminals that still count; null states drop out."""
    return updates.filter(
        F.col("departure_time").isNotNull()
        & F.col("stop_id").isin(*stops)
        & F.col("revenue")
        & (F.col("schedule_relationship") != "CANCELED")
        & (F.col("stop_schedule_relationship") != "SKIPPED")
        & (F.col("departure_uncertainty") > 0)
    )


def terminal_positions(positions: DataFrame, stops: Sequence[str]) -> DataFrame:
    """Revenue positions at or next to a terminal."""
    return positions.filter(
        F.col("timestamp").isNotNull()
        & F.col("stop_id").isin(*stops)
        & F.col("revenue")
        & F.col("trip_id").isNotNull()
        & F.col("feed_timestamp").isNotNull()
    )


def without_buses(
    routes: DataFrame, trips: DataFrame, stop_times: DataFrame, patterns: DataFrame, version: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Schedule tables cut down to rail: routes, then trips and patterns, then stop times."""
    rail_routes = routes.filter(F.col("route_type") < 3)
    rail_trips = trips.join(rail_routes.select(*version, "route_id"), [*version, "route_id"], "left_semi")
    return {
        "routes": rail_routes,
        "trips": rail_trips,
        "stop_times": stop_times.join(rail_trips.select(*version, "trip_id"), [*version, "trip_id"], "left_semi"),
        "route_patterns": patterns.join(rail_routes.select(*version, "route_id"), [*version, "route_id"], "left_semi"),
    }
