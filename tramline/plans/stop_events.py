"""Stop events kept up to date from position snapshots (batch form; ``streaming`` drives it)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.texts import joined_id
from tramline.operators import validate as V
from tramline.operators.groups import with_group_values

KEY = ("start_date", "route_id", "trip_id", "vehicle_id", "stop_sequence")
TRIP = KEY[:-1]
STATE = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("id", T.StringType()),
            ("timestamp", T.LongType()),
            ("start_date", T.StringType()),
            ("route_id", T.StringType()),
            ("trip_id", T.StringType()),
            ("vehicle_id", T.StringType()),
            ("stop_sequence", T.LongType()),
            ("direction_id", T.LongType()),
            ("start_time", T.StringType()),
            ("revenue", T.BooleanType()),
            ("stop_id", T.StringType()),
            ("arrived", T.LongType()),
            ("departed", T.LongType()),
            ("latest_stopped_timestamp", T.LongType()),
        )
    ]
)
REQUIRED = ("id", "timestamp", *KEY, "direction_id", "start_time", "revenue", "stop_id")
MAX_AGE_SECONDS = 2 * 3600


def _rules() -> V.Rules:
    return {**V.not_null(*REQUIRED), **V.in_range("direction_id", low=0, high=1)}


def checked(events: DataFrame) -> DataFrame:
    """Events that fit the state's schema; a repeated key drops all its rows."""
    return V.valid(events, _rules(), KEY)


def unnest_positions(documents: DataFrame) -> DataFrame:
    """Feed snapshot (column ``entity``) -> candidate stop events. Arrival only where the vehicle stands."""
    vehicle = F.col("v.vehicle")
    at_stop = F.col("v.current_status") == "STOPPED_AT"
    rows = (
        documents.select(F.explode("entity").alias("e"))
        .select(F.col("e.vehicle").alias("v"))
        .select(
            F.col("v.timestamp").alias("timestamp"),
            F.col("v.trip.start_date").alias("start_date"),
            F.col("v.trip.route_id").alias("route_id"),
            F.col("v.trip.trip_id").alias("trip_id"),
            vehicle["id"].alias("vehicle_id"),
            F.col("v.current_stop_sequence").cast("long").alias("stop_sequence"),
            F.col("v.trip.direction_id").cast("long").alias("direction_id"),
            F.col("v.trip.start_time").alias("start_time"),
            F.col("v.trip.revenue").alias("revenue"),
            F.col("v.stop_id").alias("stop_id"),
            F.when(at_stop, F.col("v.timestamp")).alias("arrived"),
            F.lit(None).cast("long").alias("departed"),
            F.when(at_stop, F.col("v.timestamp")).alias("latest_stopped_timestamp"),
        )
        .filter("stop_sequence is not null and trip_id is not null and timestamp is not null")
    )
    with_id = rows.withColumn("id", joined_id([F.col(k) for k in KEY]))
    return checked(with_id.select(*STATE.fieldNames()))


def expire(events: DataFrame, published: Column | int, max_age: int = MAX_AGE_SECONDS) -> DataFrame:
    """Events younger than ``max_age`` seconds at publication."""
    at = F.lit(published) if isinstance(published, int) else published
    return events.filter(at - F.col("timestamp") < max_age)


def departed_when_advanced(events: DataFrame, trip: Sequence[str] = TRIP) -> DataFrame:
    """Stops behind the trip's furthest stop have departed when last seen standing."""
    ahead = with_group_values(events, trip, _furthest=F.max("stop_sequence"))
    passed = F.col("_furthest") > F.col("stop_sequence")
    return ahead.withColumn(
        "departed", F.coalesce(F.when(passed, F.col("latest_stopped_timestamp")), F.col("departed"))
    ).drop("_furthest")


def _row_type(fields: Sequence[str]) -> T.StructType:
    return T.StructType([STATE[c] for c in fields])


def update_stop_events(
    existing: DataFrame, new: DataFrame, published: Column | int, max_age: int = MAX_AGE_SECONDS
) -> DataFrame:
    """State after a snapshot.

    Old events go. By key, existing values win except the last standing time,
    which the snapshot renews. A stop the trip has passed gets its departure
    and, the first time, the publication time. Stops without any event go. The
    state has a key once, and so has a snapshot (``unnest_positions``); a trip has
    as many rows as stops.
    """
    at = (F.lit(published) if isinstance(published, int) else published).cast("long")
    fields = [c for c in STATE.fieldNames() if c not in KEY]
    row = F.struct(*fields)
    # one shuffle and one sort, by a hash of the trip first, which compares faster than its columns: rows meet by key,
    # and the trip's furthest stop is found where they are
    sides = expire(existing, at, max_age).select(*KEY, row.alias("o"), F.lit(None).cast(_row_type(fields)).alias("n"))
    fresh = new.select(*KEY, F.lit(None).cast(_row_type(fields)).alias("o"), row.alias("n"))
    dealt = sides.unionByName(fresh).withColumn("_trip", F.xxhash64(*TRIP)).repartition("_trip")
    both = dealt.groupBy("_trip", *KEY).agg(F.max("o").alias("o"), F.max("n").alias("n"))
    passed = F.max("stop_sequence").over(Window.partitionBy("_trip", *TRIP)) > F.col("stop_sequence")
    merged = both.withColumn("_passed", passed).select(
        *KEY,
        *[
            F.coalesce(f"o.{c}", f"n.{c}").alias(c)
            for c in ("id", "direction_id", "start_time", "revenue", "stop_id", "arrived")
        ],
        F.coalesce(F.when(F.col("_passed"), F.col("o.latest_stopped_timestamp")), F.col("o.departed")).alias("departed"),
        F.coalesce(
            F.when(F.col("_passed") & F.col("o.departed").isNull(), at), F.col("o.timestamp"), at
        ).alias("timestamp"),
        F.coalesce("n.latest_stopped_timestamp", "o.latest_stopped_timestamp").alias("latest_stopped_timestamp"),
    )
    seen = merged.filter(F.col("arrived").isNotNull() | F.col("departed").isNotNull())
    return V.valid(seen.select(*STATE.fieldNames()), _rules())
