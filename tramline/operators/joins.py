"""Joins beyond plain equality: as-of, interval, fallback and match rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.rows import null_count
from tramline.operators.groups import anti, first_row, key_struct, nulls_last
from tramline.operators.scan import first_after, last_before, ordered, stretch


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join on shared key names; the size of ``right`` decides how Spark joins."""
    return left.join(right, list(keys), how)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", suffix: str = "_right"
) -> DataFrame:
    """Join where null equals null. Keys are coalesced; overlapping columns of ``right`` get a suffix.

    A full join is made of a left join, whose hot keys Spark can split, and the
    rows of ``right`` that ``left`` has no key for. ``left`` is read twice then.
    """
    if how == "full":
        matched = null_safe_join(left, right, keys, "left", suffix)
        alone = anti(right, left, keys).withColumnsRenamed(
            {c: c + suffix for c in right.columns if c not in keys and c in left.columns}
        )
        return matched.unionByName(alone, allowMissingColumns=True)
    values = [c for c in right.columns if c not in keys]
    renamed = right.select(
        key_struct(*keys).alias("_join"),
        *[F.col(f"`{k}`").alias(f"_r_{k}") for k in keys],
        *[F.col(f"`{c}`").alias(c + suffix if c in left.columns else c) for c in values],
    )
    joined = left.withColumn("_join", key_struct(*keys)).join(renamed, "_join", how)
    return joined.select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.col(f"`_r_{c}`")).alias(c) if c in keys else F.col(f"`{c}`")
            for c in left.columns
        ],
        *[F.col(f"`{c + suffix if c in left.columns else c}`") for c in values],
    )


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right") -> DataFrame:
    """Full join, keys coalesced, overlapping columns of ``right`` suffixed. Null keys do not match."""
    values = [c for c in right.columns if c not in keys]
    renamed = right.toDF(
        *[f"_r_{c}" if c in keys else (c + suffix if c in left.columns else c) for c in right.columns]
    )
    condition = [F.col(f"`{k}`") == F.col(f"`_r_{k}`") for k in keys]
    return left.join(renamed, condition, "full").select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.col(f"`_r_{c}`")).alias(c) if c in keys else F.col(f"`{c}`")
            for c in left.columns
        ],
        *[F.col(f"`{c + suffix if c in left.columns else c}`") for c in values],
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    width: int,
) -> DataFrame:
    """Equal keys and ``start < point <= end``.

    Intervals are listed once per block of ``width`` they touch and joined on
    (keys, block), so a key shared by many rows is not paired up as a whole.
    A point lies in one block: no pair appears twice.
    """
    blocks = F.sequence(stretch(F.col(start), width), stretch(F.col(end), width))
    listed = intervals.filter(F.col(start) < F.col(end)).withColumn("_block", F.explode(blocks))
    return (
        points.withColumn("_block", stretch(F.col(point), width))
        .join(listed, [*keys, "_block"])
        .filter((F.col(start) < F.col(point)) & (F.col(point) <= F.col(end)))
        .drop("_block")
    )


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_on: str,
    right_on: str,
    right_id: str,
    width: int,
    tolerance: int | None = None,
) -> DataFrame:
    """Each left row with the right row nearest in value, within equal keys.

    Both sides are laid on one line per key and each left row takes the last
    right row at or before it and the first one after; the nearer wins, the
    earlier on a tie, and among right rows of one value the lowest ``right_id``.
    Left rows without a partner (or beyond ``tolerance``) keep nulls.
    """
    values = [c for c in right.columns if c not in keys]
    # one right row per (keys, value): the lowest id, so equal values have one winner
    nearest_right = first_row(right.filter(F.col(right_on).isNotNull()), [*keys, right_on], [F.col(right_id)])
    found = F.struct(*[F.col(f"`{c}`") for c in values])
    lefts = left.filter(F.col(left_on).isNotNull()).select(
        *keys,
        F.col(left_on).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"),
    )
    rights = nearest_right.select(*keys, F.col(right_on).alias("_at"), F.lit(0).alias("_side"), found.alias("_found"))
    line = ordered(
        lefts.unionByName(rights, allowMissingColumns=True),
        keys,
        [F.col("_at"), F.col("_side")],
        stretch(F.col("_at"), width),
        _before=last_before(F.col("_found")),
        _after=first_after(F.col("_found")),
    ).filter(F.col("_side") == 1)
    behind = F.col("_at") - F.col("_before").getField(right_on)
    ahead = F.col("_after").getField(right_on) - F.col("_at")
    pick = F.when(F.col("_before").isNull(), F.col("_after")).when(ahead < behind, F.col("_after")).otherwise(
        F.col("_before")
    )
    picked = line.select("_left", pick.alias("_pick"))
    if tolerance is not None:
        gap = F.abs(F.col("_left").getField(left_on) - F.col("_pick").getField(right_on))
        picked = picked.withColumn("_pick", F.when(gap <= tolerance, F.col("_pick")))
    matched = picked.select(
        *[F.col("_left").getField(c).alias(c) for c in left.columns],
        *[F.col("_pick").getField(c).alias(c) for c in values],
    )
    # a left row without a value on the line cannot match but is kept
    unplaced = left.filter(F.col(left_on).isNull())
    return matched.unionByName(unplaced, allowMissingColumns=True)


def parent_station(events: DataFrame, stops: DataFrame, keys: Sequence[str] = ("static_version_key",)) -> DataFrame:
    """Add ``parent_station``: the stop's parent, else the stop itself."""
    lookup = stops.select(*keys, "stop_id", F.col("parent_station").alias("_parent"))
    joined = events.join(lookup, [*keys, "stop_id"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in events.columns], F.coalesce("_parent", "stop_id").alias("parent_station")
    )


def split_enrich_union(
    left: DataFrame, right: DataFrame, semi_keys: Sequence[str], enriched: DataFrame
) -> DataFrame:
    """``enriched`` (made from the rows with a partner) plus the rows without one, by name."""
    return enriched.unionByName(left.join(right.select(*semi_keys).distinct(), list(semi_keys), "left_anti"), True)


def trip_vehicle_match(schedule: DataFrame, realtime: DataFrame) -> DataFrame:
    """Which realtime vehicle belongs to which scheduled trip and pullout.

    A pair with equal labels is the match. A realtime vehicle without one takes
    the trip's pullouts that name no vehicle, or stands alone when the schedule
    does not know the trip. No vehicles are paired up within a trip.

    schedule: trip_id, tm_pullout_id, vehicle_label; realtime: trip_id, vehicle_label.
    """
    planned = schedule.select("trip_id", "tm_pullout_id", "vehicle_label").distinct()
    seen = realtime.select("trip_id", F.col("vehicle_label").alias("vehicle_label_gtfs")).distinct()
    exact = planned.join(
        seen.withColumn("vehicle_label", F.col("vehicle_label_gtfs")), ["trip_id", "vehicle_label"]
    ).select("trip_id", "tm_pullout_id", "vehicle_label", "vehicle_label_gtfs")
    unmatched = seen.join(exact.select("trip_id", "vehicle_label_gtfs"), ["trip_id", "vehicle_label_gtfs"], "left_anti")
    trips = planned.groupBy("trip_id").agg(F.lit(True).alias("_known"))
    open_pullouts = planned.filter(F.col("vehicle_label").isNull())
    adopted = unmatched.join(open_pullouts.select("trip_id", "tm_pullout_id"), "trip_id")
    alone = unmatched.join(trips, "trip_id", "left_anti")
    no_label = F.lit(None).cast("string")
    return exact.unionByName(
        adopted.select("trip_id", "tm_pullout_id", no_label.alias("vehicle_label"), "vehicle_label_gtfs")
    ).unionByName(
        alone.select("trip_id", no_label.alias("tm_pullout_id"), no_label.alias("vehicle_label"), "vehicle_label_gtfs")
    )


def match_static_stop(
    rt: DataFrame, static: DataFrame, trip: Sequence[str] = ("service_date", "pm_trip_id")
) -> DataFrame:
    """Realtime stops with the static stop of the same trip, version and station.

    Only static visits ranked at or below the realtime visit count, and one row
    per (trip, station) stays: the lowest static rank. The lowest
    rank of a station is therefore the only candidate, which keeps the join one
    to one however often a trip calls there.
    """
    candidates = first_row(
        static, ["static_trip_id", "static_version_key", "parent_station"], [F.col("static_stop_rank")]
    ).withColumnsRenamed({"static_version_key": "_version", "parent_station": "_station"})
    joined = rt.join(
        candidates,
        (F.col("static_trip_id_guess") == F.col("static_trip_id"))
        & (F.col("static_version_key") == F.col("_version"))
        & (F.col("parent_station") == F.col("_station"))
        & (F.col("rt_stop_rank") >= F.col("static_stop_rank")),
        "left",
    ).drop("_version", "_station")
    return first_row(
        joined,
        [*trip, "parent_station"],
        [*nulls_last(F.col("static_stop_rank")), F.col("rt_stop_rank"), F.col("stop_sequence")],
    )


def outer_merge_events(positions: DataFrame, predictions: DataFrame, keys: Sequence[str], details: Sequence[str]) -> DataFrame:
    """Position events and prediction events of one trip-stop in one row.

    Details come from the row with the fewest nulls among sequence, label and
    consist; positions win a tie, so the choice is always the same. Both sides
    are read once and shuffled once; the earliest time stands where a side
    repeats a key.
    """
    times = ("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    both = positions.select(*keys, *times[:2], *details, F.lit(0).alias("_from")).unionByName(
        predictions.select(*keys, times[2], *details, F.lit(1).alias("_from")), allowMissingColumns=True
    )
    nulls = null_count(F.col("stop_sequence"), F.col("vehicle_label"), F.col("vehicle_consist"))
    detail = F.struct(*[F.col(d) for d in details])
    merged = both.groupBy(*keys).agg(
        *[F.min(t).alias(t) for t in times],
        F.min_by(detail, F.struct(nulls, F.col("_from"), *[F.col(d) for d in details])).alias("_best"),
    )
    return merged.select(*keys, *times, *[F.col("_best").getField(d).alias(d) for d in details])


def drop_unpreserved_trips(bus: DataFrame, sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keep the bus rows of trips whose keys no source has lost.

    A source key missing from ``bus`` marks the trip; marked trips leave.
    """
    lost = None
    for source in sources:
        missing = anti(source.select(*keys).distinct(), bus, keys)
        lost = missing if lost is None else lost.unionByName(missing)
    return anti(bus, lost, keys)


def drop_trips_with_lost_events(
    bus: DataFrame, source: DataFrame, event_keys: Sequence[str], trip_keys: Sequence[str]
) -> DataFrame:
    """Drop the trips of every source event that has no equal event in ``bus``, null-safe."""
    lost = anti(source.select(*dict.fromkeys([*event_keys, *trip_keys])), bus, event_keys)
    return anti(bus, lost, trip_keys)


