"""Summaries: counts, branches, quantiles, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.nested import quoted
from tramline.functions.times import seconds_after_service_midnight
from tramline.operators.groups import first_row
from tramline.operators.scan import lead, ordered, row_number, stretch, sum_before

# Platforms that tell the two Red branches apart.
ASHMONT_STOPS = ("70085", "70086", "70087", "70088", "70089", "70090", "70091", "70092", "70093", "70094")
BRAINTREE_STOPS = (
    "70095", "70096", "70097", "70098", "70099", "70100", "70101", "70102", "70103", "70104", "70105",
)


def trip_stop_counts(stops: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Stops and earliest arrival per trip."""
    return stops.groupBy(*keys).agg(F.count(F.lit(1)).alias("stop_count"), F.min(arrival).alias("start_time"))


def branch_and_trunk(stops: DataFrame, keys: Sequence[str], otherwise_braintree: bool = False) -> DataFrame:
    """Branch and trunk of every trip from its route and the platforms it called at.

    Realtime rule: Ashmont platforms make Red-A, else Braintree platforms Red-B,
    else no branch. ``otherwise_braintree`` is the schedule's rule: any other
    Red trip is Red-B, and every route is its own branch.
    """
    route = F.col("route_id")
    seen = stops.groupBy(*keys, "route_id").agg(
        F.bool_or(F.col("stop_id").isin(*ASHMONT_STOPS)).alias("_ashmont"),
        F.bool_or(F.col("stop_id").isin(*BRAINTREE_STOPS)).alias("_braintree"),
    )
    red = F.when(F.col("_ashmont"), "Red-A")
    red = red.otherwise(F.lit("Red-B")) if otherwise_braintree else red.when(F.col("_braintree"), "Red-B")
    branch = F.when(route.startswith("Green"), route).when(route == "Red", red)
    if otherwise_braintree:
        branch = F.when(route == "Red", red).otherwise(route)
    trunk = F.when(route.startswith("Green"), F.lit("Green")).otherwise(route)
    return seen.select(*keys, "route_id", branch.alias("branch_route_id"), trunk.alias("trunk_route_id"))


def backfill_start_times(trips: DataFrame, scheduled: DataFrame, observed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fill missing start times: earliest scheduled departure, else the first observed time.

    ``scheduled`` has departure_time (seconds), ``observed`` the three event
    times as epochs; observed times become seconds after service midnight.
    """
    planned = scheduled.groupBy(*key).agg(F.min("departure_time").alias("_planned"))
    first = observed.groupBy(*key).agg(
        F.coalesce(
            F.min("vp_move_timestamp"), F.min("vp_stop_timestamp"), F.min("tu_stop_timestamp")
        ).alias("_seen")
    )
    return (
        trips.join(planned, list(key), "left")
        .join(first, list(key), "left")
        .withColumn(
            "start_time",
            F.coalesce("start_time", "_planned", seconds_after_service_midnight(F.col("_seen"))),
        )
        .drop("_planned", "_seen")
    )


def windowed_dedup(rows: DataFrame, new_from: Column | int, payload: Sequence[str], ts: str = "feed_timestamp") -> DataFrame:
    """Repeats of a payload collapse to the earliest feed time, from ``new_from`` on.

    Older rows stay as they are. Equality is on the payload columns themselves,
    so unequal rows never merge. A null ``new_from`` leaves a row as it is.
    """
    cut = F.lit(new_from) if isinstance(new_from, int) else new_from
    same = [F.col(quoted(c)) for c in payload]
    old = rows.filter(cut.isNull() | (F.col(ts) < cut)).select(*same, ts)
    recent = rows.filter(F.col(ts) >= cut).groupBy(*same).agg(F.min(ts).alias(ts))
    return old.unionByName(recent)


def zero_points(stops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per line, the station most branches pass; ties by widest spread of sequence, then name."""
    seen = stops.groupBy(*keys, "parent_station").agg(
        F.count("stop_sequence").alias("_n"),
        (F.max("stop_sequence") - F.min("stop_sequence")).alias("_spread"),
    )
    return first_row(seen, keys, [-F.col("_n"), -F.col("_spread"), F.col("parent_station")]).select(
        *keys, "parent_station"
    )


def sync_sequences(canon: DataFrame, version: Sequence[str] = ("static_version_key",)) -> DataFrame:
    """Station numbers that agree across the branches of a trunk.

    ``canon``: version, direction_id, trunk_route_id, route_id, parent_station, stop_sequence.
    """
    zero = zero_points(canon, [*version, "trunk_route_id"])
    at_zero = (
        canon.join(zero, [*version, "trunk_route_id", "parent_station"])
        .groupBy(*version, "direction_id", "route_id")
        .agg(F.min("stop_sequence").alias("_zero"))
    )
    shifted = canon.join(at_zero, [*version, "direction_id", "route_id"]).withColumn(
        "_shifted", F.col("stop_sequence") - F.col("_zero")
    )
    base = shifted.groupBy(*version, "direction_id", "trunk_route_id").agg(
        F.min("stop_sequence").alias("_min_seq"), F.min("_shifted").alias("_min_sync")
    )
    return (
        shifted.join(base, [*version, "direction_id", "trunk_route_id"])
        .select(
            *version,
            "direction_id",
            "trunk_route_id",
            "parent_station",
            (F.col("_shifted") - F.col("_min_sync") + F.col("_min_seq")).alias("sync_stop_sequence"),
        )
        .distinct()
    )


def canonical_sequences(patterns: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Station numbers 1..n of each route and direction, from its typical trip.

    The trip is the representative of a pattern of typicality 5, else 1.
    ``patterns``: version, route_id, direction_id, trunk_route_id, route_pattern_typicality,
    representative_trip_id; ``stop_times``: version, trip_id, stop_sequence, parent_station.
    """
    chosen = first_row(
        patterns.filter(F.col("route_pattern_typicality").isin(1, 5)),
        ["static_version_key", "route_id", "direction_id"],
        [-F.col("route_pattern_typicality"), F.col("representative_trip_id")],
    )
    calls = chosen.join(
        stop_times.withColumnRenamed("trip_id", "representative_trip_id"),
        ["static_version_key", "representative_trip_id"],
    ).withColumnRenamed("stop_sequence", "_seq")
    return ordered(
        calls,
        ["static_version_key", "direction_id", "route_id"],
        [F.col("_seq"), F.col("parent_station")],
        stretch(F.col("_seq"), 256),
        stop_sequence=row_number(),
    ).drop("_seq")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float], width: int = 1000) -> DataFrame:
    """Exact quantiles of whole-number values, linear between neighbours; ``wanted`` names them.

    Equal values are counted first, then positions run along the counts, once
    for all quantiles; no group is gathered, whatever its size.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    along = ordered(counts, keys, [F.col(value)], stretch(F.col(value), width), _before=sum_before(F.col("_n")))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    joined = along.join(totals, list(keys))
    position = {name: F.lit(q) * (F.col("_total") - 1) for name, q in wanted.items()}

    def holds(at: Column) -> Column:
        return (F.col("_before") <= at) & (at < F.col("_before") + F.col("_n"))

    sides = {"low": F.floor, "high": F.ceil}
    picked = joined.groupBy(*keys, "_total").agg(
        *[
            F.max(F.when(holds(side(at)), F.col(value))).alias(f"_{which}_{name}")
            for name, at in position.items()
            for which, side in sides.items()
        ]
    )

    def between(name: str, at: Column) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return (low + (high - low) * (at - F.floor(at))).alias(name)

    return picked.select(*keys, *[between(name, at) for name, at in position.items()])


def coverage_ratio(plausible: DataFrame, found: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Share of plausible events that were found: 1 - missing / plausible, per kind.

    Both sides have one column per event kind; a null means no such event.
    """

    def events(df: DataFrame) -> DataFrame:
        return df.unpivot(list(keys), list(kinds), "kind", "at").filter(F.col("at").isNotNull()).select(*keys, "kind").distinct()

    expected = events(plausible)
    missing = expected.join(events(found), [*keys, "kind"], "left_anti").withColumn("_missing", F.lit(1))
    total = expected.groupBy("kind").agg(F.count(F.lit(1)).alias("plausible"))
    lost = missing.groupBy("kind").agg(F.count(F.lit(1)).alias("_lost"))
    return total.join(lost, "kind", "left").select(
        "kind",
        "plausible",
        F.coalesce("_lost", F.lit(0)).alias("missing"),
        (1 - F.coalesce("_lost", F.lit(0)) / F.col("plausible")).alias("coverage"),
    )


def trip_documents(
    events: DataFrame, keys: Sequence[str], seq: str, stop_fields: Sequence[str], newest_from: int, ts: str = "timestamp",
    span_seconds: int = 3600,
) -> DataFrame:
    """Nested documents of a trip: its recent stop events as arrays ordered by sequence.

    Events older than ``newest_from`` go before anything is gathered. Every
    document covers ``span_seconds`` of a trip and carries the span's number
    (``span``) as part of its key, whatever the number of events.
    """
    recent = events.filter(F.col(ts) >= newest_from).withColumn("span", stretch(F.col(ts), span_seconds))
    item = F.struct(F.col(seq), *[F.col(f) for f in stop_fields])
    return recent.groupBy(*keys, "span").agg(F.sort_array(F.collect_list(item)).alias("stop_events"))


def distinct_trips_by_date(df: DataFrame, date: str, trip: str) -> DataFrame:
    """Distinct trips of every service date."""
    return df.groupBy(date).agg(F.count_distinct(F.col(trip)).alias("trips"))


def date_gaps(df: DataFrame, date: str) -> DataFrame:
    """Days from every service date to the next one present."""
    dates = df.select(date).distinct().withColumn("_line", F.lit(1))
    scanned = ordered(
        dates, ["_line"], [F.col(date)], stretch(F.datediff(F.col(date), F.lit("1970-01-01").cast("date")), 366),
        _next=lead(F.col(date)),
    )
    return scanned.select(date, F.datediff("_next", date).alias("days_to_next"))


def row_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, nulls, lowest and highest of each column (all, if none are named), one row per column.

    All columns are summed up in one pass over the rows; the summaries are then unpivoted.
    """
    aggs = []
    for c in columns or df.columns:
        col = F.col(f"`{c}`")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(col).alias("count"),
                F.count_if(col.isNull()).alias("nulls"),
                F.min(col).cast("string").alias("min"),
                F.max(col).cast("string").alias("max"),
            )
        )
    return df.agg(F.array(*aggs).alias("_p")).select(F.explode("_p").alias("_r")).select("_r.*")
