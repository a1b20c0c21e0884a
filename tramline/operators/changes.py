"""Snapshots, history and change data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import date_int, int_date
from tramline.operators.groups import anti, first_row, key_struct

VALIDITY = ("gtfs_active_date", "gtfs_end_date")


def snapshot_diff(snapshot: DataFrame, stored: DataFrame, on_date: int, columns: Sequence[str]) -> DataFrame:
    """Rows marked ``new``, ``same`` or ``old`` between a snapshot and the rows stored for a date.

    All columns are compared, null equal to null. Same and old rows carry the
    stored validity; new rows carry the snapshot's.
    """
    valid = stored.filter((F.col(VALIDITY[0]) <= on_date) & (F.col(VALIDITY[1]) >= on_date))
    keyed = valid.withColumn("_row", key_struct(*columns))
    in_snapshot = snapshot.select(key_struct(*columns).alias("_row")).distinct().withColumn("_in", F.lit(True))
    flagged = keyed.join(in_snapshot, "_row", "left").select(
        *columns, *VALIDITY, F.when(F.col("_in"), "same").otherwise("old").alias("change")
    )
    new = anti(snapshot, valid, columns).select(*columns, *VALIDITY, F.lit("new").alias("change"))
    return flagged.unionByName(new)


def scd2_merge(snapshot: DataFrame, stored: DataFrame, published: int, columns: Sequence[str]) -> DataFrame:
    """History after a schedule published on ``published`` (``YYYYMMDD``).

    The snapshot is valid from the day after for a year. Stored rows valid then
    but gone from it end on the publish day, rows still in it are extended, new
    rows are added and other rows stay. When the snapshot opens a new year the
    last year's rows close on 31 December and continue on 1 January; spans that
    do not last past their first day are dropped there.
    """
    day = int_date(F.lit(published))
    active_from, active_to = date_int(F.date_add(day, 1)), date_int(F.date_add(day, 364 + 1))
    fresh = snapshot.select(*columns, active_from.alias(VALIDITY[0]), active_to.alias(VALIDITY[1])).distinct()
    # a year that has rows already is merged in place; otherwise the year turns
    year = F.floor(active_from / 10000).cast("long")
    start_of_year, end_of_last = year * 10000 + 101, (year - 1) * 10000 + 1231
    has_year = stored.agg(
        F.coalesce(F.bool_or(F.floor(F.col(VALIDITY[0]) / 10000) >= year), F.lit(False))
    ).scalar()
    keyed = stored.withColumn("_row", key_struct(*columns))
    kept = fresh.select(key_struct(*columns).alias("_row"), F.lit(True).alias("_in"))
    marked = keyed.join(kept, "_row", "left").withColumn("_has_year", has_year)
    on = F.when(F.col("_has_year"), active_from).otherwise(end_of_last)
    touched = (F.col(VALIDITY[0]) <= on) & (F.col(VALIDITY[1]) >= on)
    end = F.when(F.col("_in"), active_to).otherwise(F.lit(published).cast("long"))
    spans = (
        F.when(~touched, F.array(F.struct(F.col(VALIDITY[0]).cast("long").alias("a"), F.col(VALIDITY[1]).cast("long").alias("e"))))
        .when(F.col("_has_year"), F.array(F.struct(F.col(VALIDITY[0]).cast("long").alias("a"), end.alias("e"))))
        .otherwise(
            F.filter(
                F.array(
                    F.struct(F.col(VALIDITY[0]).cast("long").alias("a"), end_of_last.alias("e")),
                    F.struct(start_of_year.alias("a"), end.alias("e")),
                ),
                lambda s: (s["e"] > s["a"]) | (s["a"] < start_of_year),
            )
        )
    )
    history = marked.withColumn("_span", F.explode(spans)).select(
        *columns, F.col("_span.a").alias(VALIDITY[0]), F.col("_span.e").alias(VALIDITY[1])
    )
    valid_now = marked.filter(touched)
    return history.unionByName(anti(fresh, valid_now, columns))


def insert_ignore(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows plus new rows whose key is not stored yet."""
    return stored.unionByName(new.join(stored.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def update_from(stored: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Stored rows with ``columns`` replaced, nulls included, where a change has the key."""
    marked = changes.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in columns]
    )
    joined = stored.join(marked, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in stored.columns
        ]
    )


def distinct_on_latest(events: DataFrame, keys: Sequence[str], seq: str, tie: Sequence[Column] = ()) -> DataFrame:
    """The event of the highest sequence per key; a null sequence ranks above all."""
    return first_row(events, keys, [F.col(seq).isNotNull(), -F.col(seq), *tie])


def load_trips(stored: DataFrame, events: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Trips after a batch: new ones inserted, then details updated from position-backed events."""
    trip_columns = [c for c in stored.columns]
    tie = [F.col(c) for c in trip_columns if c not in keys]
    newest = distinct_on_latest(events, keys, "stop_sequence", tie).select(*trip_columns)
    backed = events.filter(F.col("vp_move_timestamp").isNotNull() | F.col("vp_stop_timestamp").isNotNull())
    changes = distinct_on_latest(backed, keys, "stop_sequence", tie).select(*keys, *update)
    return update_from(insert_ignore(stored, newest, keys), changes, keys, update)


def append_distinct(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both sets by column name, missing columns null, repeats once."""
    return stored.unionByName(new, allowMissingColumns=True).distinct()


def splice(before: DataFrame, after: DataFrame, at: str, cut) -> DataFrame:
    """``before`` up to and with the cut, ``after`` from there on."""
    return before.filter(F.col(at) <= cut).unionByName(after.filter(F.col(at) > cut), allowMissingColumns=True)


def replace_recent(stored: DataFrame, requeried: DataFrame, date: str, days_back: int = 1) -> DataFrame:
    """Stored rows older than ``days_back`` before the newest date, and re-queried rows from there on.

    Nothing stored: all re-queried rows.
    """
    cut = stored.agg(F.date_sub(F.max(date), days_back)).scalar()
    return stored.filter(F.col(date) < cut).unionByName(requeried.filter(cut.isNull() | (F.col(date) >= cut)))


def newer_versions(published: DataFrame, source: DataFrame, version: str) -> DataFrame:
    """Source rows of versions above the highest one published (all, where none is)."""
    top = published.agg(F.max(version)).scalar()
    return source.filter(top.isNull() | (F.col(version) > top))


def missing_or_renewed(processed: DataFrame, published: DataFrame, renewed: DataFrame, key: str) -> DataFrame:
    """Keys processed but not published, and keys with new data."""
    return processed.select(key).join(published.select(key), key, "left_anti").union(renewed.select(key)).distinct()
