"""Feed ingestion, schedule tables, backfills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.filters import route_filters
from tramline.sinks.tables import drop_days, merge_daily_feed, write_partitioned
from tramline.sources import feeds
from tramline.sources.schedules import with_version
from tramline.sources.tables import conform, stored_table
from tramline.session import cut_lineage

DAY = ("year", "month", "day")


def feed_rows(documents: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Flat rows of a feed's documents, and the documents that could not be used."""
    parsed = feeds.parse_documents(documents, feeds.FEEDS[feed].entity)
    return feeds.flat_rows(feeds.entity_rows(parsed), feed), feeds.damaged(parsed)


def ingest_feed(
    spark: SparkSession, documents: DataFrame, feed: str, table: str, rail_table: str | None = None
) -> DataFrame:
    """Add a batch of feed documents to the day-partitioned table; returns the damaged documents.

    The touched days are read back, merged with the batch without repeats and
    rewritten; other days are not opened. Trip updates also keep a full,
    undeduplicated copy of their rail rows: a batch replaces the rows of its own
    feed times, so one batch, several, or one that comes again give the same copy.
    """
    rows, bad = feed_rows(documents, feed)
    new = cut_lineage(rows, f"new-{feed.lower()}")
    days = new.select(*DAY).distinct()
    payload = [c for c in new.columns if c != "feed_timestamp"]
    stored = stored_table(spark, table)
    if stored is None:  # first batch
        stored = new.limit(0)
    else:
        stored = conform(stored, new.schema).join(days, list(DAY), "left_semi")
    part = feeds.FEEDS[feed].sort
    merged = cut_lineage(merge_daily_feed(stored, new, payload, [F.col(c) for c in DAY]), f"merged-{feed.lower()}")
    write_partitioned(merged, table, DAY, sort=[part])
    if rail_table and feed == "RT_TRIP_UPDATES":
        rail = new.filter(route_filters(F.col(f"`{part}`"))["rail"])
        before = stored_table(spark, rail_table)
        if before is not None:
            before = conform(before, rail.schema).join(days, list(DAY), "left_semi")
            kept = before.join(new.select("feed_timestamp").distinct(), "feed_timestamp", "left_anti")
            rail = cut_lineage(kept.unionByName(rail), "rail-copy")
        write_partitioned(rail, rail_table, DAY)
    return bad


def backfill(source: DataFrame, table: str, day: str, first: str, last: str, where: Column | None = None) -> None:
    """Rebuild the days of an inclusive range from source rows; other days stay as they are.

    A day of the range without any row left is removed.
    """
    days = source.filter(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rows = days if where is None else days.filter(where)
    write_partitioned(rows, table, [day])
    drop_days(source.sparkSession, table, day, first, last, rows)


def versioned_tables(tables: dict[str, DataFrame], version: int, base: str, order: Sequence[str] = ("feed_info",)) -> None:
    """Write schedule tables under their version; ``order`` names the ones that come last.

    A version whose feed_info exists is thereby known to be complete.
    """


    for name in [*[n for n in tables if n not in order], *[n for n in order if n in tables]]:
        versioned = with_version(tables[name], version)
        versioned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("timestamp").parquet(
            f"{base}/{name}"
        )
