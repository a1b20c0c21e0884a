"""Schedule archive: every published schedule merged into validity ranges, by year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.changes import scd2_merge
from tramline.session import cut_lineage
from tramline.sinks.tables import write_partitioned
from tramline.sources.schedules import conform_text, table_schema
from tramline.sources.tables import stored_table

# how the large tables are sorted inside their files
SORT = {"stop_times": ("stop_id", "trip_id"), "trips": ("route_id", "service_id")}


def add_schedule(spark: SparkSession, table: str, snapshot: DataFrame, published: int, base: str) -> None:
    """Merge one table of a schedule published on ``YYYYMMDD`` into the archive at ``base``.

    The archive is partitioned by the year of the first valid day. Only the
    publish year and the years beside it can change, so only they are read and
    rewritten.
    """
    columns = table_schema(table).fieldNames()
    path = f"{base.rstrip('/')}/{table}"
    year = published // 10000
    archived = stored_table(spark, path)
    if archived is not None:
        stored = archived.filter(F.col("year").between(year - 1, year + 1)).drop("year")
    else:  # first schedule
        stored = snapshot.select(*columns).limit(0).withColumns(
            {"gtfs_active_date": F.lit(0).cast("long"), "gtfs_end_date": F.lit(0).cast("long")}
        )
    merged = scd2_merge(snapshot.select(*columns), stored, published, columns)
    dated = cut_lineage(merged.withColumn("year", F.floor(F.col("gtfs_active_date") / 10000)), f"archive-{table}")
    write_partitioned(dated, path, ["year"], sort=SORT.get(table, ()))


def add_schedules(
    spark: SparkSession, schedules: Sequence[tuple[int, dict[str, DataFrame]]], base: str, last: str = "feed_info"
) -> None:
    """Merge schedules, oldest first; ``feed_info`` of each comes last, so a broken run is repeated."""
    for published, tables in sorted(schedules, key=lambda s: s[0]):
        for table in sorted(tables, key=lambda name: (name == last, name)):
            snapshot = conform_text(tables[table], table_schema(table))
            add_schedule(spark, table, snapshot, published, base)


def read_archive(spark: SparkSession, base: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Archive tables by name (``operators.calendar.as_of`` picks a date)."""
    return {t: spark.read.parquet(f"{base.rstrip('/')}/{t}").drop("year") for t in tables}
