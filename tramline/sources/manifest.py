"""File manifests as DataFrames: what a file is, which dates it serves, what is still to do.

A manifest has one row per file (``path``, and where needed ``last_modified``,
``processed``). Lists of files stay rows with a group and a position; nothing
gathers a group of unknown size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.times import date_int, published_at
from tramline.operators.groups import first_row
from tramline.operators.scan import even_stretches, ordered, row_number

# Text in a feed file's name and the feed it tells; the first match wins.
FEED_PATTERNS = (
    ("realtime_Alerts_enhanced", "RT_ALERTS"),
    ("realtime_TripUpdates_enhanced", "RT_TRIP_UPDATES"),
    ("concentrate_TripUpdates_enhanced.json", "RT_TRIP_UPDATES"),
    ("realtime_VehiclePositions_enhanced", "RT_VEHICLE_POSITIONS"),
    ("concentrate_VehiclePositions_enhanced.json", "RT_VEHICLE_POSITIONS"),
    ("com_prod_TripUpdates_enhanced", "BUS_TRIP_UPDATES"),
    ("com_prod_VehiclePositions_enhanced", "BUS_VEHICLE_POSITIONS"),
    ("net_vehicleCount", "VEHICLE_COUNT"),
    ("_GTFS.zip", "SCHEDULE"),
    ("LightRailRawGPS", "LIGHT_RAIL"),
    ("rtr_TripUpdates_enhanced", "DEV_GREEN_RT_TRIP_UPDATES"),
    ("rtr_VehiclePositions_enhanced.json", "DEV_GREEN_RT_VEHICLE_POSITIONS"),
)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Manifest of the files under a path (names and times only, no contents)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("last_modified"))
    )


def feed_type(path: Column, patterns: Sequence[tuple[str, str]] = FEED_PATTERNS) -> Column:
    """Feed of a file by its name; ``ERROR`` when no pattern is in it."""
    kind = None
    for text, feed in patterns:
        hit = F.contains(path, F.lit(text))
        kind = F.when(hit, feed) if kind is None else kind.when(hit, feed)
    return kind.otherwise("ERROR")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def grouped_and_sorted(manifest: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Files with their group (name after the first ``_``) and position by the 20-character stamp."""
    name = file_name(F.col("path"))
    named = manifest.filter(~F.col("path").endswith("/")).select(
        "*",
        F.regexp_extract(name, r"^[^_]*_(.*)$", 1).alias("file_type"),
        F.substring(name, 1, 20).alias("stamp"),
    )
    order = [F.col("stamp"), F.col("path"), *[F.col(c) for c in tie]]
    cut = even_stretches(named, order)
    return ordered(cut, ["file_type"], order, F.col("_stretch"), position=row_number()).drop("_stretch")


def partition_time(path: Column) -> Column:
    """UTC time a path stands for: hive ``year=/month=/day=[/hour=]`` or ``timestamp=``."""

    def part(name: str) -> Column:
        return F.nullif(F.regexp_extract(path, rf"{name}=(\d+)", 1), F.lit("")).try_cast("int")

    stamp = F.nullif(F.regexp_extract(path, r"timestamp=(\d+)", 1), F.lit("")).try_cast("long")
    by_parts = F.try_make_timestamp(
        part("year"), part("month"), part("day"), F.coalesce(part("hour"), F.lit(0)), F.lit(0), F.lit(0)
    )
    return F.coalesce(by_parts, F.timestamp_seconds(stamp))


def name_date(path: Column) -> Column:
    """Date in a file named ``YYYYMMDD.parquet`` (with or without the leading 1)."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, r"(\d{8})\.parquet$", 1), F.lit("")), "yyyyMMdd")


def service_dates(manifest: DataFrame, at: str = "partition_time", hourly: str = "is_hourly") -> DataFrame:
    """One row per file and service date it may hold.

    Hour files up to 08:00 UTC also hold the day before; up to 02:00 UTC they
    hold only that. Day files hold their own date.
    """
    hour = F.hour(at)
    today, before = F.to_date(at), F.date_sub(F.to_date(at), 1)
    dates = (
        F.when(~F.col(hourly), F.array(today))
        .when(hour <= 2, F.array(before))
        .when(hour <= 8, F.array(before, today))
        .otherwise(F.array(today))
    )
    return manifest.withColumn("service_date", F.explode(dates))


def prefer_daily(manifest: DataFrame, prefix: str = "prefix", daily: str = "is_daily") -> DataFrame:
    """Where a folder has a whole-day file, only the day files of the folder."""
    whole = manifest.filter(F.col(daily)).select(prefix).distinct().withColumn("_whole", F.lit(True))
    return manifest.join(whole, prefix, "left").filter(F.col(daily) | F.col("_whole").isNull()).drop("_whole")


def unprocessed(manifest: DataFrame, feeds: Sequence[str], groups: int, at: str = "partition_time") -> DataFrame:
    """Files of the oldest ``groups`` times that are not processed, all feeds of a time together."""
    wanted = None
    for text in feeds:
        hit = F.contains(F.col("path"), F.lit(text))
        wanted = hit if wanted is None else wanted | hit
    todo = manifest.filter(~F.col("processed") & wanted)
    oldest = oldest_groups(todo, at, groups)
    return todo.join(oldest, at, "left_semi")


def oldest_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` lowest distinct values."""
    return df.select(column).distinct().orderBy(column).limit(n)


def latest_of_version(manifest: DataFrame, version: str, keys: Sequence[str] = ()) -> DataFrame:
    """Newest object that carries the version, per key."""
    matching = manifest.filter(F.col("version") == version)
    return first_row(matching, keys, [F.col("last_modified"), F.col("path")], last=True)


def dates_to_export(source: DataFrame, exported: DataFrame, date: str, last: int = 2) -> DataFrame:
    """Source dates not exported yet, and always the last two."""
    dates = source.select(date).distinct()
    newest = dates.orderBy(F.desc(date)).limit(last)
    return dates.join(exported.select(date), date, "left_anti").union(newest).distinct()


def dates_to_rebuild(outputs: DataFrame, wanted: DataFrame, date: str = "service_date") -> DataFrame:
    """Dates whose output is missing or has another schema than the newest output."""
    newest = outputs.agg(F.max_by("schema_id", date)).scalar()
    stale = outputs.filter(F.col("schema_id") != newest).select(date)
    missing = wanted.select(date).join(outputs.select(date), date, "left_anti")
    return stale.join(wanted.select(date), date, "left_semi").union(missing).distinct()


def files_by_date(files: DataFrame, by: Sequence[str] = ("service_date", "source")) -> DataFrame:
    """Files with their position in the sorted list of their service date and source, one row per file.

    A date may have any number of files: its list is never gathered.
    """
    cut = even_stretches(files, [F.col("path")])
    return ordered(cut, list(by), [F.col("path")], F.col("_stretch"), position=row_number()).drop("_stretch")


def schedule_index(index: DataFrame) -> DataFrame:
    """Published schedules, one per publish date (the last by start date and time)."""
    dated = index.withColumn("published_dt", published_at(F.col("feed_version")))
    dated = dated.withColumn("published_date", date_int(F.to_date("published_dt")))
    order = [F.col("feed_start_date"), F.col("published_dt"), F.col("archive_url")]
    return first_row(dated.filter(F.col("published_date").isNotNull()), ["published_date"], order, last=True)


def schedules_to_process(index: DataFrame, archived: DataFrame, year: int) -> DataFrame:
    """Schedules of a year on that are not archived.

    From 2019 on by feed version; before, by start date later than any archived
    one, because versions did not agree then.
    """
    recent = index.filter(F.col("published_date") > year * 10000)
    if year <= 2018:
        newest = archived.agg(F.max("feed_start_date")).scalar()  # null where nothing is archived
        return recent.filter(newest.isNull() | (F.col("feed_start_date") > newest))
    return recent.join(archived.select("feed_version"), "feed_version", "left_anti")
