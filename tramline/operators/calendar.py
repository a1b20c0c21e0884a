"""Service calendars and schedule versions by date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.texts import rating_season, rating_year
from tramline.functions.times import date_int, int_date
from tramline.operators.scan import lead, ordered, stretch

# Weekday columns of the calendar table, Sunday first as dayofweek counts.
WEEKDAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")


def runs_on(date, column=F.col):
    """True where the calendar row's weekday flag for the date is set; ``column`` gives a flag by its name."""
    day = F.dayofweek(date)
    flag = None
    for number, name in enumerate(WEEKDAYS, start=1):
        flag = F.when(day == number, column(name)) if flag is None else flag.when(day == number, column(name))
    return flag.cast("int") == 1


def service_ids_for_date(calendar: DataFrame, exceptions: DataFrame, service_date: int) -> DataFrame:
    """Services of one ``YYYYMMDD``: weekday services less removals, plus additions."""
    day = int_date(F.lit(service_date))
    regular = calendar.filter(
        (F.col("start_date") <= service_date) & (F.col("end_date") >= service_date) & runs_on(day)
    ).select("service_id")
    today = exceptions.filter(F.col("date") == service_date)
    removed = today.filter(F.col("exception_type") == 2).select("service_id")
    added = today.filter(F.col("exception_type") == 1).select("service_id")
    return regular.join(removed, "service_id", "left_anti").union(added).distinct()


def each_date(df: DataFrame, start: str, end: str, name: str = "service_date") -> DataFrame:
    """One row per date of each row's inclusive ``YYYYMMDD`` range."""
    first, last = int_date(F.col(start)), int_date(F.col(end))
    return (
        df.filter(F.col(start) <= F.col(end))
        .withColumn("_date", F.explode(F.sequence(first, last)))
        .withColumn(name, date_int(F.col("_date")))
    )


def service_calendar(
    calendar: DataFrame, exceptions: DataFrame, feeds: DataFrame, trips: DataFrame, close_at_next_feed: bool = False
) -> DataFrame:
    """(route_id, service_id, service_date, static_version_key) for every date of every version.

    Weekday services and additions, less removals, on dates the version covers,
    for routes with trips of that service. ``close_at_next_feed`` ends each
    version the day before the next one starts.
    """
    keys = ["static_version_key", "service_id"]
    spans = feeds.select("static_version_key", "feed_start_date", "feed_end_date")
    if close_at_next_feed:
        spans = close_spans(spans)
    # ranges are cut to the version's dates before they are spread over days
    oldest = exceptions.agg(F.min("static_version_key")).scalar()
    first = int_date(F.greatest("start_date", "feed_start_date"))
    last = int_date(F.least("end_date", "feed_end_date"))
    ranges = (
        calendar.filter(F.col("static_version_key") >= oldest)
        .join(spans, "static_version_key")
        .select(*keys, F.struct(first.alias("first"), last.alias("last"), *WEEKDAYS).alias("_range"))
        .filter(F.col("_range.first") <= F.col("_range.last"))
    )
    changed = exceptions.join(spans, "static_version_key").filter(
        F.col("date").between(F.col("feed_start_date"), F.col("feed_end_date"))
    )
    dated = [
        changed.filter(F.col("exception_type") == kind).select(*keys, F.col("date").cast("long").alias(name))
        for kind, name in ((1, "_added"), (2, "_removed"))
    ]
    routes = trips.select(*keys, F.struct("route_id").alias("_route"))
    # one row per service holds its ranges, exceptions and routes; dates are listed from it at the very
    # end, so no shuffle, sort or map holds a row per date
    services = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [ranges, *dated, routes])
        .groupBy(*keys)
        .agg(*[F.collect_set(c).alias(c) for c in ("_range", "_added", "_removed", "_route")])
        .dropna(subset=keys)
    )

    def regular(r):
        days = F.sequence(r["first"], r["last"])
        return F.transform(F.filter(days, lambda day: runs_on(day, r.getField)), date_int)

    dates = F.array_union(F.flatten(F.transform("_range", regular)), F.col("_added"))
    return (
        services.withColumn("service_date", F.explode(F.array_except(dates, F.col("_removed"))))
        .withColumn("_route", F.explode(F.array_distinct("_route")))
        .select("_route.route_id", "service_id", "service_date", "static_version_key")
    )


def close_spans(spans: DataFrame) -> DataFrame:
    """End each feed span the day before the next start (the last keeps its end, less a day)."""


    # one line for all feeds, a stretch per start date
    lined = ordered(
        spans.withColumn("_line", F.lit(1)),
        ["_line"],
        [F.col("feed_start_date"), F.col("static_version_key")],
        stretch(F.col("feed_start_date"), 1),
        _next=lead(F.col("feed_start_date")),
    )
    end = F.date_sub(int_date(F.coalesce("_next", "feed_end_date")), 1)
    return lined.withColumn("feed_end_date", date_int(end)).drop("_line", "_next")


def version_for_dates(dates: DataFrame, feeds: DataFrame) -> DataFrame:
    """The schedule version that rules each ``service_date``.

    Live rule first (published on or before the date; latest active date, then
    latest creation), else the archive rule (latest start date). Dates no feed
    covers keep a null version. Feeds are listed by date, from the first to the
    last of ``dates`` at most, so the match is an equality and the choice an
    aggregate.
    """
    first, last = (dates.agg(f("service_date").cast("long")).scalar() for f in (F.min, F.max))
    asked = feeds.withColumns({"_from": F.greatest("feed_start_date", first), "_to": F.least("feed_end_date", last)})
    listed = each_date(asked, "_from", "_to").select(
        "service_date", "feed_active_date", "feed_start_date", "created_on", "static_version_key"
    )
    order = F.struct("created_on", "static_version_key")
    live = F.when(
        F.col("feed_active_date") <= F.col("service_date"), F.struct(F.col("feed_active_date"), order.alias("o"))
    )
    ruled = listed.groupBy("service_date").agg(
        F.max_by("static_version_key", live).alias("_live"),
        F.max_by("static_version_key", F.struct(F.col("feed_start_date"), order.alias("o"))).alias("_archive"),
    )
    return (
        dates.select("service_date")
        .distinct()
        .join(ruled, "service_date", "left")
        .select("service_date", F.coalesce("_live", "_archive").alias("static_version_key"))
    )


def as_of(archive: DataFrame, service_date: int) -> DataFrame:
    """Archive rows valid on a ``YYYYMMDD``: active <= date <= end."""
    return archive.filter(
        (F.col("gtfs_active_date") <= service_date) & (F.col("gtfs_end_date") >= service_date)
    ).drop("gtfs_active_date", "gtfs_end_date")


def effective_versions(feeds: DataFrame, first: str, last: str) -> DataFrame:
    """Latest feed per date: published before the date and covering it.

    ``feeds``: timestamp (epoch of publication), feed_start_date, feed_end_date, feed_version.
    """


    lower, upper = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    published = F.to_date(F.timestamp_seconds(F.col("timestamp")))
    start = F.greatest(int_date(F.col("feed_start_date")), F.date_add(published, 1), lower)
    end = F.least(int_date(F.col("feed_end_date")), upper)
    # the longest power of two of days that fits a span, laid at its start and at its end, covers it:
    # a feed gives two rows however long it is valid, and only the best feed of a block is spread over days
    days = F.pow(F.lit(2), F.length(F.bin(F.datediff("_e", "_s") + 1)) - 1).cast("int")
    blocks = (
        feeds.select("timestamp", "feed_version", start.alias("_s"), end.alias("_e"))
        .filter(F.col("_s") <= F.col("_e"))
        .withColumn("_days", days)
        .withColumn("_s", F.explode(F.array_distinct(F.array(F.col("_s"), F.date_sub("_e", F.col("_days") - 1)))))
    )
    latest = [
        F.max("timestamp").alias("timestamp"),
        F.max_by("feed_version", F.struct("timestamp", "feed_version")).alias("feed_version"),
    ]
    return (
        blocks.groupBy("_s", "_days")
        .agg(*latest)
        .withColumn("service_date", F.explode(F.sequence("_s", F.date_add("_s", F.col("_days") - 1))))
        .groupBy("service_date")
        .agg(*latest)
        .withColumnsRenamed({"timestamp": "effective_timestamp", "feed_version": "_version"})
        .select(
            "service_date",
            rating_year(F.col("_version")).alias("rating_year"),
            rating_season(F.col("_version")).alias("rating_season"),
            "effective_timestamp",
        )
    )


def max_version_per_day(trips: DataFrame, changes: DataFrame) -> DataFrame:
    """Trips of changed days carry the day's highest schedule version."""
    top = changes.groupBy("service_date").agg(F.max("static_version_key").alias("_top"))
    return (
        trips.join(top, "service_date", "left")
        .withColumn("static_version_key", F.coalesce("_top", "static_version_key"))
        .drop("_top")
    )


