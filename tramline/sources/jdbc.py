"""Database tables of the vehicle-location system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.sources.tables import conform


# Tables exported whole, with the columns the jobs use.
WHOLE_TABLES = {
    "GEO_NODE": "GEO_NODE_ID long, GEO_NODE_ABBR string",
    "ROUTE": "ROUTE_ID long, ROUTE_ABBR string",
    "TRIP": "TRIP_ID long, BLOCK_ID long, TRIP_SERIAL_NUMBER long, PATTERN_ID long, TRIP_END_TIME long, TIME_TABLE_VERSION_ID long",
    "VEHICLE": "VEHICLE_ID long, PROPERTY_TAG string",
    "TIME_POINT": "TIME_POINT_ID long, TIME_POINT_ABBR string, TIME_PT_NAME string",
    "WORK_PIECE": "WORK_PIECE_ID long, BLOCK_ID long, RUN_ID long, BEGIN_TIME long, END_TIME long, TIME_TABLE_VERSION_ID long",
    "BLOCK": "BLOCK_ID long, BLOCK_ABBR string, TIME_TABLE_VERSION_ID long",
    "RUN": "RUN_ID long, RUN_DESIGNATOR string, TIME_TABLE_VERSION_ID long",
    "OPERATOR": "OPERATOR_ID long, ONBOARD_LOGON_ID long",
    "SCHED_ADHERE_WAIVER": "WAIVER_ID long, REMARK string, MISSED_ALLOWED_FLAG long",
    "PATTERN": "PATTERN_ID long, PATTERN_ABBR string",
}


def whole_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """A whole table with its declared columns.

    With ``key`` and ``bounds`` the read is split over connections; otherwise
    one task reads it, which suits only small lookup tables.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if key and bounds:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return conform(reader.load(), T.StructType.fromDDL(WHOLE_TABLES[table]))


def daily_partitions(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    calendar_ids: Sequence[int],
    extra: str | None = None,
) -> DataFrame:
    """Rows of the chosen days, one connection per day (``CALENDAR_ID = 1YYYYMMDD``)."""
    predicates = [f"CALENDAR_ID = {int(day)}" + (f" AND {extra}" if extra else "") for day in calendar_ids]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def with_calendar_id(df: DataFrame, date: str) -> DataFrame:
    """Add the ``1YYYYMMDD`` day key used as the export partition."""
    return df.withColumn("CALENDAR_ID", F.concat(F.lit("1"), F.date_format(date, "yyyyMMdd")).cast("long"))
