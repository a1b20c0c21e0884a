"""Published schedules: CSV tables made to fit declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.times import clock_seconds, date_int, int_date
from tramline.sources.tables import conform

# Columns of the published schedule tables, as their files have them.
SCHEDULE_TABLES = {
    "agency": "agency_id long, agency_name string, agency_url string, agency_timezone string, agency_lang string, agency_phone string",
    "areas": "area_id string, area_name string",
    "calendar": "service_id string, monday long, tuesday long, wednesday long, thursday long, friday long, saturday long, sunday long, start_date long, end_date long",
    "calendar_attributes": "service_id string, service_description string, service_schedule_name string, service_schedule_type string, service_schedule_typicality long, rating_start_date long, rating_end_date long, rating_description string",
    "calendar_dates": "service_id string, date long, exception_type long, holiday_name string",
    "checkpoints": "checkpoint_id string, checkpoint_name string",
    "directions": "route_id string, direction_id long, direction string, direction_destination string",
    "facilities": "facility_id string, facility_code string, facility_class long, facility_type string, stop_id string, facility_short_name string, facility_long_name string, facility_desc string, facility_lat double, facility_lon double, wheelchair_facility long",
    "facilities_properties": "facility_id string, property_id string, value string",
    "facilities_properties_definitions": "property_id string, definition string, possible_values string",
    "fare_leg_rules": "leg_group_id string, network_id string, from_area_id string, to_area_id string, fare_product_id string, from_timeframe_group_id string, to_timeframe_group_id string, transfer_only long",
    "fare_media": "fare_media_id string, fare_media_name string, fare_media_type long",
    "fare_products": "fare_product_id string, fare_product_name string, fare_media_id string, amount double, currency string",
    "fare_transfer_rules": "from_leg_group_id string, to_leg_group_id string, transfer_count long, duration_limit long, duration_limit_type long, fare_transfer_type long, fare_product_id string",
    "feed_info": "feed_publisher_name string, feed_publisher_url string, feed_lang string, feed_start_date long, feed_end_date long, feed_version string, feed_contact_email string, feed_id string",
    "levels": "level_id string, level_index double, level_name string, level_elevation string",
    "lines": "line_id string, line_short_name string, line_long_name string, line_desc string, line_url string, line_color string, line_text_color string, line_sort_order long",
    "linked_datasets": "url string, trip_updates long, vehicle_positions long, service_alerts long, authentication_type long",
    "multi_route_trips": "added_route_id string, trip_id string",
    "pathways": "pathway_id string, from_stop_id string, to_stop_id string, facility_id long, pathway_mode long, is_bidirectional long, length double, wheelchair_length double, traversal_time long, wheelchair_traversal_time long, stair_count long, max_slope double, pathway_name string, pathway_code double, signposted_as string, instructions string",
    "route_patterns": "route_pattern_id string, route_id string, direction_id long, route_pattern_name string, route_pattern_time_desc string, route_pattern_typicality long, route_pattern_sort_order long, representative_trip_id string, canonical_route_pattern long",
    "routes": "route_id string, agency_id long, route_short_name string, route_long_name string, route_desc string, route_type long, route_url string, route_color string, route_text_color string, route_sort_order long, route_fare_class string, line_id string, listed_route long, network_id string",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence long, shape_dist_traveled double",
    "stop_areas": "stop_id string, area_id string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence long, stop_headsign string, pickup_type long, drop_off_type long, timepoint long, checkpoint_id string, continuous_pickup long, continuous_drop_off long",
    "stops": "stop_id string, stop_code string, stop_name string, stop_desc string, platform_code string, platform_name string, stop_lat double, stop_lon double, zone_id string, stop_address string, stop_url string, level_id string, location_type long, parent_station string, wheelchair_boarding long, municipality string, on_street string, at_street string, vehicle_type long",
    "timeframes": "timeframe_group_id string, start_time string, end_time string, service_id string",
    "transfers": "from_stop_id string, to_stop_id string, transfer_type long, min_transfer_time long, min_walk_time long, min_wheelchair_time long, suggested_buffer_time long, wheelchair_transfer long, from_trip_id string, to_trip_id string",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, trip_short_name string, direction_id long, block_id string, shape_id string, wheelchair_accessible long, trip_route_type long, route_pattern_id string, bikes_allowed long",
    "trips_properties": "trip_id string, trip_property_id string, value string",
    "trips_properties_definitions": "trip_property_id string, definition string, possible_values string",
}


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEDULE_TABLES[table])


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A schedule CSV by its header: missing columns null, unknown ones left out."""
    return conform_text(spark.read.option("header", "true").csv(path), table_schema(table))


def conform_text(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns -> declared columns; blank text counts as null; repeats go."""
    blank = raw.select(
        *[F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )
    return conform(blank, schema).distinct()


def with_validity(df: DataFrame, published: int) -> DataFrame:
    """Archive validity: from the day after publication for a year."""


    day = int_date(F.lit(published))
    return df.withColumn("gtfs_active_date", date_int(F.date_add(day, 1))).withColumn(
        "gtfs_end_date", date_int(F.date_add(day, 365))
    )


def with_version(df: DataFrame, version: int) -> DataFrame:
    """Versioned form: every row carries the schedule's version key."""
    return df.withColumn("timestamp", F.lit(version).cast("long"))


def typed_static(
    df: DataFrame, ints: tuple[str, ...] = (), bools: tuple[str, ...] = (), clocks: tuple[str, ...] = ()
) -> DataFrame:
    """Declared conversions of a versioned table; ``timestamp`` becomes ``static_version_key``."""

    def typed(name: str, dtype: T.DataType):
        col = F.col(name)
        if name in ints:
            return col.try_cast("long")
        if name in bools:
            return F.coalesce(col.try_cast("long") == 1, F.lit(False))
        if name in clocks:
            return clock_seconds(col)
        return F.nullif(col, F.lit("")) if isinstance(dtype, T.StringType) else col

    return (
        df.distinct()
        .select(*[typed(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
        .withColumnRenamed("timestamp", "static_version_key")
    )
