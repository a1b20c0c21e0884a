"""Sources, sinks, filters and top-k (sections 2.1, 2.2, 2.3 and 2.7 of the inventory)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions import nested, times
from tramline.operators import calendar, changes, events, filters, groups, joins
from tramline.operators.scan import time_stretch
from tramline.operators.validate import in_range, not_null, quarantined
from tramline.session import scratch_path
from tramline.sinks import catalog, tables as sinks
from tramline.sinks.versions import AppendTable, DatedTable
from tramline.sources import event_bus, feeds, manifest, schedules, tables as sources
from tramline.streaming import jobs as streams
from tramline.workload.registry import query
from tramline.workload.standins import (
    POSITIONS,
    RAIL_EVENTS,
    STOP_TIMES,
    TRIPS,
    clock_text,
    epoch,
    positions,
    rail_events,
    stop_times,
    text,
    trips,
)


def _by_day(t, name="events"):
    """Events written by day, as the feeds are, in the shared folder."""
    day = t.events.select(
        "event_id",
        "event_type",
        F.col("user_id").alias("vehicle.trip"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    path = scratch_path(t.spark, name)
    sinks.write_partitioned(day, path, ["year", "month", "day"])
    return path


@query("""
SELECT event_id, event_type, CAST(NULL AS BIGINT) AS occupancy FROM events WHERE event_type IN ('click', 'purchase')
""")
def scan_project_fill(t):
    schema = T.StructType.fromDDL("event_id long, event_type string, occupancy long")
    return sources.scan_project(
        t.spark, [f"{t.sf_dir}/events.parquet"], schema, F.col("event_type").isin("click", "purchase")
    )


@query("""
SELECT event_id, event_type, user_id AS vehicle_trip, CAST(day(ts) AS BIGINT) AS day FROM events WHERE month(ts) = 1 AND day(ts) >= 20
""")
def scan_hive_partitions(t):
    found = sources.scan_partitions(t.spark, _by_day(t), (F.col("month") == 1) & (F.col("day") >= 20))
    return nested.underscore_names(found).select("event_id", "event_type", "vehicle_trip", F.col("day").cast("long"))


@query("""
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-02-09'
""")
def scan_date_range(t):
    return sources.scan_date_range(t.spark, _by_day(t), "2024-01-05", "2024-02-09").select("event_id", "event_type")


@query("""
SELECT event_id, event_type, user_id AS vehicle_trip FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-19'
""")
def read_ymd(t):
    return sources.read_ymd(t.spark, _by_day(t), "2024-01-05", "2024-01-19").select("event_id", "event_type", "vehicle_trip")


def _documents(t):
    """Feed documents, one per event: a header and one vehicle. Errors are damaged texts."""
    p = positions(t)
    trip = F.struct("trip_id", "route_id", F.col("direction_id").cast("int").alias("direction_id"), "start_time")
    entity = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            trip.alias("trip"),
            F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label")).alias("vehicle"),
            F.col("stop_sequence").alias("current_stop_sequence"),
            F.col("stop_id"),
            F.col("epoch").alias("timestamp"),
            F.col("current_status"),
        ).alias("vehicle"),
    )
    whole = F.to_json(F.struct(F.struct(F.col("epoch").alias("timestamp")).alias("header"), F.array(entity).alias("entity")))
    cut = F.when(F.col("event_type") == "error", F.substring(whole, 2, 20)).otherwise(whole)
    return p.select(F.concat(F.lit("p/"), F.col("event_id").cast("string")).alias("path"), cut.alias("document"))


@query(f"""
WITH {POSITIONS}
SELECT CAST(event_id AS VARCHAR) AS id, trip_id, vehicle_label AS label, stop_sequence AS seq, current_status AS status, epoch AS feed_timestamp,
  CAST(year(vehicle_timestamp) AS BIGINT) AS year, CAST(month(vehicle_timestamp) AS BIGINT) AS month, CAST(day(vehicle_timestamp) AS BIGINT) AS day
FROM positions WHERE event_type <> 'error'
""")
def feed_json_to_rows(t):
    flat = nested.underscore_names(
        feeds.flat_positions(feeds.entity_rows(feeds.parse_documents(_documents(t), feeds.POSITIONS_ENTITY)))
    )
    return flat.select(
        "id",
        F.col("vehicle_trip_trip_id").alias("trip_id"),
        F.col("vehicle_vehicle_label").alias("label"),
        F.col("vehicle_current_stop_sequence").alias("seq"),
        F.col("vehicle_current_status").alias("status"),
        "feed_timestamp",
        *[F.col(c).cast("long") for c in ("year", "month", "day")],
    )


@query("""
SELECT 'p/' || event_id AS path FROM events WHERE event_type = 'error'
""")
def feed_json_errors(t):
    return feeds.damaged(feeds.parse_documents(_documents(t), feeds.POSITIONS_ENTITY))


_NAMES_SQL = """(SELECT event_id, ts, 'in/' || strftime(ts, '%Y/%m/%d/') || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '_' ||
  CASE event_type WHEN 'view' THEN 'https_cdn_realtime_VehiclePositions_enhanced.json.gz' WHEN 'click' THEN 'https_cdn_realtime_TripUpdates_enhanced.json.gz'
  WHEN 'purchase' THEN 'https_cdn_GTFS.zip' WHEN 'signup' THEN 'https_cdn_realtime_Alerts_enhanced.json.gz' ELSE 'notes.txt' END AS path FROM events)"""


def _named_files(t):
    name = (
        F.when(F.col("event_type") == "view", "https_cdn_realtime_VehiclePositions_enhanced.json.gz")
        .when(F.col("event_type") == "click", "https_cdn_realtime_TripUpdates_enhanced.json.gz")
        .when(F.col("event_type") == "purchase", "https_cdn_GTFS.zip")
        .when(F.col("event_type") == "signup", "https_cdn_realtime_Alerts_enhanced.json.gz")
        .otherwise("notes.txt")
    )
    path = F.concat(
        F.lit("in/"), F.date_format("ts", "yyyy/MM/dd/"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z_"), name
    )
    return t.events.select("event_id", path.alias("path"))


@query(f"""
SELECT event_id, CASE WHEN path LIKE '%realtime_Alerts%' THEN 'RT_ALERTS' WHEN path LIKE '%realtime_TripUpdates%' THEN 'RT_TRIP_UPDATES'
  WHEN path LIKE '%realtime_VehiclePositions%' THEN 'RT_VEHICLE_POSITIONS' WHEN path LIKE '%GTFS.zip' THEN 'SCHEDULE' ELSE 'ERROR' END AS feed
FROM {_NAMES_SQL}
""")
def feed_config_route(t):
    return _named_files(t).select("event_id", manifest.feed_type(F.col("path")).alias("feed"))


@query(f"""
SELECT event_id, file_type, stamp, row_number() OVER (PARTITION BY file_type ORDER BY stamp, path, event_id) AS position
FROM (SELECT event_id, path, regexp_extract(split_part(path, '/', 5), '^[^_]*_(.*)$', 1) AS file_type, substr(split_part(path, '/', 5), 1, 20) AS stamp
  FROM {_NAMES_SQL})
""")
def group_sort_files(t):
    # paths of one second and type are equal, so the id takes part in the path
    return manifest.grouped_and_sorted(_named_files(t), tie=("event_id",)).select("event_id", "file_type", "stamp", "position")


@query("""
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name, CASE WHEN p_size > 25 THEN NULL ELSE p_brand END AS parent_station,
  CAST(NULL AS DOUBLE) AS stop_lat, CAST(20240601 AS BIGINT) AS timestamp FROM part
""")
def schedule_csv_versioned(t):
    stops = t.part.select(
        F.col("p_partkey").alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        F.when(F.col("p_size") > 25, "  ").otherwise(F.col("p_brand")).alias("parent_station"),
        F.col("p_type").alias("not_declared"),
    )
    path = scratch_path(t.spark, "stops-csv")
    stops.write.option("header", "true").csv(path)
    table = schedules.with_version(schedules.read_csv_table(t.spark, path, "stops"), 20240601)
    return table.select("stop_id", "stop_name", "parent_station", "stop_lat", "timestamp")


@query("""
SELECT DISTINCT c_mktsegment AS route_id, CAST(c_nationkey AS BIGINT) AS route_type, CAST(NULL AS VARCHAR) AS line_id,
  CAST(20240102 AS BIGINT) AS gtfs_active_date, CAST(20241231 AS BIGINT) AS gtfs_end_date
FROM (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer)
""")
def archive_csv_conform(t):
    raw = t.customer.select(
        F.when(F.col("c_acctbal") < 0, "   ").otherwise(F.col("c_mktsegment")).alias("route_id"),
        F.col("c_nationkey").cast("string").alias("route_type"),
        F.col("c_name").alias("unexpected"),
    ).select("route_id", "route_type")
    table = schedules.with_validity(schedules.conform_text(raw, schedules.table_schema("routes")), 20240101)
    return table.select("route_id", "route_type", "line_id", "gtfs_active_date", "gtfs_end_date")


# twenty years on, so that two-digit years read as the same century in every engine
_INDEX_SQL = """later AS (SELECT o_orderkey, o_orderstatus, o_orderdate + INTERVAL 7305 DAY AS o_orderdate FROM orders),
idx AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS feed_start_date,
    CASE WHEN o_orderstatus = 'P' THEN 'unclear' WHEN o_orderstatus = 'O' THEN 'Fall ' || strftime(o_orderdate + INTERVAL 15 HOUR, '%Y-%m-%dT%H:%M:%S') || '+00:00'
      ELSE 'Spring ' || month(o_orderdate) || '/' || day(o_orderdate) || '/' || strftime(o_orderdate, '%y') END AS feed_version,
    'u/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS archive_url, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS published_date, o_orderstatus
  FROM later),
ordered AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY published_date ORDER BY feed_start_date DESC,
    CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END DESC, archive_url DESC) AS n FROM idx WHERE o_orderstatus <> 'P') WHERE n = 1)"""


def _index(t):
    day = F.col("o_orderdate") + F.expr("INTERVAL 7305 DAYS")
    iso = F.concat(F.lit("Fall "), F.date_format(day + F.expr("INTERVAL 15 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    short = F.concat(F.lit("Spring "), F.date_format(day, "M/d/yy"))
    return t.orders.select(
        F.date_format(day, "yyyyMMdd").cast("long").alias("feed_start_date"),
        F.when(F.col("o_orderstatus") == "P", "unclear").when(F.col("o_orderstatus") == "O", iso).otherwise(short).alias("feed_version"),
        F.concat(F.lit("u/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("archive_url"),
    )


@query(f"""
WITH {_INDEX_SQL}
SELECT feed_start_date, feed_version, archive_url, published_date FROM ordered
""")
def schedule_index_ordered(t):
    return manifest.schedule_index(_index(t)).select("feed_start_date", "feed_version", "archive_url", "published_date")


@query(f"""
WITH {_INDEX_SQL}
SELECT archive_url, published_date FROM ordered WHERE published_date > 20190000 AND feed_version NOT IN (
  SELECT 'Spring ' || month(l_shipdate + INTERVAL 7305 DAY) || '/' || day(l_shipdate + INTERVAL 7305 DAY) || '/' || strftime(l_shipdate + INTERVAL 7305 DAY, '%y') FROM lineitem WHERE l_linestatus = 'O')
""")
def schedules_to_process(t):
    archived = t.lineitem.filter(F.col("l_linestatus") == "O").select(
        F.concat(F.lit("Spring "), F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 7305 DAYS"), "M/d/yy")).alias("feed_version")
    )
    recent = manifest.schedules_to_process(manifest.schedule_index(_index(t)), archived.distinct(), 2019)
    return recent.select("archive_url", "published_date")


@query("""
WITH src AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem), done AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT DISTINCT strftime(d, '%Y-%m-%d') AS service_date FROM (
  SELECT d FROM src WHERE d NOT IN (SELECT d FROM done) UNION ALL (SELECT d FROM src ORDER BY d DESC LIMIT 2))
""")
def jdbc_daily_partitions(t):
    source = t.lineitem.select(F.to_date("l_shipdate").alias("service_date"))
    done = t.orders.select(F.to_date("o_orderdate").alias("service_date"))
    return manifest.dates_to_export(source, done, "service_date").select(text(F.col("service_date")).alias("service_date"))


def _manifest(t):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    feed = F.when(F.col("event_type").isin("click", "purchase"), "/RT_TRIP_UPDATES/").otherwise("/RT_VEHICLE_POSITIONS/")
    path = F.concat(F.lit("lake"), feed, F.date_format(hour, "'year='y'/month='M'/day='d'/hour='H'/'"), F.col("event_id").cast("string"))
    return t.events.select("event_id", path.alias("path"), (F.col("event_type") == "error").alias("processed"))


_MANIFEST_SQL = """manifest AS (SELECT event_id, event_type = 'error' AS processed, date_trunc('hour', ts) AS hr,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'RT_TRIP_UPDATES' ELSE 'RT_VEHICLE_POSITIONS' END AS feed FROM events)"""


@query(f"""
WITH {_MANIFEST_SQL}
SELECT event_id, feed, strftime(hr, '%Y-%m-%d %H:%M:%S') AS partition_time FROM manifest WHERE NOT processed
  AND hr IN (SELECT DISTINCT hr FROM manifest WHERE NOT processed ORDER BY hr LIMIT 12)
""")
def unprocessed_files(t):
    files = _manifest(t).withColumn("partition_time", manifest.partition_time(F.col("path")))
    todo = manifest.unprocessed(files, ["/RT_VEHICLE_POSITIONS/", "/RT_TRIP_UPDATES/"], groups=12)
    return todo.select(
        "event_id", F.split_part("path", F.lit("/"), F.lit(2)).alias("feed"), clock_text(F.col("partition_time")).alias("partition_time")
    )


@query("""
SELECT event_id, strftime(CAST(d AS DATE), '%Y-%m-%d') AS service_date FROM (
  SELECT event_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup' OR hour(ts) > 2
  UNION ALL SELECT event_id, CAST(ts AS DATE) - 1 FROM events WHERE event_type <> 'signup' AND hour(ts) <= 8)
""")
def service_date_files(t):
    files = t.events.select(
        "event_id", F.col("ts").cast("timestamp").alias("partition_time"), (F.col("event_type") != "signup").alias("is_hourly")
    )
    return manifest.service_dates(files).select("event_id", text(F.col("service_date")).alias("service_date"))


@query("""
SELECT event_id FROM (SELECT event_id, event_type = 'signup' AS daily, max(event_type = 'signup') OVER (PARTITION BY date_trunc('hour', ts)) AS whole FROM events)
WHERE daily OR NOT whole
""")
def prefer_daily_file(t):
    files = t.events.select(
        "event_id", F.date_trunc("hour", "ts").alias("prefix"), (F.col("event_type") == "signup").alias("is_daily")
    )
    return manifest.prefer_daily(files).select("event_id")


@query("""
SELECT event_id, strftime(CASE WHEN event_type = 'view' THEN date_trunc('second', ts) ELSE date_trunc('hour', ts) END, '%Y-%m-%d %H:%M:%S') AS at,
  strftime(ts, '%Y-%m-%d') AS day FROM events
""")
def path_partition_time(t):
    hive = F.date_format("ts", "'x/year='y'/month='M'/day='d'/hour='H'/f.parquet'")
    stamped = F.concat(F.lit("x/timestamp="), epoch(F.col("ts")).cast("string"), F.lit("/f.parquet"))
    path = F.when(F.col("event_type") == "view", stamped).otherwise(hive)
    daily = F.concat(F.lit("tm/1"), F.date_format("ts", "yyyyMMdd"), F.lit(".parquet"))
    return t.events.select(
        "event_id",
        clock_text(manifest.partition_time(path)).alias("at"),
        text(manifest.name_date(daily)).alias("day"),
    )


def _bus_records(t):
    """Event-bus records: the event type decides the payload."""
    e = F.col("event_id").cast("string")
    empty = F.struct(F.lit("x").alias("note"))
    day = F.date_format("ts", "yyyy-MM-dd")
    changes_ = F.to_json(F.struct(F.array(F.struct(F.lit("start").alias("type")), F.struct(F.lit("stop").alias("type"))).alias("changes")))
    operator = F.to_json(F.struct(F.struct(F.col("user_id").cast("string").alias("badgeNumber")).alias("operator")))
    updates = F.to_json(F.struct(F.array(F.struct(F.lit("u").alias("type"), F.struct(F.col("value").alias("n")).alias("cars"))).alias("tripUpdates")))
    vehicle = F.to_json(F.struct(e.alias("vehicleId"), F.struct(day.alias("serviceDate")).alias("tripKey")))
    data = (
        F.when(F.col("event_type") == "view", changes_)
        .when(F.col("event_type") == "click", operator)
        .when(F.col("event_type") == "purchase", updates)
        .when(F.col("event_type") == "signup", vehicle)
        .otherwise(F.to_json(empty))
    )
    envelope = F.concat(
        F.lit('{"id":"'), e, F.lit('","type":"t","time":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('Z","source":"s","specversion":"1.0","data":'), data, F.lit("}"),
    )
    return t.events.select(envelope.alias("value"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS at, CASE event_type WHEN 'view' THEN 'editor_changes' WHEN 'click' THEN 'operator_sign_ins'
  WHEN 'purchase' THEN 'trip_updates' WHEN 'signup' THEN 'vehicle_trip_assignment' ELSE 'unknown' END AS kind FROM events
""")
def event_bus_route(t):
    routed = event_bus.route_records(_bus_records(t))
    return routed.select("id", F.unix_timestamp("time").alias("at"), "kind")


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, 'editor_changes' AS kind, unnest(['start', 'stop']) AS detail FROM events WHERE event_type = 'view'
UNION ALL SELECT CAST(event_id AS VARCHAR), 'operator_sign_ins', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'click' AND user_id IS NOT NULL
UNION ALL SELECT CAST(event_id AS VARCHAR), 'trip_updates', 'u' FROM events WHERE event_type = 'purchase'
UNION ALL SELECT CAST(event_id AS VARCHAR), 'vehicle_trip_assignment', strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'signup'
""")
def event_bus_append(t):
    """One stream over all records, in several batches, to the tables of the four kinds."""
    folder = scratch_path(t.spark, "bus")
    _bus_records(t).repartition(3).write.text(folder)
    details = {
        "editor_changes": "data_changes_type", "operator_sign_ins": "data_operator_badgeNumber",
        "trip_updates": "data_tripUpdates_type", "vehicle_trip_assignment": "data_tripKey_serviceDate",
    }
    nothing = event_bus.route_records(t.spark.createDataFrame([], "value string"))
    tables = {
        kind: AppendTable(t.spark, scratch_path(t.spark, kind), event_bus.typed_table(nothing, kind).schema) for kind in details
    }
    lines = t.spark.readStream.format("text").option("maxFilesPerTrigger", 2).load(folder)
    run = streams.event_bus_append(t.spark, lines, tables, scratch_path(t.spark, "bus-aside"), scratch_path(t.spark, "bus-progress"))
    run.awaitTermination()
    rows = [tables[k].latest().select("id", F.lit(k).alias("kind"), F.col(c).alias("detail")) for k, c in details.items()]
    return reduce(DataFrame.unionByName, rows)


@query(f"""
WITH {POSITIONS}
SELECT event_id AS id, trip_id, stop_sequence, epoch AS timestamp FROM positions
""")
def jsonl_state_source(t):
    state = positions(t).select(F.col("event_id").alias("id"), "trip_id", "stop_sequence", F.col("epoch").alias("timestamp"))
    path = scratch_path(t.spark, "snapshot")
    sinks.write_snapshot(state, path, ["timestamp", "id"])
    return sinks.read_snapshot(t.spark, path, state.schema)


# Sinks ---------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders
""")
def write_partitioned(t):
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    sinks.write_partitioned(rows, path, ["year"], sort=["o_custkey"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("year").cast("long"))


_FEED_SQL = f"""{POSITIONS},
feed AS (SELECT route_id, trip_id, stop_sequence, event_type, epoch AS feed_timestamp, epoch // 86400 AS day FROM positions),
cut AS (SELECT day, min(feed_timestamp) - 2700 AS c FROM feed WHERE event_type IN ('view', 'click') AND day % 3 > 0 AND feed_timestamp % 86400 > 43200 GROUP BY 1)"""


@query(f"""
WITH {_FEED_SQL}
SELECT route_id, trip_id, stop_sequence, event_type, feed_timestamp FROM feed LEFT JOIN cut USING (day) WHERE c IS NULL OR feed_timestamp < c
UNION ALL SELECT route_id, trip_id, stop_sequence, event_type, min(feed_timestamp) FROM feed JOIN cut USING (day) WHERE feed_timestamp >= c GROUP BY 1, 2, 3, 4, day
""")
def daily_feed_merge(t):
    feed = positions(t).select("route_id", "trip_id", "stop_sequence", "event_type", F.col("epoch").alias("feed_timestamp"))
    at = F.col("feed_timestamp")
    # every day has its own first new row; days without new rows stay as they are
    is_new = F.col("event_type").isin("view", "click") & (F.floor(at / 86400) % 3 > 0) & (at % 86400 > 43200)
    is_new = F.coalesce(is_new, F.lit(False))
    payload = ["route_id", "trip_id", "stop_sequence", "event_type"]
    return sinks.merge_daily_feed(feed.filter(~is_new), feed.filter(is_new), payload, [F.floor(at / 86400)])


@query(f"""
WITH {POSITIONS}
SELECT event_id, route_id, epoch AS feed_timestamp FROM positions WHERE route_id IN ('Red','Orange','Blue','Green-B','Green-C','Green-D','Green-E','Mattapan')
""")
def daily_feed_rail_side(t):
    rail = filters.route_filters(F.col("route_id"))["rail"]
    return positions(t).filter(rail).select("event_id", "route_id", F.col("epoch").alias("feed_timestamp"))


@query("""
WITH processed AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem), archived AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F'),
renewed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P')
SELECT strftime(d, '%Y-%m-%d') AS service_date FROM (SELECT d FROM processed WHERE d NOT IN (SELECT d FROM archived) UNION SELECT d FROM renewed)
""")
def dates_to_update(t):
    day = F.to_date("o_orderdate").alias("d")
    found = changes.missing_or_renewed(
        t.lineitem.select(F.to_date("l_shipdate").alias("d")),
        t.orders.filter(F.col("o_orderstatus") == "F").select(day),
        t.orders.filter(F.col("o_orderstatus") == "P").select(day),
        "d",
    )
    return found.select(text(F.col("d")).alias("service_date"))


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS service_date, 'https://host/' || strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderkey || '.parquet' AS file_url,
  o_custkey AS size_bytes FROM orders WHERE o_orderstatus <> 'P'
""")
def file_index_csv(t):
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))
    files = t.orders.select(
        F.concat(F.lit("s3/out/"), F.when(F.col("o_orderstatus") == "P", "notes.txt").otherwise(name)).alias("path"),
        F.col("o_custkey").alias("size_bytes"),
        F.col("o_orderdate").alias("last_modified"),
    )
    path = f"{scratch_path(t.spark, 'index')}.csv"
    sinks.write_index(sinks.file_index(files, "https://host/").drop("last_modified"), path)
    return t.spark.read.option("header", "true").schema("service_date string, file_url string, size_bytes long").csv(path)


@query("""
SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS absent, ROUND(value * 2, 4) AS doubled FROM events
WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 7 FROM events) AND event_type <> 'error'
""")
def rolling_window_extract(t):
    schema = T.StructType.fromDDL("event_id long, user_id long, value double, absent string, doubled double")
    return sinks.rolling_window(
        t.events.withColumn("day", F.to_date("ts")),
        "day",
        7,
        schema,
        F.col("event_type") != "error",
        lambda df: df.withColumn("doubled", F.round(F.col("value") * 2, 4)),
    )


@query("""
WITH stored AS (SELECT * FROM events WHERE event_type <> 'signup'), cut AS (SELECT max(CAST(ts AS DATE)) - 1 AS c FROM stored)
SELECT event_id, 'stored' AS origin FROM stored, cut WHERE CAST(ts AS DATE) < c UNION ALL SELECT event_id, 'again' FROM events, cut WHERE CAST(ts AS DATE) >= c
""")
def replace_recent_partitions(t):
    all_rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("service_date"))
    stored = all_rows.filter(F.col("event_type") != "signup").withColumn("origin", F.lit("stored"))
    table = DatedTable(t.spark, scratch_path(t.spark, "dated"), stored.schema, "service_date")
    table.write(stored, 0)
    table.replace_recent(all_rows.withColumn("origin", F.lit("again")))
    return table.latest().select("event_id", "origin")


@query(f"""
WITH {TRIPS}
SELECT trip_id, static_version_key FROM trips WHERE static_version_key > (SELECT max(static_version_key) FROM trips WHERE static_version_key < 1999)
""")
def append_newer_versions(t):
    table = trips(t).select("trip_id", "static_version_key")
    return changes.newer_versions(table.filter(F.col("static_version_key") < 1999), table, "static_version_key")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE strftime(o_orderdate, '%Y-%m') END AS start_month FROM orders
""")
def alerts_append_by_month(t):
    path = scratch_path(t.spark, "alerts")
    start = F.when(F.col("o_orderstatus") != "P", epoch(F.col("o_orderdate")))
    sinks.append_by_month(t.orders.select("o_orderkey", start.alias("start_timestamp")), path, "start_timestamp")
    return t.spark.read.parquet(path).select("o_orderkey", F.col("start_month").cast("string"))


@query("""
SELECT c_custkey, true AS replaced, false AS shrunk FROM customer
""")
def guarded_replace(t):
    path = scratch_path(t.spark, "customers")
    replaced = sinks.guarded_replace(t.spark, t.customer, path)
    shrunk = sinks.guarded_replace(t.spark, t.customer.filter(F.col("c_acctbal") > 0), path)
    return sinks.published(t.spark, path).select("c_custkey", F.lit(replaced).alias("replaced"), F.lit(shrunk).alias("shrunk"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'c_acctbal|min' END || CASE WHEN c_nationkey > 20 THEN ',c_nationkey|max' ELSE '' END AS reasons
FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'c_nationkey|max' FROM customer WHERE c_acctbal >= 0 AND c_nationkey > 20
""")
def quarantine_invalid(t):
    rules = {**not_null("c_mktsegment"), **in_range("c_acctbal", low=0), **in_range("c_nationkey", high=20)}
    return quarantined(t.customer, rules, ["c_custkey"]).select("c_custkey", F.array_join("reasons", ",").alias("reasons"))


@query("""
SELECT event_type, event_id FROM events
""")
def jsonl_snapshot_sink(t):
    path = scratch_path(t.spark, "jsonl")
    rows = t.events.select("event_type", "event_id")
    sinks.write_snapshot(rows, path, ["event_type", "event_id"])
    return sinks.read_snapshot(t.spark, path, rows.schema)


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS trips FROM events GROUP BY 1
""")
def catalog_views(t):
    catalog.create_views(t.spark, {"daily_positions": _by_day(t, "published")})
    return t.spark.sql(
        "SELECT event_type, count(*) AS n, count(DISTINCT vehicle_trip) AS trips FROM daily_positions GROUP BY event_type"
    )


@query("""
SELECT c_custkey, CAST(c_custkey AS BIGINT) AS unsigned, CAST(c_acctbal AS FLOAT)::DOUBLE AS balance FROM customer
""")
def typed_export(t):
    raw = t.customer.select(
        "c_custkey", F.col("c_custkey").cast("decimal(20,0)").alias("unsigned"), F.col("c_acctbal").cast("float").alias("balance")
    )
    return sinks.typed_export(raw)


@query(f"""
WITH {RAIL_EVENTS}
SELECT strftime(strptime(CAST(service_date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS service_date, pm_trip_id, stop_sequence, stop_id, vp_move_timestamp,
  vp_stop_timestamp, tu_stop_timestamp FROM rail_events
""")
def table_exports(t):
    return rail_events(t).select(
        text(times.int_date(F.col("service_date"))).alias("service_date"),
        "pm_trip_id", "stop_sequence", "stop_id", "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp",
    )


# Filters -------------------------------------------------------------------


@query(f"""
WITH {POSITIONS}
SELECT event_id, route_id, CASE WHEN current_status = 'INCOMING_AT' THEN 'IN_TRANSIT_TO' ELSE current_status END AS current_status FROM positions
WHERE route_id IN ('39', 'CR-Line') AND strftime(service_date, '%Y%m%d') = '20240108' AND NOT (k < 10)
""")
def vp_bus_filter(t):
    p = positions(t).select(
        "event_id",
        "route_id",
        "trip_id",
        "vehicle_id",
        "start_time",
        "current_status",
        F.date_format("service_date", "yyyyMMdd").alias("start_date"),
        F.when(F.col("k") >= 10, F.col("stop_id")).alias("stop_id"),
        F.col("epoch").alias("timestamp"),
    )
    routes = p.filter(F.col("route_id").isin("39", "CR-Line")).select("route_id").distinct()
    return filters.bus_positions(p, routes, "20240108").select("event_id", "route_id", "current_status")


def _rail_vp(t):
    return positions(t).select(
        "event_id", "route_id", "trip_id", "vehicle_id", "direction_id", "current_status", "start_time", "stop_id",
        F.date_format("service_date", "yyyyMMdd").alias("start_date"),
        (F.col("stop_sequence") - 2).alias("current_stop_sequence"),
        F.col("epoch").alias("vehicle_timestamp"),
        F.when(F.col("k") > 90, False).when(F.col("k") > 50, True).alias("revenue"),
    )


@query(f"""
WITH {POSITIONS}
SELECT event_id FROM positions WHERE stop_sequence - 2 >= 0 AND route_id IN ('Red', 'Orange', 'Blue')
""")
def vp_rail_filter(t):
    return filters.rail_positions(_rail_vp(t), filters.HEAVY_RAIL_ROUTES).select("event_id")


@query(f"""
WITH {POSITIONS}
SELECT event_id, current_status <> 'STOPPED_AT' AS is_moving, NOT (k > 90) AS revenue, CAST(strftime(service_date, '%Y%m%d') AS BIGINT) AS service_date,
  CAST(substr(start_time, 1, 2) AS BIGINT) * 3600 + CAST(substr(start_time, 4, 2) AS BIGINT) * 60 AS start_time FROM positions
""")
def vp_rail_types(t):
    return events.rail_position_types(_rail_vp(t)).select("event_id", "is_moving", "revenue", "service_date", "start_time")


_UPDATES_SQL = f"""{POSITIONS},
updates AS (SELECT event_id, CAST(strftime(service_date, '%Y%m%d') AS BIGINT) AS service_date, route_id, trip_id, parent_station,
  epoch + (k - 20) * 3 AS tu_stop_timestamp, CASE WHEN event_type <> 'view' THEN epoch END AS timestamp, epoch - 5 AS feed_timestamp FROM positions),
near AS (SELECT *EXCLUDE (timestamp, feed_timestamp), coalesce(timestamp, feed_timestamp) AS timestamp FROM updates
  WHERE tu_stop_timestamp - coalesce(timestamp, feed_timestamp) >= 0 AND tu_stop_timestamp - coalesce(timestamp, feed_timestamp) < 120)"""


def updates(t):
    return positions(t).select(
        "event_id",
        F.date_format("service_date", "yyyyMMdd").cast("long").alias("service_date"),
        "route_id",
        "trip_id",
        "parent_station",
        (F.col("epoch") + (F.col("k") - 20) * 3).alias("tu_stop_timestamp"),
        F.when(F.col("event_type") != "view", F.col("epoch")).alias("timestamp"),
        (F.col("epoch") - 5).alias("feed_timestamp"),
    )


@query(f"""
WITH {_UPDATES_SQL}
SELECT event_id, tu_stop_timestamp, timestamp FROM near
""")
def tu_horizon_filter(t):
    return events.near_predictions(updates(t)).select("event_id", "tu_stop_timestamp", "timestamp")


@query(f"""
WITH {_UPDATES_SQL}
SELECT service_date, route_id, trip_id, parent_station, tu_stop_timestamp, timestamp FROM (SELECT *, row_number() OVER (
  PARTITION BY service_date, route_id, trip_id, parent_station ORDER BY timestamp DESC, tu_stop_timestamp DESC, event_id DESC) AS n FROM near) WHERE n = 1
""")
def latest_prediction(t):
    near = events.near_predictions(updates(t))
    return events.latest_prediction(near).select(
        "service_date", "route_id", "trip_id", "parent_station", "tu_stop_timestamp", "timestamp"
    )


def _terminal(t):
    p = positions(t)
    return p.select(
        "event_id",
        "stop_id",
        "trip_id",
        F.when(F.col("k") >= 10, F.col("epoch")).alias("departure_time"),
        F.when(F.col("k") >= 5, F.col("epoch")).alias("timestamp"),
        F.col("epoch").alias("feed_timestamp"),
        (F.col("event_type") != "error").alias("revenue"),
        F.when(F.col("event_type") == "view", "CANCELED").when(F.col("event_type") != "signup", "SCHEDULED").alias("schedule_relationship"),
        F.when(F.col("k") < 90, "SCHEDULED").otherwise("SKIPPED").alias("stop_schedule_relationship"),
        (F.col("k") - 30).alias("departure_uncertainty"),
    )


@query(f"""
WITH {POSITIONS}
SELECT event_id FROM positions WHERE k >= 10 AND stop_id IN ('70094', '70105', '70106') AND event_type IN ('click', 'purchase') AND k < 90 AND k - 30 > 0
""")
def terminal_prediction_filter(t):
    stops = [s for s in filters.HEAVY_RAIL_TERMINALS + filters.LIGHT_RAIL_TERMINALS]
    return filters.terminal_predictions(_terminal(t), stops).select("event_id")


@query(f"""
WITH {POSITIONS}
SELECT event_id FROM positions WHERE k >= 5 AND stop_id IN ('70092', '70104', '70106') AND event_type <> 'error'
""")
def terminal_position_filter(t):
    stops = filters.HEAVY_RAIL_NEXT_TO_TERMINALS + filters.LIGHT_RAIL_NEXT_TO_TERMINALS + filters.LIGHT_RAIL_TERMINALS
    return filters.terminal_positions(_terminal(t), stops).select("event_id")


@query(f"""
WITH {POSITIONS}
SELECT event_id, route_id = 'Green-B' AS green_b, route_id LIKE 'Green%' AS green, route_id LIKE 'Green%' OR route_id = 'Mattapan' AS light_rail,
  route_id IN ('Red', 'Orange', 'Blue') AS heavy_rail, route_id NOT IN ('39', 'CR-Line') AS rail FROM positions
""")
def route_filter_bank(t):
    bank = filters.route_filters(F.col("route_id"))
    return positions(t).select("event_id", *[bank[n].alias(n) for n in ("green_b", "green", "light_rail", "heavy_rail", "rail")])


@query(f"""
WITH {TRIPS}, {STOP_TIMES}, rail AS (SELECT r_name, r_regionkey FROM region WHERE r_regionkey < 3)
SELECT s.trip_id, s.stop_sequence, s.part FROM stop_times s WHERE s.trip_id IN (SELECT trip_id FROM trips WHERE CAST(substr(route_id, 1, 1) AS INT) - 1 IN (SELECT r_regionkey FROM rail))
""")
def drop_bus_records(t):
    routes = t.region.select(F.col("r_regionkey").cast("long").alias("route_id"), F.col("r_regionkey").alias("route_type"))
    with_route = trips(t).withColumn("route_id", F.substring("route_id", 1, 1).cast("long") - 1)
    patterns = with_route.select("route_id", F.col("trip_id").alias("representative_trip_id"))
    return filters.without_buses(routes, with_route, stop_times(t), patterns)["stop_times"].select("trip_id", "stop_sequence", "part")


@query("""
SELECT DISTINCT CAST(c_custkey AS BIGINT) AS service_id, c_nationkey = 1 AS monday, nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, '') AS holiday_name,
  CAST(c_nationkey AS BIGINT) * 3600 + 60 AS start_time, CAST(7 AS BIGINT) AS static_version_key FROM customer
""")
def static_transform(t):
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("service_id"),
        F.col("c_nationkey").cast("string").alias("monday"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("holiday_name"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(":01:00")).alias("start_time"),
        F.lit("7").alias("timestamp"),
    )
    return schedules.typed_static(raw.union(raw), ints=("service_id", "timestamp"), bools=("monday",), clocks=("start_time",))


@query("""
SELECT event_id AS "vehicle_id", user_id AS "vehicle_trip_id" FROM events
""")
def rename_dots(t):
    return nested.underscore_names(t.events.select(F.col("event_id").alias("vehicle.id"), F.col("user_id").alias("vehicle.trip.id")))


def archive(t):
    """Orders as archived rows, valid from the order date for as many days as the customer number says."""
    return t.orders.select(
        F.col("o_orderkey").alias("trip_id"),
        times.date_int(F.col("o_orderdate")).alias("gtfs_active_date"),
        times.date_int(F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 365).cast("int"))).alias("gtfs_end_date"),
    )


@query("""
SELECT o_orderkey AS trip_id FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-15' AND CAST(o_orderdate AS DATE) + CAST(o_custkey % 365 AS INT) >= DATE '1998-06-15'
""")
def as_of_schedule(t):
    return calendar.as_of(archive(t), 19980615)


@query(f"""
WITH {POSITIONS}
SELECT event_id, stop_sequence FROM (SELECT event_id, stop_sequence, min(stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_label
  ORDER BY vehicle_timestamp, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lowest FROM positions) WHERE stop_sequence <= lowest
""")
def sequence_monotone_filter(t):
    kept = events.drop_out_of_order(
        positions(t),
        ["service_date", "trip_id", "vehicle_label"],
        "stop_sequence",
        [F.col("vehicle_timestamp"), F.col("event_id")],
        time_stretch(F.col("vehicle_timestamp"), 60),
    )
    return kept.select("event_id", "stop_sequence")


@query(f"""
WITH {POSITIONS}
SELECT event_id, coalesce(CASE WHEN s_nationkey > 5 THEN 'place-' || s_nationkey END, CAST(k AS VARCHAR)) AS parent_station
FROM positions LEFT JOIN supplier ON k = s_suppkey
""")
def parent_station_fallback(t):
    stops = t.supplier.select(
        F.lit(1).alias("static_version_key"),
        F.col("s_suppkey").cast("string").alias("stop_id"),
        F.when(F.col("s_nationkey") > 5, F.concat(F.lit("place-"), F.col("s_nationkey").cast("string"))).alias("parent_station"),
    )
    seen = positions(t).select("event_id", F.lit(1).alias("static_version_key"), F.col("k").cast("string").alias("stop_id"))
    return joins.parent_station(seen, stops).select("event_id", "parent_station")


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(strftime(ts - INTERVAL 9 HOUR, '%Y%m%d') AS BIGINT) ELSE 20200101 END AS service_date FROM events
""")
def missing_service_date(t):
    known = F.when(F.col("event_type") != "view", F.lit(20200101))
    return t.events.select("event_id", times.fill_service_date(known, epoch(F.col("ts"))).alias("service_date"))


# Top-k ---------------------------------------------------------------------

_FEEDS_SQL = """feeds AS (SELECT o_orderkey AS static_version_key, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INT) AS e,
  CAST(o_orderdate AS DATE) + CAST(o_custkey % 7 AS INT) - 3 AS active, o_custkey AS created_on FROM orders)"""


def feed_versions(t):
    day = F.to_date("o_orderdate")
    cust = F.col("o_custkey")
    return t.orders.select(
        F.col("o_orderkey").alias("static_version_key"),
        times.date_int(day).alias("feed_start_date"),
        times.date_int(F.date_add(day, (cust % 90).cast("int"))).alias("feed_end_date"),
        times.date_int(F.date_add(day, (cust % 7 - 3).cast("int"))).alias("feed_active_date"),
        cust.alias("created_on"),
    )


@query(f"""
WITH {_FEEDS_SQL}, dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
ranked AS (SELECT d, static_version_key, active <= d AS live, row_number() OVER (PARTITION BY d ORDER BY CASE WHEN active <= d THEN 0 ELSE 1 END,
    CASE WHEN active <= d THEN active ELSE s END DESC, created_on DESC, static_version_key DESC) AS n
  FROM dates JOIN feeds ON s <= d AND d <= e)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS service_date, static_version_key FROM dates LEFT JOIN (SELECT d, static_version_key FROM ranked WHERE n = 1) USING (d)
""")
def version_for_date(t):
    dates = t.lineitem.select(times.date_int(F.col("l_shipdate")).alias("service_date"))
    return calendar.version_for_dates(dates, feed_versions(t))


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, route_id, pm_trip_id, seq, stop_id FROM (SELECT *, row_number() OVER (PARTITION BY service_date, route_id, pm_trip_id ORDER BY seq DESC NULLS FIRST, stop_id) AS n
  FROM (SELECT *, CASE WHEN vp_move_timestamp IS NOT NULL THEN stop_sequence END AS seq FROM rail_events)) WHERE n = 1
""")
def distinct_on_latest(t):
    seen = rail_events(t).withColumn("seq", F.when(F.col("vp_move_timestamp").isNotNull(), F.col("stop_sequence")))
    latest = changes.distinct_on_latest(
        seen.select("service_date", "route_id", "pm_trip_id", "seq", "stop_id"), ["service_date", "route_id", "pm_trip_id"], "seq", [F.col("stop_id")]
    )
    return latest.select("service_date", "route_id", "pm_trip_id", "seq", "stop_id")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence FROM (SELECT *, row_number() OVER (PARTITION BY service_date, pm_trip_id ORDER BY
  CAST(vp_move_timestamp IS NULL AS INT) + CAST(vp_stop_timestamp IS NULL AS INT) + CAST(tu_stop_timestamp IS NULL AS INT), stop_sequence) AS n FROM rail_events) WHERE n = 1
""")
def dedup_keep_best(t):
    from tramline.functions.rows import null_count

    best = groups.first_row(
        rail_events(t),
        ["service_date", "pm_trip_id"],
        [null_count(F.col("vp_move_timestamp"), F.col("vp_stop_timestamp"), F.col("tu_stop_timestamp")), F.col("stop_sequence")],
    )
    return best.select("service_date", "pm_trip_id", "stop_sequence")


@query("""
SELECT l_orderkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem
""")
def cluster_sort(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_linenumber").cast("long"))
    return sinks.cluster_sort(rows, ["l_suppkey", "l_orderkey"])


@query("""
SELECT epoch_us(hr) // 1000000 AS first_hour FROM (SELECT DISTINCT date_trunc('hour', ts) AS hr FROM events ORDER BY hr LIMIT 12)
""")
def oldest_n_groups(t):
    hours_ = t.events.select(epoch(F.date_trunc("hour", "ts")).alias("first_hour"))
    return manifest.oldest_groups(hours_, "first_hour", 12)


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders WHERE o_orderpriority = '2-HIGH') WHERE n = 1
""")
def last_modified_version(t):
    objects = t.orders.select(
        "o_custkey",
        F.col("o_orderpriority").alias("version"),
        F.col("o_orderdate").alias("last_modified"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"),
        "o_orderkey",
    )
    return manifest.latest_of_version(objects, "2-HIGH", ["o_custkey"]).select("o_custkey", "o_orderkey")
