"""Set operations and change data (section 2.8 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.times import date_int
from tramline.operators import calendar, changes, events
from tramline.sources import manifest
from tramline.workload.registry import query
from tramline.workload.standins import RAIL_EVENTS, rail_events, text

_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _calendar(t):
    """Orders as services: valid from the order date for up to 120 days, on the weekdays of their number's bits."""
    day = F.to_date("o_orderdate")
    flags = [F.expr(f"cast(shiftright(o_custkey, {i}) & 1 as long)").alias(d) for i, d in enumerate(_DAYS)]
    return t.orders.select(
        F.col("o_orderkey").alias("service_id"),
        F.lit(2).cast("long").alias("static_version_key"),
        date_int(day).alias("start_date"),
        date_int(F.date_add(day, (F.col("o_custkey") % 120).cast("int"))).alias("end_date"),
        *flags,
    )


def _exceptions(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("service_id"),
        F.lit(2).cast("long").alias("static_version_key"),
        date_int(F.col("l_shipdate")).alias("date"),
        F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("exception_type"),
    )


_VERSION_SPANS = ((19970101, 19980331), (19980101, 19981231), (19970601, 19990630))
_CAL_SQL = """cal AS (SELECT o_orderkey AS service_id, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_custkey % 120 AS INT) AS e, o_custkey FROM orders),
exc AS (SELECT l_orderkey AS service_id, CAST(l_shipdate AS DATE) AS d, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS kind FROM lineitem)"""


@query(f"""
WITH {_CAL_SQL}
SELECT DISTINCT service_id FROM (
  SELECT service_id FROM cal WHERE s <= DATE '1998-06-15' AND e >= DATE '1998-06-15' AND (o_custkey >> 0) & 1 = 1
    AND service_id NOT IN (SELECT service_id FROM exc WHERE d = DATE '1998-06-15' AND kind = 2)
  UNION ALL SELECT service_id FROM exc WHERE d = DATE '1998-06-15' AND kind = 1)
""")
def service_ids_for_date(t):
    # 15 June 1998 is a Monday
    return calendar.service_ids_for_date(_calendar(t), _exceptions(t), 19980615)


@query(f"""
WITH {_CAL_SQL},
feeds AS (SELECT * FROM (VALUES (0, DATE '1997-01-01', DATE '1998-03-31'), (1, DATE '1998-01-01', DATE '1998-12-31'), (2, DATE '1997-06-01', DATE '1999-06-30')) AS f(v, fs, fe)),
regular AS (SELECT service_id, d FROM (SELECT service_id, o_custkey, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM cal) WHERE (o_custkey >> ((dayofweek(d) + 6) % 7)) & 1 = 1),
services AS (SELECT service_id, d FROM regular UNION SELECT service_id, d FROM exc WHERE kind = 1)
SELECT DISTINCT o_orderpriority AS route_id, service_id, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS service_date, CAST(v AS BIGINT) AS static_version_key
FROM services JOIN orders ON service_id = o_orderkey JOIN feeds ON o_orderkey % 3 = v AND d BETWEEN fs AND fe WHERE (service_id, d) NOT IN (SELECT (service_id, d) FROM exc WHERE kind = 2)
""")
def service_id_calendar(t):
    """Three versions, each with its own services; up to three are live on a date."""
    version = F.col("service_id") % 3
    span = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in _VERSION_SPANS])
    feeds = t.region.filter("r_regionkey < 3").select(
        F.col("r_regionkey").cast("long").alias("static_version_key"), F.get(span, F.col("r_regionkey").cast("int")).alias("_s")
    ).select("static_version_key", F.col("_s.a").alias("feed_start_date"), F.col("_s.b").alias("feed_end_date"))
    service_trips = t.orders.select(F.col("o_orderkey").alias("service_id"), F.col("o_orderpriority").alias("route_id"))
    tables = [df.withColumn("static_version_key", version) for df in (_calendar(t), _exceptions(t), service_trips)]
    return calendar.service_calendar(tables[0], tables[1], feeds, tables[2])


@query("""
WITH f AS (SELECT o_orderkey AS v, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 30 AS e FROM orders)
SELECT v AS static_version_key, CAST(strftime(s, '%Y%m%d') AS BIGINT) AS feed_start_date, CAST(strftime(coalesce(lead(s) OVER (ORDER BY s, v), e) - 1, '%Y%m%d') AS BIGINT) AS feed_end_date FROM f
""")
def service_id_calendar_spans(t):
    day = F.to_date("o_orderdate")
    feeds = t.orders.select(
        F.col("o_orderkey").alias("static_version_key"), date_int(day).alias("feed_start_date"), date_int(F.date_add(day, 30)).alias("feed_end_date")
    )
    return calendar.close_spans(feeds)


@query("""
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer
""")
def diagonal_union(t):
    left = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    right = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return left.unionByName(right, allowMissingColumns=True)


_SNAP_SQL = """stored AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg, 20240000 + 101 + c_nationkey AS a, CASE WHEN c_nationkey < 5 THEN 20240301 ELSE 20241231 END AS e FROM customer),
snap AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 6000 THEN 'X' ELSE c_mktsegment END AS seg FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def _stored(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"),
        (20240101 + F.col("c_nationkey")).cast("long").alias("gtfs_active_date"),
        F.when(F.col("c_nationkey") < 5, 20240301).otherwise(20241231).cast("long").alias("gtfs_end_date"),
    )


def _snapshot(t):
    return t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") > 6000, "X").otherwise(F.col("c_mktsegment")).alias("seg"),
    )


@query(f"""
WITH {_SNAP_SQL}, ok AS (SELECT * FROM stored WHERE a <= 20240601 AND e >= 20240601)
SELECT ok.id, ok.seg, CAST(a AS BIGINT) AS gtfs_active_date, CAST(e AS BIGINT) AS gtfs_end_date, CASE WHEN snap.id IS NULL THEN 'old' ELSE 'same' END AS change
FROM ok LEFT JOIN snap ON ok.id IS NOT DISTINCT FROM snap.id AND ok.seg IS NOT DISTINCT FROM snap.seg
UNION ALL SELECT snap.id, snap.seg, 20240602, 20250601, 'new' FROM snap WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.id IS NOT DISTINCT FROM snap.id AND ok.seg IS NOT DISTINCT FROM snap.seg)
""")
def snapshot_diff(t):
    snap = _snapshot(t).withColumns(
        {"gtfs_active_date": F.lit(20240602).cast("long"), "gtfs_end_date": F.lit(20250601).cast("long")}
    )
    return changes.snapshot_diff(snap, _stored(t), 20240601, ["id", "seg"])


_SCD_SQL = f"""{_SNAP_SQL}, m AS (SELECT stored.*, a <= 20240602 AND e >= 20240602 AS touched, snap.id IS NOT NULL AS kept FROM stored LEFT JOIN snap
  ON stored.id IS NOT DISTINCT FROM snap.id AND stored.seg IS NOT DISTINCT FROM snap.seg)"""


@query(f"""
WITH {_SCD_SQL}
SELECT id, seg, CAST(a AS BIGINT) AS gtfs_active_date, CAST(CASE WHEN NOT touched THEN e WHEN kept THEN 20250601 ELSE 20240601 END AS BIGINT) AS gtfs_end_date FROM m
UNION ALL SELECT id, seg, 20240602, 20250601 FROM snap WHERE NOT EXISTS (SELECT 1 FROM m WHERE touched AND m.id IS NOT DISTINCT FROM snap.id AND m.seg IS NOT DISTINCT FROM snap.seg)
""")
def scd2_merge(t):
    return changes.scd2_merge(_snapshot(t), _stored(t), 20240601, ["id", "seg"])


@query(f"""
WITH {_SNAP_SQL}, m AS (SELECT stored.*, a <= 20241231 AND e >= 20241231 AS touched, snap.id IS NOT NULL AS kept FROM stored LEFT JOIN snap
  ON stored.id IS NOT DISTINCT FROM snap.id AND stored.seg IS NOT DISTINCT FROM snap.seg)
SELECT id, seg, CAST(a AS BIGINT) AS gtfs_active_date, CAST(e AS BIGINT) AS gtfs_end_date FROM m WHERE NOT touched
UNION ALL SELECT id, seg, a, 20241231 FROM m WHERE touched
UNION ALL SELECT id, seg, 20250101, CASE WHEN kept THEN 20260110 ELSE 20250110 END FROM m WHERE touched
UNION ALL SELECT id, seg, 20250111, 20260110 FROM snap WHERE NOT EXISTS (SELECT 1 FROM m WHERE touched AND m.id IS NOT DISTINCT FROM snap.id AND m.seg IS NOT DISTINCT FROM snap.seg)
""")
def scd2_new_year(t):
    return changes.scd2_merge(_snapshot(t), _stored(t), 20250110, ["id", "seg"])


_PAIR_SQL = f"""{RAIL_EVENTS},
s AS (SELECT service_date, pm_trip_id, parent_station, stop_sequence, vp_move_timestamp, vp_stop_timestamp, CAST(NULL AS BIGINT) AS tu_stop_timestamp FROM rail_events WHERE vp_move_timestamp IS NOT NULL),
n AS (SELECT service_date, pm_trip_id, parent_station, stop_sequence + 100 AS stop_sequence, CASE WHEN route_id LIKE 'Green%' THEN vp_move_timestamp - 60 ELSE vp_move_timestamp + 60 END AS vp_move_timestamp,
  vp_stop_timestamp - 30 AS vp_stop_timestamp, tu_stop_timestamp FROM rail_events WHERE vp_stop_timestamp IS NOT NULL),
j AS (SELECT coalesce(s.service_date, n.service_date) AS service_date, coalesce(s.pm_trip_id, n.pm_trip_id) AS pm_trip_id, coalesce(s.parent_station, n.parent_station) AS parent_station,
    s.service_date IS NULL AS is_new, n.service_date IS NULL AS untouched, s.stop_sequence AS s_seq, n.stop_sequence AS n_seq, s.vp_move_timestamp AS s_move, n.vp_move_timestamp AS n_move,
    s.vp_stop_timestamp AS s_stop, n.vp_stop_timestamp AS n_stop, n.tu_stop_timestamp AS n_tu,
    coalesce(n.vp_move_timestamp IS NOT NULL AND (s.vp_move_timestamp IS NULL OR s.vp_move_timestamp > n.vp_move_timestamp), false) AS moved,
    coalesce(n.vp_stop_timestamp IS NOT NULL AND (s.vp_stop_timestamp IS NULL OR s.vp_stop_timestamp > n.vp_stop_timestamp), false) AS stopped
  FROM s FULL JOIN n ON s.service_date = n.service_date AND s.pm_trip_id = n.pm_trip_id AND s.parent_station = n.parent_station)"""

_EVENT = ["service_date", "pm_trip_id", "parent_station"]


def _stored_and_new(t):
    cols = [*_EVENT, "stop_sequence", "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp"]
    e = rail_events(t)
    stored = e.filter(F.col("vp_move_timestamp").isNotNull()).withColumn("tu_stop_timestamp", F.lit(None).cast("long")).select(*cols)
    shift = F.when(F.col("route_id").startswith("Green"), -60).otherwise(60)
    new = (
        e.filter(F.col("vp_stop_timestamp").isNotNull())
        .withColumn("vp_move_timestamp", F.col("vp_move_timestamp") + shift)
        .withColumn("vp_stop_timestamp", F.col("vp_stop_timestamp") - 30)
        .withColumn("stop_sequence", F.col("stop_sequence") + 100)
        .select(*cols)
    )
    return stored, new


@query(f"""
WITH {_PAIR_SQL}
SELECT service_date, pm_trip_id, parent_station, CASE WHEN is_new OR moved OR stopped THEN n_seq ELSE s_seq END AS stop_sequence, CASE WHEN moved THEN n_move ELSE s_move END AS vp_move_timestamp,
  CASE WHEN stopped THEN n_stop ELSE s_stop END AS vp_stop_timestamp, n_tu AS tu_stop_timestamp FROM j
""")
def upsert_events(t):
    return events.upsert_events(*_stored_and_new(t), _EVENT)


@query(f"""
WITH {_PAIR_SQL}
SELECT service_date, pm_trip_id, parent_station, is_new AS do_insert, NOT is_new AND (moved OR stopped OR n_tu IS NOT NULL) AS do_update FROM j WHERE NOT untouched AND (is_new OR moved OR stopped OR n_tu IS NOT NULL)
""")
def insert_update_flags(t):
    return events.insert_update_flags(*_stored_and_new(t), _EVENT)


@query(f"""
WITH {RAIL_EVENTS}, stored AS (SELECT o_custkey AS pm_trip_id, 'old' AS vehicle_label, CAST(0 AS BIGINT) AS start_time FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')),
newest AS (SELECT pm_trip_id, vehicle_label, vp_stop_timestamp AS start_time FROM (SELECT *, row_number() OVER (PARTITION BY pm_trip_id ORDER BY stop_sequence DESC NULLS FIRST, vehicle_label NULLS FIRST, vp_stop_timestamp NULLS FIRST) AS n FROM rail_events) WHERE n = 1),
ups AS (SELECT pm_trip_id, vehicle_label FROM (SELECT *, row_number() OVER (PARTITION BY pm_trip_id ORDER BY stop_sequence DESC NULLS FIRST, vehicle_label NULLS FIRST, vp_stop_timestamp NULLS FIRST) AS n FROM rail_events WHERE vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL) WHERE n = 1),
loaded AS (SELECT * FROM stored UNION ALL SELECT * FROM newest WHERE pm_trip_id NOT IN (SELECT pm_trip_id FROM stored))
SELECT pm_trip_id, coalesce(u.vehicle_label, l.vehicle_label) AS vehicle_label, start_time FROM loaded l LEFT JOIN ups u USING (pm_trip_id)
""")
def insert_ignore_then_update(t):
    stored = t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("pm_trip_id")).distinct().withColumns(
        {"vehicle_label": F.lit("old"), "start_time": F.lit(0).cast("long")}
    )
    seen = rail_events(t).withColumn("start_time", F.col("vp_stop_timestamp"))
    return changes.load_trips(stored, seen, ["pm_trip_id"], ["vehicle_label"])


@query("""
SELECT id, kind, tag FROM (SELECT user_id AS id, event_type AS kind, NULL AS tag FROM events WHERE event_type <> 'view' UNION SELECT user_id, event_type, NULL FROM events WHERE event_type <> 'click'
  UNION SELECT c_custkey, c_mktsegment, c_name FROM customer)
""")
def append_distinct_sorted(t):
    ids = [F.col("user_id").alias("id"), F.col("event_type").alias("kind")]
    stored = t.events.filter(F.col("event_type") != "view").select(*ids)
    again = t.events.filter(F.col("event_type") != "click").select(*ids)
    new = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"), F.col("c_name").alias("tag"))
    return changes.append_distinct(changes.append_distinct(stored, again), new)


@query("""
SELECT event_id, 'before' AS side FROM events WHERE ts <= TIMESTAMP '2024-01-15' UNION ALL SELECT event_id, 'after' FROM events WHERE ts > TIMESTAMP '2024-01-15'
""")
def cutover_splice(t):
    rows = t.events.select("event_id", "ts")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return changes.splice(
        rows.withColumn("side", F.lit("before")), rows.withColumn("side", F.lit("after")), "ts", cut
    ).select("event_id", "side")


@query("""
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND event_type = 'click' AND CAST(ts AS DATE) <> DATE '2024-01-11'
UNION ALL SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
""")
def backfill_range(t):
    from tramline.plans.ingest import backfill
    from tramline.session import scratch_path
    from tramline.sinks.tables import write_partitioned

    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))
    path = scratch_path(t.spark, "backfilled")
    write_partitioned(rows, path, ["day"])
    backfill(rows, path, "day", "2024-01-10", "2024-01-12", (F.col("event_type") == "click") & (F.col("day") != F.lit("2024-01-11").cast("date")))
    return t.spark.read.parquet(path).select("event_id", "event_type")


@query("""
WITH outputs AS (SELECT CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS s FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1), wanted AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT DISTINCT strftime(d, '%Y-%m-%d') AS service_date FROM (SELECT d FROM outputs WHERE s <> (SELECT arg_max(s, d) FROM outputs) AND d IN (SELECT d FROM wanted) UNION ALL SELECT d FROM wanted WHERE d NOT IN (SELECT d FROM outputs))
""")
def regenerate_recent(t):
    outputs = t.orders.filter(F.col("o_orderstatus") != "F").groupBy(F.to_date("o_orderdate").alias("service_date")).agg(
        F.max("o_orderpriority").alias("schema_id")
    )
    wanted = t.lineitem.select(F.to_date("l_shipdate").alias("service_date"))
    return manifest.dates_to_rebuild(outputs, wanted).select(text(F.col("service_date")).alias("service_date"))
