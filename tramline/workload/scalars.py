"""Scalar columns (section 2.9 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import nested, rows, texts, times
from tramline.workload.registry import query
from tramline.workload.standins import POSITIONS, RAIL_EVENTS, clock_text, epoch, positions, rail_events, text

_CLOCK_SQL = """lpad(CAST(CAST(l_quantity AS INT) AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0')
    || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')"""


def _clock():
    return F.concat(
        F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.col("l_linenumber") * 7).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0"),
    )


@query(f"""
SELECT l_orderkey, l_linenumber, clock,
  CASE WHEN contains(clock, ':')
       THEN CAST(split_part(clock, ':', 1) AS BIGINT) * 3600 + CAST(split_part(clock, ':', 2) AS BIGINT) * 60
            + CAST(split_part(clock, ':', 3) AS BIGINT)
       ELSE TRY_CAST(clock AS BIGINT) END AS seconds
FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey AS VARCHAR) WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
             ELSE {_CLOCK_SQL} END AS clock FROM lineitem)
""")
def time_to_seconds(t):
    clock = (
        F.when(F.col("l_returnflag") == "A", F.col("l_partkey").cast("string"))
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), None)
        .otherwise(_clock())
    )
    return t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("long"), clock.alias("clock")).withColumn(
        "seconds", times.clock_seconds(F.col("clock"))
    )


@query(f"""
SELECT l_orderkey, min(CAST(split_part(clock, ':', 1) AS BIGINT) * 3600 + CAST(split_part(clock, ':', 2) AS BIGINT) * 60
            + CAST(split_part(clock, ':', 3) AS BIGINT)) AS first_seconds
FROM (SELECT l_orderkey, {_CLOCK_SQL} AS clock FROM lineitem) GROUP BY 1
""")
def split_time_polars(t):
    return (
        t.lineitem.select("l_orderkey", times.clock_seconds(_clock()).alias("s"))
        .groupBy("l_orderkey")
        .agg(F.min("s").alias("first_seconds"))
    )


# January has no clock change, so a fixed offset states the local clock in SQL.
@query("""
SELECT event_id, CAST(strftime(ts - INTERVAL 9 HOUR, '%Y%m%d') AS BIGINT) AS service_date FROM events
""")
def service_date(t):
    return t.events.select("event_id", times.service_date(epoch(F.col("ts"))).alias("service_date"))


@query("""
SELECT event_id, epoch_us(ts) // 1000000 - (epoch_us(date_trunc('day', ts - INTERVAL 9 HOUR)) // 1000000 + 5 * 3600)
  AS seconds_after_midnight
FROM events
""")
def seconds_after_service_midnight(t):
    return t.events.select(
        "event_id", times.seconds_after_service_midnight(epoch(F.col("ts"))).alias("seconds_after_midnight")
    )


@query("""
SELECT o_orderkey, strftime(timezone('America/New_York', timezone('UTC', o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400))),
  '%Y-%m-%d %H:%M:%S') AS local_time
FROM orders
""")
def local_from_utc(t):
    at = epoch(F.col("o_orderdate")) + F.col("o_orderkey") % 86400
    return t.orders.select("o_orderkey", clock_text(times.local_from_epoch(at)).alias("local_time"))


# From 06:00 local on, no wall clock of the day is doubled or skipped.
@query("""
SELECT o_orderkey, strftime(timezone('UTC', timezone('America/New_York', o_orderdate + INTERVAL 1 SECOND * (21600 + o_orderkey % 60000))),
  '%Y-%m-%d %H:%M:%S') AS utc_time
FROM orders
""")
def utc_from_local_seconds(t):
    seconds = 21600 + F.col("o_orderkey") % 60000
    return t.orders.select(
        "o_orderkey", clock_text(times.utc_from_local_seconds(F.to_date("o_orderdate"), seconds)).alias("utc_time")
    )


@query("""
SELECT o_orderkey, strftime(strptime(substr('1' || strftime(o_orderdate, '%Y%m%d'), 2, 8), '%Y%m%d'), '%Y-%m-%d') AS calendar_date
FROM orders
""")
def calendar_id_date(t):
    calendar_id = F.concat(F.lit("1"), F.date_format("o_orderdate", "yyyyMMdd")).cast("long")
    return t.orders.select("o_orderkey", text(times.calendar_date(calendar_id)).alias("calendar_date"))


@query(f"""
WITH {POSITIONS}
SELECT event_id, regexp_replace(regexp_replace(trip_id, '-OL[0-9]?', ''), '_[0-9]', '') AS trip_id FROM positions
""")
def strip_trip_suffix(t):
    return positions(t).select("event_id", texts.strip_trip_suffix(F.col("trip_id")).alias("trip_id"))


@query(f"""
WITH {POSITIONS}
SELECT event_id, nullif(regexp_extract(trip_id, '-OL([0-9]?)|_([0-9])$', 1), '') AS suffix FROM positions
""")
def suffix_extract(t):
    return positions(t).select("event_id", texts.trip_suffix(F.col("trip_id")).alias("suffix"))


@query("""
SELECT p_partkey, coalesce(nullif(regexp_extract(remark, '^([a-zA-Z]{1,5})\\b[ -:]*', 1), ''), 'Unrecognized Code') AS waiver
FROM (SELECT p_partkey, p_name || '-' || p_brand AS remark FROM part)
""")
def waiver_code(t):
    remark = F.concat("p_name", F.lit("-"), "p_brand")
    return t.part.select("p_partkey", texts.waiver_code(remark).alias("waiver"))


@query("""
SELECT c_custkey, ltrim(split_part(c_name, '#', 2), '0') AS code FROM customer
""")
def strip_leading_zeros(t):
    return t.customer.select("c_custkey", texts.strip_leading_zeros(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("code"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'N' THEN CAST(l_suppkey AS VARCHAR)
    ELSE l_partkey || '|' || l_suppkey END AS consist
FROM (SELECT *EXCLUDE (l_linenumber), CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem)
""")
def pipe_join_labels(t):
    def car(c):
        return F.struct(F.col(c).cast("string").alias("label"))

    consist = F.when((F.col("l_linestatus") != "O") & (F.col("l_returnflag") != "N"), F.array(car("l_partkey"), car("l_suppkey")))
    carriages = F.when(F.col("l_linestatus") != "O", F.array(car("l_suppkey")))
    joined = F.coalesce(nested.join_labels(consist), nested.join_labels(carriages))
    return t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("long"), "l_partkey", joined.alias("consist"))


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN text END AS header, CASE WHEN lang = 'en' THEN text ELSE source END AS cause FROM documents
""")
def english_translation(t):
    def item(language, text_col):
        return F.struct(language.alias("language"), text_col.alias("text"))

    translations = F.array(item(F.lit("xx"), F.col("source")), item(F.col("lang"), F.col("text")))
    return t.documents.select(
        "doc_id",
        nested.english_text(translations).alias("header"),
        nested.english_text(translations, F.col("source")).alias("cause"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN epoch_us(o_orderdate) // 1000000 END AS start_ts,
  CAST(NULL AS BIGINT) AS end_ts FROM orders WHERE o_orderstatus <> 'O'
UNION ALL
SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 + n * 86400, epoch_us(o_orderdate) // 1000000 + n * 86400 + 3600
FROM orders, (SELECT unnest([0, 7]) AS n) WHERE o_orderstatus = 'O'
""")
def explode_active_period(t):
    at = epoch(F.col("o_orderdate"))
    never = F.lit(None).cast("long")

    def period(start, end):
        return F.struct(start.alias("start"), end.alias("end"))

    periods = (
        F.when(F.col("o_orderstatus") == "O", F.array(period(at, at + 3600), period(at + 7 * 86400, at + 7 * 86400 + 3600)))
        .when(F.col("o_orderstatus") == "F", F.array(period(at, never)))
    )
    alerts = t.orders.select("o_orderkey", periods.alias("active_period"))
    return nested.explode_active_periods(alerts).toDF("o_orderkey", "start_ts", "end_ts")


@query("""
SELECT DISTINCT o_orderkey, route_id, stop_id, activities FROM (
  SELECT o_orderkey, o_orderpriority AS route_id, o_custkey AS stop_id, 'BOARD|EXIT' AS activities FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, o_orderpriority, o_custkey % 7, 'RIDE' FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'P')
""")
def explode_informed_entity(t):
    def entity(stop, *activities):
        return F.struct(
            F.col("o_orderpriority").alias("route_id"), stop.alias("stop_id"), F.array(*[F.lit(a) for a in activities]).alias("activities")
        )

    rider = entity(F.col("o_custkey") % 7, "RIDE")
    entities = F.when(F.col("o_orderstatus") != "P", F.array(entity(F.col("o_custkey"), "BOARD", "EXIT"), rider, rider))
    alerts = t.orders.select("o_orderkey", entities.alias("informed_entity"))
    out = nested.explode_informed_entities(alerts, fields=("route_id", "stop_id"))
    return out.toDF("o_orderkey", "route_id", "stop_id", "activities")


@query("""
SELECT o_orderkey AS id, o_orderstatus AS data_kind, o_custkey AS data_author_badge, o_orderpriority AS data_author_place_code
FROM orders
""")
def flatten_structs(t):
    place = F.struct(F.col("o_orderpriority").alias("code")).alias("place")
    author = F.struct(F.col("o_custkey").alias("badge"), place).alias("author")
    message = t.orders.select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("kind"), author).alias("data"))
    return nested.underscore_names(nested.flatten_structs(message))


@query("""
SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE lang <> 'fr' AND lang <> 'de'
UNION ALL SELECT doc_id, NULL FROM documents WHERE lang = 'fr'
""")
def explode_list_outer(t):
    lines = F.when(F.col("lang") == "de", F.array().cast("array<string>")).when(F.col("lang") != "fr", F.split("text", "\n"))
    return nested.explode_keep_null(t.documents.select("doc_id", lines.alias("line")), "line")


@query("""
SELECT p_partkey AS id, p_name AS info_name, p_brand || ',' || p_type AS tags,
  '[{"size":' || p_size || '},{"size":' || (p_size + 1) || '}]' AS sizes
FROM part
""")
def flatten_for_bi(t):
    df = t.part.select(
        F.col("p_partkey").alias("id"),
        F.struct(F.col("p_name").alias("name")).alias("info"),
        F.array("p_brand", "p_type").alias("tags"),
        F.array(F.struct(F.col("p_size").alias("size")), F.struct((F.col("p_size") + 1).alias("size"))).alias("sizes"),
    )
    return nested.underscore_names(nested.flatten_for_export(df))


@query("""
SELECT event_id, '{"k":' || (props ->> '$.k') || '}' AS cars FROM events
""")
def stringify_multitype(t):
    return t.events.select(
        "event_id", nested.as_json_text(F.from_json("props", "k bigint")).alias("cars")
    )


@query("""
SELECT o_orderkey, strftime(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS at,
  strftime(try_strptime(substr(raw, 1, 10), '%Y-%m-%d'), '%Y-%m-%d') AS day
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw FROM orders)
""")
def tolerant_date_parse(t):
    raw = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    return t.orders.select(
        "o_orderkey",
        clock_text(times.tolerant_timestamp(raw)).alias("at"),
        text(times.tolerant_date(F.substring(raw, 1, 10))).alias("day"),
    )


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, least(vp_move_timestamp, vp_stop_timestamp, tu_stop_timestamp) AS lowest,
  greatest(vp_move_timestamp, vp_stop_timestamp, tu_stop_timestamp) AS highest,
  coalesce(vp_stop_timestamp, tu_stop_timestamp, vp_move_timestamp) AS first_known,
  coalesce(vp_move_timestamp, 0) + coalesce(vp_stop_timestamp, 0) + coalesce(tu_stop_timestamp, 0) AS total
FROM rail_events
""")
def null_horizontal_min_max(t):
    move, stop, tu = (F.col(c) for c in ("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp"))
    return rail_events(t).select(
        "service_date",
        "pm_trip_id",
        "stop_sequence",
        F.least(move, stop, tu).alias("lowest"),
        F.greatest(move, stop, tu).alias("highest"),
        F.coalesce(stop, tu, move).alias("first_known"),
        rows.row_sum(move, stop, tu).alias("total"),
    )


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey * 40 AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey * 40 AS VARCHAR))) AS INTEGER), '0') AS BIGINT) AS public_id
FROM orders
""")
def dated_public_id(t):
    return t.orders.select(
        "o_orderkey", texts.dated_id(F.col("o_orderdate"), F.col("o_orderkey") * 40).alias("public_id")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(strftime(o_orderdate - INTERVAL 8 HOUR, '%Y%m%d') AS BIGINT)
  ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) END AS feed_active_date
FROM orders
""")
def feed_active_date(t):
    # a midnight stamp at +03:00 is 21:00 UTC of the day before, so before midnight in Boston
    version = F.when(
        F.col("o_orderstatus") == "O",
        F.concat(F.lit("Fall, "), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00, version D")),
    ).otherwise(F.col("o_orderpriority"))
    start = F.date_format("o_orderdate", "yyyyMMdd").cast("long")
    return t.orders.select("o_orderkey", times.feed_active_date(version, start).alias("feed_active_date"))


@query(f"""
WITH {POSITIONS}
SELECT event_id, strftime(service_date, '%Y%m%d') || '-' || route_id || '-' || trip_id || '-' || vehicle_id || '-'
  || CASE WHEN event_type <> 'error' THEN CAST(stop_sequence AS VARCHAR) END AS id
FROM positions
""")
def event_id_concat(t):
    seq = F.when(F.col("event_type") != "error", F.col("stop_sequence"))
    key = [F.date_format("service_date", "yyyyMMdd"), F.col("route_id"), F.col("trip_id"), F.col("vehicle_id"), seq]
    return positions(t).select("event_id", texts.joined_id(key).alias("id"))


@query("""
SELECT o_orderkey, split_part(split_part(v, ',', 1), ' ', 1) AS season, split_part(split_part(v, ',', 1), ' ', 2) AS rating_year
FROM (SELECT o_orderkey, substr(o_orderpriority, 3) || ' ' || year(o_orderdate) || ', x y' AS v FROM orders)
""")
def rating_split(t):
    version = F.concat(F.substring("o_orderpriority", 3, 100), F.lit(" "), F.year("o_orderdate").cast("string"), F.lit(", x y"))
    return t.orders.select(
        "o_orderkey", texts.rating_season(version).alias("season"), texts.rating_year(version).alias("rating_year")
    )


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence,
  CASE WHEN vp_move_timestamp IS NULL THEN 'TM' WHEN vp_stop_timestamp IS NULL THEN 'GTFS' ELSE 'JOIN' END AS schedule_joined
FROM rail_events
""")
def provenance_label(t):
    label = texts.provenance(F.col("vp_stop_timestamp"), F.col("vp_move_timestamp"), "TM", "GTFS", "JOIN")
    return rail_events(t).select("service_date", "pm_trip_id", "stop_sequence", label.alias("schedule_joined"))


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
  strftime(l_shipdate + INTERVAL 1 SECOND * (l_partkey * 61), '%Y-%m-%d %H:%M:%S') AS scheduled_at,
  epoch_us(l_shipdate + INTERVAL 1 SECOND * (l_partkey * 61)) // 1000000 - epoch_us(l_shipdate) // 1000000 AS scheduled_sec
FROM lineitem
""")
def scheduled_datetimes(t):
    at = times.scheduled_at(F.to_date("l_shipdate"), F.col("l_partkey") * 61)
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long"),
        "l_partkey",
        clock_text(at).alias("scheduled_at"),
        times.wall_seconds_since(F.to_date("l_shipdate"), at).alias("scheduled_sec"),
    )


@query(f"""
WITH {POSITIONS}
SELECT event_id, '{{"id":"' || event_id || '","type":"stop_event","attributes":{{"stop_sequence":' || stop_sequence || ',"epoch":' || epoch
  || '}},"relationships":{{"trip":{{"data":{{"id":"' || trip_id || '","type":"trip"}}}},"stop":{{"data":{{"id":"' || stop_id || '","type":"stop"}}}}}}}}' AS document
FROM positions
""")
def jsonapi_events(t):
    document = texts.jsonapi_event(
        "stop_event", F.col("event_id"), ["stop_sequence", "epoch"], {"trip": F.col("trip_id"), "stop": F.col("stop_id")}
    )
    return positions(t).select("event_id", document.alias("document"))
