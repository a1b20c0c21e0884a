"""Validation (section 2.11 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import validate as V
from tramline.operators.groups import with_group_values
from tramline.plans.bus import public_operator_ids
from tramline.sources.feeds import parse_alerts
from tramline.workload.registry import query
from tramline.workload.standins import RAIL_EVENTS, STOP_TIMES, rail_events, stop_times, text

_TRIP = ["service_date", "pm_trip_id"]


@query(f"""
WITH {STOP_TIMES}, c AS (SELECT *, count(*) OVER (PARTITION BY trip_id, stop_sequence) AS copies FROM stop_times)
SELECT trip_id, stop_sequence, part, stop_id FROM c WHERE copies = 1 AND stop_id <= 80 AND departure_seconds >= 22000
""")
def schema_filter(t):
    rules = {**V.not_null("stop_id"), **V.in_range("stop_id", high=80), **V.in_range("departure_seconds", low=22000)}
    return V.valid(stop_times(t), rules, ["trip_id", "stop_sequence"]).select("trip_id", "stop_sequence", "part", "stop_id")


@query(f"""
WITH {STOP_TIMES}, c AS (SELECT *, count(*) OVER (PARTITION BY trip_id, stop_sequence) AS copies FROM stop_times)
SELECT reason, count(*) AS rows FROM (SELECT unnest([CASE WHEN copies > 1 THEN 'primary_key' END, CASE WHEN stop_id > 80 THEN 'stop_id|max' END, CASE WHEN departure_seconds < 22000 THEN 'departure_seconds|min' END]) AS reason FROM c)
WHERE reason IS NOT NULL GROUP BY 1
""")
def schema_filter_reasons(t):
    rules = {**V.not_null("stop_id"), **V.in_range("stop_id", high=80), **V.in_range("departure_seconds", low=22000)}
    return V.reason_counts(stop_times(t), rules, ["trip_id", "stop_sequence"])


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence FROM rail_events WHERE NOT (stop_sequence = 1 AND vp_stop_timestamp IS NULL)
""")
def first_stop_has_departure(t):
    kept = V.valid(rail_events(t), V.first_stop_has_departure("stop_sequence", "vp_stop_timestamp"))
    return kept.select(*_TRIP, "stop_sequence")


@query(f"""
WITH {RAIL_EVENTS}, e AS (SELECT *, CASE WHEN stop_sequence = max(stop_sequence) OVER w THEN 'end' END AS point_type, lag(vp_move_timestamp) OVER (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence) AS prev
  FROM rail_events WINDOW w AS (PARTITION BY service_date, pm_trip_id))
SELECT service_date, pm_trip_id, stop_sequence FROM e WHERE NOT coalesce(point_type = 'end' AND vp_move_timestamp IS NOT NULL AND vp_stop_timestamp IS NULL, false)
  AND coalesce(vp_move_timestamp >= prev, true) AND trip_id NOT LIKE '%OL%' AND NOT ends_with(trip_id, '_1') AND NOT ends_with(trip_id, '_2')
""")
def joined_event_rules(t):
    e = with_group_values(rail_events(t), _TRIP, _last=F.max("stop_sequence")).withColumn(
        "point_type", F.when(F.col("stop_sequence") == F.col("_last"), "end")
    )
    e = e.withColumns({"gtfs_last_in_transit_dt": F.col("vp_move_timestamp"), "gtfs_arrival_dt": F.col("vp_stop_timestamp")})
    e = V.with_previous(e, _TRIP, ["stop_sequence"], ["vp_move_timestamp"], width=4)
    rules = V.all_of([V.final_stop_has_arrival(), V.not_before_previous("vp_move_timestamp"), V.plain_trip_id()])
    return V.valid(e, rules).select(*_TRIP, "stop_sequence")


@query(f"""
WITH {RAIL_EVENTS}, e AS (SELECT *, lag(vp_move_timestamp) OVER w AS pa, lag(vp_stop_timestamp) OVER w AS pd FROM rail_events WINDOW w AS (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence))
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN vp_move_timestamp > vp_stop_timestamp THEN 'departure_after_arrival,' ELSE '' END || CASE WHEN vp_move_timestamp < pa THEN 'vp_move_timestamp_order,' ELSE '' END
  || CASE WHEN vp_stop_timestamp < pd THEN 'vp_stop_timestamp_order,' ELSE '' END AS reasons
FROM e WHERE vp_move_timestamp > vp_stop_timestamp OR vp_move_timestamp < pa OR vp_stop_timestamp < pd
""")
def metric_order_rules(t):
    e = V.with_previous(rail_events(t), _TRIP, ["stop_sequence"], ["vp_move_timestamp", "vp_stop_timestamp"], width=4)
    rules = {
        **V.departure_after_arrival("vp_move_timestamp", "vp_stop_timestamp"),
        **V.not_before_previous("vp_move_timestamp", "vp_stop_timestamp"),
    }
    bad = V.quarantined(e, rules)
    return bad.select(*_TRIP, "stop_sequence", F.concat(F.array_join("reasons", ","), F.lit(",")).alias("reasons"))


@query(f"""
WITH {RAIL_EVENTS}, e AS (SELECT *, CASE WHEN vp_stop_timestamp IS NOT NULL AND vp_move_timestamp IS NOT NULL THEN vp_stop_timestamp - vp_move_timestamp END AS stopped FROM rail_events),
g AS (SELECT service_date, pm_trip_id FROM e GROUP BY 1, 2 HAVING coalesce(sum(coalesce(stopped, 0)) = max(coalesce(vp_stop_timestamp, vp_move_timestamp)) - min(coalesce(vp_move_timestamp, vp_stop_timestamp)), true))
SELECT service_date, pm_trip_id, stop_sequence FROM e JOIN g USING (service_date, pm_trip_id)
""")
def trip_total_rule(t):
    e = rail_events(t).select(
        *_TRIP,
        "stop_sequence",
        F.col("vp_move_timestamp").alias("stop_arrival_dt"),
        F.col("vp_stop_timestamp").alias("stop_departure_dt"),
        F.lit(0).alias("travel_time_seconds"),
        (F.col("vp_stop_timestamp") - F.col("vp_move_timestamp")).alias("stopped_duration_seconds"),
    )
    totalled = V.with_trip_total(e, _TRIP, lambda later, earlier: later - earlier)
    return V.valid(totalled, V.trip_total()).select(*_TRIP, "stop_sequence")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 24 < 24 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_totalprice >= 50000 AND o_orderkey % 100 < 60
""")
def nested_regex_rules(t):
    minute = F.col("o_orderkey") % 100
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("at"),
        F.concat(F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"), F.lit(":00")).alias("clock"),
        F.array(F.struct(F.col("o_orderpriority").alias("kind"))).alias("items"),
        "o_totalprice",
    )
    rules = V.all_of(
        [
            V.matches("at", V.DATETIME_PATTERN),
            V.matches("clock", V.CLOCK_PATTERN),
            V.every_item("items", "kind", lambda i: i["kind"].rlike("URGENT|HIGH|MEDIUM")),
            V.min_length("items", 1),
            V.in_range("o_totalprice", low=50000),
        ]
    )
    return V.valid(rows, rules).select("o_orderkey")


@query(f"""
WITH {STOP_TIMES}
SELECT trip_id, count(*) AS rows, count(checkpoint_id) = count(*) AS checkpoint_id_not_null, min(checkpoint_id) IS NOT DISTINCT FROM max(checkpoint_id) AND (count(checkpoint_id) = count(*) OR count(checkpoint_id) = 0) AS checkpoint_id_constant,
  count(*) = max(stop_sequence) AS row_count_as_planned, count(DISTINCT stop_sequence) = count(*) AS stop_sequence_unique FROM stop_times GROUP BY 1
""")
def schedule_audit(t):
    return V.schedule_audit(
        stop_times(t), ["trip_id"], never_null=["checkpoint_id"], unique=["stop_sequence"], constant=["checkpoint_id"], planned="stop_sequence"
    )


@query(f"""
WITH {STOP_TIMES}
SELECT trip_id, stop_sequence, count(*) AS copies FROM stop_times GROUP BY 1, 2 HAVING count(*) > 1
""")
def one_to_one_guard(t):
    return V.one_to_one(stop_times(t), ["trip_id", "stop_sequence"])


@query("""
SELECT o_orderkey AS id, o_orderpriority AS cause, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'plain' END AS cause_detail, CASE WHEN o_orderstatus = 'P' THEN 'translated' END AS cause_english FROM orders
""")
def alerts_schema_fallback(t):
    from tramline.functions.nested import english_text

    translated = F.struct(F.array(F.struct(F.lit("translated").alias("text"), F.lit("en").alias("language"))).alias("translation"))
    head = F.struct(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp")).alias("header")

    def document(detail):
        alert = F.struct(F.col("o_orderpriority").alias("cause"), detail.alias("cause_detail"), F.lit(3).alias("severity"))
        return F.to_json(F.struct(head, F.array(F.struct(F.col("o_orderkey").cast("string").alias("id"), alert.alias("alert"))).alias("entity")))

    rows = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", document(translated)).otherwise(document(F.lit("plain"))).alias("document")
    )
    return parse_alerts(rows).select("id", "cause", "cause_detail", english_text(F.col("cause_detail_translation")).alias("cause_english"))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS service_date, trip, CAST(strftime(d, '%Y%m%d') || CAST(9999 + row_number() OVER (PARTITION BY d ORDER BY md5('s' || trip), trip) AS VARCHAR) AS BIGINT) AS public_operator_id
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, CAST(o_custkey AS VARCHAR) AS trip FROM orders)
""")
def public_operator_id(t):
    work = t.orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("service_date"), F.col("o_custkey").cast("string").alias("tm_trip_id"))
    ids = public_operator_ids(work, "s")
    return ids.select(text(F.col("service_date")).alias("service_date"), F.col("tm_trip_id").alias("trip"), "public_operator_id")




@query(f"""
WITH {RAIL_EVENTS}, e AS (SELECT *, stop_sequence = max(stop_sequence) OVER (PARTITION BY service_date, pm_trip_id) AS at_end FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence FROM e WHERE NOT (at_end AND vp_move_timestamp IS NOT NULL AND vp_stop_timestamp IS NULL)
""")
def final_stop_has_arrival(t):
    e = with_group_values(rail_events(t), _TRIP, _last=F.max("stop_sequence")).withColumns(
        {
            "point_type": F.when(F.col("stop_sequence") == F.col("_last"), "end"),
            "gtfs_last_in_transit_dt": F.col("vp_move_timestamp"),
            "gtfs_arrival_dt": F.col("vp_stop_timestamp"),
        }
    )
    return V.valid(e, V.final_stop_has_arrival()).select(*_TRIP, "stop_sequence")


@query(f"""
WITH {RAIL_EVENTS}, e AS (SELECT *, lag(tu_stop_timestamp) OVER (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence) AS prev FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence FROM e WHERE coalesce(tu_stop_timestamp >= prev, true)
""")
def monotonic_tm_sequence(t):
    e = V.with_previous(rail_events(t), _TRIP, ["stop_sequence"], ["tu_stop_timestamp"])
    return V.valid(e, V.not_before_previous("tu_stop_timestamp")).select(*_TRIP, "stop_sequence")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence FROM rail_events WHERE coalesce(vp_move_timestamp <= vp_stop_timestamp, true)
""")
def departure_after_arrival(t):
    rules = V.departure_after_arrival("vp_move_timestamp", "vp_stop_timestamp")
    return V.valid(rail_events(t), rules).select(*_TRIP, "stop_sequence")
