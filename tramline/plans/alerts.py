"""Service alerts: new records, English texts, clocks, one row per period and entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.nested import english_text, explode_active_periods, explode_informed_entities
from tramline.functions.times import local_from_epoch
from tramline.operators.groups import anti, first_row
from tramline.sinks.tables import append_by_month
from tramline.sources.tables import stored_table

KEY = ["id", "last_modified_timestamp"]
TEXTS = ("header_text", "description_text", "service_effect_text", "timeframe_text", "recurrence_text")
DETAILS = ("cause_detail", "effect_detail")
CLOCKS = ("created", "last_modified", "last_push_notification", "closed", "active_period_start", "active_period_end")
# Columns of the published table.
PUBLISHED = (
    "id", "cause", "cause_detail", "effect", "effect_detail", "severity_level", "severity", "alert_lifecycle", "duration_certainty",
    *[f"{t}_translation_text" for t in TEXTS],
    *[f"{c}_{kind}" for c in CLOCKS for kind in ("datetime", "timestamp")],
    "informed_entity_route_id", "informed_entity_route_type", "informed_entity_direction_id", "informed_entity_stop_id",
    "informed_entity_facility_id", "informed_entity_activities",
)


def new_records(alerts: DataFrame, published: DataFrame) -> DataFrame:
    """One row per (id, last change) that is not published yet."""
    fresh = anti(alerts, published.select(*KEY), KEY)
    return first_row(fresh, KEY, [F.col("feed_timestamp")])


def english(alerts: DataFrame) -> DataFrame:
    """English texts; the two details fall back to their plain columns."""
    out = alerts
    for t in TEXTS:
        out = out.withColumn(f"{t}_translation_text", english_text(F.col(f"{t}.translation"))).drop(t)
    for d in DETAILS:
        out = out.withColumn(d, english_text(F.col(f"{d}_translation"), F.col(d))).drop(f"{d}_translation")
    return out


def publish(alerts: DataFrame, published: DataFrame) -> DataFrame:
    """Rows to add to the published table for a batch of parsed alerts (see ``sources.feeds.parse_alerts``)."""
    texts = english(new_records(alerts, published)).drop("feed_timestamp")
    rows = explode_informed_entities(explode_active_periods(texts))
    clocks = {f"{c}_datetime": local_from_epoch(F.col(f"{c}_timestamp")) for c in CLOCKS}
    return rows.withColumns(clocks).select(*PUBLISHED)


def append_published(spark: SparkSession, alerts: DataFrame, path: str) -> None:
    """Publish a batch into the table at ``path``, clustered by start month."""
    stored = stored_table(spark, path)
    published = alerts.limit(0) if stored is None else stored
    append_by_month(publish(alerts, published.select(*KEY)), path, "active_period_start_timestamp")
