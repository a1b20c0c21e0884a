"""Streams: stop events, event bus, feed tables, rail change loop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.operators import validate as V
from tramline.operators.events import upsert_events
from tramline.operators.groups import anti
from tramline.plans import stop_events
from tramline.sinks.tables import write_snapshot
from tramline.sinks.versions import AppendTable, DatedTable
from tramline.session import cut_lineage
from tramline.sources import event_bus, feeds
from tramline.streaming.state import VersionedTable


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``each`` on every micro-batch: on a timer, or once over all there is."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def document_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Feed files as they arrive, one row per document."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value").alias("document"))


def stop_event_loop(
    spark: SparkSession,
    documents: DataFrame,
    state: VersionedTable,
    checkpoint: str,
    snapshot: str | None = None,
    every: str | None = None,
    max_age: int = stop_events.MAX_AGE_SECONDS,
) -> StreamingQuery:
    """Position snapshots -> stop events, kept in ``state`` and published as JSON lines.

    ``every='3 seconds'`` is the live loop; without it all waiting files are
    worked off. The snapshots of a batch are taken one after another by their
    publication times, so the state does not depend on how documents fall into
    batches; documents of one time are one snapshot.
    """

    def each(batch: DataFrame, number: int) -> None:
        parsed = feeds.parse_documents(batch, feeds.POSITIONS_ENTITY).select("message.*").persist()
        try:
            at = F.col("header.timestamp")
            times = [r[0] for r in parsed.where(at.isNotNull()).select(at.alias("t")).distinct().orderBy("t").collect()]
            current = state.before(number)
            for i, published in enumerate(times):
                rows = parsed.filter((at == published) & F.col("entity").isNotNull())
                new = stop_events.unnest_positions(rows)
                current = stop_events.update_stop_events(current, new, published, max_age)
                if i < len(times) - 1:
                    current = cut_lineage(current, "snapshot")
            if times:
                state.write(current, number)
        finally:
            parsed.unpersist()
        if times and snapshot:
            write_snapshot(state.latest(), snapshot, ["start_time", "route_id", "stop_sequence"])

    return start(documents, each, checkpoint, every)


def late_deduplicated(stream: DataFrame, event_time: str, payload: Sequence[str], late: str = "45 minutes") -> DataFrame:
    """Stream form of the 45-minute dedup: repeats within the watermark go, state is dropped after it."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(payload))


def event_bus_append(
    spark: SparkSession, records: DataFrame, tables: dict[str, AppendTable], quarantine: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Event-bus records -> one typed append-only table per kind, repeats once, rule breakers and unknown kinds aside.

    A batch writes its own folders only. Rows that are stored already are left out by an anti join, so records that
    come again later add nothing, and a batch that runs again after a failure replaces its own folders.
    """

    def each(batch: DataFrame, number: int) -> None:
        routed = event_bus.route_records(batch).persist()
        try:
            unknown = routed.filter(F.col("kind") == "unknown").select(
                "id", F.lit("unknown").alias("kind"), F.array(F.lit("no distinguishing key")).alias("reasons")
            )
            unknown.write.mode("overwrite").parquet(f"{quarantine}/batch={number}/kind=unknown")
            for kind, table in tables.items():
                rows = event_bus.typed_table(routed, kind)
                rules = event_bus.rules(kind)
                bad = V.quarantined(rows, rules).select("id", F.lit(kind).alias("kind"), "reasons")
                bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}/kind={kind}")
                new = V.valid(rows, rules).select(*table.schema.fieldNames()).distinct()
                table.append(anti(new, table.before(number), table.schema.fieldNames()), number)
        finally:
            routed.unpersist()

    return start(records, each, checkpoint, every)


def incremental_change_loop(
    spark: SparkSession,
    new_events: DataFrame,
    state: DatedTable,
    keys: Sequence[str],
    recompute: Callable[[DataFrame, list[str]], None] | None,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """New events upserted into the event table, then ``recompute(events of the touched dates, touched dates)``.

    A batch reads and writes the dates it touches and no others; the table's date column is one of ``keys``. The
    stream's checkpoint remembers which files are done; a failed batch is run again from the same state.
    """
    if state.by not in keys:
        raise ValueError(f"{state.by!r} has to be one of the keys")

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            touched = state.dates(batch)
            if not touched:
                return
            merged = upsert_events(state.read(before=number, dates=touched), batch, keys)
            state.write(merged.select(*state.schema.fieldNames()), number)
            if recompute is not None:
                recompute(state.read(dates=touched), touched)
        finally:
            batch.unpersist()

    return start(new_events, each, checkpoint, every)
