"""Joins, change data, calendars, validation: literal cases and brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import aggregates, calendar, changes, events, joins, validate as V
from tramline.plans.bus import public_operator_ids


def test_asof_nearest_equals_brute_force(spark):
    rng = random.Random(7)
    left = [(i, rng.choice("ab"), None if i % 40 == 0 else rng.randrange(2000)) for i in range(200)]
    right = [(i, rng.choice("ab"), rng.randrange(2000)) for i in range(150)] + [(900, "a", 10), (901, "a", 10)]
    got = joins.asof_nearest(
        spark.createDataFrame(left, "pm_trip_id long, route_id string, start_time long"),
        spark.createDataFrame(right, "static_trip_id long, route_id string, static_start_time long"),
        ["route_id"], "start_time", "static_start_time", "static_trip_id", 100,
    )
    want = {}
    for trip, route, at in left:
        options = [(abs(s - at), s, i) for i, r, s in right if r == route] if at is not None else []
        want[trip] = min(options)[2] if options else None
    assert {r.pm_trip_id: r.static_trip_id for r in got.collect()} == want


def test_asof_tolerance_leaves_far_rows_unmatched(spark):
    left = spark.createDataFrame([(1, "a", 100), (2, "a", 500), (3, "z", 5)], "id long, k string, t long")
    right = spark.createDataFrame([(7, "a", 110)], "rid long, k string, rt long")
    got = joins.asof_nearest(left, right, ["k"], "t", "rt", "rid", 50, tolerance=20)
    assert sorted((r.id, r.rid) for r in got.collect()) == [(1, 7), (2, None), (3, None)]


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), rng.randrange(500)) for i in range(150)]
    spans = [(i, rng.choice("ab"), s, s + rng.randrange(-5, 90)) for i, s in enumerate(rng.choices(range(450), k=80))]
    got = joins.interval_join(
        spark.createDataFrame(points, "p long, k string, at long"),
        spark.createDataFrame(spans, "s long, k string, lo long, hi long"),
        ["k"], "at", "lo", "hi", 17,
    )
    want = sorted((p, s) for p, k, at in points for s, k2, lo, hi in spans if k == k2 and lo < at <= hi)
    assert sorted((r.p, r.s) for r in got.collect()) == want


def test_null_safe_full_join_coalesces_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v long")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, v long")
    got = joins.null_safe_join(left, right, ["k"], "full", suffix="_r")
    assert sorted((str(r.k), r.v, r.v_r) for r in got.collect()) == [("None", 1, 10), ("a", 2, None), ("b", None, 20)] or sorted(
        (str(r.k), str(r.v), str(r.v_r)) for r in got.collect()
    ) == [("None", "1", "10"), ("a", "2", "None"), ("b", "None", "20")]


def _archive(spark, data):
    return spark.createDataFrame(data, "id string, v string, gtfs_active_date long, gtfs_end_date long")


def test_scd2_within_a_year(spark):
    stored = _archive(spark, [("same", None, 20240110, 20250108), ("gone", "x", 20240110, 20250108), ("closed", "x", 20240101, 20240201)])
    snapshot = spark.createDataFrame([("same", None), ("new", "y")], "id string, v string")
    got = {tuple(r) for r in changes.scd2_merge(snapshot, stored, 20240601, ["id", "v"]).collect()}
    assert got == {
        ("same", None, 20240110, 20250601), ("gone", "x", 20240110, 20240601), ("closed", "x", 20240101, 20240201), ("new", "y", 20240602, 20250601),
    }


def test_scd2_opens_a_new_year(spark):
    stored = _archive(spark, [("same", "x", 20240110, 20250108), ("gone", "x", 20240110, 20250108), ("closed", "x", 20240101, 20240201)])
    snapshot = spark.createDataFrame([("same", "x"), ("new", "y")], "id string, v string")
    got = {tuple(r) for r in changes.scd2_merge(snapshot, stored, 20250110, ["id", "v"]).collect()}
    assert got == {
        ("same", "x", 20240110, 20241231), ("same", "x", 20250101, 20260110),
        ("gone", "x", 20240110, 20241231), ("gone", "x", 20250101, 20250110),
        ("closed", "x", 20240101, 20240201), ("new", "y", 20250111, 20260110),
    }


def test_scd2_new_year_drops_spans_that_do_not_last(spark):
    stored = _archive(spark, [("gone", "x", 20240110, 20250108)])
    snapshot = spark.createDataFrame([("new", "y")], "id string, v string")
    got = {tuple(r) for r in changes.scd2_merge(snapshot, stored, 20250101, ["id", "v"]).collect()}
    assert got == {("gone", "x", 20240110, 20241231), ("new", "y", 20250102, 20260101)}


def test_scd2_from_nothing(spark):
    got = changes.scd2_merge(spark.createDataFrame([("a", "x")], "id string, v string"), _archive(spark, []), 20240601, ["id", "v"])
    assert [tuple(r) for r in got.collect()] == [("a", "x", 20240602, 20250601)]


def test_version_for_dates_prefers_live_then_archive(spark):
    feeds = spark.createDataFrame(
        [(1, 20240101, 20241231, 20240101, 1), (2, 20240301, 20241231, 20240401, 2), (3, 20250101, 20250131, 20250301, 3)],
        "static_version_key long, feed_start_date long, feed_end_date long, feed_active_date long, created_on long",
    )
    dates = spark.createDataFrame([(20240315,), (20240402,), (20250115,), (20260101,)], "service_date long")
    got = {r.service_date: r.static_version_key for r in calendar.version_for_dates(dates, feeds).collect()}
    assert got == {20240315: 1, 20240402: 2, 20250115: 3, 20260101: None}


def test_service_ids_once_even_when_added_twice(spark):
    cal = spark.createDataFrame(
        [("wk", 20240101, 20241231, 0, 1, 1, 1, 1, 1, 0), ("off", 20240101, 20241231, 0, 1, 1, 1, 1, 1, 0)],
        "service_id string, start_date long, end_date long, sunday long, monday long, tuesday long, wednesday long, thursday long, friday long, saturday long",
    )
    exc = spark.createDataFrame([("off", 20240603, 2), ("wk", 20240603, 1), ("extra", 20240603, 1)], "service_id string, date long, exception_type long")
    assert sorted(r.service_id for r in calendar.service_ids_for_date(cal, exc, 20240603).collect()) == ["extra", "wk"]
    assert sorted(r.service_id for r in calendar.service_ids_for_date(cal, exc, 20240602).collect()) == []


def test_distinct_on_latest_puts_null_sequences_first(spark):
    df = spark.createDataFrame([("t", 5, "a"), ("t", None, "b"), ("u", 1, "c"), ("u", 2, "d")], "k string, seq long, v string")
    assert sorted((r.k, r.v) for r in changes.distinct_on_latest(df, ["k"], "seq").collect()) == [("t", "b"), ("u", "d")]


def test_upsert_takes_the_earliest_times(spark):
    schema = "k string, stop_sequence long, vp_move_timestamp long, vp_stop_timestamp long, tu_stop_timestamp long"
    stored = spark.createDataFrame([("a", 1, 100, None, None), ("b", 1, 100, 200, 300)], schema)
    new = spark.createDataFrame([("a", 2, 150, 160, None), ("b", 2, 90, 250, 310), ("c", 2, 5, None, None)], schema)
    assert sorted(tuple(r) for r in events.upsert_events(stored, new, ["k"]).collect()) == [
        ("a", 2, 100, 160, None), ("b", 2, 90, 200, 310), ("c", 2, 5, None, None),
    ]
    flags = {r.k: (r.do_insert, r.do_update) for r in events.insert_update_flags(stored, new, ["k"]).collect()}
    assert flags == {"a": (False, True), "b": (False, True), "c": (True, False)}


def test_validation_keeps_null_results_and_drops_all_copies(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50), (4, 7), (4, 8)], "id long, v long")
    rules = V.in_range("v", low=0, high=10)
    assert sorted(r.id for r in V.valid(df, rules, ["id"]).collect()) == [1, 2]
    assert {r.reason: r.rows for r in V.reason_counts(df, rules, ["id"]).collect()} == {"v|max": 1, "primary_key": 2}


@pytest.mark.parametrize(
    "arrivals,departures,travel,stopped,kept",
    [
        ([None, 90, 120], [60, 90, None], [None, 1800, 1800], [None, 0, None], 3),
        ([None, 90, 120], [60, 90, None], [None, 60000, 1800], [None, 0, None], 0),
        ([None, 90, 120], [60, 90, None], [None, 0, 1800], [60, 60, 0], 0),
    ],
)
def test_trip_total_rejects_whole_trips(spark, arrivals, departures, travel, stopped, kept):
    data = [("t", i, None if a is None else a * 60, None if d is None else d * 60, tr, st) for i, (a, d, tr, st) in enumerate(zip(arrivals, departures, travel, stopped))]
    df = spark.createDataFrame(data, "trip string, seq long, stop_arrival_dt long, stop_departure_dt long, travel_time_seconds long, stopped_duration_seconds long")
    checked = V.with_trip_total(df, ["trip"], lambda later, earlier: later - earlier)
    assert V.valid(checked, V.trip_total()).count() == kept


def test_arrival_order_is_per_service_date(spark):
    rows = [("d1", "t", 1, 60), ("d1", "t", 2, 0)]
    split = [("d1", "t", 1, 60), ("d2", "t", 2, 0)]
    for data, kept in ((rows, 1), (split, 2)):
        df = spark.createDataFrame(data, "service_date string, trip string, seq long, stop_arrival_dt long")
        with_prev = V.with_previous(df, ["service_date", "trip"], ["seq"], ["stop_arrival_dt"])
        assert V.valid(with_prev, V.not_before_previous("stop_arrival_dt")).count() == kept


@pytest.mark.parametrize(
    "own,kept", [([1, 2, 3, 4], 4), ([1, 2, 4, 3], 3), ([None, None, None, None], 4), ([1, 2, 2, 3], 3)]
)
def test_schedule_order_audit(spark, own, kept):
    df = spark.createDataFrame([("t", i + 1, o) for i, o in enumerate(own)], "trip string, stop_sequence long, gtfs_stop_sequence long")
    with_prev = V.with_previous(df, ["trip"], ["stop_sequence"], ["gtfs_stop_sequence"])
    assert V.valid(with_prev, V.schedule_order_rules()).count() == kept


def test_exact_quantile(spark):
    rng = random.Random(1)
    values = [rng.randrange(1000) for _ in range(501)]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v long")
    got = aggregates.exact_quantiles(df, ["k"], "v", {"high": 0.99, "mid": 0.5}, width=10).first()
    want = df.agg(F.percentile("v", 0.99), F.percentile("v", 0.5)).first()
    assert (got.high, got.mid) == (pytest.approx(want[0]), pytest.approx(want[1]))


def test_public_ids_are_unique_and_repeatable(spark):
    work = spark.range(3000).select(F.lit("2024-06-01").cast("date").alias("service_date"), F.col("id").cast("string").alias("tm_trip_id"))
    first = {r.tm_trip_id: r.public_operator_id for r in public_operator_ids(work, "seed").collect()}
    again = {r.tm_trip_id: r.public_operator_id for r in public_operator_ids(work.repartition(7), "seed").collect()}
    other = {r.tm_trip_id: r.public_operator_id for r in public_operator_ids(work, "another").collect()}
    assert first == again != other
    assert len(set(first.values())) == 3000
    assert all(str(v).startswith("20240601") and len(str(v)) == 13 for v in first.values())


def test_trips_have_a_document_for_each_span(spark):
    df = spark.range(25).select(F.lit("t").alias("trip"), F.col("id").alias("seq"), F.col("id").alias("timestamp"))
    docs = aggregates.trip_documents(df, ["trip"], "seq", ["timestamp"], 0, span_seconds=10)
    assert sorted((r.span, [e.seq for e in r.stop_events]) for r in docs.collect()) == [
        (0, list(range(10))), (1, list(range(10, 20))), (2, list(range(20, 25))),
    ]


def test_feed_merge_cuts_each_day_by_itself(spark):
    from tramline.sinks.tables import merge_daily_feed

    schema = "day int, k string, feed_timestamp long"
    stored = spark.createDataFrame([(1, "a", 100), (1, "b", 9000), (2, "a", 90000), (2, "a", 99000), (3, "a", 1), (3, "a", 2)], schema)
    new = spark.createDataFrame([(1, "b", 9100), (2, "a", 99500)], schema)
    day = [F.col("day")]
    merged = merge_daily_feed(stored, new, ["day", "k"], day)
    assert sorted(map(tuple, merged.select("day", "k", "feed_timestamp").collect())) == [
        (1, "a", 100), (1, "b", 9000), (2, "a", 90000), (2, "a", 99000), (3, "a", 1), (3, "a", 2),
    ]
    assert merge_daily_feed(stored, new.limit(0), ["day", "k"], day).count() == stored.count()


def test_feed_merge_query_keeps_every_row(spark):
    """Rows of either kind at every hour of four days: each has its own payload, so each comes out once."""
    from types import SimpleNamespace

    from tramline.workload import load

    kinds = ["view", "click", "purchase", "error", None]
    rows = [(i, i, f"2024-01-{1 + i % 4:02d} {i // 20 % 24:02d}:30:00", kinds[i % 5]) for i in range(480)]
    made = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string")
    t = SimpleNamespace(events=made.withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "value": F.lit(1.0), "props": F.lit("{}")}))
    found = load()["daily_feed_merge"].build(t).select("trip_id", "event_type").collect()
    assert len(found) == len(set(found)) == 480


def test_nothing_stored_takes_everything(spark):
    from tramline.operators.changes import replace_recent
    from tramline.sources.manifest import schedules_to_process

    rows = spark.sql("SELECT 1 AS id, DATE'2024-01-01' AS d")
    assert replace_recent(rows.limit(0), rows, "d").count() == 1
    index = spark.sql("SELECT 20180105L AS published_date, 20180101L AS feed_start_date, 'v' AS feed_version")
    assert schedules_to_process(index, index.limit(0), 2018).count() == 1


def test_repeated_keys_of_a_batch_become_one_event(spark):
    schema = "k string, stop_sequence int, vp_move_timestamp long, vp_stop_timestamp long, tu_stop_timestamp long"
    stored = spark.createDataFrame([("a", 1, 50, None, None)], schema)
    batch = spark.createDataFrame([("a", 2, 40, None, 7), ("a", 3, None, 60, 9), ("b", 5, None, None, 4), ("b", 5, None, None, 4)], schema)
    found = events.upsert_events(stored, batch, ["k"])
    assert sorted(map(tuple, found.collect())) == [("a", 2, 40, 60, 9), ("b", 5, None, None, 4)]


def test_ids_keep_all_digits(spark):
    from tramline.functions.texts import dated_id

    found = spark.sql("SELECT DATE'2024-01-01' AS d, explode(array(7, 10000, 100000)) AS n").select(dated_id(F.col("d"), F.col("n")))
    assert [r[0] for r in found.collect()] == [2024010100007, 2024010110000, 20240101100000]


def test_backfill_removes_days_that_are_left_empty(spark):
    from tramline.plans.ingest import backfill
    from tramline.session import scratch_path
    from tramline.sinks.tables import write_partitioned

    rows = spark.sql("SELECT n, date_add(DATE'2024-01-01', n) AS day FROM (SELECT explode(sequence(0, 3)) AS n)")
    path = scratch_path(spark, "days")
    write_partitioned(rows, path, ["day"])
    backfill(rows, path, "day", "2024-01-01", "2024-01-02", F.col("n") != 1)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 2, 3]


def test_effective_versions_equal_brute_force(spark):
    rng = random.Random(11)
    feeds, first = [], datetime.date(2024, 1, 1)
    for i in range(60):
        start = first + datetime.timedelta(rng.randrange(-20, 80))
        end = start + datetime.timedelta(rng.choice([-3, 0, 1, 2, 6, 7, 8, 30, 70]))
        published = None if i == 7 else 1704067200 + 86400 * rng.randrange(60)
        feeds.append((published, int(start.strftime("%Y%m%d")), int(end.strftime("%Y%m%d")), rng.choice([f"Fall 20{i}", "Spring 2023", None])))
    got = calendar.effective_versions(
        spark.createDataFrame(feeds, "timestamp long, feed_start_date long, feed_end_date long, feed_version string"), "2024-01-01", "2024-03-31"
    )
    want = {}
    for n in range(91):
        day = first + datetime.timedelta(n)
        live = [
            (ts if ts is not None else -1, version or "")
            for ts, start, end, version in feeds
            if start <= int(day.strftime("%Y%m%d")) <= end
            and (ts is None or datetime.date.fromtimestamp(0) + datetime.timedelta(ts // 86400 + 1) <= day)
        ]
        if live:
            ts, version = max(live)
            want[day] = (None if ts < 0 else ts, (version.split()[1] if version else None))
    assert {r.service_date: (r.effective_timestamp, r.rating_year) for r in got.collect()} == want


def test_effective_versions_spread_only_the_best_feeds_over_days(spark):
    feeds = spark.createDataFrame([(1704067200, 20240101, 20241231, "Fall 2024")], "timestamp long, feed_start_date long, feed_end_date long, feed_version string")
    plan = calendar.effective_versions(feeds, "2024-01-01", "2024-12-31")._jdf.queryExecution().optimizedPlan().toString()
    # the plan reads from its end: days are listed above an aggregate
    assert "Aggregate" in plan[plan.index("explode(sequence") :]


def test_service_calendar_lists_dates_last_and_equals_brute_force(spark):
    rng = random.Random(5)
    first = datetime.date(2024, 1, 1)

    def number(n):
        return int((first + datetime.timedelta(n)).strftime("%Y%m%d"))

    spans = {1: (0, 40), 2: (20, 60), 3: (10, 30)}
    ranges = [
        (rng.choice([1, 2, 3, 4]), f"s{rng.randrange(5)}", a, a + rng.choice([-1, 0, 5, 50]), [rng.choice([0, 1, None]) for _ in range(7)])
        for a in rng.choices(range(-10, 60), k=30)
    ]
    ranges += ranges[:3]
    changes_ = [(rng.choice([1, 2, 3]), f"s{rng.randrange(5)}", rng.randrange(70), rng.choice([0, 1, 2])) for _ in range(60)] * 2
    trips = [(v, f"s{i}", r) for v in (1, 2, 3) for i in range(4) for r in ("Red", None, "Red")] + [(1, None, "Red")]
    rows = [(v, s, number(a), number(b), *flags) for v, s, a, b, flags in ranges] + [(1, "s0", 20240230, 20240310, *[1] * 7), (1, None, number(1), number(9), *[1] * 7)]
    flags = ", ".join(f"{d} int" for d in calendar.WEEKDAYS)
    got = calendar.service_calendar(
        spark.createDataFrame(rows, f"static_version_key long, service_id string, start_date long, end_date long, {flags}"),
        spark.createDataFrame([(v, s, number(d), k) for v, s, d, k in changes_], "static_version_key long, service_id string, date long, exception_type int"),
        spark.createDataFrame([(v, number(a), number(b)) for v, (a, b) in spans.items()], "static_version_key long, feed_start_date long, feed_end_date long"),
        spark.createDataFrame(trips, "static_version_key long, service_id string, route_id string"),
    )
    days = {
        (v, s, n)
        for v, s, a, b, on in ranges
        if v in spans
        for n in range(max(a, spans[v][0]), min(b, spans[v][1]) + 1)
        if on[(first + datetime.timedelta(n)).isoweekday() % 7] == 1
    } | {(v, s, n) for v, s, n, kind in changes_ if kind == 1 and spans[v][0] <= n <= spans[v][1]}
    days -= {(v, s, n) for v, s, n, kind in changes_ if kind == 2}
    want = {(r, s, number(n), v) for v, s, n in days for tv, ts, r in trips if (tv, ts) == (v, s)}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    # the plan reads from its end: nothing that holds rows stands above the lists of dates
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "Aggregate" not in above and "Join" not in above
