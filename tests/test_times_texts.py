"""Clock, date and text columns with literal cases."""

import pytest
from pyspark.sql import functions as F

from tramline.functions import nested, texts, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "epoch,expected",
    [(e, 20200307) for e in (1583650800, 1583654399)]
    + [(e, 20200308) for e in (1583654400, 1583654460)]
    + [(e, 20201031) for e in (1604209800, 1604210340, 1604210399, 1604210400, 1604214000, 1604217600, 1604221199)]
    + [(e, 20201101) for e in (1604221200, 1604221260)],
)
def test_service_date_turns_at_four_also_on_clock_changes(spark, epoch, expected):
    assert one(spark, times.service_date(F.lit(epoch))) == expected


@pytest.mark.parametrize("text,expected", [("00:00:00", 0), ("25:10:05", 90605), ("07:38:00", 27480), ("12345", 12345), (None, None), ("soon", None)])
def test_clock_seconds(spark, text, expected):
    assert one(spark, times.clock_seconds(F.lit(text).cast("string"))) == expected


def test_doubled_autumn_hour_is_the_earlier_one(spark):
    utc = times.utc_from_local_seconds(F.lit("2025-11-02").cast("date"), F.lit(5400))
    assert one(spark, F.date_format(utc, "yyyy-MM-dd HH:mm")) == "2025-11-02 05:30"


def test_local_seconds_after_service_midnight(spark):
    # 2024-06-01 08:45 UTC is 04:45 in Boston
    assert one(spark, times.seconds_after_service_midnight(F.lit(1717231500))) == 4 * 3600 + 45 * 60
    # 01:30 local belongs to the day before
    assert one(spark, times.seconds_after_service_midnight(F.lit(1717219800))) == 25 * 3600 + 30 * 60


@pytest.mark.parametrize(
    "version,expected",
    [
        ("Spring 2024, 2024-05-01T02:00:00+00:00, version D", "2024-04-30 22:00"),
        ("Winter 12/3/18 a", "2018-12-03 00:00"),
        ("nothing", None),
    ],
)
def test_published_at(spark, version, expected):
    assert one(spark, F.date_format(times.published_at(F.lit(version)), "yyyy-MM-dd HH:mm")) == expected


@pytest.mark.parametrize("version,expected", [("x 2024-05-01T02:00:00+00:00", 20240430), ("x 2024-05-01", 20240101)])
def test_feed_active_date(spark, version, expected):
    assert one(spark, times.feed_active_date(F.lit(version), F.lit(20240101))) == expected


@pytest.mark.parametrize(
    "trip,expected",
    [("123-OL1", "123"), ("123-OL2", "123"), ("123", "123"), ("456_1", "456"), ("456_2", "456"), ("456_3", "456"), ("7_1_2", "7_2")],
)
def test_trip_suffix_is_removed_once(spark, trip, expected):
    assert one(spark, texts.strip_trip_suffix(F.lit(trip))) == expected


@pytest.mark.parametrize("remark,expected", [("AB - late", "AB"), ("toolong x", "Unrecognized Code"), (None, "Unrecognized Code"), ("12", "Unrecognized Code")])
def test_waiver_code(spark, remark, expected):
    assert one(spark, texts.waiver_code(F.lit(remark).cast("string"))) == expected


def test_joined_id_is_null_when_a_part_is(spark):
    assert one(spark, texts.joined_id([F.lit("a"), F.lit(1)])) == "a-1"
    assert one(spark, texts.joined_id([F.lit("a"), F.lit(None).cast("string")])) is None


def test_explode_keeps_null_lists_and_drops_empty_ones(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id long, l array<string>")
    assert sorted((r.id, str(r.l)) for r in nested.explode_keep_null(df, "l").collect()) == [(1, "a"), (1, "b"), (3, "None")]


def test_flatten_structs_reaches_every_depth(spark):
    df = spark.sql("select 1 id, named_struct('b', named_struct('c', 2, 'd', 'x')) a, array(1) l")
    assert nested.flatten_structs(df).columns == ["id", "a.b.c", "a.b.d", "l"]
    assert nested.underscore_names(nested.flatten_structs(df)).columns == ["id", "a_b_c", "a_b_d", "l"]


def test_flatten_for_export_types(spark):
    df = spark.sql("select array('a','b') l, array(named_struct('x', 1)) s, cast(7 as decimal(20,0)) u")
    assert tuple(nested.flatten_for_export(df).first()) == ("a,b", '[{"x":1}]', 7)
