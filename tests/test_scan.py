"""Ordered scans against the plain windows they stand for."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline.operators import scan as S
from tramline.operators.groups import first_row, with_group_values


def _frame(spark, seed, hot=False):
    rng = random.Random(seed)
    data = []
    for i in range(600):
        key = "hot" if hot and i % 3 else rng.choice(["a", "b", None])
        at = None if rng.random() < 0.05 else rng.randrange(400)
        data.append((key, at, i, None if rng.random() < 0.4 else rng.randrange(50)))
    return spark.createDataFrame(data, "key string, at long, id long, value long").repartition(4)


@pytest.mark.parametrize("seed,width,hot", [(1, 7, False), (2, 50, True), (3, 1000, True), (4, 1, False)])
def test_every_kind_equals_the_plain_window(spark, seed, width, hot):
    df = _frame(spark, seed, hot)
    order = [F.col("at"), F.col("id")]
    got = S.ordered(
        df,
        ["key"],
        order,
        S.stretch(F.col("at"), width),
        lag=S.lag(F.col("value")),
        lag_at=S.lag_at(),
        lead=S.lead(F.col("value")),
        before=S.last_before(F.col("value")),
        after=S.first_after(F.col("value")),
        first=S.first_in_key(F.col("value")),
        highest=S.max_before(F.col("value")),
        total=S.sum_before(F.col("value")),
        lowest=S.min_from(F.col("value")),
        n=S.row_number(),
        r=S.rank(),
        d=S.dense_rank(),
        start=S.is_first(),
        end=S.is_last(),
    )
    w = Window.partitionBy("key").orderBy(*order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.select(
        "*",
        F.lag("value").over(w).alias("lag"),
        F.lag("at").over(w).alias("lag_at"),
        F.lead("value").over(w).alias("lead"),
        F.last("value", ignorenulls=True).over(past).alias("before"),
        F.first("value", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
        F.first("value", ignorenulls=True).over(whole).alias("first"),
        F.max("value").over(past).alias("highest"),
        F.coalesce(F.sum("value").over(past), F.lit(0)).alias("total"),
        F.min("value").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("lowest"),
        F.row_number().over(w).cast("long").alias("n"),
        F.rank().over(w).cast("long").alias("r"),
        F.dense_rank().over(w).cast("long").alias("d"),
        F.lag(F.lit(1)).over(w).isNull().alias("start"),
        F.lead(F.lit(1)).over(w).isNull().alias("end"),
    )
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_single_numeric_order_with_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 9, 3), ("b", 2, None), ("b", 30, 4)], "key string, at long, value long"
    )
    got = S.ordered(df, ["key"], [F.col("at")], S.stretch(F.col("at"), 3), p=S.lag(F.col("value")), b=S.last_before(F.col("value")))
    assert {(r.key, r.at): (r.p, r.b) for r in got.collect()} == {
        ("a", None): (None, None), ("a", 5): (1, 1), ("a", 9): (2, 2), ("b", 2): (None, None), ("b", 30): (None, None),
    }


def test_ties_share_a_rank_across_stretches(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 1, 4, 4, 4, 9)], "key string, at long")
    got = S.ordered(df, ["key"], [F.col("at")], S.stretch(F.col("at"), 2), r=S.rank(), d=S.dense_rank())
    assert sorted((r.at, r.r, r.d) for r in got.collect()) == [(1, 1, 1), (1, 1, 1), (4, 3, 2), (4, 3, 2), (4, 3, 2), (9, 6, 3)]


def test_filled_goes_forward_then_back(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 30, None), ("a", 31, "y")], "key string, at long, v string")
    got = S.filled(df, ["key"], [F.col("at")], S.stretch(F.col("at"), 10), ["v"])
    assert sorted((r.at, r.v) for r in got.collect()) == [(1, "x"), (2, "x"), (30, "x"), (31, "y")]


def test_group_values_and_first_row_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "key string, v long")
    assert sorted((str(r.key), r.v, r.n) for r in with_group_values(df, ["key"], n=F.count(F.lit(1))).collect()) == [
        ("None", 1, 2), ("None", 2, 2), ("a", 3, 1),
    ]
    assert sorted((str(r.key), r.v) for r in first_row(df, ["key"], [F.col("v")], last=True).collect()) == [("None", 2), ("a", 3)]


def test_a_hot_key_is_spread_over_stretches(spark):
    df = spark.range(5000).select(F.lit("hot").alias("key"), F.col("id").alias("at"))
    scanned = S.ordered(df, ["key"], [F.col("at")], S.stretch(F.col("at"), 100), n=S.row_number())
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "SinglePartition" not in plan
    assert scanned.agg(F.max("n")).first()[0] == 5000


def test_rows_without_a_time_do_not_share_a_stretch(spark):
    from tramline.operators.metrics import headway

    df = spark.range(2000).select(F.lit("s").alias("station"), F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("t"))
    found = headway(df, ["station"], F.col("t"), "gap", ["id"]).collect()
    assert sorted((r.id, r.gap) for r in found) == [(i, 4 if i % 4 == 0 and i else None) for i in range(2000)]


def test_even_stretches_of_texts_with_common_ends(spark):
    from tramline.operators.scan import even_stretches
    from tramline.sources.manifest import files_by_date, grouped_and_sorted

    paths = [f"bucket/out/{i:06d}/part.parquet" for i in range(3000)]
    files = spark.createDataFrame([("2024-01-01", "a" if i % 3 else "b", p) for i, p in enumerate(paths)], "service_date string, source string, path string")
    cut = even_stretches(files, [F.col("path")], 10)
    sizes = [r["count"] for r in cut.groupBy("_stretch").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 900  # neither one stretch nor one for each path
    found = {(r.source, r.path): r.position for r in files_by_date(files).collect()}
    for source in "ab":
        own = sorted(p for s, p in found if s == source)
        assert [found[source, p] for p in own] == list(range(1, len(own) + 1))
    odd = spark.createDataFrame([(f"x/no-stamp-{i:04d}_type.json",) for i in range(500)] + [(None,)], "path string")
    placed = grouped_and_sorted(odd.where("path is not null")).orderBy("path").collect()
    assert [r.position for r in placed] == list(range(1, 501))


@pytest.mark.parametrize("limit", [0, 150, 10_000])
def test_small_keys_in_plain_windows_and_large_ones_in_stretches_give_the_same(spark, limit):
    from tramline.operators.groups import by_size

    df = _frame(spark, 6, hot=True)
    made = {
        "lag": S.lag(F.col("value")), "lag_at": S.lag_at(), "lead": S.lead(F.col("value")), "before": S.last_before(F.col("value")),
        "after": S.first_after(F.col("value")), "first": S.first_in_key(F.col("value")), "highest": S.max_before(F.col("value")),
        "total": S.sum_before(F.col("value")), "lowest": S.min_from(F.col("value")), "n": S.row_number(), "r": S.rank(),
        "d": S.dense_rank(), "start": S.is_first(), "end": S.is_last(),
    }
    ways = []

    def steps(rows, whole):
        ways.append(whole)
        scanned = S.ordered(rows, ["key"], [F.col("at"), F.col("id")], S.stretch(F.col("at"), 9), whole, **made)
        return with_group_values(scanned, ["key"], whole, most=F.max("value"), rows=F.count(F.lit(1)))

    got, want = by_size(df, ["key"], steps, limit), steps(df, False)
    assert ways[:-1] == ([True] if limit == 10_000 else [True, False])
    assert got.schema.names == want.schema.names and got.count() == 600
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
