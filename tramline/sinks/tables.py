"""Partitioned tables, guarded replacement, snapshots, extracts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.nested import quoted
from tramline.operators.aggregates import windowed_dedup
from tramline.operators.validate import Rules, quarantined, valid
from tramline.session import scratch_path
from tramline.sinks.versions import PublishedTable
from tramline.sources.tables import conform


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet by partition columns; only the partitions present in ``df`` are replaced.

    The rebalance hint brings the rows of a value together but splits values
    that are too large for one task, and joins small ones; rows are sorted
    inside each file to compress well.
    """
    laid_out = cluster_sort(df.hint("rebalance", *[F.col(quoted(c)) for c in by]), [*by, *sort])
    laid_out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def cluster_sort(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sort inside each file; no global order, no extra shuffle."""
    return df.sortWithinPartitions(*[F.col(quoted(c)) for c in by]) if by else df


def merge_daily_feed(
    stored: DataFrame,
    new: DataFrame,
    payload: Sequence[str],
    day: Sequence[Column],
    ts: str = "feed_timestamp",
    back_seconds: int = 45 * 60,
) -> DataFrame:
    """Stored rows with new ones; within a day, repeats go from 45 minutes before the day's first new row on.

    ``day`` are the columns that tell a row's day file. Days without new rows stay as they are.
    """
    days = {f"_day{i}": c for i, c in enumerate(day)}
    cuts = new.withColumns(days).groupBy(*days).agg((F.min(ts) - back_seconds).alias("_cut"))
    both = stored.unionByName(new).withColumns(days).withColumn("_on", F.struct(*days))
    both = both.join(cuts.select(F.struct(*days).alias("_on"), "_cut"), "_on", "left").drop("_on")
    return windowed_dedup(both, F.col("_cut"), [*payload, *days], ts).drop(*days)


def guarded_replace(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Replace a table only by one with at least as many rows; read it with ``published``.

    The rows are written once, into a folder of their own; then a small list points to it. Until that moment, and
    whatever happens before, readers have the old rows.
    """
    table = PublishedTable(spark, path)
    return table.replace(df, table.rows())


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that ``guarded_replace`` published last; none where it never did."""
    return PublishedTable(spark, path).read()


def drop_days(spark: SparkSession, path: str, column: str, first: str, last: str, keep: DataFrame) -> None:
    """Remove the date partitions from ``first`` to ``last`` that ``keep`` has no row of."""
    kept = {str(r[0]) for r in keep.select(column).distinct().collect()}  # at most one for each date of the range
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return
    for entry in fs.listStatus(top):
        name, _, value = entry.getPath().getName().partition("=")
        if name == column and first <= value <= last and value not in kept:
            fs.delete(entry.getPath(), True)


def write_snapshot(df: DataFrame, path: str, sort: Sequence[str]) -> None:
    """Sorted gzip JSON lines."""
    df.orderBy(*sort).write.mode("overwrite").option("compression", "gzip").json(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines by a declared schema; an empty table where there is nothing yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_with_quarantine(df: DataFrame, rules: Rules, unique: Sequence[str], path: str, aside: str) -> None:
    """Valid rows to ``path``, the others with their reasons to ``aside``."""
    valid(df, rules, unique).write.mode("append").parquet(path)
    quarantined(df, rules, unique).write.mode("append").parquet(aside)


def append_by_month(df: DataFrame, path: str, start: str) -> None:
    """Append rows clustered by the month of an epoch column; rows without one come last."""
    month = F.coalesce(F.date_format(F.timestamp_seconds(start), "yyyy-MM"), F.lit("none"))
    (
        df.withColumn("start_month", month)
        .repartitionByRange("start_month", start)
        .sortWithinPartitions("start_month", start)
        .write.mode("append")
        .partitionBy("start_month")
        .parquet(path)
    )


def file_index(manifest: DataFrame, url_prefix: str) -> DataFrame:
    """Index of published files: address, size, change time, service date."""
    name = F.substring_index("path", "/", -1)
    date = F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return manifest.select(
        date.alias("service_date"),
        F.concat(F.lit(url_prefix), name).alias("file_url"),
        "size_bytes",
        F.col("last_modified"),
    ).filter(F.col("service_date").isNotNull())


def write_index(index: DataFrame, path: str) -> None:
    """The index as one CSV file with a header, newest date first.

    Tasks write ranges of the order; the file system client then copies their files, by name, into one, 64 KB at a
    time: no task and no memory holds the index.
    """
    spark = index.sparkSession
    parts = scratch_path(spark, "index")
    named = index.select(*[F.col(quoted(c)).cast("string") for c in index.columns])
    named.orderBy(F.desc("service_date"), "file_url").write.csv(f"{parts}/rows")
    header = spark.createDataFrame([tuple(index.columns)], named.schema)
    header.coalesce(1).write.csv(f"{parts}/header")
    join_files(spark, [f"{parts}/header", f"{parts}/rows"], path)


def join_files(spark: SparkSession, folders: Sequence[str], path: str) -> None:
    """All part files of some folders, in order of their names, as one file: aside first, then in its place."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = place.getFileSystem(conf)
    out = fs.create(aside, True)
    for folder in folders:
        top = jvm.org.apache.hadoop.fs.Path(folder)
        own = top.getFileSystem(conf)
        for found in sorted(s.getPath().getName() for s in own.listStatus(top) if s.getPath().getName().startswith("part-")):
            source = own.open(jvm.org.apache.hadoop.fs.Path(top, found))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            source.close()
    out.close()
    if fs.exists(place):
        fs.delete(place, True)
    if not fs.rename(aside, place):
        raise OSError(f"cannot put {path} in place")


def rolling_window(df: DataFrame, date: str, days: int, schema: T.StructType, where: Column | None = None, convert=None) -> DataFrame:
    """The newest date of a table and the ``days`` days before it, filtered, converted, in declared columns."""
    recent = df.filter(F.col(date) >= df.agg(F.date_sub(F.max(date), days)).scalar())
    return extract(recent, schema, where, convert)


def extract(df: DataFrame, schema: T.StructType, where: Column | None = None, convert=None) -> DataFrame:
    """Filter, then the caller's DataFrame function, then the declared columns."""
    out = df if where is None else df.filter(where)
    return conform(out if convert is None else out.transform(convert), schema)


def signed_and_zoneless(schema: T.StructType) -> T.StructType:
    """Types a BI tool takes: no decimals standing for unsigned numbers, no zones, wide floats."""

    def kind(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.DecimalType) and dtype.scale == 0:
            return T.LongType()
        if isinstance(dtype, T.TimestampType):
            return T.TimestampNTZType()
        if isinstance(dtype, T.FloatType):
            return T.DoubleType()
        return dtype

    return T.StructType([T.StructField(f.name, kind(f.dataType), f.nullable) for f in schema.fields])


def typed_export(df: DataFrame) -> DataFrame:
    """Every column cast to its BI type."""
    return conform(df, signed_and_zoneless(df.schema))
