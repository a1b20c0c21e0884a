"""Parquet tables: declared columns, partitions by day, date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.nested import underscore_names


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and type; absent ones are null."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def scan_project(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, where: Column | None = None
) -> DataFrame:
    """Read files of drifting schemas as one declared table.

    The filter stands before the projection, on raw columns, so Parquet can
    skip row groups; only declared columns are read.
    """
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    if where is not None:
        df = df.filter(where)
    return conform(df, schema)


def scan_partitions(spark: SparkSession, base: str, where: Column | None = None) -> DataFrame:
    """Hive-partitioned dataset; filters on partition columns choose folders."""
    df = spark.read.parquet(base)
    return df if where is None else df.filter(where)


def partition_date() -> Column:
    """Date of ``year``/``month``/``day`` partition columns; prunes folders when filtered on."""
    return F.make_date("year", "month", "day")


def scan_date_range(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """All days from ``first`` to ``last``, both included; days without data are no error."""
    return scan_partitions(spark, base, partition_date().between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def read_ymd(spark: SparkSession, base: str, start: str, end: str) -> DataFrame:
    """Days from ``start`` up to, not with, ``end``; dotted names become underscores."""
    days = scan_partitions(
        spark,
        base,
        (partition_date() >= F.lit(start).cast("date")) & (partition_date() < F.lit(end).cast("date")),
    )
    return underscore_names(days)
