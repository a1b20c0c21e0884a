"""Arrays and structs: flattening, exploding, translations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return f"`{name}`"


def join_labels(items: Column, field: str = "label", separator: str = "|") -> Column:
    """array<struct<label>> -> ``a|b``; null array stays null."""
    return F.array_join(F.transform(items, lambda item: item[field].cast("string")), separator)


def english_text(translations: Column, fallback: Column | None = None, language: str = "en") -> Column:
    """First text in the language; optionally a plain column where there is none."""
    text = F.get(F.filter(translations, lambda t: t["language"] == language), F.lit(0))["text"]
    return text if fallback is None else F.coalesce(text, fallback)


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Struct columns, at any depth, become one column per leaf: ``a.b.c``."""

    def leaves(name: str, col: Column, dtype: T.DataType) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [
                leaf
                for f in dtype.fields
                for leaf in leaves(f"{name}{separator}{f.name}", col.getField(f.name), f.dataType)
            ]
        return [col.alias(name)]

    return df.select(
        *[leaf for f in df.schema.fields for leaf in leaves(f.name, F.col(quoted(f.name)), f.dataType)]
    )


def underscore_names(df: DataFrame) -> DataFrame:
    """Dotted column names -> underscores, so SQL needs no quotes."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def explode_keep_null(df: DataFrame, column: str) -> DataFrame:
    """One row per list item. Null lists keep their row; empty lists vanish."""
    col = F.col(quoted(column))
    element = df.schema[column].dataType.elementType
    one_null = F.array(F.lit(None).cast(element))
    others = [F.col(quoted(c)) for c in df.columns if c != column]
    return df.select(*others, F.explode(F.coalesce(col, one_null)).alias(column))


def explode_active_periods(df: DataFrame, column: str = "active_period") -> DataFrame:
    """One row per period with its start and end; alerts without a period keep one row."""
    others = [F.col(quoted(c)) for c in df.columns if c != column]
    return df.select(*others, F.explode_outer(F.col(quoted(column))).alias("_period")).select(
        *others,
        F.col("_period.start").cast("long").alias(f"{column}_start_timestamp"),
        F.col("_period.end").cast("long").alias(f"{column}_end_timestamp"),
    )


# The fields of an alert's informed entity that are published.
INFORMED_FIELDS = ("route_id", "route_type", "direction_id", "stop_id", "facility_id")


def explode_informed_entities(
    df: DataFrame, column: str = "informed_entity", fields: Sequence[str] = INFORMED_FIELDS
) -> DataFrame:
    """One row per informed entity, its activities joined by a pipe, doubles removed."""
    others = [F.col(quoted(c)) for c in df.columns if c != column]
    return (
        df.select(*others, F.explode_outer(F.col(quoted(column))).alias("_entity"))
        .select(
            *others,
            *[F.col(f"_entity.{f}").alias(f"{column}_{f}") for f in fields],
            F.array_join(F.col("_entity.activities"), "|").alias(f"{column}_activities"),
        )
        .distinct()
    )


def flatten_for_export(df: DataFrame) -> DataFrame:
    """Flat columns only: structs apart, text lists comma-joined, other lists as JSON."""

    def flat(field: T.StructField) -> Column:
        col = F.col(quoted(field.name))
        kind = field.dataType
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.StringType):
                return F.array_join(col, ",").alias(field.name)
            return F.to_json(col).alias(field.name)
        if isinstance(kind, T.DecimalType) and kind.scale == 0:
            return col.cast("long").alias(field.name)
        return col

    flattened = flatten_structs(df)
    return flattened.select(*[flat(f) for f in flattened.schema.fields])


def as_json_text(value: Column) -> Column:
    """A value of uneven shape kept as JSON text."""
    return F.to_json(value)
