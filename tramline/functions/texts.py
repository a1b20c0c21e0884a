"""Text columns: trip-id suffixes, codes, labels and ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_first(text: Column, pattern: str) -> Column:
    """Remove the first match only (``regexp_replace`` alone removes every one)."""
    return F.regexp_replace(text, rf"(?s)^(.*?)(?:{pattern})", "$1")


def strip_overload_suffix(trip_id: Column) -> Column:
    return drop_first(trip_id, r"-OL\d?")


def strip_variant_suffix(trip_id: Column) -> Column:
    return drop_first(trip_id, r"_\d")


def strip_trip_suffix(trip_id: Column) -> Column:
    """Trip id without its overload (``-OL1``) and variant (``_2``) marks."""
    return strip_variant_suffix(strip_overload_suffix(trip_id))


def trip_suffix(trip_id: Column) -> Column:
    """Digit after ``-OL`` (the reference's group 1); null when there is none."""
    return F.nullif(F.regexp_extract(trip_id, r"-OL(\d?)|_(\d)$", 1), F.lit(""))


def waiver_code(remark: Column) -> Column:
    """Leading code of one to five letters, else a fixed label, so no free text leaks."""
    code = F.nullif(F.regexp_extract(remark, r"^(\p{Alpha}{1,5})\b[ -:]*", 1), F.lit(""))
    return F.coalesce(code, F.lit("Unrecognized Code"))


def strip_leading_zeros(code: Column) -> Column:
    return F.ltrim(code, F.lit("0"))


def dated_id(date: Column, number: Column) -> Column:
    """``YYYYMMDD`` followed by a number of five digits or more, as one long; no digit is cut off."""
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(5)), F.lit("0"))
    return F.concat(F.date_format(date, "yyyyMMdd"), padded).cast("long")


def joined_id(parts: Sequence[Column], separator: str = "-") -> Column:
    """Key columns joined into one id; null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(separator), part.cast("string")]
    return F.concat(*pieces[1:])


def rating_season(version_text: Column) -> Column:
    """``Fall 2024, ...`` -> ``Fall``."""
    return F.split_part(F.split_part(version_text, F.lit(","), F.lit(1)), F.lit(" "), F.lit(1))


def rating_year(version_text: Column) -> Column:
    """``Fall 2024, ...`` -> ``2024``."""
    return F.split_part(F.split_part(version_text, F.lit(","), F.lit(1)), F.lit(" "), F.lit(2))


def provenance(first_present: Column, second_present: Column, first: str, second: str, both: str) -> Column:
    """Which of two sources a joined row came from, by the null pattern of its keys."""
    return F.when(second_present.isNull(), first).when(first_present.isNull(), second).otherwise(both)


def jsonapi_event(kind: str, event_id: Column, attributes: Sequence[str], relationships: dict[str, Column]) -> Column:
    """One event as a JSON document: id, type, attributes and relationships."""
    related = [
        F.struct(F.struct(col.cast("string").alias("id"), F.lit(name).alias("type")).alias("data")).alias(name)
        for name, col in relationships.items()
    ]
    return F.to_json(
        F.struct(
            event_id.cast("string").alias("id"),
            F.lit(kind).alias("type"),
            F.struct(*[F.col(a) for a in attributes]).alias("attributes"),
            F.struct(*related).alias("relationships"),
        )
    )
