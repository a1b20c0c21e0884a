"""Named views over published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.functions.nested import underscore_names
from tramline.sources.tables import stored_table


def create_view(spark: SparkSession, name: str, path: str) -> DataFrame | None:
    """A view over a dataset, its dotted columns renamed, partition columns included; None without data."""
    stored = stored_table(spark, path)
    if stored is None:
        return None
    df = underscore_names(stored)
    df.createOrReplaceTempView(name)
    return df


def create_views(spark: SparkSession, datasets: dict[str, str]) -> list[str]:
    """Views for all datasets that can be read; raises when none can."""
    built = []
    for name, path in datasets.items():
        if create_view(spark, name, path) is not None:
            built.append(name)
    if not built:
        raise ValueError("no dataset could be read")
    return built
