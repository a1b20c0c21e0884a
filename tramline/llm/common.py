"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tramline
from tramline.session import cut_lineage
from tramline.session import prepare as prepare_session

# Arrow batches bounded by rows and by bytes, so that very long texts do not pile up in one batch.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package once per application, for the functions that run there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(tramline.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tramline-code-")) / "tramline-code.zip"  # Spark sends it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    prepare_session(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_rows(df: DataFrame, make: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``make`` turns the rows of a partition (tuples of Python values) into rows of ``schema``.

    Rows come and go in Arrow batches; output is flushed by rows and by bytes of its text and binary values.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def flush(held: list[tuple]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

        held: list[tuple] = []
        weight = 0
        for row in make(rows()):
            held.append(row)
            weight += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= 5000 or weight > 4 << 20:
                yield flush(held)
                held, weight = [], 0
        if held:
            yield flush(held)

    return df.mapInArrow(run, fields)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the table: computed once, safe when executors are lost."""
    return cut_lineage(df, f"llm-{name}")


UNKNOWN = 1 << 56  # Spark's estimate for rows that come from no file is far above


def shards(df: DataFrame, per_shard: int, least: int = 24, most: int = 100_000) -> int:
    """How many shards to deal work into: in proportion to the input's size as Spark estimates it, where it can."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(most, max(least, -(-size // per_shard))) if size < UNKNOWN else least


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def crc_mod(column: str, modulus: int):
    """crc32 of a column's text, modulo; null for null."""
    return F.crc32(F.col(column).cast("string")) % modulus
