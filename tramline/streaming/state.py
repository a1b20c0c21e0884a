"""A table that each micro-batch replaces as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionedTable:
    """One folder per batch number; readers take the newest complete one.

    A batch that runs again after a failure reads the same predecessor and
    overwrites only its own folder: the outcome is the same as running once.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _versions(self) -> list[int]:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jvm_path):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        found = []
        for entry in fs.listStatus(jvm_path):
            folder = entry.getPath()
            if folder.getName().startswith("v=") and fs.exists(done(folder, "_SUCCESS")):
                found.append(int(folder.getName()[2:]))
        return sorted(found)

    def before(self, batch: int) -> DataFrame:
        """State the batch starts from."""
        earlier = [v for v in self._versions() if v < batch]
        return self._read(earlier[-1]) if earlier else self.spark.createDataFrame([], self.schema)

    def latest(self) -> DataFrame:
        versions = self._versions()
        return self._read(versions[-1]) if versions else self.spark.createDataFrame([], self.schema)

    def _read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def write(self, df: DataFrame, batch: int, keep: int = 3) -> None:
        """Write the batch's version and drop all but the newest few."""
        df.write.mode("overwrite").parquet(f"{self.path}/v={batch}")
        stale = [v for v in self._versions() if v <= batch][:-keep]
        for version in stale:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
