"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: safe to apply to a session somebody else made.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # small stages keep their tasks; large ones are far above this anyway
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Settings that only a new session takes.
STARTUP = {
    # without it every Python column call also records its call site in the JVM
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def new_session(master: str, app: str = "tramline", **settings: str) -> SparkSession:
    """A session with all settings of this module; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**STARTUP, **RUNTIME, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Only where a local session names none (tests, a laptop) is a temporary
    folder made, one per application; on a cluster that is an error, because
    executors would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="tramline-")
    return _OWN_FOLDER[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage to the shared folder and go on from the table.

    Runs a job. Unlike ``checkpoint()`` the rows are computed once, later steps
    can prune columns, and the file sizes tell Spark which joins may broadcast.
    Losing executors afterwards loses nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
