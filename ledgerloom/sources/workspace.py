"""The shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster
    a machine-local folder would be lost with its machine, so its absence is an error.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_folders[application]


def session_folder(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared one that belongs to this application alone."""
    return "/".join([shared_folder(spark), "ledgerloom", spark.sparkContext.applicationId, *parts])


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back."""
    path = session_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
