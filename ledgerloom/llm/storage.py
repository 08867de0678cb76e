"""Tables that cut lineage, kept in the shared folder the cluster names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.workspace import session_folder


def free_name(columns: list[str], stem: str) -> str:
    """``stem``, or the first of ``stem_1``, ``stem_2``... that is no column, whatever the case."""
    taken = {c.lower() for c in columns}
    number, name = 0, stem
    while name.lower() in taken:
        number += 1
        name = f"{stem}_{number}"
    return name


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it back.

    A lost executor then costs the tasks of one step only, and what later steps see is
    fixed by files, whatever tasks were retried.
    """
    return stored_in(df, label, partition_by)[0]


def stored_in(df: DataFrame, label: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the folder, for steps that are to be :func:`removed` before the method ends."""
    path = session_folder(df.sparkSession, "llm", f"{label}-{uuid.uuid4().hex}")
    with _brief_exchanges(df.sparkSession):
        df.select("*").write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _brief_exchanges(spark: SparkSession) -> Iterator[None]:
    """Queries made inside leave no files of their exchanges behind when they end.

    Otherwise these stay until the driver happens to collect garbage, and the rounds of a
    method pile up on the disks of the executors. A choice that the session has made stays.
    """
    if spark.conf.get(_CLEANUP_SETTING, None) is not None:
        yield
        return
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP_SETTING)


#: Bytes of a batch of rows that goes to Python.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python by their bytes from now on.

    By rows alone a batch holds 10,000 whole texts, which the executor and Python both have
    several copies of. A bound that the session has already stays.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of a step whose successor is written, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
