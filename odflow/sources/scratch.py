"""Intermediate tables in the shared folder of the cluster.

A written table cuts the lineage, survives the loss of executors, and lets the
planner see the true size of what it joins. It is used where a step would
otherwise be planned blind: split offsets, repeated ids, reused datasets.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_steps: list[list[str]] = []  # what the calls of ``settle`` that are running have written

# Rows that travel to Python at once. An executor holds a batch several times over outside
# its heap while it grows and is sent: with Spark's 10 000 whole texts that is hundreds of MB.
BATCH_ROWS = 1000
_BATCH_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="odflow-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/odflow/{label}-{uuid.uuid4().hex}"


def limit_batches(spark: SparkSession) -> None:
    """Let batches for Python have ``BATCH_ROWS`` rows, unless the session sets a number."""
    if spark.conf.get(_BATCH_ROWS_SETTING, None) is None:
        spark.conf.set(_BATCH_ROWS_SETTING, str(BATCH_ROWS))


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Let a query delete its shuffle files at its end, unless the session says otherwise.

    Else they stay until the driver happens to collect its garbage.
    """
    if spark.conf.get(_CLEANUP_SETTING, None) is not None:
        yield
        return
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP_SETTING)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch folder and read it back."""
    spark = df.sparkSession
    limit_batches(spark)
    path = scratch_path(spark, label)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    if _steps:
        _steps[-1].append(path)
    return table


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned and that nothing reads any more."""
    for table in tables:
        path = _paths.pop(table, None)
        if path is not None:
            _delete(table.sparkSession, path)


def settle(build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, written; tables that it wrote on the way are deleted."""
    _steps.append([])
    try:
        table = materialize(build(), label)
    finally:
        written = _steps.pop()
    if _steps:
        _steps[-1].append(_paths[table])
    for path in written[:-1]:
        _delete(table.sparkSession, path)
    return table
