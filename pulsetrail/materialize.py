"""Cut a plan by writing it once to the shared checkpoint folder.

Used where an intermediate result is read more than once and recomputing it would
either scan the events again or, for range partitioning, give different answers
(range bounds are sampled, so two evaluations may split rows differently).

The result is Parquet rather than an RDD checkpoint: later reads prune columns, and
the planner knows the size before it decides on a broadcast. It lives on storage all
executors share, so losing executors costs nothing.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names.

    Only a session that names none and runs in a single process, as tests do, gets
    one of its own; with separate executors a missing setting is an error.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pulsetrail-"))
    return context.getCheckpointDir()


def _hadoop_path(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    target = f"{checkpoint_dir(spark).rstrip('/')}/pulsetrail-{name}-{uuid.uuid4().hex}"
    path, files = _hadoop_path(spark, target)
    files.deleteOnExit(path)
    return target


def remove(spark: SparkSession, target: str) -> None:
    """Delete what was written under a scratch path."""
    path, files = _hadoop_path(spark, target)
    files.delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a scan of it.

    The files go with ``release``, or when the Spark application ends.
    """
    spark = df.sparkSession
    target = scratch_path(spark, "copy")
    df.write.parquet(target)
    copy = spark.read.schema(df.schema).parquet(target)
    copy._pulsetrail_copy = target
    return copy


def release(*copies: DataFrame) -> None:
    """Remove materialised copies that nothing will read again."""
    for copy in copies:
        target = getattr(copy, "_pulsetrail_copy", None)
        if target:
            remove(copy.sparkSession, target)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the files of shuffles that no plan refers to any more.

    It does so when the driver collects its garbage, which may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
