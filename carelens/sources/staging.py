"""Tables kept between steps, in the folder the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only where all runs in one process.

    The setting is taken at its word: whether a path without a scheme is a
    mounted share cannot be seen from here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        made = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="carelens-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return _local_roots[context.applicationId]


def _own_folder(spark: SparkSession) -> str:
    """All tables this application keeps."""
    return f"{shared_root(spark)}/carelens-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """A folder nobody else writes to."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def discard(spark: SparkSession) -> None:
    """Delete the tables kept so far; call it when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def save_stage(df: DataFrame, name: str, root: str | None = None, partition_by: list[str] | None = None) -> str:
    """Write a step's table and return its path."""
    path = f"{root or new_folder(df.sparkSession)}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table several later steps read, and go on from the written copy."""
    return read_stage(df.sparkSession, save_stage(df, name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small table, for loops and results read more than once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
