"""Session helpers: the shared work folder and the folders on it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset, as in local tests, a folder of this machine is
    taken and set on the context.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        # Not local-cluster: its executors have folders of their own.
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-"))
        current = context.getCheckpointDir()
    return current


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table in the shared folder.

    What reads them more than once does not compute them again, also not after
    the loss of an executor.
    """
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_complete(spark: SparkSession, root: str) -> bool:
    """Whether Spark's writer has finished the table at ``root``."""
    path, fs = _path(spark, f"{root.rstrip('/')}/_SUCCESS")
    return fs.exists(path)


def make_folder(spark: SparkSession, root: str) -> None:
    """Make a folder, where a stream can look for files before there are any."""
    path, fs = _path(spark, root)
    fs.mkdirs(path)


def _path(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
