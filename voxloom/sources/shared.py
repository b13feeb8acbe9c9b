"""The folder that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in one JVM (``local[...]``) may do without the setting; it then gets a
    temporary folder, which is also set for the session. A cluster without it is an error,
    because no machine-local folder is visible to the other executors.
    """
    found = spark.conf.get(_SETTING, None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {_SETTING} to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="voxloom-")
    spark.conf.set(_SETTING, made)
    return made


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/voxloom/{label}-{uuid.uuid4().hex}"
    fs, hadoop = _file_system(spark, path)
    fs.deleteOnExit(hadoop)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result has no lineage above the files, so it survives lost executors and is computed once.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # the shuffle files of this one write go when it ends
    try:
        df.select("*").write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._voxloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stage` that nothing will read again."""
    path = getattr(df, "_voxloom_path", None)
    if path:
        fs, hadoop = _file_system(df.sparkSession, path)
        fs.delete(hadoop, True)
