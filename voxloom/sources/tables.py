"""Tables by name, and spreading small ones over the cores there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a small table in as many partitions as there are cores.

    A small table may be a single file, which one task would read and then work on alone. A table
    whose size gives every core a full read partition, or with a file for each, is left as it is and
    not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    full = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * full and len(df.inputFiles()) < cores else df
