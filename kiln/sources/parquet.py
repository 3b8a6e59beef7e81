"""Parquet scans with a floor on task parallelism.

A Parquet split cannot be smaller than a row group, so a table stored as
one large row group is scanned by one task, and every per-row expression
after it (text parsing, hashing) runs on one core.  ``read_parquet`` asks
the planner how many splits the scan has (file metadata only) and, only when
there is a single one *and* the input is not tiny (``min_bytes``, from the file
system's size summary), adds a round-robin repartition to the cluster's
default parallelism.  A table of several splits is left alone, whatever the
number of cores; a 25-row dimension is not worth a shuffle either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    return df.repartition(want) if have == 1 < want else df


def _size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()


def read_parquet(spark: SparkSession, path: str, min_partitions: int | None = None,
                 min_bytes: int = 1 << 20) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df, min_partitions) if _size(spark, path) >= min_bytes else df
