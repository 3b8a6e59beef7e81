"""Cut lineage by writing a table into the shared checkpoint folder.

``materialize(df)`` computes ``df`` once, writes it as Parquet below
``spark.checkpoint.dir`` (a folder every executor can reach) and returns a
DataFrame reading it back.  Unlike ``DataFrame.checkpoint()`` on an
unpersisted plan it computes the data once, and the copy is columnar with
file statistics.  Lost executors do not lose it: it lives on the shared
file system, not in executor memory or local disk.

Copies made inside ``scratch_scope`` are deleted when the scope ends, so the
scope has to enclose the write that consumes them.  Outside of a scope a copy
stays until ``spark.checkpoint.dir`` is cleaned, because a lazy result may
still read it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from kiln.session import scratch_path

_scopes: list[list[str]] = []


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the copies that ``materialize`` makes inside the ``with`` block at its end."""
    _scopes.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scopes.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
