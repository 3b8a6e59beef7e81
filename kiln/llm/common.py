"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.session import scratch_path

#: a word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"

#: rows of a broadcast side: beyond this many the join shuffles
MAX_BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a copy every executor can reach, and the copy's file
    size tells the planner how large the table really is.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_stored(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stored`` or an operator wrote below ``spark.checkpoint.dir``, once nothing reads it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def lean_steps(spark: SparkSession, rows: int, max_bytes: int | None = None) -> Iterator[None]:
    """For jobs that each write a table: at most ``rows`` rows (and about ``max_bytes``, one row at least)
    go to Python at once, and a job's shuffle files are deleted when it has ended."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if max_bytes:
        wanted["spark.sql.execution.arrow.maxBytesPerBatch"] = str(max_bytes)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a *stored* table of few narrow columns if its counted rows stay below the bound."""
    return F.broadcast(df) if df.count() <= max_rows else df


def process_wide(name: str, make: Callable):
    """One object per Python worker process, kept from task to task (the functions themselves come
    anew with every task)."""
    kept = vars(sys).setdefault("_kiln_process_wide", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def hash32(*cols: Column | str) -> Column:
    """The first 32 bits of an MD5 over the values, as a long from 0 to 2**32 - 1."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\x00"))
             for c in cols]
    digest = F.md5(F.concat_ws("\x1f", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def running_total(df: DataFrame, group: str, bucket: str, order: Sequence[str],
                  weight: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows of ``group`` that come before, as ``name``.

    ``bucket`` is a column that cuts a group's order into consecutive parts.
    Parts are summed first (combined on the map side), the sums are added up
    over the parts of a group, and rows are only sorted within a part: a
    group that holds a third of all rows spreads over as many tasks as it has
    parts.  ``group`` and ``bucket`` are never NULL.
    """
    df = df.withColumn("__w", weight)
    parts = df.groupBy(group, bucket).agg(F.sum("__w").alias("__sum"))
    over_parts = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, bucket,
                         F.coalesce(F.sum("__sum").over(over_parts), F.lit(0)).alias("__before"))
    in_part = (Window.partitionBy(group, bucket).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    return (df.join(parts, [group, bucket])
            .withColumn(name, (F.col("__before")
                               + F.coalesce(F.sum("__w").over(in_part), F.lit(0))).cast("long"))
            .drop("__w", "__before"))
