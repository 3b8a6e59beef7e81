"""File-once ingest: every landing file is loaded exactly once.

The ledger is the checkpoint of a Structured Streaming file source: Spark
records which files a micro-batch takes before it runs, and that it ran
afterwards.  Each batch is written as partition ``load_id=<batch id>`` of the
target with dynamic partition overwrite, so a batch that died half-way is
taken again with the same files and overwrites its partition instead of
adding rows twice.  No list of files is kept or compared here, and the target
is partitioned by load, so a feed of very many small files does not become as many
folders.  ``max_files_per_load`` bounds one load; the run goes on until
nothing is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.streaming.ingest import ingest_available


def file_once_ingest(spark: SparkSession, pattern: str, columns: Sequence[str],
                     ledger_path: str, target_path: str,
                     project: Callable[[DataFrame], DataFrame] = lambda d: d,
                     max_files_per_load: int | None = None) -> int:
    """Append rows of not-yet-loaded files under ``pattern`` to ``target_path``.

    ``project`` is the typed projection (``CAST(date AS DATE)`` ...).
    Returns the number of loads that this run made.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        (project(batch.drop("read_timestamp")).withColumn("load_id", F.lit(f"{batch_id:012d}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("load_id").parquet(target_path))

    return ingest_available(spark, pattern, columns, ledger_path, load, max_files_per_load)
