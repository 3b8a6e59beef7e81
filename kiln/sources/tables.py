"""Named Parquet tables written and read by Spark alone.

A table ``(layer, name)`` is a folder of Parquet files, partitioned by columns where that helps:

* a load writes its own partition ``load_id=<id>`` (``write_load``), so taking a load again replaces it;
* partitions are replaced by Spark's *dynamic partition overwrite*: those present in the
  data are replaced, all others are neither read nor written;
* reads merge the schemas of the files (``mergeSchema``), so a column that a later write adds is NULL in
  older rows.

A plan may not overwrite what it reads.  Data derived from the table it replaces is therefore *staged*: first
computed into a folder of its own below ``_staged/<group>/<id>``, then published from there.
Nothing of the table changes before all stages of a load are complete.  A load that dies
before that leaves the tables as they were; one that dies while publishing is finished by
running it again with the same id, because a complete stage is published as it is and not computed again
from half replaced tables.  While a stage of another id is left, ``begin`` refuses.
Publishing is not atomic for concurrent readers, and a table has one writer at a time.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: partition column of loads; its values are text whatever they look like
LOAD = "load_id"
#: loads, stages and published tables; about half the bytes of the default
CODEC = "zstd"
_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def new_load_id() -> str:
    """Ids that sort in the order of their making."""
    return f"{time.time_ns():020d}"


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """REBALANCE on the partition columns before a partitioned write: AQE
    groups rows of one partition value into few files of the advisory size
    and splits a very large partition value over several tasks, so neither
    tiny files nor one giant writer task arise."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def in_periods(table: DataFrame, column: str, periods: DataFrame) -> DataFrame:
    """Rows of ``table``, partitioned by ``column``, whose value is in ``periods(column)``.

    A semi join with the broadcast list (one row per period): Spark reuses it at run time to scan only
    those partitions (dynamic partition pruning), and no value passes through the driver program.
    """
    return table.join(F.broadcast(periods.select(column).distinct()), column, "left_semi")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- folders (Hadoop FS: works on HDFS, S3, local) ----------------------
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def folder(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def exists(self, layer: str, name: str) -> bool:
        return self._there(self.folder(layer, name))

    # --- reads ---------------------------------------------------------------
    def _scan(self, path: str) -> DataFrame:
        df = self.spark.read.option("mergeSchema", "true").parquet(path)
        typed = StructType([StructField(f.name, StringType()) if f.name == LOAD else f for f in df.schema.fields])
        return df if typed == df.schema else self.spark.read.schema(typed).parquet(path)

    def read(self, layer: str, name: str, empty: StructType | None = None) -> DataFrame:
        """The whole table.  A table that never got a row has no file to tell its columns: it reads as
        an empty one of the schema ``empty``, and is an error without that."""
        try:
            return self._scan(self.folder(layer, name))
        except AnalysisException as e:
            if empty is None or e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            return self.spark.createDataFrame([], empty)

    # --- writes of data that does not read the table --------------------------
    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> DataFrame:
        """Overwrite the table, or append to it (an append may add columns); returns the columns of ``df``."""
        rebalanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(self.folder(layer, name))
        return self.spark.read.schema(df.schema).parquet(self.folder(layer, name))

    def _load_folder(self, layer: str, name: str, load_id: str) -> str:
        if not _SAFE.fullmatch(load_id):
            raise ValueError(f"{load_id!r} cannot name a folder")
        return f"{self.folder(layer, name)}/{LOAD}={load_id}"

    def has_load(self, layer: str, name: str, load_id: str) -> bool:
        return self._there(f"{self._load_folder(layer, name, load_id)}/_SUCCESS")

    def write_load(self, df: DataFrame, layer: str, name: str, load_id: str) -> DataFrame:
        """Write ``df`` as the partition of one load, whatever it held before; returns that partition."""
        path = self._load_folder(layer, name, load_id)
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_load(self, layer: str, name: str, load_id: str) -> None:
        self._delete(self._load_folder(layer, name, load_id))

    # --- staged writes ---------------------------------------------------------
    def _stage_folder(self, group: str, load_id: str = "") -> str:
        return f"{self.root}/_staged/{group}" + (f"/{load_id}" if load_id else "")

    def begin(self, group: str, load_id: str) -> None:
        """Refuse to start while a load with another id is unfinished."""
        p, fs = self._fs(self._stage_folder(group))
        left = {st.getPath().getName() for st in fs.listStatus(p)} - {load_id} if fs.exists(p) else set()
        if left:
            raise RuntimeError(f"the load {sorted(left)} of {group} did not finish: run it again with its id first")

    def stage(self, df: DataFrame, group: str, load_id: str, layer: str, name: str,
              partition_by: Sequence[str] = ()) -> DataFrame:
        """Compute ``df`` into the stage of a table, unless that is complete already; returns the staged rows."""
        path = f"{self._stage_folder(group, load_id)}/{layer}/{name}"
        if not self._there(f"{path}/_SUCCESS"):
            df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def publish(self, staged: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the partitions present in ``staged`` (the whole table if it is not partitioned), which does not
        read the table.  Rows that do not lie by partition come ``rebalanced``, or each task writes a file for each partition."""
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partition_by else "static")
         .option("compression", CODEC).partitionBy(*partition_by).parquet(self.folder(layer, name)))

    def end(self, group: str, load_id: str) -> None:
        """Drop the stages of a load; everything is published."""
        self._delete(self._stage_folder(group, load_id))

    def replace(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> None:
        """Stage and publish one table; ``df`` may read what it replaces.

        ``finish`` has to run before ``df`` is made, if a run may have died here.
        """
        group, load_id = f"{layer}-{name}", "replace"
        self.publish(rebalanced(self.stage(df, group, load_id, layer, name), partition_by), layer, name, partition_by)
        self.end(group, load_id)

    def finish(self, layer: str, name: str, partition_by: Sequence[str] = ()) -> None:
        """Publish what a ``replace`` that died had staged completely; drop what it had not."""
        group, load_id = f"{layer}-{name}", "replace"
        path = f"{self._stage_folder(group, load_id)}/{layer}/{name}"
        if self._there(f"{path}/_SUCCESS"):
            self.publish(rebalanced(self.spark.read.parquet(path), partition_by), layer, name, partition_by)
        self.end(group, load_id)
