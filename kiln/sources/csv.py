"""CSV landing files with per-row file lineage (A1-A4).

Values are read as text: types do not drift with the content of a batch (an
inferred int column turns bigint or string depending on what arrived); typing
is the cleaning step's job (``kiln.functions.clean``).  Columns are taken by
the *names in the header*, so a file with another column order is read right
and a column that a later file adds is kept.  The files of one read must
share one header: a file that differs fails the read instead of having its
values put into the wrong columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LINEAGE_COLS = ("read_timestamp", "file_name", "file_size")
CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def header_columns(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Column names in the header (one line of one file is read)."""
    return spark.read.option("header", "true").csv(paths if isinstance(paths, str) else list(paths)).columns


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = (),
             lineage: bool = True, timestamp: bool = True, corrupt: bool = False) -> DataFrame:
    """Header CSV files -> text columns (+ ``read_timestamp``, ``file_name``, ``file_size``).

    ``columns`` must be in the header and come first, in that order; columns the
    header has besides follow.  With ``corrupt`` the text of a row with too
    many or too few values is kept in ``_corrupt_record``.
    ``file_name``/``file_size`` come from the hidden ``_metadata`` column, so
    they are exact per row in batch and in streaming reads.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    header = header_columns(spark, paths)
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"no column {missing} in the header {header}")
    fields = text_schema([*header, CORRUPT] if corrupt else header)
    df = (spark.read.schema(fields).option("header", "true").option("enforceSchema", "false")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    order = [*columns, *[c for c in header if c not in columns], *([CORRUPT] if corrupt else [])]
    return with_lineage(df, timestamp, order) if lineage else df.select(*order)


def with_lineage(df: DataFrame, timestamp: bool = True, columns: Sequence[str] = ("*",)) -> DataFrame:
    out = df.select(*columns, F.col("_metadata.file_name").alias("file_name"),
                    F.col("_metadata.file_size").alias("file_size"))
    return out.withColumn("read_timestamp", F.current_timestamp()) if timestamp else out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, every value written as text."""
    df.select(*[F.col(c).cast("string") for c in df.columns]) \
        .write.mode(mode).option("header", "true").csv(path)
