"""Landing-folder ingest with Structured Streaming, exactly once per file (M1).

A text file stream over the landing folder, ``trigger(availableNow=True)`` so each
run drains what has landed and stops, and ``foreachBatch`` handing every
micro-batch to a batch function (for example ``kiln.plans.facts`` through a
``TableStore``).  The checkpoint records which files were taken, so a rerun
takes none twice, and a micro-batch that fails is replayed with the same
files.  ``cleanSource=archive`` moves taken files to an archive folder
(it lags one batch behind; the checkpoint, not the folder, is the truth).
Late, old-dated rows need no watermark: they just add their month to the
batch's affected months.

Files of one folder may have different headers: other column orders, more columns, fewer.  The files
of a micro-batch are grouped by their header line, each group is read as CSV with its own header
(values are never put into the wrong columns), and the groups are united by column name.
A column that a file lacks is NULL for its rows; rows with too few or too many values keep their text in
``_corrupt_record``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kiln.operators.sizing import smaller_splits
from kiln.operators.union import union_evolving
from kiln.sources.csv import CORRUPT, LINEAGE_COLS, read_csv

#: bytes of a file that are looked at for its header line; a task sorts that much text
HEADER_SPLIT_BYTES = 16 << 20


def landing_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                   archive_dir: str | None = None) -> DataFrame:
    """The lines of landed files with their place; files are taken whatever their age."""
    reader = spark.readStream.option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.text(landing).select("value", F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("start"))


def files_by_header(lines: DataFrame) -> dict[str, list[str]]:
    """The files of a micro-batch by header line: one row per file comes to the driver, which has listed them."""
    # the first line of the first block; ids ascend with the lines of a block
    first = (lines.withColumn("at", F.monotonically_increasing_id()).filter("start = 0").groupBy("file")
             .agg(F.min_by("value", "at").alias("header")))
    jvm = lines.sparkSession.sparkContext._jvm
    groups = defaultdict(list)
    for row in first.sort("file").collect():  # the metadata column gives an encoded URI
        groups[row.header].append(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.file)).toString())
    return dict(groups)


def read_mixed(spark: SparkSession, groups: dict[str, list[str]], columns: Sequence[str]) -> DataFrame:
    """The files of all groups by column name: ``columns`` first, then what else the headers have, then lineage."""
    read = union_evolving(*[read_csv(spark, files, corrupt=True) for files in groups.values()])
    missing = {c: F.lit(None).cast(StringType()) for c in columns if c not in read.columns}
    read = read.withColumns(missing) if missing else read
    rest = [c for c in read.columns if c not in (*columns, *LINEAGE_COLS, CORRUPT)]
    return read.select(*columns, *rest, CORRUPT, *LINEAGE_COLS)


def ingest_available(spark: SparkSession, landing: str, columns: Sequence[str],
                     checkpoint: str, process_batch: Callable[[DataFrame, int], None],
                     max_files_per_trigger: int | None = None,
                     archive_dir: str | None = None) -> int:
    """Drain every file that has landed, one ``process_batch(df, batch_id)`` per micro-batch.

    Returns the number of micro-batches that carried data.
    """
    seen = []

    def _run(lines: DataFrame, batch_id: int) -> None:
        groups = files_by_header(lines)
        if groups:
            process_batch(read_mixed(lines.sparkSession, groups, columns), batch_id)
        seen.append(batch_id)

    # only the first split of a file is aggregated for its header; a micro-batch's scan is planned before it is handed on
    with smaller_splits(spark, HEADER_SPLIT_BYTES):
        q = (landing_stream(spark, landing, max_files_per_trigger, archive_dir)
             .writeStream.foreachBatch(_run)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    return len(seen)
