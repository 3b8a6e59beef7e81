"""Broadcast only behind a checked size, without running a job.

``fits`` asks the planner for its size estimate of the relation.  For a stored
table that is the size of its files, known exactly from the file listing.  Files are compressed
and a hashed relation is not, so the estimate is taken ``EXPANSION`` times.  Filters do not lower the estimate and a join
multiplies its inputs', but an ``explode`` is not seen: store such a relation before asking.
``bounded_broadcast`` marks the relation for broadcast when that is
within the bound.  Otherwise it is returned untouched: the planner uses a
shuffle join, and AQE still turns that into a broadcast join if the relation
proves small at run time, or splits a skewed key if it does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: bytes of the hashed relation
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
#: bytes of a hashed row for a byte of a compressed file
EXPANSION = 8


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the relation's size; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return EXPANSION * estimated_bytes(df) <= max_bytes


def hashed_fits(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether the hashed relation of a *stored* table is within the bound, by its rows and the length of its texts: a job over
    these columns.

    ``fits`` is misled by texts that a file holds once in a dictionary, and a relation once a row: ids with a code of 64 characters
    take 30 times the bytes of their file.  The driver holds the relation and its serialised copy while it broadcasts.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    length = sum([F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in texts], F.lit(0)).cast("bigint")
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()
    # a hashed row: key and value, each column in a word of its own besides its text, in a map that is half empty
    return rows * (64 + 16 * len(df.columns)) + 2 * text <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its estimated size is within the bound, else ``df`` for a shuffle join."""
    return F.broadcast(df) if fits(df, max_bytes) else df


@contextmanager
def smaller_splits(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans that start inside the ``with`` block have splits of at most ``most`` bytes, for tasks that sort what they read."""
    key, now = "spark.sql.files.maxPartitionBytes", spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(key, str(min(most, now)))
    try:
        yield
    finally:
        spark.conf.set(key, str(now))


#: a task builds a hash table of a side of a join with at most as many bytes of its shuffle
HASHED_SIDE_BYTES = 64 << 20


@contextmanager
def load_settings(spark: SparkSession, split_bytes: int, writers: int) -> Iterator[None]:
    """``smaller_splits``, and inside the ``with`` block:

    * a task keeps files of up to ``writers`` partitions open instead of sorting its rows by partition (it sorts what goes beyond);
    * a shuffle join whose smaller side has at most ``HASHED_SIDE_BYTES`` in each of its shuffle partitions, which AQE knows, hashes that
      side instead of sorting both.
    """
    conf = spark._jsparkSession.sessionState().conf()
    advisory = conf.getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": max(writers, conf.maxConcurrentOutputFileWriters())}
    if advisory is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory) <= HASHED_SIDE_BYTES:
        wanted["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"] = HASHED_SIDE_BYTES
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        with smaller_splits(spark, split_bytes):
            yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
