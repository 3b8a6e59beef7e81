"""Appends and schema-evolving unions.

Columns and types may change from batch to batch.  Columns are matched by name; one that a batch
lacks is NULL there.  A column whose types differ reads as the first type of
``int -> bigint -> double -> string`` that holds all of them (a date and a timestamp meet as a timestamp, anything
else as a string), so no value is lost to the type of an earlier batch.  Where whole numbers and fractions
meet, whole numbers beyond 2**53 are rounded to a double.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               NullType, ShortType, StringType, TimestampNTZType, TimestampType)

SHAPE = "batch_shape"
_LADDER = (ByteType(), ShortType(), IntegerType(), LongType(), DoubleType(), StringType())


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds in ({DateType, TimestampType}, {DateType, TimestampNTZType}):
        return a if type(b) is DateType else b
    if kinds == {DecimalType} or kinds & {DecimalType} and kinds & {ByteType, ShortType, IntegerType, LongType}:
        digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
        size = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (digits[type(t)], 0) for t in (a, b)]
        whole, scale = max(x for x, _ in size), max(y for _, y in size)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    step = {type(t): k for k, t in enumerate(_LADDER)} | {FloatType: 4}  # a float is a double, exactly
    if type(a) in step and type(b) in step:
        return _LADDER[max(step[type(a)], step[type(b)])]
    return StringType()


def union_evolving(*dfs: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is NULL there, types are widened."""
    types: dict[str, DataType] = {}
    for df in dfs:
        for f in df.schema.fields:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    cast = [df.select(*[F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name) if f.dataType != types[f.name]
                        else F.col(f"`{f.name}`") for f in df.schema.fields]) for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def append_parquet(df: DataFrame, path: str) -> None:
    """Append a batch to a Parquet folder (B2).  Batches of one schema share a sub-folder ``batch_shape=<digest>``,
    so a folder that Spark reads has one schema, however many batches it holds."""
    shape = hashlib.sha256(",".join(sorted(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)).encode()).hexdigest()[:16]
    df.write.mode("append").parquet(f"{path}/{SHAPE}={shape}")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder of appended batches (B4): one scan per schema, united and widened by ``union_evolving``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    shapes = sorted(st.getPath().toString() for st in found if st.getPath().getName().startswith(f"{SHAPE}="))
    return union_evolving(*[spark.read.parquet(x) for x in shapes])
