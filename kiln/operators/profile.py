"""Data-quality looks as DataFrames (O1: D2, D6, D7, F3-F6)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "count") -> DataFrame:
    """Keys occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def untrimmed(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` has leading or trailing blanks."""
    return df.filter(F.col(col) != F.trim(F.col(col)))


def missing_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def row_count(df: DataFrame, stage: str) -> DataFrame:
    """One row ``(stage, rows)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")


def row_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row counts of several stages of one pipeline, one row each."""
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in stages])


def stage_counts(df: DataFrame, stages: Sequence[tuple[str, Column | None]]) -> DataFrame:
    """Rows ``(stage, rows)`` for several filters of one relation in one pass:
    ``None`` counts every row, a condition counts the rows it keeps."""
    aggs = [(F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(f"__s{i}")
            for i, (_, cond) in enumerate(stages)]
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(f"__s{i}").alias("rows"))
                     for i, (name, _) in enumerate(stages)])
    return df.agg(*aggs).select(F.inline(rows))


def count_distinct(df: DataFrame, cols: Sequence[str], alias: str = "n_distinct") -> DataFrame:
    """Exact number of distinct ``cols`` tuples (F5); NULL-containing tuples not counted."""
    return df.agg(F.count_distinct(*[F.col(c) for c in cols]).alias(alias))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct tuples of ``cols``."""
    return df.select(*cols).distinct()


def profile(df: DataFrame, keys: Sequence[str], text_cols: Sequence[str] = ()) -> DataFrame:
    """One-row summary in a single aggregate pass: rows, distinct keys, NULLs
    per column, untrimmed values per text column."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    aggs += [F.count_if(F.col(c) != F.trim(F.col(c))).alias(f"untrimmed_{c}") for c in text_cols]
    return df.agg(*aggs)
