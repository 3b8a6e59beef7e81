"""Deterministic deduplication.

``dropDuplicates(keys)`` keeps an arbitrary row per key, so two runs (or the
two lazy re-executions of one plan) can keep different rows.  ``dedupe``
keeps the first row per key under a *total* order: the caller's ``order_by``
followed by every other column that has an order (all but maps) as
tie-break.

Plan shape: ``row_number() == 1`` is rewritten by Catalyst into a
``WindowGroupLimit`` that runs once *before* the shuffle (partial, per map
partition) and once after it.  A key holding a third of all rows therefore
ships at most one row per map partition across the network, and the final
window sorts only those survivors — no task ever holds the whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RN = "__kiln_rn"


def _orderable(df: DataFrame, exclude: set[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in exclude and has_order(f.dataType)]


def has_order(kind: DataType) -> bool:
    """Everything but maps (and what holds one) can be sorted by."""
    if isinstance(kind, ArrayType):
        return has_order(kind.elementType)
    if isinstance(kind, StructType):
        return all(has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def first_window(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ()) -> WindowSpec:
    """The rows of one key under ``order_by`` then all columns ascending."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tie = [F.col(c).asc_nulls_last() for c in _orderable(df, set(keys))]
    # with every column a key the rows of a group are equal and any order does
    return Window.partitionBy(*keys).orderBy(*(order + tie or [F.lit(1)]))


def dedupe(df: DataFrame, keys: Sequence[str],
           order_by: Sequence[Column | str] = ()) -> DataFrame:
    """One row per ``keys``: the first under ``order_by`` then all columns ascending."""
    return df.withColumn(_RN, F.row_number().over(first_window(df, keys, order_by))).filter(F.col(_RN) == 1).drop(_RN)
