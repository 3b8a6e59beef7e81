"""Key resolution against a dimension and lookup-based filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.dedupe import dedupe
from kiln.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, bounded_broadcast


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _dim_side(dim: DataFrame, on: list[str], take: Sequence[str], max_bytes: int | None) -> DataFrame:
    # Only the join keys and the taken columns reach the join, so the scan of
    # the dimension is pruned to those (Catalyst adds the IsNotNull filter).
    side = dim.select(*on, *[c for c in take if c not in on])
    return bounded_broadcast(side, max_bytes) if max_bytes else side


def resolve_key(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                take: Sequence[str], how: str = "inner",
                max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """All of ``df`` plus ``take`` columns from ``dim``; unmatched rows dropped for ``inner``.

    Rows of ``df`` are never multiplied if ``dim`` holds a key once.  The
    dimension side is broadcast when its estimated size is within the bound;
    otherwise both sides are shuffled on the key (AQE splits a skewed key on
    the fact side).
    """
    keys = _keys(on)
    return df.join(_dim_side(dim, keys, take, max_broadcast_bytes), keys, how)


def rejects(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
            max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``dim`` (left anti join)."""
    keys = _keys(on)
    side = dim.select(*keys).distinct()
    side = bounded_broadcast(side, max_broadcast_bytes) if max_broadcast_bytes else side
    return df.join(side, keys, "left_anti")


def fill_from_lookup(df: DataFrame, fixes: DataFrame, on: str | Sequence[str],
                     column: str, fix_column: str,
                     max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Left join a correction table; keep ``column`` where set, else take the fix."""
    keys = _keys(on)
    # one correction per key, whatever the table holds: a repeated key must
    # not multiply the rows being fixed
    fixes = dedupe(fixes.select(*keys, fix_column), keys)
    side = _dim_side(fixes, keys, [fix_column], max_broadcast_bytes)
    cols = df.columns
    return (df.join(side, keys, "left")
            .withColumn(column, F.coalesce(F.col(column), F.col(fix_column)))
            .select(*cols))
