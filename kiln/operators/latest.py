"""Latest value per group.

``rank() == 1`` keeps ties (two rows for the same latest month);
``row_number() == 1`` keeps exactly one with a total-order tie-break.  Both
become a two-phase ``WindowGroupLimit`` (partial before the shuffle, final
after), so a hot group is cut down on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_R = "__kiln_rank"


def top_per_group(df: DataFrame, group_cols: Sequence[str],
                  order_by: Sequence[Column | str], keep_ties: bool = True,
                  rank_col: str | None = None) -> DataFrame:
    """Rows ranked first in their group under ``order_by``."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if not keep_ties:
        used = set(group_cols)
        order = order + [F.col(c).asc_nulls_last() for c in df.columns if c not in used]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    fn = F.rank() if keep_ties else F.row_number()
    name = rank_col or _R
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) == 1)
    return out if rank_col else out.drop(_R)


def latest_nonzero(df: DataFrame, group_cols: Sequence[str], date_col: str,
                   value_col: str, keep_ties: bool = True) -> DataFrame:
    """Latest row per group, preferring non-zero ``value_col``.

    A group whose values are all zero keeps its latest zero.  NULL dates sort
    last.
    """
    is_zero = F.when(F.col(value_col) == 0, 1).otherwise(0)
    return top_per_group(df, group_cols,
                         [is_zero.asc(), F.col(date_col).desc_nulls_last()],
                         keep_ties=keep_ties)
