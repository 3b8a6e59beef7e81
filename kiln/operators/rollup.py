"""Monthly rollup and recomputation of affected months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.clean import month_start


def monthly_rollup(df: DataFrame, date_col: str, keys: Sequence[str],
                   measure: str, out_date: str = "date", out_measure: str | None = None,
                   cast: str | None = "bigint") -> DataFrame:
    """Sum ``measure`` per (month of ``date_col``, ``keys``).

    Hash aggregate with a partial (map-side) sum, so a hot key is combined
    on every map task before the shuffle.  The sum is cast *after* summing
    (a fractional daily quantity is not truncated row by row).
    """
    total = F.sum(measure)
    total = total.cast(cast) if cast else total
    return (df.groupBy(month_start(date_col).alias(out_date), *keys)
            .agg(total.alias(out_measure or measure)))


def date_range(df: DataFrame, date_col: str,
               start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row: earliest and latest value of ``date_col`` (F2)."""
    return df.agg(F.min(date_col).alias(start), F.max(date_col).alias(end))


def affected_periods(batch: DataFrame, date_col: str, out: str = "month") -> DataFrame:
    """Distinct months present in a batch; NULL dates are left out."""
    return (batch.select(month_start(date_col).alias(out))
            .filter(F.col(out).isNotNull()).distinct())


def restrict_to_periods(fact: DataFrame, date_col: str, periods: DataFrame,
                        period_col: str = "month") -> DataFrame:
    """Rows of ``fact`` whose month is among ``periods``.

    The period list is distinct, so an inner join equals a left semi join;
    the semi join never multiplies fact rows.  The list is made distinct here,
    so it has at most one row per calendar month, and is broadcast.
    """
    keyed = fact.withColumn("__kiln_month", month_start(date_col))
    months = F.broadcast(periods.select(month_start(period_col).alias("__kiln_month")).distinct())
    return keyed.join(months, "__kiln_month", "left_semi").drop("__kiln_month")


def recompute_periods(fact: DataFrame, date_col: str, periods: DataFrame,
                      keys: Sequence[str], measure: str, out_date: str = "date",
                      out_measure: str | None = None, cast: str | None = "bigint",
                      period_col: str = "month") -> DataFrame:
    """Full monthly sums, but only for the affected months (K4).

    Replacing a month's sums by a recomputation (never adding a delta) makes
    re-running a batch idempotent.
    """
    return monthly_rollup(restrict_to_periods(fact, date_col, periods, period_col),
                          date_col, keys, measure, out_date, out_measure, cast)
