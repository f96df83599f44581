"""Look-back filter on an ingest clock.

Rows count as recent when ``floor(epoch(col)) > floor(epoch(as_of)) - minutes*60``.
Written that way the column hides inside a function and the filter cannot
reach the parquet reader.  For whole seconds the condition is the same as
``col >= trunc_second(as_of) - (minutes*60 - 1) seconds``, a plain range on
the column that Spark pushes to the scan (and to partition pruning).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def lower_bound(minutes: int, as_of: Column | dt.datetime | None = None) -> Column:
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of)
    seconds = int(minutes) * 60 - 1
    return F.date_trunc("second", as_of) - F.make_dt_interval(secs=F.lit(seconds))


def recent(df: DataFrame, minutes: int | None, col: str = "dtk_inserted_at",
           as_of: Column | dt.datetime | None = None) -> DataFrame:
    """Rows of the last ``minutes`` minutes before ``as_of`` (default: now); ``None`` keeps all."""
    if minutes is None:
        return df
    # The bound takes the column's own type: a cast column would not reach the reader.
    bound = lower_bound(minutes, as_of).cast(df.schema[col].dataType)
    return df.filter(F.col(col) >= bound)


def latest_value(df: DataFrame, col: str) -> Column:
    """The largest value of a clock column as a constant of the column's type.

    One small job before the plan is built; a constant bound is pushed to the
    parquet reader, a scalar subquery is not.
    """
    value = df.select(F.max(col).cast("string")).first()[0]
    return F.lit(value).cast(df.schema[col].dataType)
