"""Column-level helpers; everything stays a built-in Spark expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Fixed value: separator between the parts of a hashed id (ASCII unit separator).
ID_SEPARATOR = "\x1f"

# Fixed value: report time format.
REPORT_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asc_last(c: str | Column) -> Column:
    return _col(c).asc_nulls_last()


def desc_last(c: str | Column) -> Column:
    return _col(c).desc_nulls_last()


def stable_id(*cols: str | Column) -> Column:
    """Deterministic id: md5 over the parts joined by a separator.

    Unlike a 32-bit hash it does not collide in practice, and unlike a
    generated row number it does not depend on partitioning.  ``concat_ws``
    skips nulls, so fill nulls first (``fill_unknown``) where that matters.
    """
    return F.md5(F.concat_ws(ID_SEPARATOR, *[_col(c).cast("string") for c in cols]))


def fill_unknown(df: DataFrame, value: str = "unknown") -> DataFrame:
    """``na.fill`` on string columns only; numbers and arrays keep their nulls."""
    return df.na.fill(value)


def format_time(c: str | Column) -> Column:
    return F.date_format(_col(c), REPORT_TIME_FORMAT)


def sorted_set(c: str | Column) -> Column:
    """Distinct non-null values in ascending order (``[]`` when all are null)."""
    return F.array_sort(F.collect_set(_col(c)))


def set_label(c: str | Column, empty: str = "unknown") -> Column:
    """``[a, b]`` rendering of an array, or ``empty`` for an empty one."""
    c = _col(c)
    return F.when(F.size(c) == 0, F.lit(empty)).otherwise(c.cast("string"))


def to_ltz(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp_ntz`` column to ``timestamp`` (session zone).

    Watermarks need ``timestamp``; the driver tables store wall-clock NTZ.
    """
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
             if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(casts) if casts else df
