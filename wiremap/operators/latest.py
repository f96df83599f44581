"""Latest (or earliest) row per key: ``row_number() = 1`` over a window.

Catalyst plans ``row_number() = 1`` as a ``WindowGroupLimit`` on both sides
of the shuffle, so a hot key is cut to one row per map task before it moves.
The order is made total: the clock, then the declared tie-break columns, then
every other orderable column, so reruns pick the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from wiremap.functions.columns import asc_last, desc_last

_RN = "__rn"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def total_order(df: DataFrame, first: Sequence[Column], used: Sequence[str] = (),
                exclude: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by all other orderable columns, ascending, nulls last."""
    skip = set(used) | set(exclude)
    rest = [asc_last(f.name) for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]
    return list(first) + rest


def latest_by_key(df: DataFrame, keys: Sequence[str], order_col: str = "inserted_at",
                  tie_break: Sequence[str] = (), earliest: bool = False,
                  complete_order: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest ``order_col`` (nulls last); ``earliest`` flips it."""
    clock = asc_last(order_col) if earliest else desc_last(order_col)
    first = [clock] + [asc_last(c) for c in tie_break]
    order = (total_order(df, first, used=[order_col, *tie_break], exclude=keys)
             if complete_order else first)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def one_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> DataFrame:
    """One row per key by ``first`` then every other column (a total order)."""
    order = total_order(df, first, exclude=keys)
    if not order:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
