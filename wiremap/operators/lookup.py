"""Address -> host lookup.

Addresses are ``struct<address, mask, ...>``; struct equality compares every
field, so ``{a,24}`` does not match ``{a,32}``.  The host table is reduced to
one host per address (the smallest name) before the join, so a fact row never
fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def host_by_address(hosts: DataFrame) -> DataFrame:
    """One ``(address, host)`` row per address: the smallest non-null host name."""
    return (hosts.select("address", "host").filter(F.col("address").isNotNull())
            .groupBy("address").agg(F.min("host").alias("host")))


def lookup_host(df: DataFrame, hosts: DataFrame, address_col: str, out_col: str,
                reduced: DataFrame | None = None) -> DataFrame:
    """Left-join ``hosts`` on ``df[address_col] == hosts.address``; adds ``out_col``.

    ``reduced`` lets callers that look up several columns reuse one reduced
    table.  Spark broadcasts it where its size in bytes allows.
    """
    dim = host_by_address(hosts) if reduced is None else reduced
    dim = dim.select(F.col("address").alias("__addr"), F.col("host").alias(out_col))
    return df.join(dim, df[address_col] == F.col("__addr"), "left").drop("__addr")
