"""The edge summary straight from packets, without writing the connection pairs.

All pairs that meet at one endpoint (host, port, machine) are a product: every
minute of the endpoint's "source" rows with every peer of its "destination"
rows.  The report only asks for sets of each side's values and for the last
minute, so each side is aggregated first, per endpoint and own network or per
endpoint and peer, and the aggregates are joined: one row for each endpoint and
edge, whatever the number of minutes, packets and peer ports.

The connection map keeps one pair per key, and the machine is no part of that
key.  Where a (host, port) belongs to one machine the kept pairs are the
whole product.  The others (``shared`` endpoints) take the pairwise way, and both
parts are united.  The result equals
``edge_summary(report_connections(connection_map(packets), ...))``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from wiremap.functions.columns import fill_unknown, format_time
from wiremap.operators.recent import recent
from wiremap.plans.connection_map import A_ENDPOINT, B_ENDPOINT, connection_sides, pick_connections
from wiremap.plans.graph import EDGE_KEY, SET_COLUMNS
from wiremap.session import FREE_SHUFFLES, settings
from wiremap.spec import REPORT_LOOKBACK_MINUTES

_HOST_PORT = ["source_host", "source_port"]


def endpoint_edges(a: DataFrame, b: DataFrame, align_minutes: bool = False) -> DataFrame:
    """One row per endpoint and edge: the sets of both sides and the last minute.

    ``a`` and ``b`` are the reduced sides; with ``align_minutes`` an endpoint is
    taken minute by minute.
    """
    a_key, b_key = A_ENDPOINT, B_ENDPOINT
    if align_minutes:
        a_key, b_key = [*a_key, "created_at_minute"], [*b_key, "__b_minute"]
    ours = fill_unknown(a.select(*a_key, "source_network", "source_pid", "source_command",
                                 F.col("created_at_minute").alias("__last")))
    ours = ours.groupBy(*a_key, "source_network").agg(
        F.collect_set("source_pid").alias("source_pid"), F.collect_set("source_command").alias("source_command"),
        F.max("__last").alias("__last"))
    peer = ["destination_network", "destination_hostname", "destination_host"]
    theirs = fill_unknown(b.select(*b_key, *peer, "destination_port", "destination_pid", "destination_command"))
    theirs = theirs.groupBy(*b_key, *peer).agg(
        *[F.collect_set(c).alias(c) for c in ("destination_port", "destination_pid", "destination_command")])
    met = ours.join(theirs, [ours[x] == theirs[y] for x, y in zip(a_key, b_key)], "inner")
    return met.withColumn("source_port", F.array("source_port")).select(*EDGE_KEY, *SET_COLUMNS, "__last")


def _united(parts: DataFrame) -> DataFrame:
    """The sets of each edge's rows united: one row for each endpoint and edge is shuffled, not one a value."""
    lists = parts.groupBy(*EDGE_KEY).agg(*[F.collect_list(c).alias(c) for c in SET_COLUMNS],
                                         F.max("__last").alias("__last"))
    sets = [F.array_sort(F.array_distinct(F.filter(F.flatten(c), lambda x: x.isNotNull()))).alias(c) for c in SET_COLUMNS]
    return lists.select(*EDGE_KEY, *sets, format_time("__last").alias("time"))


def edge_summary_of_packets(packets: DataFrame, minutes: int | None = REPORT_LOOKBACK_MINUTES,
                            as_of: Column | dt.datetime | None = None, align_minutes: bool = False) -> DataFrame:
    """``edge_summary`` of the connection map of ``packets``, by factors.

    One small job over the endpoints of ``packets`` (best a written table) tells
    whether any (host, port) has several machines; without one there is no pairwise part.
    """
    a, b = connection_sides(packets, align_minutes)
    # Null ports and hosts meet nothing.
    machines = packets.filter(F.col("created_at").isNotNull()).groupBy(*_HOST_PORT).agg(
        F.min("source_hostname").alias("__one"), F.max("source_hostname").alias("__other"))
    shared = machines.filter("__one <> __other").select(*_HOST_PORT)
    with settings(packets.sparkSession, FREE_SHUFFLES):
        none_shared = shared.isEmpty()
    if none_shared:
        return _united(endpoint_edges(recent(a, minutes, "dtk_inserted_at", as_of), b, align_minutes))
    alone = a.join(shared, _HOST_PORT, "left_anti")
    pairs = pick_connections(a.join(shared, _HOST_PORT, "left_semi"), b, align_minutes)
    pairs = fill_unknown(recent(pairs, minutes, "dtk_inserted_at", as_of))
    single = pairs.select(*EDGE_KEY, *[F.array(c).alias(c) for c in SET_COLUMNS], F.col("created_at").alias("__last"))
    product = endpoint_edges(recent(alone, minutes, "dtk_inserted_at", as_of), b, align_minutes)
    return _united(product.unionByName(single))
