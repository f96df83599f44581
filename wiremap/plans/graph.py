"""Report layer: edges, nodes and networks of the network map.

* ``report_connections``: look-back on the gold refresh time, then
  ``na.fill("unknown")`` on string columns.
* ``edge_summary``: one row per (source node, destination node) with the
  sorted sets of ports, pids and commands and the last minute seen.  The sets
  are built with partial aggregation; their size is bounded by distinct values
  (ports, pids, commands), not by rows.
* Node and edge ids are md5 digests of the identifying columns, so they are
  stable across runs and partitionings and need no single-partition numbering.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from wiremap.functions.columns import (
    fill_unknown, format_time, set_label, sorted_set, stable_id,
)
from wiremap.operators.recent import recent
from wiremap.spec import REPORT_LOOKBACK_MINUTES

SOURCE_NODE = ["source_network", "source_hostname", "source_host"]
DESTINATION_NODE = ["destination_network", "destination_hostname", "destination_host"]
EDGE_KEY = SOURCE_NODE + DESTINATION_NODE
SET_COLUMNS = ["source_port", "source_pid", "source_command",
               "destination_port", "destination_pid", "destination_command"]

# Columns of the edge report, in order.
REPORT_COLUMNS = [
    "edge_id", "time", "source_network", "source_hostname", "source_host", "source_port",
    "source_pid", "source_command", "destination_network", "destination_hostname",
    "destination_host", "destination_port", "destination_pid", "destination_command",
]


def report_connections(connections: DataFrame,
                       minutes: int | None = REPORT_LOOKBACK_MINUTES,
                       as_of: Column | dt.datetime | None = None) -> DataFrame:
    return fill_unknown(recent(connections, minutes, "dtk_inserted_at", as_of))


def edge_summary(connections: DataFrame) -> DataFrame:
    """Group the (filled) connection map by its two end nodes.

    A plain hash aggregation on (edge, set values) first collapses the rows to
    their distinct value combinations (fixed-width buffer, map-side combine);
    the sets are then collected from those few rows.  Same sets, same maximum.
    """
    combos = connections.groupBy(*EDGE_KEY, *SET_COLUMNS).agg(F.max("created_at").alias("__last"))
    return combos.groupBy(*EDGE_KEY).agg(
        *[sorted_set(c).alias(c) for c in SET_COLUMNS],
        format_time(F.max("__last")).alias("time"),
    )


def with_ids(summary: DataFrame) -> DataFrame:
    return summary.withColumns({
        "source_id": stable_id(*SOURCE_NODE),
        "destination_id": stable_id(*DESTINATION_NODE),
        "edge_id": stable_id(*EDGE_KEY),
    })


def _node(side: str) -> Column:
    return F.struct(
        F.col(f"{side}_network").alias("network"),
        F.col(f"{side}_id").alias("_id"),
        F.concat(F.col(f"{side}_host"), F.lit("\n"), F.col(f"{side}_hostname")).alias("label"),
    )


def graph_nodes(summary: DataFrame) -> DataFrame:
    """Both ends of every edge, one row per node.

    The two ends are unpivoted with ``explode`` in one pass over the summary
    (a union of two projections would plan the summary twice).
    """
    ends = summary.select(F.explode(F.array(_node("source"), _node("destination"))).alias("n"))
    return ends.select("n.network", "n._id", "n.label").distinct()


def graph_edges(summary: DataFrame) -> DataFrame:
    label = F.concat(
        F.lit("commands: "), set_label("source_command"), F.lit("->"),
        set_label("destination_command"), F.lit("\n"), F.col("time"),
    )
    return summary.select(F.col("edge_id").alias("_id"), "source_id", "destination_id",
                          label.alias("label"))


def graph_networks(nodes: DataFrame) -> DataFrame:
    return nodes.select("network").distinct()


def nodes_by_network(nodes: DataFrame) -> DataFrame:
    """Nodes with the id of their network cluster, clustered by network.

    One distributed result replaces a filter-and-collect per network.
    """
    return nodes.withColumn("cluster_id", stable_id("network")) \
        .repartitionByRange("network", "_id").sortWithinPartitions("network", "_id")


def edge_report(summary: DataFrame) -> DataFrame:
    return summary.select(*REPORT_COLUMNS).orderBy("edge_id")


def network_graph(connections: DataFrame, minutes: int | None = REPORT_LOOKBACK_MINUTES,
                  as_of: Column | dt.datetime | None = None) -> DataFrame:
    """Summary with ids, ready for nodes/edges/report."""
    return with_ids(edge_summary(report_connections(connections, minutes, as_of)))


def packet_detail(packets: DataFrame, minutes: int | None = REPORT_LOOKBACK_MINUTES,
                  as_of: Column | dt.datetime | None = None) -> DataFrame:
    return recent(packets, minutes, "dtk_inserted_at", as_of)
