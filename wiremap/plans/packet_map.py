"""Gold packet map: one row per packet with its two interfaces and its process.

    network_ip --(_id, hostname)-- network_packet          ip_packet        (inner)
      --(source_host, hostname)-- interface                packet_with_host (inner)
      --(destination_host)------- interface                                 (inner)
      --(_id=packet_id, hostname)-- [process_network       packet_with_process (left)
           --(pid, hostname)-- process]                    (left, joined first)
      as-of pick: earliest start before the packet         pick_process
      (latest start: time-bucketed as-of join)             packet_with_latest_process
      19-column projection                                 network_map_packet

Plan notes
* Both interface joins read one size-checked broadcast of the interface table,
  so the packet stream keeps its ``(_id, hostname)`` hash partitioning from the
  first join; the process attributes are joined onto the link table first, so
  the link join and the as-of window reuse that partitioning (the packets are
  not shuffled again).
* ``earliest_starts`` cuts the process table to its earliest non-null start per
  ``(hostname, pid)`` (plus all null-start rows) before the join.  An earlier
  start than the packet exists iff the overall earliest one is earlier, so the
  result is the same as joining every start, without the fan-out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from wiremap.functions.columns import asc_last, desc_last
from wiremap.operators.asof import DEFAULT_BUCKET_SECONDS, asof_latest
from wiremap.operators.latest import latest_by_key, total_order
from wiremap.operators.recent import recent

# Gold packet map columns, in order.
PACKET_COLUMNS = [
    "packet_id", "source_hostname", "source_host", "source_port", "source_network",
    "interface", "created_at", "length", "pid", "ppid", "uid", "command", "full_command",
    "process_started_at", "destination_host", "destination_port", "destination_network",
    "destination_hostname", "dtk_inserted_at",
]

PROCESS_COLUMNS = ["ppid", "uid", "command", "full_command", "process_started_at"]


def ip_packet(network_ip: DataFrame, network_packet: DataFrame) -> DataFrame:
    """Packet metadata for every ip row: inner join on ``(_id, hostname)``."""
    ip = network_ip.select("_id", "hostname", "source_host", "source_port",
                           "destination_host", "destination_port")
    pk = network_packet.select("_id", "hostname", "length", "created_at", "interface")
    return ip.join(pk, ["_id", "hostname"], "inner")


def packet_with_host(packets: DataFrame, interfaces: DataFrame) -> DataFrame:
    """Source interface on the sending machine, destination interface on any machine.

    Rows need both networks and distinct hosts; a host with several
    interfaces yields one row per interface (as written in the pipeline).
    """
    iface = interfaces.filter(F.col("network").isNotNull()).select("host", "hostname", "network")
    src = iface.select(F.col("host").alias("source_host"), "hostname",
                       F.col("network").alias("source_network"))
    dst = iface.select(F.col("host").alias("destination_host"),
                       F.col("network").alias("destination_network"),
                       F.col("hostname").alias("destination_hostname"))
    out = (packets.join(src, ["source_host", "hostname"], "inner")
           .join(dst, ["destination_host"], "inner")
           .filter(F.col("source_host") != F.col("destination_host")))
    return out.select(*packets.columns, "source_network",
                      F.col("hostname").alias("source_hostname"),
                      "destination_network", "destination_hostname")


def earliest_starts(process: DataFrame) -> DataFrame:
    """Earliest non-null start per ``(hostname, pid)``, plus every null-start row."""
    start = F.col("process_started_at")
    first = latest_by_key(process.filter(start.isNotNull()), ["hostname", "pid"],
                          "process_started_at", earliest=True)
    return first.unionByName(process.filter(start.isNull()))


def packet_with_process(packets: DataFrame, process_network: DataFrame, process: DataFrame,
                        reduce_first: bool = True) -> DataFrame:
    """Left-join the packet->pid link, then the process attributes.

    The process table is joined to the link table first (both are keyed by
    ``(pid, hostname)`` there), and the result meets the packets on
    ``(_id, hostname)``, the partitioning the packets already have from their
    first join.  Same rows as joining link then process onto the packets, one
    shuffle of the packet stream fewer when the process side is too big to
    broadcast.
    """
    link = process_network.select(F.col("packet_id").alias("_id"), "hostname", "pid")
    proc = process.select("pid", "hostname", "ppid", "uid", "command", "full_command",
                          F.col("started_at").alias("process_started_at"))
    if reduce_first:
        proc = earliest_starts(proc)
    link_proc = link.join(proc, ["pid", "hostname"], "left")
    out = packets.join(link_proc, ["_id", "hostname"], "left")
    return out.select(*packets.columns, "pid", *PROCESS_COLUMNS)


def packet_with_latest_process(packets: DataFrame, process_network: DataFrame,
                               process: DataFrame, keep_unmatched: bool = False,
                               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Candidates for ``pick="latest"`` without joining every start.

    Each packet row gets the latest start before it through the as-of
    operator.  Rows are then kept as the full join followed by the pick would
    keep them: matched rows; rows whose ``(hostname, pid)`` has no process
    row at all (with nulls); with ``keep_unmatched`` rows whose starts are all
    later (with nulls); plus one row per null-start process row.
    """
    link = process_network.select(F.col("packet_id").alias("_id"), "hostname", "pid")
    with_pid = packets.join(link, ["_id", "hostname"], "left")
    start = F.col("started_at")
    attrs = ["ppid", "uid", "command", "full_command"]
    proc = process.select("pid", "hostname", "started_at", *attrs)
    matched = asof_latest(with_pid, proc.filter(start.isNotNull()), ["hostname", "pid"],
                          "created_at", "started_at", attrs, out="__proc",
                          bucket_seconds=bucket_seconds)
    flags = proc.groupBy("hostname", "pid").agg(F.count(F.lit(1)).alias("__n_any"),
                                                F.count(start).alias("__n_start"))
    m = matched.join(flags, ["hostname", "pid"], "left")
    keep = F.col("__proc").isNotNull() | F.col("__n_any").isNull()
    if keep_unmatched:
        keep = keep | (F.col("__n_start") > 0)
    found = m.filter(keep).select(
        *with_pid.columns, *[F.col("__proc").getField(c).alias(c) for c in attrs],
        F.col("__proc").getField("started_at").alias("process_started_at"))
    null_start = proc.filter(start.isNull()).withColumnRenamed("started_at", "process_started_at")
    no_start = with_pid.join(null_start, ["pid", "hostname"], "inner") \
        .select(*with_pid.columns, *PROCESS_COLUMNS)
    return found.unionByName(no_start)


def pick_process(df: DataFrame, pick: str = "earliest",
                 pick_keys: tuple[str, ...] = ("_id", "hostname", "pid"),
                 keep_unmatched: bool = False) -> DataFrame:
    """As-of pick of the process that was running when the packet was created.

    Rows without a start (no link, no process row, or a null start) are all
    kept.  Of the rows whose start is before ``created_at`` one per
    ``pick_keys`` survives: the earliest (``pick="latest"``: the latest).
    Packets whose starts are all later are dropped, or with
    ``keep_unmatched=True`` kept once with the process attributes cleared.

    ``pick_keys`` includes ``hostname`` so that equal packet ids on two
    machines do not erase each other; ``("_id", "pid")`` is the pipeline's
    original partition.
    """
    if pick not in ("earliest", "latest"):
        raise ValueError("pick must be 'earliest' or 'latest'")
    start = F.col("process_started_at")
    no_start = start.isNull()
    before = start < F.col("created_at")
    clock = asc_last(start) if pick == "earliest" else desc_last(start)
    if keep_unmatched:
        kept = df
        first = [F.coalesce(before, F.lit(False)).desc(), clock]
    else:
        kept = df.filter(no_start | before)
        first = [clock]
    order = total_order(kept, first, used=["process_started_at"], exclude=pick_keys)
    w = Window.partitionBy(*pick_keys, no_start).orderBy(*order)
    out = (kept.withColumn("__rn", F.row_number().over(w))
           .filter(no_start | (F.col("__rn") == 1)).drop("__rn"))
    if keep_unmatched:
        ok = no_start | F.coalesce(before, F.lit(False))
        out = out.withColumns({c: F.when(ok, F.col(c)) for c in PROCESS_COLUMNS})
    return out


def network_map_packet(df: DataFrame, as_of: Column | dt.datetime | None = None) -> DataFrame:
    """The 19 gold columns; ``dtk_inserted_at`` is the refresh time ``as_of``."""
    if as_of is None:
        stamp = F.current_timestamp()
    elif isinstance(as_of, Column):
        stamp = as_of
    else:
        stamp = F.lit(as_of)
    return df.select(
        F.col("_id").alias("packet_id"), "source_hostname", "source_host", "source_port",
        "source_network", "interface", "created_at", "length", "pid", "ppid", "uid",
        "command", "full_command", "process_started_at", "destination_host",
        "destination_port", "destination_network", "destination_hostname",
        stamp.cast("timestamp").alias("dtk_inserted_at"),
    )


def packet_map(network_ip: DataFrame, network_packet: DataFrame, interfaces: DataFrame,
               process_network: DataFrame, process: DataFrame, *,
               as_of: Column | dt.datetime | None = None,
               lookback_minutes: int | None = None,
               dim_lookback: bool = True,
               pick: str = "earliest",
               pick_keys: tuple[str, ...] = ("_id", "hostname", "pid"),
               keep_unmatched: bool = False,
               reduce_first: bool = True) -> DataFrame:
    """Full gold packet map (G1).

    ``lookback_minutes`` applies the ingest-time look-back to the fact tables
    and, with ``dim_lookback`` (the pipeline's behaviour), to the interface and
    process tables as well.
    """
    def window(df: DataFrame, is_dim: bool) -> DataFrame:
        if lookback_minutes is None or (is_dim and not dim_lookback):
            return df
        return recent(df, lookback_minutes, "dtk_inserted_at", as_of)

    pk = ip_packet(window(network_ip, False), window(network_packet, False))
    pk = packet_with_host(pk, window(interfaces, True))
    links, procs = window(process_network, False), window(process, True)
    if reduce_first and pick == "latest":
        pk = packet_with_latest_process(pk, links, procs, keep_unmatched=keep_unmatched)
        return network_map_packet(pick_process(pk, pick=pick, pick_keys=pick_keys), as_of)
    # Exact for the earliest pick whatever the pick keys: per (hostname, pid)
    # an eligible start exists iff the earliest one is eligible, and the
    # minimum over hostnames of those earliest starts is the overall minimum.
    pk = packet_with_process(pk, links, procs, reduce_first=reduce_first)
    pk = pick_process(pk, pick=pick, pick_keys=pick_keys, keep_unmatched=keep_unmatched)
    return network_map_packet(pk, as_of)
