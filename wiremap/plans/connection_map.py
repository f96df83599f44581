"""Gold connection map: who talked to an endpoint, one row per minute and pair.

The pipeline joins the packet map to itself: a "source" packet ``a`` and a
"destination" packet ``b`` pair up when ``a``'s sending endpoint is ``b``'s
receiving endpoint, ``(a.source_host, a.source_port, a.source_hostname) =
(b.destination_host, b.destination_port, b.destination_hostname)``.  One row
is kept per ``(minute(a.created_at), a.source_network, a.source_host,
a.source_port, b.source_host, b.source_port, b.source_network)``.

The minute condition of the pipeline compares ``a.created_at`` with itself,
so the only effect is that ``a.created_at`` must be non-null (parity default).
``align_minutes=True`` compares both packets' minutes instead.

Plan: the self-join is many-to-many, but only one row per output key
survives, chosen by a total order (``a``'s order, then ``b``'s).  Each side is
first cut to its best row per (output key part + join key), which keeps every
winning pair and no other, so the join emits about one row per output row
instead of every packet pair.  A hot endpoint is split by AQE's skew-join
handling; both reductions are ``row_number() = 1`` windows that Catalyst
turns into partial group limits before the shuffle.

The machine is part of the join key and no part of the output key.  Where a
(host, port) sends from one machine only, each pair of the reduced sides is
therefore the only one of its key and goes out as joined; pairs are shuffled and
ranked for the (host, port)s of several machines only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wiremap.session import FREE_SHUFFLES, settings

# Gold connection map columns, in order.
CONNECTION_COLUMNS = [
    "created_at", "source_network", "source_hostname", "source_host", "source_port",
    "source_interface", "source_pid", "source_ppid", "source_uid", "source_command",
    "source_full_command", "source_process_started_at", "destination_network",
    "destination_hostname", "destination_host", "destination_port",
    "destination_interface", "destination_pid", "destination_ppid", "destination_uid",
    "destination_command", "destination_full_command",
    "destination_process_started_at", "dtk_inserted_at",
]

# Per-packet columns copied to each side of a connection.
_SIDE = ["interface", "pid", "ppid", "uid", "command", "full_command", "process_started_at"]

# Total order of packet-map rows used to pick the representative pair:
# earliest packet first, then every other column (ascending, nulls last).
PACKET_ORDER = [
    "created_at", "packet_id", "source_hostname", "destination_hostname",
    "destination_network", "destination_host", "destination_port", "source_network",
    "source_host", "source_port", "interface", "length", "pid", "ppid", "uid",
    "command", "full_command", "process_started_at", "dtk_inserted_at",
]

# How each packet-map column is named on the "source" (a) and "destination" (b)
# side of a pair.  Output columns keep their output names; the rest are
# carried under private names only for the order.
_A_NAMES = {
    "created_at": "__a_created_at", "packet_id": "__a_packet_id",
    "source_hostname": "source_hostname", "destination_hostname": "__a_dst_hostname",
    "destination_network": "__a_dst_network", "destination_host": "__a_dst_host",
    "destination_port": "__a_dst_port", "source_network": "source_network",
    "source_host": "source_host", "source_port": "source_port",
    "interface": "source_interface", "length": "__a_length", "pid": "source_pid",
    "ppid": "source_ppid", "uid": "source_uid", "command": "source_command",
    "full_command": "source_full_command",
    "process_started_at": "source_process_started_at", "dtk_inserted_at": "dtk_inserted_at",
}
_B_NAMES = {
    "created_at": "__b_created_at", "packet_id": "__b_packet_id",
    "source_hostname": "destination_hostname", "destination_hostname": "__j_hostname",
    "destination_network": "__b_dst_network", "destination_host": "__j_host",
    "destination_port": "__j_port", "source_network": "destination_network",
    "source_host": "destination_host", "source_port": "destination_port",
    "interface": "destination_interface", "length": "__b_length", "pid": "destination_pid",
    "ppid": "destination_ppid", "uid": "destination_uid", "command": "destination_command",
    "full_command": "destination_full_command",
    "process_started_at": "destination_process_started_at",
    "dtk_inserted_at": "__b_dtk_inserted_at",
}
_A_ORDER = [_A_NAMES[c] for c in PACKET_ORDER]
_B_ORDER = [_B_NAMES[c] for c in PACKET_ORDER]

_KEY = ["created_at", "source_network", "source_host", "source_port",
        "destination_host", "destination_port", "destination_network"]


def _first(df: DataFrame, keys: list[str], order: list[str],
           map_side_limit: bool = True) -> DataFrame:
    """Best row per ``keys`` by ``order`` (keys left out of the sort: they are constant).

    ``rn = 1`` lets Catalyst add a partial group limit before the shuffle,
    which cuts a hot group map-side.  Where rows of one group arrive from
    different upstream partitions anyway (the pairs of the self-join, grouped
    across machines) that partial limit only sorts the whole input for
    nothing; ``map_side_limit=False`` writes the same filter as ``rn - 1 = 0``,
    which Catalyst does not turn into a group limit.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last()
                                            for c in order if c not in keys])
    rn = F.col("__rn")
    keep = (rn == 1) if map_side_limit else ((rn - 1) == 0)
    return df.withColumn("__rn", F.row_number().over(w)).filter(keep).drop("__rn")


#: Endpoint columns on which the two sides meet.
A_ENDPOINT = ["source_host", "source_port", "source_hostname"]
B_ENDPOINT = ["__j_host", "__j_port", "__j_hostname"]


def connection_sides(packets: DataFrame, align_minutes: bool = False,
                     reduce_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """The "source" and the "destination" side of the self-join, by default cut to the rows that can win."""
    minute = F.date_trunc("minute", F.col("created_at"))

    a = packets.filter(F.col("created_at").isNotNull()).select(
        minute.alias("created_at_minute"), *[F.col(c).alias(n) for c, n in _A_NAMES.items()])
    b_src = packets.filter(F.col("created_at").isNotNull()) if align_minutes else packets
    b = b_src.select(minute.alias("__b_minute"),
                     *[F.col(c).alias(n) for c, n in _B_NAMES.items()])
    if reduce_first:
        a = _first(a, ["created_at_minute", "source_network", *A_ENDPOINT], _A_ORDER)
        b_keys = ["destination_network", "destination_host", "destination_port", *B_ENDPOINT]
        if align_minutes:
            b_keys.append("__b_minute")
        b = _first(b, b_keys, _B_ORDER)
    return a, b


def join_sides(a: DataFrame, b: DataFrame, align_minutes: bool = False) -> DataFrame:
    """Every pair of the two sides that meets at an endpoint."""
    cond = [a[x] == b[y] for x, y in zip(A_ENDPOINT, B_ENDPOINT)]
    if align_minutes:
        cond.append(a["created_at_minute"] == b["__b_minute"])
    return a.join(b, cond, "inner").withColumnRenamed("created_at_minute", "created_at")


def pick_connections(a: DataFrame, b: DataFrame, align_minutes: bool = False) -> DataFrame:
    """Join the two sides and keep the best pair of each connection key."""
    best = _first(join_sides(a, b, align_minutes), _KEY, _A_ORDER + _B_ORDER, map_side_limit=False)
    return best.select(*CONNECTION_COLUMNS)


def shared_endpoints(packets: DataFrame) -> DataFrame:
    """Sending endpoints whose (host, port) belongs to several machines."""
    sent = packets.filter(F.col("created_at").isNotNull()).select(*A_ENDPOINT).dropna().distinct()
    w = Window.partitionBy("source_host", "source_port")
    machine = F.col("source_hostname")
    return (sent.withColumn("__several", F.min(machine).over(w) != F.max(machine).over(w))
            .filter("__several").drop("__several"))


def connection_map(packets: DataFrame, align_minutes: bool = False,
                   reduce_first: bool = True) -> DataFrame:
    """Gold connection map (G2) from a packet map (G1).

    One small job over the endpoints of ``packets`` (best a written table) tells
    whether any (host, port) has several machines; without one nothing is ranked.
    """
    a, b = connection_sides(packets, align_minutes, reduce_first)
    if not reduce_first:
        return pick_connections(a, b, align_minutes)
    shared = shared_endpoints(packets)
    with settings(packets.sparkSession, FREE_SHUFFLES):
        none_shared = shared.isEmpty()
    if none_shared:
        return join_sides(a, b, align_minutes).select(*CONNECTION_COLUMNS)
    # keyed like the join below, so the "source" side is shuffled once for both
    single = join_sides(a.join(shared, A_ENDPOINT, "left_anti"), b, align_minutes)
    several = pick_connections(a.join(shared, A_ENDPOINT, "left_semi"), b, align_minutes)
    return single.select(*CONNECTION_COLUMNS).unionByName(several)
