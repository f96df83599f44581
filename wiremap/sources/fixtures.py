"""Capture-shaped views derived from the driver's TPC-H-like tables.

The driver ships ``events``, ``supplier`` and ``nation``; these functions
turn them into the packet, ip, interface, process and process-link tables
the network map reads.  Machines are suppliers (``S`` = supplier count):

* packet ``event_id`` is sent by machine ``user_id % S`` to ``(event_id*7 + user_id) % S``;
* interface: one per supplier, host = supplier name, network = nation name;
* packet ``created_at`` is folded to minute 0 of its hour so minutes collide;
* two thirds of the packets link to a process ``user_id % 5``;
* processes start at every ``signup`` event, pid ``event_id % 5``.

Every view grows with the driver tables; nothing is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wiremap.sources.tables import read_table
from wiremap.spec import ADDRESS  # noqa: F401  (documented struct layout)


@dataclass
class CaptureViews:
    ev: DataFrame
    interfaces: DataFrame
    network_ip: DataFrame
    network_packet: DataFrame
    process_network: DataFrame
    process: DataFrame
    as_of: Column


def _machine(c: Column, n: Column) -> Column:
    return F.concat(F.lit("m"), (c % n).cast("string"))


def capture_views(spark: SparkSession, sf_dir: str) -> CaptureViews:
    # The driver tables hold UTC wall-clock times; minute/hour folding is defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = read_table(spark, sf_dir, "events")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")

    n_machines = supplier.select(F.count(F.lit(1))).scalar()
    ev = events.withColumns({
        "s": F.col("user_id") % n_machines,
        "d": (F.col("event_id") * 7 + F.col("user_id")) % n_machines,
        "hostname": _machine(F.col("user_id"), n_machines),
    })

    interfaces = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("_id"),
        F.col("s_name").alias("host"),
        F.col("n_name").alias("network"),
        F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("hostname"),
    )

    src = supplier.select(F.col("s_suppkey").alias("s"), F.col("s_name").alias("source_host"))
    dst = supplier.select(F.col("s_suppkey").alias("d"), F.col("s_name").alias("destination_host"))
    network_ip = (
        ev.join(src, "s", "left").join(dst, "d", "left")
        .select(
            F.col("event_id").alias("_id"), "hostname", "source_host",
            (F.lit(1000) + F.col("event_id") % 4).cast("int").alias("source_port"),
            "destination_host",
            (F.lit(1000) + F.floor(F.col("event_id") / 4) % 4).cast("int").alias("destination_port"),
            F.col("ts").alias("dtk_inserted_at"),
        )
    )

    ts = F.col("ts")
    network_packet = ev.select(
        F.col("event_id").alias("_id"), "hostname",
        F.floor("value").cast("bigint").alias("length"),
        (F.date_trunc("hour", ts) + (ts - F.date_trunc("minute", ts))).alias("created_at"),
        F.col("event_type").alias("interface"),
        ts.alias("dtk_inserted_at"),
    )

    process_network = ev.filter(F.col("event_id") % 3 != 0).select(
        F.col("event_id").alias("_id"), F.col("event_id").alias("packet_id"), "hostname",
        (F.col("user_id") % 5).alias("pid"), ts.alias("dtk_inserted_at"),
    )

    pid = F.col("event_id") % 5
    process = ev.filter(F.col("event_type") == "signup").select(
        pid.alias("pid"), "hostname", ts.alias("started_at"),
        F.lit(1).cast("bigint").alias("ppid"), F.col("user_id").alias("uid"),
        F.concat(F.lit("cmd"), pid.cast("string")).alias("command"),
        F.concat(F.lit("cmd"), pid.cast("string"), F.lit(" --x")).alias("full_command"),
    )

    as_of = events.select(F.max("ts")).scalar()
    return CaptureViews(ev, interfaces, network_ip, network_packet, process_network, process, as_of)


def _address(ip_suffix: Column, mask: Column) -> Column:
    return F.named_struct(F.lit("address"), F.concat(F.lit("10.0."), ip_suffix.cast("string")),
                          F.lit("mask"), mask.cast("int"))


def host_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_network_host`` shape: suppliers, two suppliers per address from sf0.01 on."""
    supplier = read_table(spark, sf_dir, "supplier")
    return supplier.select(
        F.col("s_suppkey").alias("_id"),
        _address(F.col("s_suppkey") % 50, F.lit(24)).alias("address"),
        F.col("s_name").alias("host"),
    )


def address_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address per event; every tenth carries mask 32 and so matches no host."""
    events = read_table(spark, sf_dir, "events")
    mask = F.when(F.col("event_id") % 10 == 0, F.lit(32)).otherwise(F.lit(24))
    return events.select(F.col("event_id").alias("_id"),
                         _address(F.col("user_id") % 60, mask).alias("address"))


def interface_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``dim_network_interface`` rows: machines re-report interfaces over time."""
    supplier = read_table(spark, sf_dir, "supplier")
    events = read_table(spark, sf_dir, "events")
    n = supplier.select(F.count(F.lit(1))).scalar()
    return events.select(
        (F.col("user_id") % 7).alias("_id"),
        _machine(F.col("user_id"), n).alias("hostname"),
        _address(F.col("event_id") % 60, F.lit(24)).alias("address"),
        F.col("event_type").alias("network"),
        F.col("ts").alias("inserted_at"),
    )


def capture_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<hostname>-<yyyyMMddHHmmss>.parquet`` per event; error events get a bad stamp."""
    v = capture_views(spark, sf_dir)
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    bad = F.concat(F.substring(stamp, 1, 13), F.lit("Z"))
    stamp = F.when(F.col("event_type") == "error", bad).otherwise(stamp)
    return v.ev.select(F.col("event_id"),
                       F.concat("hostname", F.lit("-"), stamp, F.lit(".parquet")).alias("file_name"))


def raw_capture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables the gold layer needs, shaped as the capture agents write them.

    Hosts are addressed by struct addresses (``10.1.<supplier>/32``); the
    silver lookups turn them back into host names.  ``hostname`` marks the
    machine whose file a row goes to (it is parsed back from the file name).
    """
    v = capture_views(spark, sf_dir)
    supplier = read_table(spark, sf_dir, "supplier")
    ip_of = lambda c: F.named_struct(
        F.lit("address"), F.concat(F.lit("10.1."), c.cast("string")), F.lit("mask"), F.lit(32))
    hosts = supplier.select(F.col("s_suppkey").alias("_id"), ip_of(F.col("s_suppkey")).alias("address"),
                            F.col("s_name").alias("host"),
                            F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("hostname"),
                            # file stamp only; the host table's schema has no clock
                            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("inserted_at"))
    ifaces = supplier.join(read_table(spark, sf_dir, "nation"),
                           F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("_id"), ip_of(F.col("s_suppkey")).alias("address"),
        F.col("n_name").alias("network"),
        F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("hostname"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("inserted_at"))
    ev = v.ev
    ip = ev.select(F.col("event_id").alias("_id"), ip_of(F.col("s")).alias("source_address"),
                   ip_of(F.col("d")).alias("destination_address"),
                   (F.lit(1000) + F.col("event_id") % 4).cast("int").alias("source_port"),
                   (F.lit(1000) + F.floor(F.col("event_id") / 4) % 4).cast("int").alias("destination_port"),
                   "hostname", F.col("ts").alias("inserted_at"))
    pk = v.network_packet.select("_id", "length", "created_at", "interface", "hostname",
                                 F.col("dtk_inserted_at").alias("inserted_at"))
    link = v.process_network.select("_id", "packet_id", "pid", "hostname",
                                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("inserted_at"))
    proc = v.process.select("pid", "ppid", "uid", "command", "full_command", "started_at",
                            "hostname", F.col("started_at").alias("inserted_at"))
    return {"dim_network_host": hosts, "dim_network_interface": ifaces, "fact_network_ip": ip,
            "fact_network_packet": pk, "fact_process_network": link, "dim_process": proc}


# Columns of the raw tables outside the packet map, as expressions over events.
_ADDR = "named_struct('address', concat('10.0.', {}), 'mask', 24)"
_FILE = {"pid": "user_id % 5", "fd": "concat('fd', event_id % 3)", "node": "user_id % 11"}
SILVER_CAPTURE = {
    "dim_network_host": {"_id": "user_id % 40", "address": _ADDR.format("user_id % 30"),
                         "host": "concat('host', user_id % 40)"},
    "dim_file_reg": _FILE,
    "dim_network_foreign_ip": {"_id": "user_id % 13", "address": _ADDR.format("event_id % 60")},
    "dim_network_open_port": {"pid": "user_id % 5", "port": "cast(1000 + event_id % 7 as int)"},
    "dim_network_socket": {"_id": "user_id % 13", "source_address": _ADDR.format("event_id % 60")},
    "file_host": {"name": "concat('h', user_id % 9)", "address": _ADDR.format("event_id % 6")},
    "file_user": {"name": "concat('u', user_id % 9)", "uid": "event_id % 4"},
    "file_service": {"name": "event_type", "port": "cast(1000 + user_id % 6 as int)",
                     "protocol": "if(event_id % 2 = 0, 'udp', 'tcp')"},
    "fact_file_reg": _FILE | {"created_at": "date_trunc('hour', ts)"},
    "fact_process": {"pid": "user_id % 5", "started_at": "date_trunc('day', ts)",
                     "created_at": "date_trunc('hour', ts)"},
    "tech_chrono": {"name": "event_type"},
    "tech_table_count": {"_id": "user_id % 13"},
}


def silver_capture(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One raw row per event for a table of ``SILVER_CAPTURE``: keys repeat, some addresses have no host."""
    v = capture_views(spark, sf_dir)
    return v.ev.select("event_id", *[F.expr(e).alias(c) for c, e in SILVER_CAPTURE[table].items()],
                       "hostname", F.col("ts").alias("inserted_at"))


# Ingest times folded to half an hour, so that a ten-minute look-back bites.
SLIDING_START = "2024-02-01 00:00:00"
SLIDING_SECONDS = 1800


def sliding_capture(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five gold inputs as rows arrive within half an hour, by silver table.

    Event ``e`` arrives at second ``e % 1800``.  Every tenth packet is sent again
    eight minutes later, one byte longer.  Interfaces are sent every five minutes
    and stop after one to six times: then they leave the look-back.
    """
    v = capture_views(spark, sf_dir)
    at = lambda second: F.timestamp_seconds(
        F.unix_timestamp(F.lit(SLIDING_START)) + second).alias("dtk_inserted_at")
    by_event = at(F.col("_id") % SLIDING_SECONDS)
    ip = v.network_ip.drop("dtk_inserted_at").select("*", by_event)
    packet = v.network_packet.drop("dtk_inserted_at")
    again = packet.filter(F.col("_id") % 10 == 0).withColumn("length", F.col("length") + 1)
    packet = packet.select("*", by_event).unionByName(
        again.select("*", at(F.col("_id") % SLIDING_SECONDS + 480)))
    link = v.process_network.drop("dtk_inserted_at").select("*", by_event)
    times = F.explode(F.sequence(F.lit(0), (F.col("_id") % 6).cast("int")))
    iface = v.interfaces.select("*", times.alias("k")).select(
        "_id", "host", "network", "hostname", at(F.col("_id") % 300 + F.col("k") * 300))
    pid = F.col("event_id") % 5
    process = v.ev.filter(F.col("event_type") == "signup").select(
        pid.alias("pid"), "hostname", F.col("ts").alias("started_at"), F.lit(1).cast("bigint").alias("ppid"),
        F.col("user_id").alias("uid"), F.concat(F.lit("cmd"), pid.cast("string")).alias("command"),
        F.concat(F.lit("cmd"), pid.cast("string"), F.lit(" --x")).alias("full_command"),
        at(F.col("event_id") % SLIDING_SECONDS))
    return {"fact_network_ip": ip, "fact_network_packet": packet, "dim_network_interface": iface,
            "fact_process_network": link, "dim_process": process}
