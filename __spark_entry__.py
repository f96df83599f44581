"""

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full.  Capture-shaped inputs come from
``wiremap.sources.fixtures.capture_views``; the matching DuckDB CTEs live in
``wiremap.oracle``.  Every query has oracle SQL except ``src_file_meta``,
whose file sizes and ingest times are specific to the run (rows-only check).
Queries that write (streams, upserts, refreshes) use fresh folders below
``spark.checkpoint.dir`` and return what they wrote, read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from wiremap import oracle as O
from wiremap.functions.columns import fill_unknown
from wiremap.operators.latest import latest_by_key
from wiremap.operators.lookup import lookup_host
from wiremap.operators.recent import latest_value, recent
from wiremap.operators.upsert import read_keyed, upsert
from wiremap.plans import graph as G
from wiremap.plans.connection_map import connection_map
from wiremap.plans.edge_factors import edge_summary_of_packets
from wiremap.plans.packet_map import (
    ip_packet, packet_map, packet_with_host, packet_with_latest_process, packet_with_process,
    pick_process,
)
from wiremap.session import materialize, scratch_path
from wiremap.sources import fixtures as X
from wiremap.sources.files import file_date_sent, file_hostname
from wiremap.sources.fixtures import capture_views
from wiremap.sources.tables import read_table
from wiremap.spec import SPECS_BY_SOURCE
from wiremap.sources.landing import write_capture_files, write_capture_files_in_order
from wiremap.spec import TableSpec
from wiremap.streaming import gold as GOLD
from wiremap.streaming.bronze import bronze_schema, bronze_stream, read_bronze, start_bronze
from wiremap.streaming.ingest_log import append_log
from wiremap.streaming.silver import silver_batch, silver_writer, start_silver, start_silver_files

try:  # the corpus operators and their pipeline are optional parts
    import corpus_pipeline
    from wiremap.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "wiremap.llm"):
        raise
    corpus_pipeline = corpus_queries = None

FLAGSHIP_SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- gold: packets

def q_ip_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = capture_views(spark, sf_dir)
    return ip_packet(v.network_ip, v.network_packet)


def q_packet_with_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = capture_views(spark, sf_dir)
    return packet_with_host(ip_packet(v.network_ip, v.network_packet), v.interfaces)


def q_packet_with_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every process start joined (the naive input of the as-of pick)."""
    v = capture_views(spark, sf_dir)
    pk = packet_with_host(ip_packet(v.network_ip, v.network_packet), v.interfaces)
    return packet_with_process(pk, v.process_network, v.process, reduce_first=False)


def q_packet_process_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = capture_views(spark, sf_dir)
    pk = packet_with_host(ip_packet(v.network_ip, v.network_packet), v.interfaces)
    return pick_process(packet_with_process(pk, v.process_network, v.process))


def q_packet_process_asof_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest start before each packet, through the bucketed as-of operator."""
    v = capture_views(spark, sf_dir)
    pk = packet_with_host(ip_packet(v.network_ip, v.network_packet), v.interfaces)
    return pick_process(packet_with_latest_process(pk, v.process_network, v.process),
                        pick="latest")


def _picked(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    v = capture_views(spark, sf_dir)
    pk = packet_with_host(ip_packet(v.network_ip, v.network_packet), v.interfaces)
    return pick_process(packet_with_process(pk, v.process_network, v.process), **kw)


def q_packet_process_asof_keep_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets whose process starts are all later are kept once, process cleared."""
    return _picked(spark, sf_dir, keep_unmatched=True)


def q_packet_process_asof_original_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's original pick partition ``(_id, pid)`` (without the hostname)."""
    return _picked(spark, sf_dir, pick_keys=("_id", "pid"))


def _packets(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    v = capture_views(spark, sf_dir)
    return packet_map(v.network_ip, v.network_packet, v.interfaces, v.process_network,
                      v.process, as_of=v.as_of, **kw)


def q_network_map_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packets(spark, sf_dir)


def q_network_map_packet_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold packet map over the last 7 days of ingest time (facts only)."""
    return _packets(spark, sf_dir, lookback_minutes=7 * 24 * 60, dim_lookback=False)


def q_network_map_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection_map(materialize(_packets(spark, sf_dir)))


def q_network_map_connection_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection_map(materialize(_packets(spark, sf_dir)), align_minutes=True)


# ---------------------------------------------------------------- silver operators

def q_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return latest_by_key(li, ["l_orderkey", "l_linenumber"], "l_shipdate",
                         tie_break=["l_partkey", "l_suppkey", "l_extendedprice"])


def q_lookup_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = X.address_facts(spark, sf_dir)
    out = lookup_host(facts, X.host_table(spark, sf_dir), "address", "host")
    return out.select("_id", F.col("address.address").alias("ip"),
                      F.col("address.mask").alias("mask"), "host")


def q_struct_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver interface job: host lookup, ``address.mask``, latest per key."""
    spec = SPECS_BY_SOURCE["dim_network_interface"]
    out = silver_batch(X.interface_reports(spark, sf_dir), spec, X.host_table(spark, sf_dir))
    return out.select("_id", "hostname", F.col("address.address").alias("ip"), "network",
                      "inserted_at", "host", "mask")


def _events_as_of(spark: SparkSession, sf_dir: str):
    ev = read_table(spark, sf_dir, "events")
    return ev, latest_value(ev, "ts")


def q_recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, as_of = _events_as_of(spark, sf_dir)
    return recent(ev, 7 * 24 * 60, "ts", as_of)


def q_recent_window_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, as_of = _events_as_of(spark, sf_dir)
    return recent(ev, G.REPORT_LOOKBACK_MINUTES, "ts", as_of)


def q_distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = capture_views(spark, sf_dir)
    return v.network_ip.select("hostname", "source_host", "destination_host").distinct()


def q_parse_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = X.capture_file_names(spark, sf_dir)
    name = F.col("file_name")
    return names.select("event_id", "file_name", file_hostname(name).alias("hostname"),
                        file_date_sent(name).alias("date_sent"))


# ---------------------------------------------------------------- report

def _connections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, object]:
    v = capture_views(spark, sf_dir)
    pk = packet_map(v.network_ip, v.network_packet, v.interfaces, v.process_network,
                    v.process, as_of=v.as_of)
    return connection_map(materialize(pk)), v.as_of


def _graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    conn, as_of = _connections(spark, sf_dir)
    return G.network_graph(conn, G.REPORT_LOOKBACK_MINUTES, as_of)


def q_fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    conn, as_of = _connections(spark, sf_dir)
    return G.report_connections(conn, G.REPORT_LOOKBACK_MINUTES, as_of)


def q_edge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    conn, as_of = _connections(spark, sf_dir)
    return G.edge_summary(G.report_connections(conn, G.REPORT_LOOKBACK_MINUTES, as_of))


def q_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.graph_edges(_graph(spark, sf_dir))


def q_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.graph_nodes(_graph(spark, sf_dir))


def q_graph_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.graph_networks(G.graph_nodes(_graph(spark, sf_dir)))


def q_graph_nodes_by_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.nodes_by_network(G.graph_nodes(_graph(spark, sf_dir)))


def q_edge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_report(_graph(spark, sf_dir))


def q_edge_report_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edge report straight from the packets: no connection pair is written."""
    v = capture_views(spark, sf_dir)
    pk = packet_map(v.network_ip, v.network_packet, v.interfaces, v.process_network, v.process, as_of=v.as_of)
    summary = edge_summary_of_packets(materialize(pk), G.REPORT_LOOKBACK_MINUTES, v.as_of)
    return G.edge_report(G.with_ids(summary))


def q_packet_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = capture_views(spark, sf_dir)
    pk = packet_map(v.network_ip, v.network_packet, v.interfaces, v.process_network,
                    v.process, as_of=v.as_of)
    return G.packet_detail(pk, G.REPORT_LOOKBACK_MINUTES, v.as_of)


# ---------------------------------------------------------------- keyed upsert

_EV_KEYS = ["user_id", "event_type"]


def _upsert_two(spark: SparkSession, sf_dir: str, keys: list[str], events: DataFrame,
                **kw) -> DataFrame:
    """Even events are the stored table, odd events arrive as one batch."""
    path = scratch_path(spark, "upsert")
    even = events.filter(F.col("event_id") % 2 == 0)
    odd = events.filter(F.col("event_id") % 2 == 1)
    upsert(spark, even, path, keys, batch_id=0, order_by="ts", **kw)
    upsert(spark, odd, path, keys, batch_id=1, order_by="ts", **kw)
    return read_keyed(spark, path)


def q_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_two(spark, sf_dir, _EV_KEYS, read_table(spark, sf_dir, "events"))


def q_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same upsert as ``upsert_by_key`` on the bucketed, partition-rewriting layout."""
    return _upsert_two(spark, sf_dir, _EV_KEYS, read_table(spark, sf_dir, "events"), buckets=8)


def q_upsert_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "upsert")
    upsert(spark, read_table(spark, sf_dir, "events"), path, _EV_KEYS, order_by="ts")
    return read_keyed(spark, path)


def _null_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn("k", F.when(F.col("user_id") % 4 != 0, F.col("user_id")))


def q_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_two(spark, sf_dir, ["k", "event_type"], _null_key_events(spark, sf_dir))


def q_upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_two(spark, sf_dir, ["k", "event_type"], _null_key_events(spark, sf_dir),
                       null_safe=True)


def q_upsert_newest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored = the later half of the month, incoming = the earlier half."""
    path = scratch_path(spark, "upsert")
    ev = read_table(spark, sf_dir, "events")
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp")
    upsert(spark, ev.filter(F.col("ts") >= mid), path, _EV_KEYS, batch_id=0, order_by="ts")
    upsert(spark, ev.filter(F.col("ts") < mid), path, _EV_KEYS, batch_id=1, order_by="ts",
           newest_wins=True)
    return read_keyed(spark, path)


def _upsert_thirds(spark: SparkSession, sf_dir: str, writes) -> DataFrame:
    """Events by event_id modulo 3, as three writes of (third, writer, batch number)."""
    path, ev = scratch_path(spark, "upsert"), read_table(spark, sf_dir, "events")
    for third, writer, number in writes:
        upsert(spark, ev.filter(F.col("event_id") % 3 == third), path, _EV_KEYS, batch_id=number,
               writer=writer, order_by="ts")
    return read_keyed(spark, path)


def q_upsert_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of one writer; the last one is replayed."""
    return _upsert_thirds(spark, sf_dir, [(0, "s", 0), (1, "s", 1), (2, "s", 2), (0, "s", 2)])


def q_upsert_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers whose batch numbers overlap."""
    return _upsert_thirds(spark, sf_dir, [(0, "one", 0), (1, "two", 0), (2, "one", 1)])


def q_upsert_after_reenrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch job without numbers between two batches of a stream."""
    return _upsert_thirds(spark, sf_dir, [(0, "stream", 0), (1, "job", None), (2, "stream", 1)])


def q_upsert_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A restarted stream counts from 0 again, under its new query id."""
    return _upsert_thirds(spark, sf_dir, [(0, "query:a", 0), (1, "query:a", 1), (2, "query:b", 0)])


def q_upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ev = scratch_path(spark, "upsert"), read_table(spark, sf_dir, "events")
    upsert(spark, ev.filter(F.col("event_id") % 2 == 0), path, _EV_KEYS, order_by="ts")
    odd = ev.filter(F.col("event_id") % 2 == 1).withColumn("odd_id", F.col("event_id"))
    upsert(spark, odd, path, _EV_KEYS, order_by="ts")
    return read_keyed(spark, path)


# ---------------------------------------------------------------- streams

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _land_events(spark: SparkSession, sf_dir: str, copies: int = 1) -> tuple[str, object]:
    """Events as capture files of their machine; ``copies`` repeats rows in place."""
    v = capture_views(spark, sf_dir)
    raw = v.ev.select(*EVENT_COLUMNS, "hostname")
    if copies > 1:
        raw = raw.withColumn("__c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__c")
    base = scratch_path(spark, "stream")
    write_capture_files(spark, raw, f"{base}/raw")
    return base, read_table(spark, sf_dir, "events").schema


def _bronze(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    base, schema = _land_events(spark, sf_dir, copies)
    q = start_bronze(spark, f"{base}/raw", f"{base}/bronze", f"{base}/_chk/bronze",
                     schema=schema, max_files_per_trigger=64)
    q.awaitTermination()
    return read_bronze(spark, f"{base}/bronze")


def q_src_stream_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select(*EVENT_COLUMNS, "hostname")


def q_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row landed twice in the same file; bronze keeps one."""
    return _bronze(spark, sf_dir, copies=2).select(*EVENT_COLUMNS, "hostname")


def q_src_file_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance columns as written (file size and ingest time are run-specific)."""
    return _bronze(spark, sf_dir)


EVENTS_LATEST = TableSpec("events", "events_latest", ("user_id", "event_type"), order_by="ts")


def q_stream_latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals of capture files -> bronze -> silver latest-per-key upsert."""
    ev = read_table(spark, sf_dir, "events")
    raw = ev.withColumn("hostname", F.concat(F.lit("cap"), (F.col("event_id") % 3).cast("string")))
    base = scratch_path(spark, "stream")
    write_capture_files_in_order(
        spark, [raw.filter(F.col("event_id") % 3 == i) for i in range(3)], f"{base}/raw")
    q = start_bronze(spark, f"{base}/raw", f"{base}/bronze", f"{base}/_chk/bronze",
                     schema=ev.schema, max_files_per_trigger=1)
    q.awaitTermination()
    stream = bronze_stream(spark, f"{base}/bronze", bronze_schema(ev.schema))
    q = start_silver(spark, stream, EVENTS_LATEST, f"{base}/silver", f"{base}/_chk/silver",
                     newest_wins=True)
    q.awaitTermination()
    return read_keyed(spark, f"{base}/silver").select(*EVENT_COLUMNS)


def q_file_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance columns without what is specific to the run."""
    out = _bronze(spark, sf_dir)
    whole = F.length("file_name") == F.length("hostname") + 23
    return out.select(
        "event_id", "hostname", "date_sent",
        (whole & F.col("file_name").startswith(F.col("hostname"))).alias("name_matches"),
        (F.col("file_size") > 0).alias("has_size"),
        F.col("dtk_inserted_at").isNotNull().alias("has_ingest_time"))


def _silver_target(source: str) -> Callable[[SparkSession, str], DataFrame]:
    """A silver job over two arrivals, the odd events after the even ones, by the spec list."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, spec = X.silver_capture(spark, sf_dir, source), SPECS_BY_SOURCE[source]
        path = scratch_path(spark, f"silver-{spec.target}")
        batch = silver_writer(spark, spec, path, lambda: X.host_table(spark, sf_dir))
        for n in (0, 1):
            batch(raw.filter(F.col("event_id") % 2 == n), n)
        out = read_keyed(spark, path)
        flat = ("address", "source_address")
        return out.select(*[c for c in out.columns if c not in flat],
                          *[F.col(f"{c}.{f}").alias("ip" if f == "address" else f)
                            for c in out.columns if c in flat for f in ("address", "mask")])
    return run


def q_upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with several rows for a key and no clock (a fan-out) leaves one row a key."""
    path = scratch_path(spark, "upsert")
    upsert(spark, read_table(spark, sf_dir, "events"), path, _EV_KEYS)
    return read_keyed(spark, path)


def q_evolving_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals -> bronze -> silver: the second one brings a column and a wider type.

    Both streams start before any file is there.
    """
    ev = read_table(spark, sf_dir, "events")
    base = scratch_path(spark, "stream")
    third = F.col("event_id") % 3
    arrivals = [None,
                ev.filter(third == 0).select(F.col("event_id").cast("int").alias("event_id"), "ts", "user_id",
                                             "event_type"),
                ev.filter(third != 0).select("event_id", "ts", "user_id", "event_type", "value")]
    for i, rows in enumerate(arrivals):
        if rows is not None:
            rows.write.parquet(f"{base}/raw/arrival-{i}")
        start_bronze(spark, f"{base}/raw", f"{base}/bronze", f"{base}/_chk/bronze").awaitTermination()
        start_silver_files(spark, f"{base}/bronze", EVENTS_LATEST, f"{base}/silver", f"{base}/_chk/silver",
                           newest_wins=True).awaitTermination()
    return read_keyed(spark, f"{base}/silver").select("event_id", "ts", "user_id", "event_type", "value")


def _gold(spark: SparkSession, sf_dir: str) -> str:
    v = capture_views(spark, sf_dir)
    inputs = GOLD.SilverInputs(v.network_ip, v.network_packet, v.interfaces,
                               v.process_network, v.process)
    path = scratch_path(spark, "gold")
    GOLD.refresh(spark, inputs, path, as_of=v.as_of, lookback_minutes=None, batch_id=0)
    return path


def q_gold_refresh_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GOLD.read_gold(spark, _gold(spark, sf_dir), GOLD.PACKET_TABLE)


def q_gold_refresh_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GOLD.read_gold(spark, _gold(spark, sf_dir), GOLD.CONNECTION_TABLE)


def _sliding_gold(spark: SparkSession, sf_dir: str) -> str:
    """Three refreshes, ten minutes apart, each after the rows of its minutes arrived."""
    tables, base = X.sliding_capture(spark, sf_dir), scratch_path(spark, "sliding")
    start = dt.datetime.fromisoformat(X.SLIDING_START)
    for r in range(3):
        first, last = (start + dt.timedelta(seconds=600 * r + s) for s in (0, 599))
        for name, rows in tables.items():
            arrived = rows.filter(F.col("dtk_inserted_at").between(F.lit(first), F.lit(last)))
            append_log(arrived, f"{base}/log/{name}", f"arrival-{r}")
        GOLD.refresh(spark, GOLD.window_inputs(spark, f"{base}/log", last), f"{base}/gold", as_of=last, batch_id=r)
    return f"{base}/gold"


def q_gold_sliding_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GOLD.read_gold(spark, _sliding_gold(spark, sf_dir), GOLD.PACKET_TABLE)


def q_gold_sliding_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GOLD.read_gold(spark, _sliding_gold(spark, sf_dir), GOLD.CONNECTION_TABLE)


def q_pipeline_packet_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture files -> bronze -> silver (spec jobs, struct-address lookups) -> gold packets."""
    from wiremap.sources.fixtures import raw_capture_tables
    from wiremap.streaming.pipeline import ensure_layers, start_ingest, start_silver_all
    root = scratch_path(spark, "lake")
    ensure_layers(spark, root)
    raw = raw_capture_tables(spark, sf_dir)
    for name, df in raw.items():
        write_capture_files(spark, df, f"{root}/raw/{name}", stamp_col="inserted_at")
    for q in start_ingest(spark, root, tables=list(raw)).values():
        q.awaitTermination()
    for q in start_silver_all(spark, root, tables=list(raw)).values():
        q.awaitTermination()
    as_of = read_table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    GOLD.refresh(spark, GOLD.silver_inputs(spark, f"{root}/silver"), f"{root}/gold",
                 as_of=as_of, lookback_minutes=None, batch_id=0)
    return GOLD.read_gold(spark, f"{root}/gold", GOLD.PACKET_TABLE)


def q_late_host_reenrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ip rows built while half the hosts were missing, then re-enriched."""
    from wiremap.sources.fixtures import raw_capture_tables
    from wiremap.streaming.pipeline import reenrich_table
    raw = raw_capture_tables(spark, sf_dir)
    hosts, ip = raw["dim_network_host"], raw["fact_network_ip"]
    spec = SPECS_BY_SOURCE["fact_network_ip"]
    path = scratch_path(spark, "silver_ip")
    early = silver_batch(ip, spec, hosts.filter(F.col("_id") % 2 == 0))
    upsert(spark, early, path, list(spec.keys), batch_id=0, order_by=spec.order_by,
           writer="early", buckets=spec.buckets, unique_keys=True)
    out = reenrich_table(spark, path, spec, hosts)
    return out.select("_id", "hostname", "source_host", "source_port", "destination_host",
                      "destination_port")


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the gold packet map on sf0.001."""
    return q_network_map_packet(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus_queries is None:
        return network_queries()
    return network_queries() | corpus_queries.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if corpus_queries is None:
        return network_oracle_sql()
    whole = corpus_pipeline.ORACLE_SQL
    return (network_oracle_sql() | corpus_queries.oracle_sql()
            | ({"pipeline": whole} if whole else {}))


def network_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ip_packet": q_ip_packet,
        "packet_with_host": q_packet_with_host,
        "packet_with_process": q_packet_with_process,
        "packet_process_asof": q_packet_process_asof,
        "packet_process_asof_latest": q_packet_process_asof_latest,
        "packet_process_asof_keep_unmatched": q_packet_process_asof_keep_unmatched,
        "packet_process_asof_original_keys": q_packet_process_asof_original_keys,
        "network_map_packet": q_network_map_packet,
        "network_map_packet_recent": q_network_map_packet_recent,
        "network_map_connection": q_network_map_connection,
        "network_map_connection_aligned": q_network_map_connection_aligned,
        "latest_by_key": q_latest_by_key,
        "lookup_host": q_lookup_host,
        "struct_field": q_struct_field,
        "recent_window": q_recent_window,
        "recent_window_param": q_recent_window_param,
        "distinct_projection": q_distinct_projection,
        "parse_file_name": q_parse_file_name,
        "fill_unknown": q_fill_unknown,
        "edge_summary": q_edge_summary,
        "graph_edges": q_graph_edges,
        "graph_nodes": q_graph_nodes,
        "graph_networks": q_graph_networks,
        "graph_nodes_by_network": q_graph_nodes_by_network,
        "edge_report": q_edge_report,
        "edge_report_factors": q_edge_report_factors,
        "packet_detail": q_packet_detail,
        "upsert_by_key": q_upsert_by_key,
        "upsert_bucketed": q_upsert_bucketed,
        "upsert_first_load": q_upsert_first_load,
        "upsert_null_keys": q_upsert_null_keys,
        "upsert_null_safe": q_upsert_null_safe,
        "upsert_newest_wins": q_upsert_newest_wins,
        "upsert_three_batches": q_upsert_three_batches,
        "upsert_two_writers": q_upsert_two_writers,
        "upsert_after_reenrich": q_upsert_after_reenrich,
        "upsert_new_checkpoint": q_upsert_new_checkpoint,
        "upsert_new_column": q_upsert_new_column,
        "src_stream_parquet": q_src_stream_parquet,
        "stream_distinct": q_stream_distinct,
        "src_file_meta": q_src_file_meta,
        "stream_latest_upsert": q_stream_latest_upsert,
        "evolving_columns": q_evolving_columns,
        "gold_refresh_packet": q_gold_refresh_packet,
        "gold_refresh_connection": q_gold_refresh_connection,
        "pipeline_packet_map": q_pipeline_packet_map,
        "late_host_reenrich": q_late_host_reenrich,
        "gold_sliding_packet": q_gold_sliding_packet,
        "gold_sliding_connection": q_gold_sliding_connection,
        "file_provenance": q_file_provenance,
        "upsert_duplicate_keys": q_upsert_duplicate_keys,
        **{f"silver_{SPECS_BY_SOURCE[t].target}": _silver_target(t) for t in X.SILVER_CAPTURE},
    }


def network_oracle_sql() -> dict[str, str]:
    return {
        "ip_packet": O.with_ctes(O.PACKET_CTES, "select * from ip_packet"),
        "packet_with_host": O.with_ctes(O.PACKET_CTES, "select * from with_host"),
        "packet_with_process": O.with_ctes(O.PACKET_CTES, "select * from with_proc"),
        "packet_process_asof": O.with_ctes(O.PACKET_CTES, "select * from picked"),
        "packet_process_asof_latest": O.with_ctes(O.PACKET_CTES, "select * from picked_latest"),
        "packet_process_asof_keep_unmatched": O.with_ctes(
            O.PACKET_CTES, "select * from picked_keep_unmatched"),
        "packet_process_asof_original_keys": O.with_ctes(
            O.PACKET_CTES, "select * from picked_original_keys"),
        "network_map_packet": O.with_ctes(O.PACKET_CTES, "select * from g1"),
        "network_map_packet_recent": O.with_ctes(O.packet_ctes_recent(7 * 24 * 60),
                                                 "select * from g1"),
        "network_map_connection": O.with_ctes(O.CONNECTION_CTES, "select * from g2"),
        "network_map_connection_aligned": O.with_ctes(O.CONNECTION_ALIGNED_CTES,
                                                      "select * from g2"),
        "latest_by_key": O.LATEST_LINEITEM,
        "lookup_host": O.LOOKUP_HOST,
        "struct_field": O.STRUCT_FIELD,
        "recent_window": O.RECENT_EVENTS.format(secs=7 * 24 * 3600 - 1),
        "recent_window_param": O.RECENT_EVENTS.format(secs=15 * 60 - 1),
        "distinct_projection": O.with_ctes(
            O.CAPTURE_CTES, "select distinct hostname, source_host, destination_host from network_ip"),
        "parse_file_name": "with " + O.PARSE_FILE_NAME.strip(),
        "fill_unknown": O.with_ctes(O.GRAPH_CTES, "select * from filled"),
        "edge_summary": O.with_ctes(O.GRAPH_CTES, "select * from summary"),
        "graph_edges": O.with_ctes(O.GRAPH_CTES, O.GRAPH_EDGES),
        "graph_nodes": O.with_ctes(O.GRAPH_CTES, "select * from nodes"),
        "graph_networks": O.with_ctes(O.GRAPH_CTES, "select distinct network from nodes"),
        "graph_nodes_by_network": O.with_ctes(
            O.GRAPH_CTES, "select *, md5(network) as cluster_id from nodes"),
        "edge_report": O.with_ctes(O.GRAPH_CTES, O.EDGE_REPORT),
        "edge_report_factors": O.with_ctes(O.GRAPH_CTES, O.EDGE_REPORT),
        "packet_detail": O.with_ctes(
            O.PACKET_CTES, "select * from g1 where dtk_inserted_at >= "
            "date_trunc('second', (select max(ts) from events)) - to_seconds(899)"),
        "upsert_by_key": O.UPSERT_BY_KEY,
        "upsert_bucketed": O.UPSERT_BY_KEY,
        "upsert_first_load": O.UPSERT_FIRST_LOAD,
        "upsert_null_keys": O.UPSERT_NULL_KEYS.format(match="s.k = t.k"),
        "upsert_null_safe": O.UPSERT_NULL_KEYS.format(match="s.k is not distinct from t.k"),
        "upsert_newest_wins": O.UPSERT_FIRST_LOAD,
        "upsert_three_batches": O.UPSERT_THREE_BATCHES,
        "upsert_two_writers": O.UPSERT_THREE_BATCHES,
        "upsert_after_reenrich": O.UPSERT_THREE_BATCHES,
        "upsert_new_checkpoint": O.UPSERT_THREE_BATCHES,
        "upsert_new_column": O.UPSERT_NEW_COLUMN,
        "src_stream_parquet": O.with_ctes(
            O.CAPTURE_CTES, "select event_id, ts, user_id, event_type, value, props, hostname from ev"),
        "stream_distinct": O.with_ctes(
            O.CAPTURE_CTES, "select event_id, ts, user_id, event_type, value, props, hostname from ev"),
        "stream_latest_upsert": O.UPSERT_FIRST_LOAD,
        "evolving_columns": O.EVOLVING_COLUMNS,
        "gold_sliding_packet": O.SLIDING_PACKETS,
        "gold_sliding_connection": O.SLIDING_CONNECTIONS,
        "file_provenance": O.with_ctes(O.CAPTURE_CTES, O.FILE_PROVENANCE),
        "upsert_duplicate_keys": O.UPSERT_DUPLICATE_KEYS,
        **{f"silver_{SPECS_BY_SOURCE[t].target}": O.silver_target(t) for t in X.SILVER_CAPTURE},
        "gold_refresh_packet": O.with_ctes(O.PACKET_CTES, "select * from g1"),
        "gold_refresh_connection": O.with_ctes(O.CONNECTION_CTES, "select * from g2"),
        "pipeline_packet_map": O.with_ctes(O.PACKET_CTES, "select * from g1"),
        "late_host_reenrich": O.with_ctes(
            O.CAPTURE_CTES, "select _id, hostname, source_host, source_port, destination_host, "
            "destination_port from network_ip"),
    }
