"""Gold refresh: recompute the recent packet and connection maps and upsert them.

The pipeline re-runs this every 30 seconds over the last 10 minutes of
ingest time.  Here one refresh is a function of ``as_of``; the schedule is a
Structured Streaming processing-time trigger over any tick stream (usually
the bronze packet stream), so the refresh runs under Spark's query manager
with its own checkpointed batch ids instead of a Python thread.

Per refresh the packet map is computed once, written under the gold folder
and read back; the connection map's self-join and both upserts then read
that snapshot instead of recomputing the joins three times.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from wiremap import fs
from wiremap.operators.upsert import read_keyed, upsert
from wiremap.plans.connection_map import connection_map
from wiremap.plans.packet_map import packet_map
from wiremap.session import FREE_SHUFFLES, settings
from wiremap.spec import (
    CONNECTION_KEYS, GOLD_LOOKBACK_MINUTES, GOLD_REFRESH_SECONDS, PACKET_KEYS, SILVER_TABLES,
)
from wiremap.streaming.ingest_log import read_window
from wiremap.streaming.silver import query_writer

log = logging.getLogger(__name__)

PACKET_TABLE = "fact_network_map_packet"
CONNECTION_TABLE = "fact_network_map_connection"
GOLD_BUCKETS = 16


@dataclass
class SilverInputs:
    network_ip: DataFrame
    network_packet: DataFrame
    interfaces: DataFrame
    process_network: DataFrame
    process: DataFrame


def silver_inputs(spark: SparkSession, silver_path: str) -> SilverInputs:
    """Current snapshots of the five silver tables the gold layer reads."""
    def t(name: str) -> DataFrame:
        df = read_keyed(spark, f"{silver_path}/{name}")
        if df is None:
            raise FileNotFoundError(f"silver table {name} has no committed version yet")
        return df
    return SilverInputs(t("fact_network_ip"), t("fact_network_packet"),
                        t("dim_network_interface"), t("fact_process_network"), t("dim_process"))


def window_inputs(spark: SparkSession, log_path: str, as_of: dt.datetime,
                  minutes: int = GOLD_LOOKBACK_MINUTES) -> SilverInputs:
    """The five inputs of a refresh from the ingest logs: only the look-back's hours are opened."""
    def t(name: str) -> DataFrame:
        spec = next(s for s in SILVER_TABLES if s.target == name)
        return read_window(spark, f"{log_path}/{name}", minutes, as_of, spec.keys)
    return SilverInputs(t("fact_network_ip"), t("fact_network_packet"),
                        t("dim_network_interface"), t("fact_process_network"), t("dim_process"))


def refresh(spark: SparkSession, inputs: SilverInputs, gold_path: str, *,
            as_of: Column | dt.datetime | None = None,
            lookback_minutes: int | None = GOLD_LOOKBACK_MINUTES,
            batch_id: int | None = None, writer: str = "refresh", align_minutes: bool = False,
            dim_lookback: bool = True, buckets: int = GOLD_BUCKETS) -> None:
    """One gold refresh.

    ``batch_id`` numbers the refreshes of one ``writer``; a number that it has
    committed is a replay.  Without one the refresh always runs.
    """
    gold_path = gold_path.rstrip("/")
    packets = packet_map(inputs.network_ip, inputs.network_packet, inputs.interfaces,
                         inputs.process_network, inputs.process, as_of=as_of,
                         lookback_minutes=lookback_minutes, dim_lookback=dim_lookback)
    stage = f"{gold_path}/_refresh/{uuid.uuid4().hex}"
    try:
        with settings(spark, FREE_SHUFFLES):
            packets.write.parquet(stage)
        pk = spark.read.schema(packets.schema).parquet(stage)
        upsert(spark, pk, f"{gold_path}/{PACKET_TABLE}", list(PACKET_KEYS), batch_id=batch_id,
               writer=writer, buckets=buckets)
        conn = connection_map(pk, align_minutes=align_minutes)
        # one row per connection key by construction (group limit in connection_map)
        upsert(spark, conn, f"{gold_path}/{CONNECTION_TABLE}", list(CONNECTION_KEYS),
               batch_id=batch_id, writer=writer, buckets=buckets, unique_keys=True, spread=True)
    finally:
        fs.delete(spark, stage)


def start_gold(spark: SparkSession, ticks: DataFrame, silver_path: str, gold_path: str,
               checkpoint: str, *, period_seconds: int = GOLD_REFRESH_SECONDS,
               lookback_minutes: int | None = GOLD_LOOKBACK_MINUTES,
               log_path: str | None = None, available_now: bool = False):
    """Run ``refresh`` on every trigger of a streaming query over ``ticks``.

    With ``log_path`` (the ingest logs that the silver jobs write) a refresh reads
    its look-back from there instead of the keyed tables.
    """
    writer_id = query_writer(spark, checkpoint)

    def run(_batch: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        now = dt.datetime.now(dt.timezone.utc)
        inputs = (silver_inputs(spark, silver_path) if log_path is None or lookback_minutes is None
                  else window_inputs(spark, log_path, now, lookback_minutes))
        refresh(spark, inputs, gold_path, as_of=now, lookback_minutes=lookback_minutes,
                batch_id=batch_id, writer=writer_id())
        took = time.time() - t0
        if took > period_seconds:
            log.warning("gold refresh took %.1f s, longer than its %d s period",
                        took, period_seconds)
    writer = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=f"{period_seconds} seconds"))
    return writer.start()


def read_gold(spark: SparkSession, gold_path: str, table: str) -> DataFrame | None:
    return read_keyed(spark, f"{gold_path.rstrip('/')}/{table}")
