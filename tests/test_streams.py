import datetime as dt

import pytest
from pyspark.sql import functions as F

from wiremap.operators.latest import latest_by_key
from wiremap.operators.upsert import read_keyed
from wiremap.sources.files import add_file_provenance, raw_stream
from wiremap.sources.landing import write_capture_files, write_capture_files_in_order
from wiremap.spec import BRONZE_COLUMNS, RAW_SCHEMAS, SILVER_TABLES, TableSpec
from wiremap.streaming import gold as G
from wiremap.streaming.bronze import bronze_schema, bronze_stream, read_bronze, start_bronze
from wiremap.streaming.silver import silver_batch, start_silver

from conftest import SF_SMALL

SPEC = TableSpec("events", "events_latest", ("user_id", "event_type"), order_by="ts")
COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp"))


def _split(ev):
    raw = ev.withColumn("hostname", F.concat(F.lit("cap"), (F.col("event_id") % 3).cast("string")))
    return [raw.filter(F.col("event_id") % 3 == i) for i in range(3)]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    ev = _events(spark)
    base = str(tmp_path)
    write_capture_files_in_order(spark, _split(ev), f"{base}/raw")
    for _ in range(2):       # second run restarts from the checkpoints
        start_bronze(spark, f"{base}/raw", f"{base}/bronze", f"{base}/chk_b",
                     schema=ev.schema, max_files_per_trigger=1).awaitTermination()
        stream = bronze_stream(spark, f"{base}/bronze", bronze_schema(ev.schema))
        start_silver(spark, stream, SPEC, f"{base}/silver", f"{base}/chk_s",
                     newest_wins=True).awaitTermination()
    assert read_bronze(spark, f"{base}/bronze").count() == ev.count()
    got = read_keyed(spark, f"{base}/silver").select(*COLS)
    want = latest_by_key(ev, list(SPEC.keys), "ts")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*COLS).collect()))


def test_arrival_order_wins_without_newest_wins(spark, tmp_path):
    """Later files overwrite keys even with older rows (the pipeline's MERGE)."""
    ev = _events(spark)
    base = str(tmp_path)
    parts = _split(ev)
    write_capture_files_in_order(spark, parts[::-1], f"{base}/raw")   # files 2, 1, 0
    stream = add_file_provenance(raw_stream(spark, f"{base}/raw", ev.schema, 1))
    start_silver(spark, stream, SPEC, f"{base}/silver", f"{base}/chk").awaitTermination()
    got = {(r.user_id, r.event_type): r.event_id
           for r in read_keyed(spark, f"{base}/silver").collect()}
    # expected: latest row of the last file (event_id % 3 == 0 arrives last) holding the key
    ranked = ev.withColumn("arrival", 2 - F.col("event_id") % 3)
    want = latest_by_key(ranked, list(SPEC.keys), "arrival", tie_break=[],
                         complete_order=False)
    want = latest_by_key(ranked.join(want.select(*SPEC.keys, "arrival"),
                                     [*SPEC.keys, "arrival"]), list(SPEC.keys), "ts")
    assert got == {(r.user_id, r.event_type): r.event_id for r in want.collect()}


def test_duplicate_rows_in_one_file_are_dropped(spark, tmp_path):
    ev = _events(spark).withColumn("hostname", F.lit("m0"))
    twice = ev.withColumn("__c", F.explode(F.array(F.lit(1), F.lit(2)))).drop("__c")
    write_capture_files(spark, twice, f"{tmp_path}/raw")
    start_bronze(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/chk",
                 schema=_events(spark).schema).awaitTermination()
    out = read_bronze(spark, f"{tmp_path}/bronze")
    assert out.count() == ev.count()
    assert {r.hostname for r in out.select("hostname").distinct().collect()} == {"m0"}


HOSTS = "_id bigint, address struct<address:string,mask:int>, host string"


@pytest.mark.parametrize("spec", SILVER_TABLES, ids=lambda s: s.target)
def test_every_silver_spec_runs(spark, spec):
    schema = bronze_schema(RAW_SCHEMAS[spec.source])
    t0 = dt.datetime(2024, 1, 1)
    row = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        row.append({"bigint": 1, "int": 1, "string": "s", "timestamp": t0,
                    "date": t0.date()}.get(t, ("10.0.0.1", 24)))
    df = spark.createDataFrame([tuple(row), tuple(row)], schema)
    hosts = spark.createDataFrame([(1, ("10.0.0.1", 24), "h")], HOSTS)
    out = silver_batch(df, spec, hosts)
    assert out.count() == 1
    assert set(spec.keys) <= set(out.columns)
    for _, host_col in spec.lookups:
        assert out.select(host_col).collect()[0][0] == "h"
    if not spec.distinct_only:
        assert set(BRONZE_COLUMNS) <= set(out.columns)


def test_gold_refresh_under_a_trigger(spark, tmp_path):
    """Silver snapshots -> one triggered gold refresh -> both gold tables."""
    from wiremap.operators.upsert import upsert
    from wiremap.sources.fixtures import capture_views
    v = capture_views(spark, SF_SMALL)
    silver = str(tmp_path / "silver")
    for name, df, keys in (("fact_network_ip", v.network_ip, ["_id", "hostname"]),
                           ("fact_network_packet", v.network_packet, ["_id", "hostname"]),
                           ("dim_network_interface", v.interfaces, ["_id", "hostname"]),
                           ("fact_process_network", v.process_network, ["_id", "hostname"]),
                           ("dim_process", v.process, ["pid", "started_at", "hostname"])):
        upsert(spark, df, f"{silver}/{name}", keys)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = G.start_gold(spark, ticks, silver, str(tmp_path / "gold"), str(tmp_path / "chk"),
                     period_seconds=1, lookback_minutes=None)
    try:
        import time
        deadline = time.time() + 120
        while G.read_gold(spark, str(tmp_path / "gold"), G.CONNECTION_TABLE) is None:
            assert time.time() < deadline
            time.sleep(1)
    finally:
        q.stop()
    pk = G.read_gold(spark, str(tmp_path / "gold"), G.PACKET_TABLE)
    assert pk.count() == 805
    assert pk.groupBy("packet_id", "source_hostname").count().filter("count > 1").count() == 0


def test_inferred_schema_and_keyed_dedupe_across_files(spark, tmp_path):
    """Copies of a key in two files: per-batch distinct keeps both, the
    watermark dedupe on business keys keeps one."""
    ev = _events(spark).withColumn("hostname", F.lit("m0"))
    write_capture_files_in_order(spark, [ev, ev], f"{tmp_path}/raw")
    for name, kw, expected in (("plain", {}, 2), ("keyed", {"dedupe_keys": ["event_id"],
                                                          "watermark": ("ts", "1 hour")}, 1)):
        start_bronze(spark, f"{tmp_path}/raw", f"{tmp_path}/{name}", f"{tmp_path}/chk_{name}",
                     max_files_per_trigger=1, **kw).awaitTermination()
        out = read_bronze(spark, f"{tmp_path}/{name}")
        assert out.count() == expected * ev.count(), name


def test_a_small_micro_batch_is_listed_and_compared_in_few_tasks(spark, tmp_path):
    """Forty small files in one batch: no listing job with a task a file, one file of distinct rows."""
    ev = _events(spark).withColumn("hostname", F.concat(F.lit("m"), (F.col("event_id") % 40).cast("string")))
    write_capture_files(spark, ev.unionAll(ev), f"{tmp_path}/raw")
    start_bronze(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/chk",
                 schema=_events(spark).schema, max_files_per_trigger=64).awaitTermination()
    assert read_bronze(spark, f"{tmp_path}/bronze").count() == ev.count()
    assert len(list((tmp_path / "bronze").glob("batch=*/*.parquet"))) == 1
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")) >= 64
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) < 64
