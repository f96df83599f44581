"""A key holding a third of all rows: results stay exact, plans stay split."""

import datetime as dt

from pyspark.sql import functions as F

from wiremap.operators.latest import latest_by_key
from wiremap.plans.connection_map import connection_map
from wiremap.plans.packet_map import packet_map

from test_network_map import AS_OF, T, frames


def _skewed(spark, n=600):
    # machine m0 / pid 1 sends a third of all packets, all to one endpoint h1:2000
    ips, pkts, links, procs = [], [], [], []
    for i in range(n):
        hot = i % 3 == 0
        m = "m0" if hot else ("m1" if i % 2 else "m2")
        src = {"m0": "h0", "m1": "h1", "m2": "h2"}[m]
        dst = "h1" if hot else ("h0" if m != "m0" else "h2")
        ips.append((i, m, src, 1000 + i % 2, dst, 2000 if hot else 1000 + i % 2))
        pkts.append((i, m, 60, T + dt.timedelta(seconds=i * 7), "eth0"))
        links.append((10_000 + i, i, m, 1 if hot else i % 4))
    for k in range(40):     # many restarts of the hot process over the period
        procs.append((1, "m0", T + dt.timedelta(seconds=k * 97 - 30), 1, k, f"c{k % 3}", "x"))
    procs += [(p, m, T - dt.timedelta(minutes=1), 1, 0, "o", "x")
              for p in range(4) for m in ("m1", "m2")]
    return ips, pkts, links, procs


def test_hot_process_latest_pick_matches_naive(spark):
    f = frames(spark, *_skewed(spark))
    fast = packet_map(*f, as_of=AS_OF, pick="latest")
    slow = packet_map(*f, as_of=AS_OF, pick="latest", reduce_first=False)
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect()))
    # the as-of windows partition the hot (hostname, pid) by time bucket
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(hostname" in plan and "__b" in plan


def test_hot_endpoint_connections_match_naive(spark):
    f = frames(spark, *_skewed(spark))
    pk = packet_map(*f, as_of=AS_OF)
    a = connection_map(pk)
    b = connection_map(pk, reduce_first=False)
    assert a.count() > 0
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_hot_key_latest_by_key(spark):
    rows = [(0 if i % 3 == 0 else i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i)
            for i in range(900)]
    df = spark.createDataFrame(rows, "k int, inserted_at timestamp, v int")
    out = {r.k: r.v for r in latest_by_key(df, ["k"]).collect()}
    assert out[0] == 897 and len(out) == 601
    assert "WindowGroupLimit" in latest_by_key(df, ["k"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert df.filter(F.col("k") == 0).count() == 300
