import datetime as dt
import random

import pytest

from wiremap.plans.connection_map import connection_map
from wiremap.plans.packet_map import packet_map

T = dt.datetime(2024, 1, 1, 10, 0, 0)
AS_OF = dt.datetime(2024, 1, 1, 11, 0, 0)

IFACE = "host string, hostname string, network string"
IP = ("_id bigint, hostname string, source_host string, source_port int, "
      "destination_host string, destination_port int")
PKT = "_id bigint, hostname string, length bigint, created_at timestamp, interface string"
LINK = "_id bigint, packet_id bigint, hostname string, pid bigint"
PROC = ("pid bigint, hostname string, started_at timestamp, ppid bigint, uid bigint, "
        "command string, full_command string")

BASE_IFACES = [("h0", "m0", "n0"), ("h1", "m1", "n1"), ("h2", "m2", "n0")]


def frames(spark, ips, pkts, links, procs, ifaces=BASE_IFACES):
    return (spark.createDataFrame(ips, IP), spark.createDataFrame(pkts, PKT),
            spark.createDataFrame(ifaces, IFACE), spark.createDataFrame(links, LINK),
            spark.createDataFrame(procs, PROC))


def gold(spark, ips, pkts, links, procs, ifaces=BASE_IFACES, **kw):
    return packet_map(*frames(spark, ips, pkts, links, procs, ifaces), as_of=AS_OF, **kw)


def one_packet(pid=7, created=T, link=True):
    ips = [(1, "m0", "h0", 1000, "h1", 2000)]
    pkts = [(1, "m0", 60, created, "eth0")]
    links = [(11, 1, "m0", pid)] if link else []
    return ips, pkts, links


def proc(start, pid=7, cmd="c", host="m0"):
    return (pid, host, start, 1, 0, cmd, cmd + " --x")


def test_packet_without_process_is_kept(spark):
    ips, pkts, links = one_packet(link=False)
    out = gold(spark, ips, pkts, links, []).collect()
    assert len(out) == 1 and out[0].pid is None and out[0].command is None


def test_only_later_start_drops_packet(spark):
    ips, pkts, links = one_packet()
    procs = [proc(T + dt.timedelta(seconds=1)), proc(T)]   # equal start is not "before"
    assert gold(spark, ips, pkts, links, procs).count() == 0
    kept = gold(spark, ips, pkts, links, procs, keep_unmatched=True).collect()
    assert len(kept) == 1 and kept[0].pid == 7 and kept[0].process_started_at is None


def test_two_earlier_starts(spark):
    ips, pkts, links = one_packet()
    t1, t2 = T - dt.timedelta(minutes=2), T - dt.timedelta(minutes=1)
    procs = [proc(t2, cmd="second"), proc(t1, cmd="first")]
    assert [r.command for r in gold(spark, ips, pkts, links, procs).collect()] == ["first"]
    latest = gold(spark, ips, pkts, links, procs, pick="latest").collect()
    assert [r.command for r in latest] == ["second"]


def test_null_start_kept_beside_earlier_start(spark):
    ips, pkts, links = one_packet()
    procs = [proc(None, cmd="nostart"), proc(T - dt.timedelta(minutes=1), cmd="early")]
    out = sorted(r.command for r in gold(spark, ips, pkts, links, procs).collect())
    assert out == ["early", "nostart"]


def test_same_id_on_two_machines_both_kept(spark):
    ips = [(1, "m0", "h0", 1000, "h1", 2000), (1, "m1", "h1", 2000, "h0", 1000)]
    pkts = [(1, "m0", 60, T, "eth0"), (1, "m1", 60, T, "eth0")]
    links = [(11, 1, "m0", 7), (12, 1, "m1", 7)]
    procs = [proc(T - dt.timedelta(minutes=1), host="m0"),
             proc(T - dt.timedelta(minutes=2), host="m1")]
    assert gold(spark, ips, pkts, links, procs).count() == 2
    # the pipeline's original partition (_id, pid) lets one machine erase the other
    assert gold(spark, ips, pkts, links, procs, pick_keys=("_id", "pid")).count() == 1


def test_self_traffic_dropped(spark):
    ips = [(1, "m0", "h0", 1000, "h0", 2000)]
    pkts = [(1, "m0", 60, T, "eth0")]
    assert gold(spark, ips, pkts, [], []).count() == 0


def test_null_port_in_packets_not_in_connections(spark):
    ips = [(1, "m0", "h0", None, "h1", None), (2, "m1", "h1", None, "h0", None)]
    pkts = [(1, "m0", 60, T, "eth0"), (2, "m1", 60, T, "eth0")]
    pk = gold(spark, ips, pkts, [], [])
    assert pk.count() == 2
    assert connection_map(pk).count() == 0
    # one known port is enough on the receiving side: the reply pairs with the request
    ips[1] = (2, "m1", "h1", 2000, "h0", None)
    ips[0] = (1, "m0", "h0", None, "h1", 2000)
    assert connection_map(gold(spark, ips, pkts, [], [])).count() == 1


def test_connection_pairs_endpoints(spark):
    # m0:h0:1000 -> h1:2000 and the reply m1:h1:2000 -> h0:1000
    ips = [(1, "m0", "h0", 1000, "h1", 2000), (2, "m1", "h1", 2000, "h0", 1000)]
    pkts = [(1, "m0", 60, T, "eth0"), (2, "m1", 60, T + dt.timedelta(seconds=5), "eth1")]
    pk = gold(spark, ips, pkts, [], [])
    out = sorted((r.source_host, r.source_port, r.destination_host, r.destination_port)
                 for r in connection_map(pk).collect())
    assert out == [("h0", 1000, "h1", 2000), ("h1", 2000, "h0", 1000)]


def random_inputs(seed):
    rnd = random.Random(seed)
    hosts = ["h0", "h1", "h2", None]
    machines = ["m0", "m1", "m2"]
    ifaces = list(BASE_IFACES) + [("h1", "m2", "n2"), ("h3", "m0", None)]
    ips, pkts, links, procs = [], [], [], []
    for i in range(rnd.randint(8, 20)):
        _id = rnd.randint(0, 6)
        m = rnd.choice(machines)
        port = lambda: rnd.choice([1000, 1001, None])
        ips.append((_id, m, rnd.choice(hosts), port(), rnd.choice(hosts), port()))
        created = None if rnd.random() < 0.1 else T + dt.timedelta(
            minutes=rnd.randint(0, 2), seconds=rnd.randint(0, 3))
        pkts.append((_id, m, rnd.randint(1, 3), created, rnd.choice(["e0", "e1"])))
        if rnd.random() < 0.7:
            links.append((100 + i, _id, m, rnd.choice([1, 2, None])))
    for _ in range(rnd.randint(0, 10)):
        start = None if rnd.random() < 0.15 else T + dt.timedelta(minutes=rnd.randint(-2, 2))
        procs.append((rnd.choice([1, 2]), rnd.choice(machines), start, 1,
                      rnd.randint(0, 1), rnd.choice(["a", "b"]), "x"))
    return ips, pkts, links, procs, ifaces


@pytest.mark.parametrize("seed", range(6))
def test_reduced_plans_equal_naive_plans(spark, seed):
    ips, pkts, links, procs, ifaces = random_inputs(seed)
    f = frames(spark, ips, pkts, links, procs, ifaces)
    fast = packet_map(*f, as_of=AS_OF)
    slow = packet_map(*f, as_of=AS_OF, reduce_first=False)
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect()))
    for aligned in (False, True):
        a = connection_map(fast, align_minutes=aligned)
        b = connection_map(slow, align_minutes=aligned, reduce_first=False)
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("seed", range(6, 10))
@pytest.mark.parametrize("keep_unmatched", [False, True])
def test_latest_asof_equals_naive(spark, seed, keep_unmatched):
    ips, pkts, links, procs, ifaces = random_inputs(seed)
    # equal start times with different attributes exercise the tie-break
    procs = procs + [(p[0], p[1], p[2], 2, 9, "z", "y") for p in procs[:3]]
    f = frames(spark, ips, pkts, links, procs, ifaces)
    kw = dict(as_of=AS_OF, pick="latest", keep_unmatched=keep_unmatched)
    fast = packet_map(*f, **kw)
    slow = packet_map(*f, reduce_first=False, **kw)
    assert sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect()))


def test_lookback_on_facts_and_dimensions(spark):
    """Facts and (by default) dimensions older than the look-back drop out."""
    ips, pkts, links = one_packet()
    procs = [proc(T - dt.timedelta(minutes=1))]
    f = list(frames(spark, ips, pkts, links, procs))
    from pyspark.sql import functions as F
    fresh, stale = F.lit(AS_OF - dt.timedelta(minutes=5)), F.lit(AS_OF - dt.timedelta(minutes=30))
    f = [df.withColumn("dtk_inserted_at", fresh) for df in f]
    kw = dict(as_of=AS_OF, lookback_minutes=10)
    assert packet_map(*f, **kw).count() == 1
    old_ip = f[0].withColumn("dtk_inserted_at", stale)
    assert packet_map(old_ip, *f[1:], **kw).count() == 0
    old_proc = f[4].withColumn("dtk_inserted_at", stale)
    # a stale process row is invisible: the packet stays, without its process
    out = packet_map(*f[:4], old_proc, **kw).collect()
    assert len(out) == 1 and out[0].command is None
    out = packet_map(*f[:4], old_proc, dim_lookback=False, **kw).collect()
    assert out[0].command == "c"
