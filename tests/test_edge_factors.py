"""The factorised edge summary equals the one over all connection pairs."""

import datetime as dt
import random

import pytest

from wiremap.plans.connection_map import connection_map, connection_sides
from wiremap.plans.edge_factors import edge_summary_of_packets, endpoint_edges
from wiremap.plans.graph import edge_summary, report_connections
from wiremap.plans.packet_map import packet_map
from wiremap.sources.fixtures import capture_views

from conftest import SF_SMALL, rows

SCHEMA = ("packet_id long, source_hostname string, source_host string, source_port int, source_network string, "
          "interface string, created_at timestamp, length long, pid long, ppid long, uid long, command string, "
          "full_command string, process_started_at timestamp, destination_host string, destination_port int, "
          "destination_network string, destination_hostname string, dtk_inserted_at timestamp")
T0 = dt.datetime(2024, 1, 1)


def random_packets(seed, n, machines):
    """Hosts with one machine (machines=1) or several; null ports, pids, commands, networks and clocks."""
    rng = random.Random(seed)
    host = lambda: f"h{rng.randrange(4)}"
    machine = lambda h: f"{h}-m{rng.randrange(machines)}"
    some = lambda v: None if rng.random() < 0.15 else v
    out = []
    for i in range(n):
        s, d = host(), host()
        out.append((i % (n // 2), machine(s), s, some(rng.randrange(3)), some(f"net{rng.randrange(2)}"), "eth",
                    some(T0 + dt.timedelta(seconds=rng.randrange(400))), i, some(rng.randrange(3)), 1, 2,
                    some(f"c{rng.randrange(3)}"), "full", None, d, some(rng.randrange(3)), some(f"net{rng.randrange(2)}"),
                    machine(d), T0 + dt.timedelta(minutes=rng.randrange(30))))
    return out


def pairwise(packets, minutes, as_of, align):
    return edge_summary(report_connections(connection_map(packets, align), minutes, as_of))


@pytest.mark.parametrize("align", [False, True])
@pytest.mark.parametrize("machines,seed", [(1, 1), (1, 2), (2, 3), (3, 4)])
def test_equals_the_pairwise_summary(spark, machines, seed, align):
    packets = spark.createDataFrame(random_packets(seed, 120, machines), SCHEMA)
    for minutes in (None, 15):
        as_of = T0 + dt.timedelta(minutes=30)
        got = edge_summary_of_packets(packets, minutes, as_of, align)
        want = pairwise(packets, minutes, as_of, align)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert rows(got) == rows(want) and (align or want.count() > 0)


def test_join_output_is_bounded_by_edges(spark):
    """Rows after the join: endpoints times edges, however many minutes and packets there are."""
    v = capture_views(spark, SF_SMALL)
    packets = packet_map(v.network_ip, v.network_packet, v.interfaces, v.process_network, v.process,
                         as_of=v.as_of).cache()
    a, b = connection_sides(packets)
    met = endpoint_edges(a, b)
    edges = edge_summary_of_packets(packets, None)
    assert rows(edges) == rows(pairwise(packets, None, None, False))
    ports = packets.select("source_port").distinct().count()
    assert met.count() <= edges.count() * ports
    assert met.count() < connection_map(packets).count()


def test_no_packets(spark):
    assert edge_summary_of_packets(spark.createDataFrame([], SCHEMA), None).count() == 0


def test_sets_are_united_without_a_row_for_each_value(spark):
    """No row a set value is shuffled, and no pairwise part is planned where each (host, port) has one machine."""
    packets = spark.createDataFrame(random_packets(5, 200, 1), SCHEMA)
    plan = edge_summary_of_packets(packets, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") == 1
    several = spark.createDataFrame(random_packets(5, 200, 2), SCHEMA)
    assert edge_summary_of_packets(several, None)._jdf.queryExecution().optimizedPlan().toString().count("Join") > 1
