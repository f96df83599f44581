"""Connection pairs are ranked only where a (host, port) sends from several machines."""

import pytest

from wiremap.plans import connection_map as C

from conftest import rows
from test_edge_factors import SCHEMA, random_packets


@pytest.mark.parametrize("align", [False, True])
@pytest.mark.parametrize("machines,seed", [(1, 5), (2, 6), (3, 7)])
def test_same_rows_as_ranking_every_pair(spark, machines, seed, align):
    packets = spark.createDataFrame(random_packets(seed, 120, machines), SCHEMA)
    want = C.connection_map(packets, align, reduce_first=False)
    assert rows(C.connection_map(packets, align)) == rows(want)


@pytest.mark.parametrize("machines,some", [(1, False), (3, True)])
def test_pairs_of_single_machines_are_not_ranked(spark, monkeypatch, machines, some):
    packets = spark.createDataFrame(random_packets(8, 120, machines), SCHEMA)
    ranked, pick = [], C.pick_connections
    monkeypatch.setattr(C, "pick_connections", lambda a, b, align=False: ranked.append(a) or pick(a, b, align))
    assert C.connection_map(packets).count() > 0
    assert (sum(a.count() for a in ranked) > 0) == some
