"""Property test: latest row per key equals a plain-Python reference."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from wiremap.operators.latest import latest_by_key

T0 = dt.datetime(2024, 1, 1)
rows_st = st.lists(
    st.tuples(st.integers(0, 3),                                   # key
              st.one_of(st.none(), st.integers(0, 4)),             # clock (seconds)
              st.integers(0, 5)),                                  # payload
    min_size=1, max_size=25)


def reference(rows):
    best = {}
    for k, t, v in rows:
        # greatest clock first, nulls last, then the smallest payload
        rank = (t is None, -(t or 0), v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    return sorted(r for _, r in best.values())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_latest_by_key_matches_reference(spark, rows):
    df = spark.createDataFrame(
        [(k, None if t is None else T0 + dt.timedelta(seconds=t), v) for k, t, v in rows],
        "k int, inserted_at timestamp, v int")
    got = sorted((r.k, None if r.inserted_at is None else int((r.inserted_at - T0).total_seconds()),
                  r.v) for r in latest_by_key(df, ["k"]).collect())
    assert got == reference(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 5)),
                     min_size=2, max_size=20, unique_by=lambda r: (r[0], r[1])),
       cut=st.integers(1, 19))
def test_newest_wins_order_independent(spark, tmp_path_factory, rows, cut):
    from wiremap.operators.upsert import read_keyed, upsert
    data = [(k, T0 + dt.timedelta(seconds=t), v) for k, t, v in rows]
    cut = min(cut, len(data) - 1)
    first = spark.createDataFrame(data[:cut], "k int, inserted_at timestamp, v int")
    second = spark.createDataFrame(data[cut:], "k int, inserted_at timestamp, v int")
    out = []
    for a, b in ((first, second), (second, first)):
        p = str(tmp_path_factory.mktemp("nw"))
        upsert(spark, a, p, ["k"], batch_id=0, order_by="inserted_at", newest_wins=True)
        upsert(spark, b, p, ["k"], batch_id=1, order_by="inserted_at", newest_wins=True)
        out.append(sorted(map(tuple, read_keyed(spark, p).collect())))
    assert out[0] == out[1]
    assert out[0] == sorted(tuple(r) for r in spark.createDataFrame(
        data, "k int, inserted_at timestamp, v int").collect()
        if r.inserted_at == max(x[1] for x in data if x[0] == r.k))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 300))),
                     min_size=1, max_size=15),
       right=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300), st.integers(0, 3)),
                      max_size=15),
       width=st.sampled_from([1, 30, 600]))
def test_asof_matches_brute_force(spark, left, right, width):
    from wiremap.operators.asof import asof_latest
    ldf = spark.createDataFrame(
        [(i, k, None if t is None else T0 + dt.timedelta(seconds=t)) for i, (k, t) in enumerate(left)],
        "id int, k int, t timestamp")
    rdf = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=t), v) for k, t, v in right],
                                "k int, rt timestamp, v int")
    got = {r.id: (r.asof.v if r.asof else None)
           for r in asof_latest(ldf, rdf, ["k"], "t", "rt", ["v"], bucket_seconds=width).collect()}
    want = {}
    for i, (k, t) in enumerate(left):
        cands = [(rt, v) for rk, rt, v in right if rk == k and t is not None and rt < t]
        # latest time, then the smallest value
        want[i] = min(cands, key=lambda c: (-c[0], c[1]))[1] if cands else None
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets=st.lists(st.integers(0, 1_300_000_000), min_size=1, max_size=30),
       as_of_us=st.integers(600_000_000, 1_300_000_000), minutes=st.sampled_from([1, 10, 15]))
def test_pushable_lookback_equals_whole_second_form(spark, offsets, as_of_us, minutes):
    """``col >= trunc_second(as_of) - (N*60-1) s`` keeps exactly the rows with
    ``unix_timestamp(col) > unix_timestamp(as_of) - N*60``."""
    from pyspark.sql import functions as F
    from wiremap.operators.recent import recent
    as_of = T0 + dt.timedelta(microseconds=as_of_us)
    df = spark.createDataFrame([(i, T0 + dt.timedelta(microseconds=o)) for i, o in enumerate(offsets)],
                               "id int, dtk_inserted_at timestamp")
    fast = {r.id for r in recent(df, minutes, as_of=F.lit(as_of)).collect()}
    slow = {r.id for r in df.filter(F.unix_timestamp("dtk_inserted_at")
                                    > F.unix_timestamp(F.lit(as_of)) - minutes * 60).collect()}
    assert fast == slow
