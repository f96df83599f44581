import datetime as dt

import pytest
from pyspark.sql import functions as F

from wiremap.operators.upsert import read_keyed, upsert, versions

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k int, v string, inserted_at timestamp"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_first_load_dedupes_keys(spark, tmp_path):
    p = str(tmp_path / "t")
    upsert(spark, _df(spark, [(1, "old", T0), (1, "new", T0 + dt.timedelta(1))]), p, ["k"],
           order_by="inserted_at")
    assert [(r.k, r.v) for r in read_keyed(spark, p).collect()] == [(1, "new")]


def test_matched_replaced_unmatched_inserted(spark, tmp_path):
    p = str(tmp_path / "t")
    upsert(spark, _df(spark, [(1, "a", T0), (2, "b", T0)]), p, ["k"], batch_id=0)
    upsert(spark, _df(spark, [(2, "B", T0), (3, "C", T0)]), p, ["k"], batch_id=1)
    out = sorted((r.k, r.v) for r in read_keyed(spark, p).collect())
    assert out == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_accumulate_unless_null_safe(spark, tmp_path):
    for null_safe, expected in ((False, 2), (True, 1)):
        p = str(tmp_path / f"t{null_safe}")
        upsert(spark, _df(spark, [(None, "x", T0)]), p, ["k"], batch_id=0, null_safe=null_safe)
        upsert(spark, _df(spark, [(None, "y", T0)]), p, ["k"], batch_id=1, null_safe=null_safe)
        assert read_keyed(spark, p).count() == expected


def test_duplicate_source_key(spark, tmp_path):
    rows = [(1, "a", T0), (1, "b", T0)]
    p = str(tmp_path / "t")
    upsert(spark, _df(spark, rows), p, ["k"])
    assert read_keyed(spark, p).count() == 1
    with pytest.raises(ValueError):
        upsert(spark, _df(spark, rows), str(tmp_path / "e"), ["k"], on_duplicate="error")


def test_replay_of_committed_batch_is_noop(spark, tmp_path):
    p = str(tmp_path / "t")
    upsert(spark, _df(spark, [(1, "a", T0)]), p, ["k"], batch_id=0)
    upsert(spark, _df(spark, [(1, "b", T0)]), p, ["k"], batch_id=1)
    upsert(spark, _df(spark, [(1, "zzz", T0)]), p, ["k"], batch_id=1)   # replay
    assert [r.v for r in read_keyed(spark, p).collect()] == ["b"]


def test_upsert_twice_equals_once_and_keys_unique(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    upsert(spark, ev, once, ["user_id", "event_type"], order_by="ts")
    upsert(spark, ev, twice, ["user_id", "event_type"], order_by="ts")
    upsert(spark, ev, twice, ["user_id", "event_type"], order_by="ts")
    a, b = read_keyed(spark, once), read_keyed(spark, twice)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert b.groupBy("user_id", "event_type").count().filter("count > 1").count() == 0


def test_newest_wins_is_order_independent(spark, tmp_path):
    old, new = _df(spark, [(1, "old", T0)]), _df(spark, [(1, "new", T0 + dt.timedelta(1))])
    for name, first, second in (("a", old, new), ("b", new, old)):
        p = str(tmp_path / name)
        upsert(spark, first, p, ["k"], batch_id=0, order_by="inserted_at", newest_wins=True)
        upsert(spark, second, p, ["k"], batch_id=1, order_by="inserted_at", newest_wins=True)
        assert [r.v for r in read_keyed(spark, p).collect()] == ["new"]


def test_old_versions_are_pruned(spark, tmp_path):
    p = str(tmp_path / "t")
    for i in range(4):
        upsert(spark, _df(spark, [(i, "x", T0)]), p, ["k"], batch_id=i, keep=2, keep_hours=0)
    assert versions(spark, p) == [2, 3]
    assert read_keyed(spark, p).count() == 4


def test_a_reader_survives_ten_commits(spark, tmp_path):
    p = str(tmp_path / "t")
    upsert(spark, _df(spark, [(0, "old", T0)]), p, ["k"])
    reader = read_keyed(spark, p)
    for i in range(10):
        upsert(spark, _df(spark, [(0, f"new{i}", T0)]), p, ["k"])
    assert [r.v for r in reader.collect()] == ["old"]
    assert [r.v for r in read_keyed(spark, p).collect()] == ["new9"]


def _files(p):
    import pathlib
    return {str(f): f.stat().st_mtime_ns for f in pathlib.Path(p, "data").rglob("part-*.parquet")}


def test_a_batch_writes_only_touched_buckets_and_changes_nothing_in_place(spark, tmp_path):
    p = str(tmp_path / "b")
    upsert(spark, _df(spark, [(k, "v0", T0) for k in range(40)]), p, ["k"], batch_id=0, buckets=8)
    old, before = read_keyed(spark, p), _files(p)
    upsert(spark, _df(spark, [(3, "v1", T0), (100, "new", T0)]), p, ["k"], batch_id=1)
    after = _files(p)
    assert all(after[f] == t for f, t in before.items())
    assert 1 <= len({f.split("__bucket=")[1].split("/")[0] for f in set(after) - set(before)}) <= 2
    assert {r.k: r.v for r in old.collect()}[3] == "v0"            # a reader of the old version
    out = {r.k: r.v for r in read_keyed(spark, p).collect()}
    assert len(out) == 41 and out[3] == "v1" and out[100] == "new" and out[4] == "v0"


def _rows(spark, p):
    return sorted((r.k, r.v) for r in read_keyed(spark, p).collect())


def test_writers_have_batch_numbers_of_their_own(spark, tmp_path):
    p = str(tmp_path / "w")
    for n in (0, 1):
        upsert(spark, _df(spark, [(n, "s", T0)]), p, ["k"], batch_id=n, writer="stream")
    upsert(spark, _df(spark, [(1, "job", T0)]), p, ["k"], writer="reenrich")
    upsert(spark, _df(spark, [(5, "s", T0)]), p, ["k"], batch_id=2, writer="stream")
    upsert(spark, _df(spark, [(6, "n", T0)]), p, ["k"], batch_id=0, writer="new checkpoint")
    upsert(spark, _df(spark, [(6, "again", T0)]), p, ["k"], batch_id=0, writer="new checkpoint")
    assert _rows(spark, p) == [(0, "s"), (1, "job"), (5, "s"), (6, "n")]


def test_layout_is_checked(spark, tmp_path):
    p = str(tmp_path / "l")
    upsert(spark, _df(spark, [(1, "a", T0)]), p, ["k"], buckets=4)
    for kw in ({"buckets": 8}, {"null_safe": True}):
        with pytest.raises(ValueError):
            upsert(spark, _df(spark, [(2, "b", T0)]), p, ["k"], **kw)
    with pytest.raises(ValueError):
        upsert(spark, _df(spark, [(2, "b", T0)]), p, ["k", "v"])
    assert _rows(spark, p) == [(1, "a")]


def test_new_and_missing_columns_are_merged(spark, tmp_path):
    p = str(tmp_path / "c")
    upsert(spark, _df(spark, [(k, "a", T0) for k in range(9)]), p, ["k"], buckets=4)
    upsert(spark, _df(spark, [(1, "b", T0)]).withColumn("w", F.lit(7)), p, ["k"])
    upsert(spark, _df(spark, [(2, "c", T0)]), p, ["k"])
    out = {r.k: (r.v, r.w) for r in read_keyed(spark, p).collect()}
    assert len(out) == 9 and out[1] == ("b", 7) and out[2] == ("c", None) and out[3] == ("a", None)


def test_keys_do_not_depend_on_the_session_time_zone(spark, tmp_path):
    p, key = str(tmp_path / "z"), ["inserted_at"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    source = _df(spark, [(1, "a", T0)])
    try:
        for v, z in (("a", "UTC"), ("b", "America/New_York")):
            spark.conf.set("spark.sql.session.timeZone", z)
            upsert(spark, source.withColumn("v", F.lit(v)), p, key)
        assert [r.v for r in read_keyed(spark, p).collect()] == ["b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_lost_commit_race_starts_over(spark, tmp_path, monkeypatch):
    from wiremap import fs
    p = str(tmp_path / "r")
    upsert(spark, _df(spark, [(1, "a", T0)]), p, ["k"], buckets=2)
    real, lost = fs.write_new, []

    def once(session, path, text):
        if not lost:
            lost.append(path)
            monkeypatch.setattr(fs, "write_new", real)
            upsert(spark, _df(spark, [(2, "other", T0)]), p, ["k"])
            return real(session, path, text)
        return real(session, path, text)

    monkeypatch.setattr(fs, "write_new", once)
    upsert(spark, _df(spark, [(3, "mine", T0)]), p, ["k"])
    assert lost and _rows(spark, p) == [(1, "a"), (2, "other"), (3, "mine")]


def test_hot_null_keys_are_spread(spark, tmp_path):
    p = str(tmp_path / "n")
    rows = [(None, f"x{i}", T0) for i in range(200)]
    upsert(spark, _df(spark, rows), p, ["k"], buckets=8, unique_keys=True)
    assert len({f.split("__bucket=")[1].split("/")[0] for f in _files(p)}) == 8
    assert read_keyed(spark, p).count() == 200


def test_empty_batch_is_a_noop(spark, tmp_path):
    p = str(tmp_path / "e")
    upsert(spark, _df(spark, [(1, "a", T0)]), p, ["k"], batch_id=0, buckets=4)
    upsert(spark, _df(spark, []), p, ["k"], batch_id=1, buckets=4)
    assert [(r.k, r.v) for r in read_keyed(spark, p).collect()] == [(1, "a")]


def test_empty_batch_snapshot_layout(spark, tmp_path):
    p = str(tmp_path / "s")
    upsert(spark, _df(spark, [(1, "a", T0)]), p, ["k"], batch_id=0)
    upsert(spark, _df(spark, []), p, ["k"], batch_id=1)
    assert [(r.k, r.v) for r in read_keyed(spark, p).collect()] == [(1, "a")]


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_first_write_leaves_no_second_copy_on_the_disks(spark, tmp_path, monkeypatch):
    """No staged copy, no shuffle by bucket (``spread``), and the source's own shuffle files go with the write."""
    import time

    from pyspark.sql import functions as F

    from wiremap.operators import upsert as U
    path, setting = str(tmp_path / "t"), "spark.sql.maxConcurrentOutputFileWriters"
    before, had = _shuffle_files(spark), spark.conf.get(setting)
    with monkeypatch.context() as m:
        m.setattr(U, "_clustered", None)
        rows = spark.range(500).withColumn("v", F.col("id") * 2).repartition(4, "v")
        assert U.upsert(spark, rows, path, ["id"], batch_id=0, buckets=4, unique_keys=True, spread=True) == 0
    assert not (tmp_path / "t" / "_staging").exists() and spark.conf.get(setting) == had
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    more = spark.range(400, 600).withColumn("v", F.lit(-1).cast("long"))
    assert U.upsert(spark, more, path, ["id"], batch_id=1, buckets=4, unique_keys=True, spread=True) == 1
    found = {r.id: r.v for r in U.read_keyed(spark, path).collect()}
    assert found == {i: 2 * i if i < 400 else -1 for i in range(600)}


def test_first_write_without_rows(spark, tmp_path):
    from wiremap.operators import upsert as U
    none = spark.range(0)
    assert U.upsert(spark, none, str(tmp_path / "t"), ["id"]) == 0
    assert U.read_keyed(spark, str(tmp_path / "t")).count() == 0
    assert U.upsert(spark, spark.range(3), str(tmp_path / "t"), ["id"]) == 1
    assert U.read_keyed(spark, str(tmp_path / "t")).count() == 3
