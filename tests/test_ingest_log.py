"""Ingest logs: a look-back opens its hours only and finds what the keyed table holds."""

import datetime as dt

from pyspark.sql import functions as F

from wiremap.operators.recent import recent
from wiremap.operators.upsert import read_keyed
from wiremap.spec import TableSpec
from wiremap.streaming.ingest_log import HOUR, append_log, read_window, window_hours
from wiremap.streaming.silver import silver_writer

from conftest import rows

NOON = dt.datetime(2024, 1, 1, 12)
SPEC = TableSpec("t", "t", ("k",))


def arrivals(spark, first, n, step=60):
    """n rows, one every ``step`` seconds from ``first`` on; five keys; source clocks run backwards."""
    return spark.range(n).select(
        (F.col("id") % 5).alias("k"), F.col("id").alias("v"),
        F.timestamp_seconds(F.lit(int(first.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("id") * step
                            ).alias("dtk_inserted_at"),
        F.timestamp_seconds(F.lit(10_000) - F.col("id")).alias("inserted_at"))


def test_hours_of_a_window():
    h = int(NOON.replace(tzinfo=dt.timezone.utc).timestamp()) // 3600
    assert window_hours(10, NOON) == [h - 1, h]
    assert window_hours(10, NOON + dt.timedelta(minutes=30)) == [h]
    # A second counts to the window's first whole second.
    assert window_hours(10, NOON + dt.timedelta(seconds=599)) == [h]
    assert window_hours(10, NOON + dt.timedelta(seconds=598)) == [h - 1, h]
    east = dt.timezone(dt.timedelta(hours=2))
    assert window_hours(10, (NOON + dt.timedelta(hours=2)).replace(tzinfo=east)) == [h - 1, h]


def test_only_the_windows_folders_are_opened(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(arrivals(spark, NOON - dt.timedelta(hours=30), 60 * 31), path, "q-0")
    got = read_window(spark, path, 10, NOON + dt.timedelta(minutes=5), ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"{HOUR}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(dtk_inserted_at)" in plan and "GreaterThanOrEqual(dtk_inserted_at" in plan
    opened = {f.split(f"{HOUR}=")[1].split("/")[0] for f in got.inputFiles()}
    assert opened == {str(h) for h in window_hours(10, NOON + dt.timedelta(minutes=5))}
    # 30 hours and n minutes in: the last ten minutes, the last row of each key.
    assert rows(got, "k", "v") == sorted(((1800 + i) % 5, 1800 + i) for i in range(1, 6))


def test_a_window_that_ends_now_is_the_look_back_on_the_keyed_table(spark, tmp_path):
    write = silver_writer(spark, SPEC, f"{tmp_path}/keyed", log_path=f"{tmp_path}/log")
    batches = [arrivals(spark, NOON, 7, 60), arrivals(spark, NOON + dt.timedelta(minutes=7), 4, 30),
               arrivals(spark, NOON + dt.timedelta(minutes=55), 3, 200)]
    for n, batch in enumerate(batches):
        write(batch, n)
        now = batch.agg(F.max("dtk_inserted_at")).first()[0]
        want = recent(read_keyed(spark, f"{tmp_path}/keyed"), 10, as_of=now)
        got = read_window(spark, f"{tmp_path}/log", 10, now, SPEC.keys, "inserted_at")
        assert rows(got, "k", "v") == rows(want, "k", "v") != []


def test_replays_late_columns_and_missing_times(spark, tmp_path):
    path = str(tmp_path / "log")
    first = arrivals(spark, NOON, 3)
    for _ in range(2):
        append_log(first, path, "q-0")
    append_log(arrivals(spark, NOON, 2).withColumn("note", F.lit("late")).withColumn("k", F.col("k") + 10), path, "q-1")
    append_log(first.withColumn("dtk_inserted_at", F.lit(None).cast("timestamp")), path, "q-2")
    got = read_window(spark, path, 10, NOON + dt.timedelta(minutes=5), ["k"])
    assert rows(got, "k", "note") == [(0, None), (1, None), (10, "late"), (11, "late"), (2, None)]
    empty = read_window(spark, path, 10, NOON + dt.timedelta(days=1), ["k"])
    assert empty.count() == 0 and set(empty.columns) == {"k", "v", "note", "dtk_inserted_at", "inserted_at"}
