"""Files that gain columns and wider types; bronze across checkpoints; one stream for all tables."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from wiremap.operators.upsert import read_keyed, upsert
from wiremap.sources.evolving import TypeConflict, files_schema, list_files, read_files, widen, widen_type
from wiremap.sources.landing import write_capture_files
from wiremap.streaming.bronze import read_bronze, start_bronze, write_bronze
from wiremap.streaming.pipeline import start_ingest, start_ingest_all, start_silver_all

from conftest import rows

NOW = dt.datetime(2024, 1, 1)


def land(spark, path, sql, host="box", at=NOW):
    """One capture file of ``host`` with the rows of a statement."""
    df = spark.sql(sql).selectExpr("*", f"'{host}' hostname", f"timestamp'{at}' ts")
    write_capture_files(spark, df.coalesce(1), path)


def ingest(spark, raw, base, checkpoint="chk"):
    start_bronze(spark, raw, f"{base}/bronze", f"{base}/{checkpoint}").awaitTermination()
    return read_bronze(spark, f"{base}/bronze")


def test_stream_started_on_an_empty_folder(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    assert ingest(spark, raw, tmp_path).count() == 0
    land(spark, raw, "select 'a' name, 1.5D duration")
    assert rows(ingest(spark, raw, tmp_path), "name", "duration") == [("a", 1.5)]


def test_columns_fields_and_wider_types_come_late(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    land(spark, raw, "select 'a' name, 1 n, named_struct('x', 1) s, array(1) v")
    ingest(spark, raw, tmp_path)
    land(spark, raw, "select 'b' name, 5000000000 n, named_struct('x', 2L, 'y', 'q') s, array(7L) v, 2.5D duration")
    land(spark, raw, "select 'c' name, named_struct('y', 'r') s", host="other")
    out = ingest(spark, raw, tmp_path)
    assert rows(out.selectExpr("name", "n", "s.x", "s.y", "v[0] v", "duration", "hostname")) == [
        ("a", 1, 1, None, 1, None, "box"), ("b", 5000000000, 2, "q", 7, 2.5, "box"),
        ("c", None, None, "r", None, None, "other")]


def test_a_new_checkpoint_adds_and_overwrites_nothing(spark, tmp_path):
    """File 1 is ingested and archived; file 2 comes under a new checkpoint."""
    land(spark, f"{tmp_path}/one", "select 1 a")
    ingest(spark, f"{tmp_path}/one", tmp_path, "chk1")
    land(spark, f"{tmp_path}/two", "select 2 a")
    assert rows(ingest(spark, f"{tmp_path}/two", tmp_path, "chk2"), "a") == [(1,), (2,)]


def test_a_replayed_batch_keeps_its_files(spark, tmp_path):
    df = spark.range(3).selectExpr("id a")
    write_bronze(df, f"{tmp_path}/b", "q", 0)
    before = list_files(spark, f"{tmp_path}/b")
    write_bronze(df, f"{tmp_path}/b", "q", 0)
    assert list_files(spark, f"{tmp_path}/b") == before and len(before) > 0


def test_types_that_hold_each_other():
    dec = T.DecimalType
    for a, b, want in ((T.ByteType(), T.LongType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
                       (dec(4, 2), dec(6, 1), dec(7, 2)), (T.NullType(), T.StringType(), T.StringType()),
                       (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType())):
        assert widen_type(a, b) == widen_type(b, a) == want
    for a, b in ((T.LongType(), T.DoubleType()), (T.StringType(), T.LongType()), (dec(38, 0), dec(38, 30)),
                 (T.LongType(), T.StructType())):
        with pytest.raises(TypeConflict, match="c"):
            widen_type(a, b, "c")
    old = T.StructType().add("Key", T.IntegerType())
    new = T.StructType().add("key", T.LongType()).add("x", T.StringType())
    assert widen(old, new).simpleString() == "struct<Key:bigint,x:string>"


def test_a_type_conflict_stops_the_batch(spark, tmp_path):
    land(spark, f"{tmp_path}/raw", "select 1 a")
    land(spark, f"{tmp_path}/raw", "select 'x' a", host="other")
    with pytest.raises(TypeConflict):
        files_schema(spark, list_files(spark, f"{tmp_path}/raw"))
    assert list_files(spark, f"{tmp_path}/nowhere") == []


def test_names_with_glob_characters(spark, tmp_path):
    land(spark, f"{tmp_path}/raw", "select 1 a", host="b[o]x*{1}")
    # Spark's file metadata holds names as they stand in a URI.
    assert rows(ingest(spark, f"{tmp_path}/raw", tmp_path), "a", "hostname") == [(1, "b%5Bo%5Dx*%7B1%7D")]


ADDR = "named_struct('address', '10.0.0.1', 'mask', 24)"


def test_late_columns_through_silver(spark, tmp_path):
    """The address gains a field, the facts a column; the running silver jobs keep both."""
    root = str(tmp_path)
    tables = ["dim_network_host", "dim_network_foreign_ip"]

    def run():
        for start in (start_ingest, start_silver_all):
            for q in start(spark, root, tables).values():
                q.awaitTermination()

    run()
    land(spark, f"{root}/raw/dim_network_host", f"select 1L _id, {ADDR} address, 'alpha' host")
    land(spark, f"{root}/raw/dim_network_foreign_ip",
         f"select 7 _id, {ADDR} address, timestamp'2024-01-01' inserted_at")
    run()
    wide = "named_struct('address', '10.0.0.1', 'mask', 24, 'zone', {})"
    land(spark, f"{root}/raw/dim_network_foreign_ip", "select _id, address, timestamp'2024-01-02' inserted_at, "
         f"'new' note from values (8L, {wide.format('cast(null as string)')}), (7L, {wide.format(repr('z'))}) t(_id, address)")
    run()
    out = read_keyed(spark, f"{root}/silver/dim_network_foreign_ip")
    assert rows(out.selectExpr("_id", "address.zone", "host", "note")) == [
        (7, "z", None, "new"), (8, None, "alpha", "new")]


def test_one_stream_for_all_tables(spark, tmp_path):
    one, many = f"{tmp_path}/one", f"{tmp_path}/many"
    for root in (one, many):
        land(spark, f"{root}/raw/tech_chrono", "select 'a' name, 1 n")
        land(spark, f"{root}/raw/file_user", "select 'u' name, 5L uid")
    start_ingest_all(spark, one).awaitTermination()
    for root in (one, many):
        land(spark, f"{root}/raw/tech_chrono", "select 'b' name, 2L n, 'late' note", at=NOW + dt.timedelta(days=1))
    start_ingest_all(spark, one).awaitTermination()
    for q in start_ingest(spark, many, ["tech_chrono", "file_user"]).values():
        q.awaitTermination()
    for table, cols in (("tech_chrono", ("name", "n", "note", "hostname")), ("file_user", ("name", "uid", "hostname"))):
        got, want = (read_bronze(spark, f"{root}/bronze/{table}") for root in (one, many))
        assert got.schema["name"] == want.schema["name"] and rows(got, *cols) == rows(want, *cols) != []
    land(spark, f"{one}/raw/unheard_of", "select 1 a")
    with pytest.raises(Exception, match="folder of no table"):
        start_ingest_all(spark, one).awaitTermination()


def test_upsert_widens_keys_and_fields(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(spark, spark.sql("select id k, cast(id as int) v, named_struct('x', 1) s from (select cast(id as int) id from range(20))"),
           path, ["k"])
    upsert(spark, spark.sql("select id k, id + 100 v, named_struct('x', 2, 'y', 3) s from range(10, 30)"), path, ["k"])
    out = rows(read_keyed(spark, path).selectExpr("k", "v", "s.x", "s.y"))
    assert sorted(out, key=lambda r: r[0]) == [(i, i, 1, None) if i < 10 else (i, i + 100, 2, 3) for i in range(30)]


def test_read_files_adds_needed_columns(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t")
    out = read_files(spark, list_files(spark, f"{tmp_path}/t"), T.StructType().add("id", T.LongType()).add("host", T.StringType()))
    assert rows(out) == [(0, None), (1, None)]
