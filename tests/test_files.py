import datetime as dt

import pytest
from pyspark.sql import functions as F

from wiremap.sources.files import add_file_provenance, file_date_sent, file_hostname


def _parse(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    c = F.col("file_name")
    return {r[0]: (r[1], r[2]) for r in
            df.select("file_name", file_hostname(c), file_date_sent(c)).collect()}


def test_good_name(spark):
    out = _parse(spark, ["my.long-host-20240229000000.parquet"])
    assert out["my.long-host-20240229000000.parquet"] == ("my.long-host", dt.date(2024, 2, 29))


def test_bad_names_give_null_dates(spark):
    out = _parse(spark, ["x.parquet", "h-2024010112345Z.parquet"])
    assert out["x.parquet"] == ("", None)
    assert out["h-2024010112345Z.parquet"][1] is None


def test_bad_name_error_option(spark):
    df = spark.createDataFrame([("x.parquet",)], "file_name string")
    out = add_file_provenance(df, name=F.col("file_name"), size=F.lit(1),
                              on_bad_name="error")
    with pytest.raises(Exception):
        out.collect()


def test_provenance_columns(spark):
    df = spark.createDataFrame([("m1-20240101000000.parquet",)], "file_name string")
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5)
    r = add_file_provenance(df, name=F.col("file_name"), size=F.lit(7).cast("bigint"),
                            inserted_at=F.lit(stamp)).collect()[0]
    assert (r.hostname, r.date_sent, r.file_size) == ("m1", dt.date(2024, 1, 1), 7)
    assert r.dtk_inserted_at == stamp


def test_capture_files_of_hosts_that_folders_escape(spark, tmp_path):
    import pytest
    from wiremap.sources.landing import write_capture_files
    rows = [("a=1%", 1, "2024-01-01 00:00:00"), ("plain", 2, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "hostname string, x int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    names = write_capture_files(spark, df, str(tmp_path / "land"))
    assert len(names) == 2 and spark.read.parquet(str(tmp_path / "land")).count() == 2
    with pytest.raises(ValueError):
        write_capture_files(spark, df.withColumn("hostname", F.lit("b:1")), str(tmp_path / "land2"))


def test_one_capture_file_for_each_host_however_many_tasks_read(spark, tmp_path):
    from wiremap.sources.landing import by_host, write_capture_files
    rows = [(f"m{i % 5}", i // 10, "2024-01-01 00:00:00") for i in range(60)]
    df = spark.createDataFrame(rows, "hostname string, x int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    names = write_capture_files(spark, df.repartition(6), str(tmp_path / "land"))
    assert sorted(names) == [f"m{h}-20240101000000.parquet" for h in range(5)]
    assert spark.read.parquet(str(tmp_path / "land")).count() == 60
    # a large host is dealt to several tasks, equal rows to one
    dealt = by_host(df, "hostname", {"m0": 12, "m1": 2, "m2": 2, "m3": 2, "m4": 2}, rows_a_file=2)
    tasks = dealt.withColumn("task", F.spark_partition_id()).groupBy("hostname").agg(F.countDistinct("task").alias("n"))
    found = {r[0]: r[1] for r in tasks.collect()}
    assert found["m0"] > 1 and all(found[f"m{h}"] == 1 for h in range(1, 5))
    assert dealt.withColumn("task", F.spark_partition_id()).groupBy("hostname", "x").agg(
        F.countDistinct("task").alias("n")).filter("n > 1").count() == 0


def test_capture_files_of_a_large_host_and_of_a_second_landing(spark, tmp_path, monkeypatch):
    """A host's files are a second apart, taken names are passed over, and no row or type is lost."""
    from wiremap.sources import landing
    monkeypatch.setattr(landing, "ROWS_A_FILE", 10)
    rows = [("m0", i, "2024-01-01 00:00:07", None) for i in range(25)] + [("m1", i, None, (1, [i])) for i in range(3)]
    df = spark.createDataFrame(rows, "hostname string, x int, ts string, s struct<a:int,b:array<int>>").withColumns(
        {"ts": F.col("ts").cast("timestamp"), "d": F.lit("1.5").cast("decimal(20,3)"), "y": F.expr("interval 1 day")})
    path = str(tmp_path / "land")
    names = landing.write_capture_files(spark, df, path)
    assert "m1-19700101000000.parquet" in names
    assert {n for n in names if n.startswith("m0")} <= {f"m0-2024010100000{s}.parquet" for s in (7, 8, 9)}
    assert len(landing.write_capture_files(spark, df.filter("hostname = 'm1'"), path)) == 1
    found = spark.read.parquet(path).withColumn("name", F.col("_metadata.file_name"))
    assert found.filter("name = 'm1-19700101000001.parquet'").count() == 3
    first = found.filter("name <> 'm1-19700101000001.parquet'")
    assert sorted(map(repr, first.select("x", "ts", "s", "d", "y").collect())) == sorted(
        map(repr, df.select("x", "ts", "s", "d", "y").collect()))
    assert found.drop("name").schema.simpleString() == df.drop("hostname").schema.simpleString()


def test_capture_files_are_not_handed_through_the_driver(spark, tmp_path, monkeypatch):
    """No listing and no rename a file: a landing of many hosts is one rename of its folder."""
    from wiremap import fs
    from wiremap.sources import landing

    def never(*_args):
        raise AssertionError("renamed file by file")

    monkeypatch.setattr(fs, "rename_all", never)
    df = spark.range(40).select(F.concat(F.lit("m"), F.col("id") % 20).alias("hostname"), "id",
                                F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    assert len(landing.write_capture_files(spark, df, str(tmp_path / "land"))) == 20
    assert spark.read.parquet(str(tmp_path / "land")).count() == 40
    assert sorted(p.name for p in tmp_path.iterdir()) == ["land"]
