"""Every column that raw files hold reaches bronze and silver."""

import datetime as dt

from wiremap.operators.upsert import read_keyed
from wiremap.streaming.bronze import read_bronze
from wiremap.streaming.pipeline import start_ingest, start_silver_all


def test_extra_columns_reach_silver(spark, tmp_path):
    root = str(tmp_path)
    now = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([("step", 1.5, now)], "name string, duration double, inserted_at timestamp")
    raw.coalesce(1).write.parquet(f"{root}/stage")
    import pathlib
    source = next(pathlib.Path(root, "stage").glob("part-*.parquet"))
    target = pathlib.Path(root, "raw", "tech_chrono", "box-20240101000000.parquet")
    target.parent.mkdir(parents=True)
    target.write_bytes(source.read_bytes())
    for q in start_ingest(spark, root, ["tech_chrono"]).values():
        q.awaitTermination()
    assert read_bronze(spark, f"{root}/bronze/tech_chrono").first()["duration"] == 1.5
    for q in start_silver_all(spark, root, ["tech_chrono"]).values():
        q.awaitTermination()
    row = read_keyed(spark, f"{root}/silver/fact_tech_chrono").first()
    assert row["duration"] == 1.5 and row["hostname"] == "box"
