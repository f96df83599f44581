"""Append log of a silver table, laid out by ingest hour, for refreshes over a short look-back.

A keyed table spreads recent rows over all of its buckets, so a look-back on
the ingest clock has to open every bucket.  The log holds the same rows as they
arrive, below ``ingest_hour=<hours since 1970>/batch=<query>-<number>``.  A
window names the folders of its hours (two for ten minutes), reads no other, and
keeps the last arrival of each key.  For a window that ends now this is what the
look-back finds in the keyed table: a key's stored row is its last arrival.

A replayed batch replaces its own folders.  Folders of hours that no look-back
reaches any more can be deleted at any time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wiremap import fs
from wiremap.operators.latest import latest_by_key
from wiremap.operators.recent import recent
from wiremap.sources.evolving import files_schema, list_files

HOUR, BATCH = "ingest_hour", "batch"
CLOCK = "dtk_inserted_at"


def hour_of(clock: str = CLOCK) -> F.Column:
    """Whole hours since 1970; no time zone takes part."""
    return F.floor(F.unix_seconds(F.col(clock).cast("timestamp")) / 3600).cast("int")


def append_log(df: DataFrame, path: str, batch: str, clock: str = CLOCK) -> None:
    """Write the rows of one batch; rows without an ingest time are in no window and stay out."""
    rows = df.filter(F.col(clock).isNotNull()).withColumns({HOUR: hour_of(clock), BATCH: F.lit(batch)})
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(HOUR, BATCH).parquet(path))


def _utc(moment: dt.datetime) -> dt.datetime:
    """Naive times count as UTC, as in the session."""
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def window_hours(minutes: int, as_of: dt.datetime) -> list[int]:
    """The hours that a look-back touches."""
    end = int(_utc(as_of).timestamp())
    return list(range((end - minutes * 60 + 1) // 3600, end // 3600 + 1))


def read_window(spark: SparkSession, path: str, minutes: int, as_of: dt.datetime, keys: Sequence[str],
                order_by: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The last arrival of each key among the rows of the last ``minutes`` before ``as_of``.

    Only the window's hour folders are listed and opened.  Without any, the
    result is empty and has the columns of ``schema``.
    """
    folders = [f"{path}/{HOUR}={h}" for h in window_hours(minutes, as_of)]
    folders = [f for f in folders if fs.exists(spark, f)]
    if not folders:
        if schema is None:
            schema = files_schema(spark, list_files(spark, path))
        return spark.createDataFrame([], schema)
    found = files_schema(spark, [f for folder in folders for f in list_files(spark, folder)])
    found = T.StructType([*found.fields, T.StructField(HOUR, T.IntegerType()), T.StructField(BATCH, T.StringType())])
    rows = spark.read.schema(found).option("basePath", path).parquet(*folders)
    hours = window_hours(minutes, as_of)
    rows = recent(rows.filter(F.col(HOUR).between(hours[0], hours[-1])), minutes, CLOCK, as_of)
    end = F.lit(_utc(as_of)).cast(rows.schema[CLOCK].dataType)
    rows = rows.filter(F.col(CLOCK) <= end).drop(HOUR, BATCH)
    return latest_by_key(rows, keys, CLOCK) if order_by is None else _last_arrival(rows, keys, order_by)


def _last_arrival(rows: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Later batches replace earlier ones; within a batch the source clock decides."""
    clock = F.struct(F.col(CLOCK).alias("a"), F.col(order_by).alias("b"))
    return latest_by_key(rows.withColumn("__clock", clock), keys, "__clock").drop("__clock")
