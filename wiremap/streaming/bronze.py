"""Raw capture files -> bronze, as a Structured Streaming job.

Each micro-batch gets the provenance columns (file name and size, host name
and send date parsed from the name, ingest time), is de-duplicated, and is
written to ``<bronze>/batch=<query id>-<number>/``.  Within one micro-batch
every raw file is read whole and ``dtk_inserted_at`` is one value, so the
pipeline's full-row ``distinct`` can only ever remove copies inside one file of
one batch; doing it per batch gives the same rows without streaming state that
grows forever.

The query id belongs to the checkpoint: a new checkpoint counts from 0 again,
in folders of its own, and touches nothing that an older one wrote.  A replayed
batch that had been written whole is left as it is, so that the silver jobs
don't meet its rows again under new file names; half a batch is overwritten.

By default a micro-batch is read under the merged schema of its own files
(``wiremap.sources.evolving``): columns that come late are kept.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wiremap import fs
from wiremap.sources.evolving import list_files, new_files, read_files, start_files
from wiremap.sources.files import add_file_provenance, raw_stream

BATCH_DIR = "batch="
#: Rows of so few bytes of files are one task's work; dealing them out would take longer than comparing them.
SMALL_BATCH = 8 << 20


def query_id(spark: SparkSession, checkpoint: str) -> Callable[[], str]:
    """The id of the query that owns a checkpoint (once it runs); a new checkpoint has a new one."""
    return lambda: json.loads(fs.read_text(spark, f"{checkpoint}/metadata"))["id"]


def distinct_rows(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch without copies; those of a small one meet in one task."""
    if int(batch._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= SMALL_BATCH:
        batch = batch.coalesce(batch.sparkSession.sparkContext.defaultParallelism).repartition(1)
    return batch.dropDuplicates()


def write_bronze(batch: DataFrame, bronze_path: str, query: str, batch_id: int, distinct: bool = True) -> None:
    """Append one micro-batch of one query; a batch that is there already is left as it is."""
    folder = f"{bronze_path}/{BATCH_DIR}{query}-{batch_id}"
    if fs.exists(batch.sparkSession, f"{folder}/_SUCCESS"):
        return
    out = distinct_rows(batch) if distinct else batch
    out.write.mode("overwrite").parquet(folder)


def ingest_files(spark: SparkSession, paths: list[str], bronze_path: str, query: str, batch_id: int,
                 inserted_at: Column | None = None, distinct: bool = True, on_bad_name: str = "null") -> None:
    """Append raw files to a bronze table, with every column that they hold."""
    raw = add_file_provenance(read_files(spark, paths), inserted_at=inserted_at, on_bad_name=on_bad_name)
    write_bronze(raw, bronze_path, query, batch_id, distinct)


def start_bronze(spark: SparkSession, raw_path: str, bronze_path: str, checkpoint: str, *,
                 schema: T.StructType | None = None, max_files_per_trigger: int | None = None,
                 inserted_at: Column | None = None, available_now: bool = True,
                 processing_time: str | None = None, distinct: bool = True,
                 dedupe_keys: list[str] | None = None,
                 watermark: tuple[str, str] | None = None,
                 on_bad_name: str = "null") -> StreamingQuery:
    """Start the raw -> bronze stream of one table.

    Without a ``schema`` every micro-batch has the schema of its own files, and
    the folder may still be empty; with one, only its columns are read.
    ``dedupe_keys`` (which needs a schema, or files to take one from) with ``watermark=(event time column, delay)`` switches from
    the per-batch full-row distinct to ``dropDuplicatesWithinWatermark`` on
    business keys: copies of a key arriving in different files or batches
    within the delay are dropped too, with state bounded by the watermark.
    """
    query = query_id(spark, checkpoint)
    if schema is None and not dedupe_keys:
        return start_files(
            new_files(spark, raw_path, max_files_per_trigger),
            lambda own, paths, n: ingest_files(own, paths, bronze_path, query(), n, inserted_at, distinct, on_bad_name),
            checkpoint, available_now=available_now, processing_time=processing_time)
    stream = add_file_provenance(raw_stream(spark, raw_path, schema, max_files_per_trigger),
                                 inserted_at=inserted_at, on_bad_name=on_bad_name)
    if dedupe_keys:
        if not watermark:
            raise ValueError("dedupe_keys needs watermark=(event time column, delay)")
        stream = (stream.withWatermark(*watermark)
                  .dropDuplicatesWithinWatermark(list(dedupe_keys)))
        distinct = False
    def run(batch: DataFrame, batch_id: int) -> None:
        write_bronze(batch, bronze_path, query(), batch_id, distinct)

    writer = (stream.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def bronze_schema(raw_schema: T.StructType) -> T.StructType:
    extra = [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("date_sent", T.DateType()),
        T.StructField("dtk_inserted_at", T.TimestampType()),
    ]
    names = {f.name for f in extra}
    return T.StructType([f for f in raw_schema.fields if f.name not in names] + extra)


def bronze_stream(spark: SparkSession, bronze_path: str, schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The bronze table as a stream (input of the silver jobs)."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(f"{bronze_path}/{BATCH_DIR}*")


def read_bronze(spark: SparkSession, bronze_path: str, needed: T.StructType | None = None) -> DataFrame:
    """The whole bronze table under the merged schema of all its batches.

    Columns of ``needed`` that no batch holds are null; a table without files is empty.
    """
    files = list_files(spark, bronze_path)
    if files:
        return read_files(spark, files, needed)
    return spark.createDataFrame([], bronze_schema(needed or T.StructType([])))
