"""Bronze -> silver: per micro-batch enrichment, latest row per key, upsert.

Window functions are not allowed on a streaming DataFrame, so each silver job
is a ``foreachBatch`` function: the micro-batch is a plain DataFrame there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wiremap.operators.latest import latest_by_key
from wiremap.operators.lookup import host_by_address, lookup_host
from wiremap.operators.upsert import upsert
from wiremap.sources.evolving import files_schema, list_files, new_files, scan, start_files, widen, widen_type
from wiremap.spec import RAW_SCHEMAS, TableSpec
from wiremap.streaming.bronze import query_id
from wiremap.streaming.ingest_log import append_log


def silver_batch(df: DataFrame, spec: TableSpec, hosts: DataFrame | None = None) -> DataFrame:
    """The batch transformation of one silver table (no write)."""
    if spec.distinct_only:
        return df.select(*spec.distinct_only).distinct()
    if spec.lookups:
        if hosts is None:
            raise ValueError(f"{spec.target} needs the host table for its lookups")
        reduced = host_by_address(hosts)
        for address_col, out_col in spec.lookups:
            df = lookup_host(df, hosts, address_col, out_col, reduced=reduced)
    if spec.mask_from:
        df = df.withColumn("mask", F.col(spec.mask_from).getField("mask"))
    return latest_by_key(df, spec.keys, spec.order_by, spec.tie_break)


def silver_writer(spark: SparkSession, spec: TableSpec, target_path: str,
                  hosts_loader=None, newest_wins: bool = False, null_safe: bool = False,
                  writer=None, log_path: str | None = None):
    """``foreachBatch`` function for one silver table.

    With ``log_path`` the batch is also appended to the table's ingest log.

    ``hosts_loader()`` returns the host table as it is now (read per batch,
    like the pipeline).  ``newest_wins`` re-ranks the stored row against the
    incoming one by the clock instead of letting the later batch win.
    ``writer()`` names the streaming query whose batch numbers these are.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        hosts = hosts_loader() if (hosts_loader and spec.lookups) else None
        out = silver_batch(batch_df, spec, hosts)
        name = writer() if writer else "stream"
        if log_path is not None:
            append_log(out, log_path, f"{name}-{batch_id}".replace(":", "-"))
        upsert(spark, out, target_path, list(spec.keys), batch_id=batch_id, writer=name,
               order_by=None if spec.distinct_only else spec.order_by,
               newest_wins=newest_wins and not spec.distinct_only, null_safe=null_safe,
               unique_keys=True, buckets=spec.buckets)   # silver_batch left one row per key
    return run


def query_writer(spark: SparkSession, checkpoint: str):
    """The name under which the query of a checkpoint numbers its batches."""
    own = query_id(spark, checkpoint)
    return lambda: "query:" + own()


class HostFiles:
    """The bronze host table as it is now, by files; each file's footer is read once."""

    def __init__(self, spark: SparkSession, path: str, base: T.StructType):
        self.spark, self.path, self.base = spark, path, base
        self.files: list[str] = []
        self.schema: T.StructType | None = None

    def refresh(self) -> None:
        files = list_files(self.spark, self.path)
        if fresh := sorted(set(files) - set(self.files)):
            self.schema = widen(self.schema, files_schema(self.spark, fresh))
        self.files = files

    def address(self) -> T.DataType:
        return (self.schema or self.base)["address"].dataType

    def frame(self, address: T.DataType) -> DataFrame:
        """(_id, address, host) with addresses of the type ``address``."""
        schema = self.schema or self.base
        schema = T.StructType([T.StructField(c, address if c == "address" else schema[c].dataType)
                               for c in ("_id", "address", "host")])
        return scan(self.spark, self.files, schema) if self.files else self.spark.createDataFrame([], schema)


def with_address(schema: T.StructType, columns: set[str], address: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, address if f.name in columns else f.dataType) for f in schema.fields])


def start_silver_files(spark: SparkSession, bronze_path: str, spec: TableSpec, target_path: str,
                       checkpoint: str, *, host_path: str | None = None, log_path: str | None = None,
                       newest_wins: bool = False,
                       null_safe: bool = False, max_files_per_trigger: int | None = None,
                       available_now: bool = True, processing_time: str | None = None):
    """Silver job over the files of a bronze table: columns that come late reach the keyed table.

    Address structs that gained fields are compared whole: both sides take the
    union of the fields, absent ones are null (and null equals null there).
    """
    hosts = HostFiles(spark, host_path, RAW_SCHEMAS["dim_network_host"]) if spec.lookups else None
    current: dict[str, DataFrame] = {}
    write = silver_writer(spark, spec, target_path, lambda: current["hosts"], newest_wins, null_safe,
                          query_writer(spark, checkpoint), log_path)
    clocks = () if spec.distinct_only else (spec.order_by,)
    used = {*spec.keys, *spec.distinct_only, *clocks, *[a for a, _ in spec.lookups]}

    def run(_own: SparkSession, paths: list[str], batch_id: int) -> None:
        schema = files_schema(spark, paths)
        if lacking := sorted(used - set(schema.names)):
            raise ValueError(f"{bronze_path}: no column {', '.join(lacking)}")
        if hosts is not None:
            hosts.refresh()
            columns = {a for a, _ in spec.lookups}
            address = reduce(widen_type, [schema[a].dataType for a in sorted(columns)], hosts.address())
            schema, current["hosts"] = with_address(schema, columns, address), hosts.frame(address)
        write(scan(spark, paths, schema), batch_id)

    return start_files(new_files(spark, bronze_path, max_files_per_trigger), run, checkpoint,
                       available_now=available_now, processing_time=processing_time)


def start_silver(spark: SparkSession, stream: DataFrame, spec: TableSpec, target_path: str,
                 checkpoint: str, *, hosts_loader=None, newest_wins: bool = False,
                 null_safe: bool = False, available_now: bool = True,
                 processing_time: str | None = None):
    writer = (stream.writeStream.outputMode("update")
              .foreachBatch(silver_writer(spark, spec, target_path, hosts_loader,
                                          newest_wins, null_safe,
                                          query_writer(spark, checkpoint)))
              .option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
