"""Write DataFrames as capture files: ``<hostname>-<yyyyMMddHHmmss>.parquet``.

Stands in for the capture agents in tests and fixtures.  The hosts are dealt
over all cores and a host gets one file (a large one several) however many
tasks read the input.  Spark's writer takes some ten milliseconds a file and
hands one folder a host back to the driver, so each task writes its files
itself (``pyarrow.fs``), under their final names: the host's first timestamp,
one second more for each further file.  They lie in a staging folder until all are
there.  Only file names and what is known of large hosts pass through the
driver, never rows.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Collection, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wiremap import fs
from wiremap.sources.files import NAME_TAIL

#: A host with more rows gets several files, in several tasks.
ROWS_A_FILE = 1_000_000
#: A task holds so many bytes of a file's rows before it writes them as a row group.
GROUP_BYTES = 32 << 20
PART = "__part"


def _files(rows: dict[str, int], rows_a_file: int) -> dict[str, int]:
    return {h: -(-n // rows_a_file) for h, n in rows.items()}


def _part(df: DataFrame, host_col: str, files: dict[str, int]) -> Column | None:
    """Number of a row's file within its host; None where each host has one file."""
    large = {h: n for h, n in files.items() if n > 1}
    if not large:
        return None
    of = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
    return F.pmod(F.xxhash64(*df.columns), F.coalesce(of[F.col(host_col)], F.lit(1)))


def by_host(df: DataFrame, host_col: str, rows: dict[str, int], rows_a_file: int = ROWS_A_FILE,
            hosts: int = 0) -> DataFrame:
    """Rows dealt by host; equal rows stay together, also those of a host with several files.

    ``rows`` has the row count of every large host at least; ``hosts`` counts all of them.
    """
    files = _files(rows, rows_a_file)
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    part = _part(df, host_col, files)
    keys = [F.col(host_col)] if part is None else [F.col(host_col), part]
    number = sum(files.values()) + max(0, hosts - len(files))
    return df.repartition(max(1, min(tasks, number)), *keys)


def _runs(batch: pa.RecordBatch, columns: Collection[str]) -> list[int]:
    """Where a batch's runs of equal values end."""
    ends: set[int] = set()
    for c in columns:
        ends.update(pc.run_end_encode(batch.column(c), run_end_type=pa.int64()).run_ends.to_pylist())
    return sorted(ends)


def free_names(host: str, first: dt.datetime | dt.date | None, number: int, taken: Collection[str]) -> str:
    """The name of a host's file ``number``: one file per stamp, a second further while a name is taken."""
    stamp = first or dt.datetime(1970, 1, 1)
    if not isinstance(stamp, dt.datetime):
        stamp = dt.datetime.combine(stamp, dt.time())
    stamp = stamp.replace(tzinfo=None)
    while True:
        name = f"{host}-{stamp:%Y%m%d%H%M%S}.parquet"
        if name not in taken:
            if number == 0:
                return name
            number -= 1
        stamp += dt.timedelta(seconds=1)


class _File:
    """One capture file while a task writes it; it gets its name when its first timestamp is known."""

    def __init__(self, store, root: str, kept: list[str], meta: dict):
        self.store, self.root, self.kept, self.meta = store, root, kept, meta
        self.part = f"{root}/.{uuid.uuid4().hex}.tmp"
        self.held: list[pa.RecordBatch] = []
        self.bytes = 0
        self.first = None
        self.writer: pq.ParquetWriter | None = None

    def add(self, rows: pa.RecordBatch, stamp_col: str) -> None:
        if (first := pc.min(rows.column(stamp_col)).as_py()) is not None:
            self.first = first if self.first is None else min(self.first, first)
        self.held.append(rows)
        self.bytes += rows.nbytes
        if self.bytes >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        table = pa.Table.from_batches(self.held).select(self.kept)
        if self.writer is None:
            self.writer = pq.ParquetWriter(self.part, table.schema, filesystem=self.store, store_schema=False)
            self.writer.add_key_value_metadata(self.meta)
        self.writer.write_table(table)
        self.held, self.bytes = [], 0

    def close(self, name: str) -> None:
        if self.held:
            self.flush()
        self.writer.close()
        self.store.move(self.part, f"{self.root}/{name}")


def _stage(df: DataFrame, staging: str, host_col: str, stamp_col: str, large: dict[str, dt.datetime | None],
           taken: Collection[str]) -> DataFrame:
    """Write the files of ``df`` (sorted by host and part in each task) below ``staging``; their names as rows."""
    uri = fs.uri(df.sparkSession, staging)
    kept = [c for c in df.columns if c not in (host_col, PART)]
    # what Spark's own writer notes, so that readers find the exact types
    meta = {"org.apache.spark.sql.parquet.row.metadata": T.StructType([df.schema[c] for c in kept]).json(),
            "org.apache.spark.version": df.sparkSession.version}
    whose = [c for c in (host_col, PART) if c in df.columns]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(uri)
        at, file, names = None, None, []

        def close() -> None:
            host, number = at[0], at[1] if len(at) > 1 else 0
            name = free_names(host, large.get(host, file.first), number, taken)
            file.close(name)
            names.append(name)

        for batch in batches:
            start = 0
            for end in _runs(batch, whose):
                key = tuple(batch.column(c)[start].as_py() for c in whose)
                if key != at:
                    if file is not None:
                        close()
                    at, file = key, _File(store, root, kept, meta)
                file.add(batch.slice(start, end - start), stamp_col)
                start = end
        if file is not None:
            close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    return df.mapInArrow(write, "name string")


def write_capture_files(spark: SparkSession, df: DataFrame, landing: str,
                        host_col: str = "hostname", stamp_col: str = "ts") -> list[str]:
    landing = landing.rstrip("/")
    staging = f"{landing}_staging_{uuid.uuid4().hex[:8]}"
    host, n = F.col(host_col), F.col("n")
    first = df.groupBy(host_col).agg(F.min(stamp_col).alias("t0"), F.count(F.lit(1)).alias("n"))
    odd = host.isNull() | (host == "") | host.rlike(r"[/:\x00]")
    t0 = F.date_format("t0", "yyyy-MM-dd HH:mm:ss").alias("t0")
    about = first.agg(F.count(F.lit(1)).alias("hosts"), F.first(F.when(odd, F.struct(host.alias("host"))), True).alias("odd"),
                      F.collect_list(F.when(n > ROWS_A_FILE, F.struct(host.alias("host"), "n", t0))).alias("large")).first()
    if about.odd is not None:
        raise ValueError(f"no file can be named after host {about.odd.host!r}")
    rows = {r.host: r.n for r in about.large}
    stamps = {r.host: r.t0 and dt.datetime.fromisoformat(r.t0) for r in about.large}
    dealt = by_host(df, host_col, rows, hosts=about.hosts)
    if (part := _part(df, host_col, _files(rows, ROWS_A_FILE))) is not None:
        dealt = dealt.withColumn(PART, part)
    dealt = dealt.sortWithinPartitions(*[c for c in (host_col, PART) if c in dealt.columns])
    before = fs.list_names(spark, landing)
    fs.mkdirs(spark, staging)
    names = _stage(dealt, staging, host_col, stamp_col, stamps, frozenset(before)).toArrow()["name"].to_pylist()
    if before or not fs.replace_empty(spark, staging, landing):
        fs.rename_all(spark, [(f"{staging}/{name}", f"{landing}/{name}") for name in names])
        fs.delete(spark, staging)
    return sorted(names, key=lambda x: (x[:-NAME_TAIL], x))


def write_capture_files_in_order(spark: SparkSession, batches: list[DataFrame], landing: str,
                                 host_col: str = "hostname", stamp_col: str = "ts") -> None:
    """Write several sets of capture files one after another.

    The file source orders new files by modification time, so each set
    arrives after the previous one.
    """
    for i, df in enumerate(batches):
        if i:
            time.sleep(0.1)   # file sources order by millisecond mtimes
        write_capture_files(spark, df, landing, host_col, stamp_col)
