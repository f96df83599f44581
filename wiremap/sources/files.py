"""Raw capture files: streaming scan and file provenance columns.

A capture file is named ``<hostname><sep><yyyyMMddHHmmss>.parquet``:
one separator character, 14 digits and the 8-character suffix, 23 characters
after the host name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wiremap.session import list_cheaply

# File-name layout of capture files.
NAME_TAIL = 23          # separator + 14 digits + ".parquet"
STAMP_FROM_END = 21     # start of the 14 digits, counted back from the name length
STAMP_LEN = 14
STAMP_FORMAT = "yyyyMMddHHmmss"


def file_hostname(name: Column) -> Column:
    """Host part of a capture file name ('' for names shorter than the tail)."""
    return F.substring(name, F.lit(1), F.greatest(F.length(name) - NAME_TAIL, F.lit(0)))


def file_date_sent(name: Column) -> Column:
    """Date the file was sent, from its 14-digit stamp; null for malformed names."""
    stamp = F.substring(name, F.length(name) - STAMP_FROM_END, F.lit(STAMP_LEN))
    return F.when(F.length(name) >= NAME_TAIL,
                  F.try_to_date(stamp, STAMP_FORMAT))


def add_file_provenance(df: DataFrame, name: Column | None = None, size: Column | None = None,
                        inserted_at: Column | None = None,
                        on_bad_name: str = "null") -> DataFrame:
    """Add ``file_name, file_size, hostname, date_sent, dtk_inserted_at``.

    By default the name and size come from Spark's hidden ``_metadata`` column,
    which file sources expose for batch and streaming scans alike.
    ``inserted_at`` defaults to ``current_timestamp()`` (one value per query
    or micro-batch); pass a literal to make runs reproducible.
    """
    name = F.col("_metadata.file_name") if name is None else name
    size = F.col("_metadata.file_size") if size is None else size
    inserted_at = F.current_timestamp() if inserted_at is None else inserted_at
    date_sent = file_date_sent(name)
    if on_bad_name == "error":
        date_sent = F.when(date_sent.isNull(),
                           F.raise_error(F.concat(F.lit("bad capture file name: "), name))
                           ).otherwise(date_sent)
    elif on_bad_name != "null":
        raise ValueError(f"on_bad_name must be 'null' or 'error', not {on_bad_name!r}")
    return df.withColumns({
        "file_name": name,
        "file_size": size,
        "hostname": file_hostname(name),
        "date_sent": date_sent,
        "dtk_inserted_at": inserted_at,
    })


def raw_stream(spark: SparkSession, path: str, schema: T.StructType | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet folder as an unbounded table.

    An explicit schema is the default; without one the schema is taken from
    the files present when the query starts (parquet footers only).
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    list_cheaply(spark, path)
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
