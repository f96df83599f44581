"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremap.session import scratch_path

BYTE_LIMIT = 8 << 20
SIEVE_BITS = 1 << 24


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (null: empty) of ``docs``.

    Every operator starts from this projection, so further columns, also such
    with the names of its own columns, never reach its plans.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it back.

    A written table cuts the lineage and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sieve(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Fewer ``rows`` before a join on ``key`` (long); none is lost whose key is in ``wanted``.

    A row passes if the bit of its key's hash is set in a bitmap of ``SIEVE_BITS`` bits (2 MB,
    whatever the size of the tables), so most rows that the join would drop are never shuffled.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)) + 1
    bucket, place = F.bitmap_bucket_number(F.col("__slot")), F.bitmap_bit_position(F.col("__slot"))
    # Dealt by bucket first: partial bitmaps of each task would be much more than the keys.
    bits = wanted.select(slot.alias("__slot")).repartition(bucket.alias("__bucket")).groupBy(
        bucket.alias("__bucket")).agg(F.bitmap_construct_agg(place).alias("__bits"))
    found = rows.withColumn("__slot", slot).withColumn("__bucket", bucket).join(F.broadcast(bits), "__bucket")
    octet = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(octet, (place % 8).cast("int")) == 1).select(*rows.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key() -> Column:
    """A 128-bit digest of column ``text``, as a struct of two longs."""
    return F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str,
             limit: int = BYTE_LIMIT) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of ``column``.

    A slice holds at least one row, so a very long text is a slice of its own.
    """
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield b.slice(start)


def hash_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``key``.

    A filter on the hash lets about twice as many rows through to the sort, so
    what tasks hand on doesn't grow with their number.
    """
    total, top = rows.count(), 1 << 40
    if total > 2 * size:
        rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(top)) < int(2 * size / total * top))
    return rows.orderBy(F.pmod(F.xxhash64(key), F.lit(top)), key).limit(size)
