"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case; it is stored as its 128-bit digest (two of a trillion different
lines share one with a probability below 1e-14).  ``counts`` is the exact
table: digest -> number of documents that hold the key.  Keys that reach
``min_docs`` documents are *common*; each shard (a range of digests) keeps its
common keys as a cuckoo filter and as a sorted list.  ``insert`` and ``delete``
add to or take from the counts and then insert into or delete from the filters
exactly the keys that crossed the threshold, so a deletion undoes an insertion.
``clean`` deals the lines' digests to the shards, asks the filter, confirms its
hits in the sorted list, and cuts the lines out of the texts.

Each version of an index is a folder of Parquet tables that is written once.
Hot lines are counted per batch and per task before they are shuffled, and a
shard's lookups are salted over several groups, each with a copy of the
shard's bounded filter.  Defined cases: null and empty texts are one empty
line; empty keys are never dropped; every row is a document of its own, also
one with a null or repeated id; rows with equal id and text get equal results;
deleting documents that were never inserted raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wiremap.llm.common import by_bytes, id_text, shuffle_partitions
from wiremap.session import scratch_path

SPACE = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 16_384
COUNTS = "key binary, was long, now long"
FILTERS = "shard int, cuckoo binary, keys binary"
CLEANED = T.StructType([T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("n_dropped", T.LongType())])


def line_keys(text: str | None) -> list[bytes | None]:
    """The digest of each line's key; None for an empty key."""
    digest = xxhash.xxh3_128_digest
    return [digest(k.lower()) if (k := line.strip(SPACE)) else None
            for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


class Cuckoo:
    """Cuckoo filter of 16-byte digests: buckets of four 16-bit fingerprints.

    The fingerprint and the first bucket come from the digest; the second
    bucket is the first one xor a hash of the fingerprint, so an entry can be
    moved or deleted without its key.
    """

    SLOTS = 4

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, keys: np.ndarray) -> "Cuckoo":
        """A filter for these keys (rows of two uint64), grown until they fit."""
        buckets = 1 << max(4, int(len(keys) / cls.SLOTS / 0.8).bit_length())
        while True:
            out = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if all(out.insert(a, b) for a, b in keys.tolist()):
                return out
            buckets *= 2

    @classmethod
    def read(cls, data: bytes) -> "Cuckoo":
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def bytes(self) -> bytes:
        return self.table.tobytes()

    def _other(self, i: int, fp: int) -> int:
        return (i ^ (fp * 0x5BD1E995)) & (len(self.table) - 1)

    def _start(self, a: int, b: int) -> tuple[int, int]:
        return (b & 0xFFFF) or 1, (a >> 8) & (len(self.table) - 1)

    def insert(self, a: int, b: int) -> bool:
        fp, i = self._start(a, b)
        for i in (self._other(i, fp), i):
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = fp
                return True
        for kick in range(500):
            slot = kick % self.SLOTS
            fp, self.table[i, slot] = int(self.table[i, slot]), fp
            i = self._other(i, fp)
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = fp
                return True
        return False

    def delete(self, a: int, b: int) -> bool:
        fp, i = self._start(a, b)
        for i in (i, self._other(i, fp)):
            at = np.flatnonzero(self.table[i] == fp)
            if len(at):
                self.table[i, at[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.table) - 1)
        fp = keys[:, 1] & np.uint64(0xFFFF)
        fp[fp == 0] = 1
        i = (keys[:, 0] >> np.uint64(8)) & mask
        j = (i ^ (fp * np.uint64(0x5BD1E995))) & mask
        fp = fp.astype(np.uint16)[:, None]
        return (self.table[i] == fp).any(1) | (self.table[j] == fp).any(1)


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _shard(key: F.Column, shards: int) -> F.Column:
    return F.conv(F.hex(F.substring(key, 1, 3)), 16, 10).cast("int") % shards


def update_shard(old: list[tuple[bytes, bytes]], keys: list[bytes],
                 common: list[bool]) -> tuple[bytes, bytes]:
    """Apply crossings (digest, now common) to one shard's filter and sorted keys."""
    cuckoo, known = (Cuckoo.read(old[0][0]), old[0][1]) if old else (Cuckoo.of(_pairs([])), b"")
    have = {known[i:i + 16] for i in range(0, len(known), 16)}
    gone = [k for k, c in zip(keys, common) if not c and k in have]
    new = [k for k, c in zip(keys, common) if c and k not in have]
    have = have.difference(gone).union(new)
    fits = all(cuckoo.delete(a, b) for a, b in _pairs(gone).tolist())
    if not (fits and all(cuckoo.insert(a, b) for a, b in _pairs(new).tolist())):
        cuckoo = Cuckoo.of(_pairs(sorted(have)))
    return cuckoo.bytes(), b"".join(sorted(have))


class LineIndex:
    """One written version of the counts and filters; updates return a new one."""

    def __init__(self, spark: SparkSession, path: str | None, min_docs: int, shards: int):
        self.spark, self.path, self.min_docs, self.shards = spark, path, min_docs, shards

    @classmethod
    def create(cls, spark: SparkSession, min_docs: int = 10) -> "LineIndex":
        return cls(spark, None, min_docs, 0)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "LineIndex":
        row = spark.read.parquet(f"{path}/about").first()
        return cls(spark, path, row["min_docs"], row["shards"])

    @property
    def counts(self) -> DataFrame:
        if self.path is None:
            return self.spark.createDataFrame([], "key binary, n_docs long")
        table = self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")
        return table.select("key", F.col("now").alias("n_docs")).filter("n_docs > 0")

    @property
    def filters(self) -> DataFrame:
        if self.path is None:
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.schema(FILTERS).parquet(f"{self.path}/filters")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None) -> "LineIndex":
        return self._update(id_text(docs, id_col, text_col), 1, path)

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None) -> "LineIndex":
        return self._update(id_text(docs, id_col, text_col), -1, path)

    def _update(self, docs: DataFrame, sign: int, path: str | None) -> "LineIndex":
        spark, path = self.spark, path or scratch_path(self.spark, "line-index")

        def count(batches):
            for b in by_bytes(batches, "text"):
                n: dict[bytes, int] = {}
                for text in b.column("text").to_pylist():
                    for k in set(line_keys(text)):
                        if k:
                            n[k] = n.get(k, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(n), pa.binary()), pa.array(np.fromiter(n.values(), np.int64, len(n)) * sign)],
                    names=["key", "n"])

        delta = docs.select("text").mapInArrow(count, "key binary, n long")
        both = (self.counts.select("key", F.col("n_docs").alias("was"), F.lit(0).cast("long").alias("n"))
                .unionByName(delta.select("key", F.lit(0).cast("long").alias("was"), "n")))
        both = both.groupBy("key").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
        now = F.col("was") + F.col("n")
        now = F.when(now < 0, F.raise_error("deleted documents that were never inserted")).otherwise(now)
        (both.select("key", "was", now.alias("now")).filter("was > 0 or now != 0")
         .write.parquet(f"{path}/counts"))
        counts = spark.read.schema(COUNTS).parquet(f"{path}/counts")
        common = F.col("now") >= self.min_docs
        shards = max(1, self.shards)
        n = counts.filter(common).count()
        fits = self.path is not None and n <= 2 * SHARD_KEYS * shards
        if fits:
            changes = counts.filter(common != (F.col("was") >= self.min_docs))
            old = self.filters
        else:  # the first version, or more common keys than the shards should hold
            shards = -(-n // SHARD_KEYS) or 1
            changes, old = counts.filter(common), spark.createDataFrame([], FILTERS)
        changes = changes.select(_shard(F.col("key"), shards).alias("shard"), "key", common.alias("common"))

        def apply(have: pa.Table, new: pa.Table) -> pa.Table:
            shard = (new if new.num_rows else have)["shard"][0].as_py()
            old = list(zip(have["cuckoo"].to_pylist(), have["keys"].to_pylist()))
            cuckoo, keys = update_shard(old, new["key"].to_pylist(), new["common"].to_pylist())
            return pa.table({"shard": pa.array([shard], pa.int32()), "cuckoo": pa.array([cuckoo], pa.binary()),
                             "keys": pa.array([keys], pa.binary())})

        (old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(apply, FILTERS)
         .write.parquet(f"{path}/filters"))
        about = spark.range(1).select(F.lit(self.min_docs).alias("min_docs"), F.lit(shards).alias("shards"))
        about.write.parquet(f"{path}/about")
        return LineIndex(spark, path, self.min_docs, shards)

    def common_lines(self, docs: DataFrame) -> DataFrame:
        """Rows (doc_id, a, b, keys) for texts with common lines; a, b: text digest.

        ``docs`` has ``doc_id`` and ``text``.
        """
        shards = max(1, self.shards)
        salts = max(2, -(-2 * shuffle_partitions(self.spark) // shards))

        def keys(batches):
            for b in by_bytes(batches, "text"):
                doc, a, c, out = [], [], [], []
                for i, x, y, text in zip(*(b.column(k).to_pylist() for k in ("doc_id", "a", "b", "text"))):
                    own = [k for k in set(line_keys(text)) if k]
                    doc += [i] * len(own)
                    a += [x] * len(own)
                    c += [y] * len(own)
                    out += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(a, pa.int64()), pa.array(c, pa.int64()),
                     pa.array(out, pa.binary())], names=["doc_id", "a", "b", "key"])

        lines = (docs.select("doc_id", F.xxhash64("text").alias("a"),
                             F.xxhash64(F.lit(7), "text").alias("b"), "text")
                 .mapInArrow(keys, "doc_id long, a long, b long, key binary")
                 .withColumn("shard", _shard(F.col("key"), shards))
                 .withColumn("salt", F.pmod(F.xxhash64("doc_id", "a", "key"), F.lit(salts)).cast("int")))
        copies = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def probe(have: pa.Table, asked: pa.Table) -> pa.Table:
            asked = asked.select(["doc_id", "a", "b", "key"])
            if not have.num_rows or not asked.num_rows:
                return asked.slice(0, 0)
            keys = asked["key"].to_pylist()
            hit = Cuckoo.read(have["cuckoo"][0].as_py()).contains(_pairs(keys))
            sure = have["keys"][0].as_py()
            sure = {sure[i:i + 16] for i in range(0, len(sure), 16)}
            return asked.filter(pa.array([h and k in sure for h, k in zip(hit.tolist(), keys)], pa.bool_()))

        hits = (copies.groupBy("shard", "salt").cogroup(lines.groupBy("shard", "salt"))
                .applyInArrow(probe, "doc_id long, a long, b long, key binary"))
        return hits.groupBy("doc_id", "a", "b").agg(F.collect_set("key").alias("keys"))

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` with a struct ``line_dedup`` (kept text, n_lines, n_dropped)."""
        hits = self.common_lines(id_text(docs, id_col, text_col)).select(
            F.col("doc_id").alias("__id"), F.col("a").alias("__a"), F.col("b").alias("__b"),
            F.col("keys").alias("__keys"))
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.withColumns({"__x": F.xxhash64(text), "__y": F.xxhash64(F.lit(7), text)})
        rows = rows.join(hits, F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
                         & (F.col("__x") == F.col("__a")) & (F.col("__y") == F.col("__b")), "left")

        @F.arrow_udf(CLEANED)
        def cut(texts: pa.Array, common: pa.Array) -> pa.Array:
            kept, total, dropped = [], [], []
            for text, keys in zip(texts, common):
                text, keys = text.as_py() or "", keys.as_py()
                lines = text.split("\n")
                keys = set(keys or ())
                rest = [s for s, k in zip(lines, line_keys(text)) if k not in keys] if keys else lines
                kept.append("\n".join(rest))
                total.append(len(lines))
                dropped.append(len(lines) - len(rest))
            return pa.StructArray.from_arrays(
                [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                names=["kept", "n_lines", "n_dropped"])

        return rows.withColumn("line_dedup", cut(F.col(text_col), F.col("__keys"))).drop(
            "__x", "__y", "__id", "__a", "__b", "__keys")
