"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file holds the ids of consecutive documents in ascending id order::

    "EFT1"  u32 shard  u64 ids before it in its shard
    u32 documents  u32 documents with a null id (they come first)
    i64 smallest doc_id  u8 bytes an id (2 or 4)
    Elias-Fano of (doc_id - smallest) of the documents with an id
    Elias-Fano of the boundaries 0, n0, n0+n1, ... (documents + 1 values)
    the ids, little-endian, one after another

Shards are ranges of (doc_id, text digest), so a doc_id that very many rows
share is spread over shards.  Each task writes the files of its shard, each of
at most ``file_tokens`` ids unless one document alone is longer, under fixed
names by write-and-rename: a repeated task writes the same bytes again.
Defined cases: null or empty text gives only the end id; null ids come first;
rows that share an id follow each other; an empty table gives no files.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremap.llm import elias_fano
from wiremap.llm.common import by_bytes, id_text, shuffle_partitions

HEAD = struct.Struct("<4sIQIIqB")
MAGIC = b"EFT1"
MANIFEST = "file string, shard int, n_docs long, n_tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def pack_file(shard: int, before: int, doc_ids: list, ids: list[np.ndarray], width: int) -> bytes:
    known = [i for i in doc_ids if i is not None]
    first = known[0] if known else 0
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.uint64)
    offsets = np.array([i - first for i in known], np.uint64)
    return b"".join([
        HEAD.pack(MAGIC, shard, before, len(doc_ids), len(doc_ids) - len(known), first, width),
        elias_fano.encode(offsets), elias_fano.encode(bounds),
        np.concatenate(ids).astype(f"<u{width}").tobytes() if ids else b""])


class TokenFile:
    """One file's bytes: ``doc_id(i)``, ``bounds(i)``, ``ids(i)`` by select."""

    def __init__(self, data: bytes):
        magic, self.shard, self.before, self.n, self.nulls, self.first, width = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.doc_ids = elias_fano.EliasFano(data, HEAD.size)
        self.boundaries = elias_fano.EliasFano(data, HEAD.size + self.doc_ids.size)
        at = HEAD.size + self.doc_ids.size + self.boundaries.size
        self.tokens = np.frombuffer(data, f"<u{width}", offset=at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.doc_ids[i - self.nulls]

    def bounds(self, i: int) -> tuple[int, int]:
        return self.boundaries[i], self.boundaries[i + 1]

    def ids(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.tokens[a:b]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text",
                      file_tokens: int = 2 << 20) -> DataFrame:
    """Encode whole texts, add ``end_id`` to each, write the files below ``path``.

    ``path`` is a URI that all executors reach (``pyarrow.fs`` writes it).
    Texts move once, before they are encoded, by ranges of the id; a task then
    encodes and writes one shard as a stream.  Returns the manifest (one row
    for each file), which is also written beside the files.
    """
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def write(batches):
        from pyarrow import fs as pafs

        from wiremap.llm.tokens import SLICE, encoder
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        store, root = pafs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        doc_ids: list = []
        ids: list = []
        before = held = number = 0

        def flush():
            nonlocal before, held, number, doc_ids, ids
            wide = max(int(x.max()) for x in ids) > 0xFFFF
            data = pack_file(shard, before, doc_ids, ids, 4 if wide else 2)
            name = f"part-{shard:07d}-{number:05d}.eft"
            part = f"{root}/_{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(data)
            store.move(part, f"{root}/{name}")
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([shard], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([held], pa.int64())], names=["file", "shard", "n_docs", "n_tokens"])
            before, held, number, doc_ids, ids = before + held, 0, number + 1, [], []
            return row

        end = np.array([end_id], np.uint32)
        for b in by_bytes(batches, "text", SLICE):
            for i, x in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text"))):
                if held and held + len(x) + 1 > file_tokens:
                    yield flush()
                doc_ids.append(i)
                ids.append(np.concatenate((x, end)))
                held += len(x) + 1
        if doc_ids:
            yield flush()

    out = rows.select("doc_id", "text").mapInArrow(write, MANIFEST)
    manifest = f"{path}/_manifest"
    out.write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document, as ``DOCUMENT``; ``ids`` are little-endian uint32.

    ``start`` counts the ids of all documents before it over all files.  The
    driver gathers one total for each shard (their number is the shuffle's).
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    base, total = {}, 0
    for r in manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect():
        base[r["shard"]] = total
        total += r["n"]
    if not base:
        return spark.createDataFrame([], DOCUMENT)

    def decode(batches):
        for b in batches:
            for data in b.column("content"):
                f = TokenFile(data.as_py())
                bounds = f.boundaries.values().astype(np.int64)
                known = (f.doc_ids.values().astype(np.int64) + f.first).tolist()
                at = base[f.shard] + f.before
                for i in range(0, f.n, 2048):
                    j = min(i + 2048, f.n)
                    own = f.tokens[bounds[i]:bounds[j]].astype("<u4")
                    cut = ((bounds[i:j + 1] - bounds[i]) * 4).tolist()
                    raw = own.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if k < f.nulls else known[k - f.nulls] for k in range(i, j)],
                                  pa.int64()),
                         pa.array(at + bounds[i:j], pa.int64()), pa.array(np.diff(bounds[i:j + 1]), pa.int64()),
                         pa.array([raw[x:y] for x, y in zip(cut, cut[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.eft").load(path)
             .select("path", "content"))
    return files.select("content").mapInArrow(decode, DOCUMENT)
