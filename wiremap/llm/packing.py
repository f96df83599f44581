"""Concatenate-and-cut packing by two passes over partition token totals.

Pass one encodes every document once and stores its ids with the partition's
number and the document's start in that partition.  The driver gathers one
total for each partition, whose prefix sum gives every document its global
offset.  Pass two cuts at multiples of ``length``: a piece (boundary record)
says which ids of a document stand where in which sequence.  Nothing is
shuffled.  Defined cases: null or empty text is a document of only the end id;
repeated rows and ids are documents of their own; an empty table gives no
pieces.  Only the last sequence can be short; ``padded`` is ``length`` unless
the sequence's own length is a power of two, which is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import by_bytes, id_text, stored

TOKENS = "part int, start_in_part long, doc_id long, doc_tokens long, ids binary"
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, padded long")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text", max_pieces: int = 500_000, slice_bytes: int = 8 << 20) -> DataFrame:
    """Ids of each document (two bytes each where the vocabulary allows), stored once.

    ``max_pieces`` and ``slice_bytes`` trade a worker's memory for time; the ids are the same.
    """

    def encode(batches):
        from wiremap.llm.tokens import encoder
        enc, part, at = encoder(tokenizer, max_pieces), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        for b in by_bytes(batches, "text", slice_bytes):
            ids = [np.concatenate((x, end)) for x in enc.encode(b.column("text"))]
            n = np.array([len(x) for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            # A leading byte tells the width of the ids that follow.
            raw = [b"\x02" + x.astype("<u2").tobytes() if x.max() <= 0xFFFF
                   else b"\x04" + x.astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(starts), b.column("doc_id"),
                 pa.array(n), pa.array(raw, pa.binary())],
                names=["part", "start_in_part", "doc_id", "doc_tokens", "ids"])

    return stored(id_text(docs, id_col, text_col).mapInArrow(encode, TOKENS), "tokens")


def pack(tokens: DataFrame, length: int = 1024) -> DataFrame:
    """Cut the stored ids into pieces (``PIECES``; ids are little-endian uint32)."""
    spark = tokens.sparkSession
    base, total = {}, 0
    for r in (tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").collect()):
        base[r["part"]] = total
        total += r["n"]
    if not base:
        return spark.createDataFrame([], PIECES)
    last, rest = total // length, total % length
    padded_last = rest if rest & (rest - 1) == 0 else length

    def cut(batches):
        for b in by_bytes(batches, "ids"):
            cols: list[list] = [[] for _ in range(8)]
            for part, start, doc, n, raw in zip(*(b.column(k).to_pylist() for k in (
                    "part", "start_in_part", "doc_id", "doc_tokens", "ids"))):
                ids = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype("<u4").tobytes()
                g, at = base[part] + start, 0
                while at < n:
                    seq, off = divmod(g + at, length)
                    m = min(length - off, n - at)
                    for c, v in zip(cols, (doc, at, m, ids[4 * at:4 * (at + m)], n, seq, off,
                                           padded_last if seq == last else length)):
                        c.append(v)
                    at += m
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(cols)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                       "padded"])

    return tokens.mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, length, and ``ids`` padded to ``padded``.

    A group holds at most one window of ids, so groups are bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    out = pieces.groupBy("sequence_id").agg(
        parts.alias("parts"), F.sum("length").alias("length"), F.first("padded").alias("padded"))
    ids = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    pad = pad_id.to_bytes(4, "little")
    fill = F.unhex(F.expr(f"repeat('{pad.hex()}', cast(padded - length as int))"))
    return out.select("sequence_id", "length", F.concat(ids, fill).alias("ids"))
