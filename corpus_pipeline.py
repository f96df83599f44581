"""Corpus pipeline over ``documents``: each stage calls one operator of ``wiremap.llm``.

Every stage works on all rows that its predecessor kept, and all but the last
return the columns of their input.  Toxicity drops the documents that the
ordinal model grades 1 or above; line dedup replaces each text by its kept
lines (a document may become empty and stays); near-dedup keeps one document
of each group linked at 80 % of their five-word shingles or more; packing returns the pieces of the sequences.
Rows with a null id are kept unless toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremap.llm import packing, toxicity
from wiremap.llm.common import stored
from wiremap.llm.line_dedup import LineIndex
from wiremap.llm.near_dups import near_duplicates

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    score = toxicity.scores(model, "text")
    return docs.withColumn("__toxicity", score).filter("__toxicity.grade < 1").drop("__toxicity")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = LineIndex.create(spark, min_docs=10).insert(docs).clean(docs)
    kept = F.when(F.col("text").isNotNull(), F.col("line_dedup.kept"))
    changed = {"text": kept}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("line_dedup.n_dropped") > 0, F.length(kept).cast("long")).otherwise(
            F.col("n_chars"))
    return cleaned.withColumns(changed).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat an id are kept if any of them is; rows with a null id are kept."""
    verdict = near_duplicates(docs, percent=80, words=5)
    gone = verdict.filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept")
    gone = gone.select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers of the earlier stages still hold memory here.
    tokens = packing.token_table(docs, TOKENIZER, max_pieces=150_000, slice_bytes=4 << 20)
    pieces = packing.pack(tokens)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "padded")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_common_lines), ("near_dups", keep_one_of_each),
          ("packing", pack)]

#: Toxicity needs a fitted model and packing a tokenizer: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
