"""The registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremap.llm import (
    attention_quality, bpe, licenses, main_text, merkle, packing, prefix_forest, threshold_topk, token_files,
    toxicity, whitening,
)
from wiremap.llm.line_dedup import LineIndex
from wiremap.llm.near_dups import near_duplicates
from wiremap.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = LineIndex.create(spark, min_docs=10).insert(docs).clean(docs)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2("line_dedup.kept", 256).alias("kept_sha256"))


OP1_SQL = """
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
line as (
    select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from split),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from line),
common as (
    select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10),
marked as (
    select k.*, c.key is not null as dropped from keyed k left join common c on k.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), "toxic")
    score = toxicity.scores(model, "text")
    return docs.select("doc_id", score.alias("s")).select(
        "doc_id", "s.severity", "s.p_toxic", "s.grade", (F.col("s.grade") >= 1).alias("rejected"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(_table(spark, sf_dir, "documents"),
                     public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    out = token_files.read_token_files(spark, path)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = licenses.scan(docs, licenses.train(docs))
    return out.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.family")), ",").alias("families"),
        F.array_max("notices.probability").alias("probability"),
        F.array_min("notices.similarity").alias("similarity"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85, words=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.token_table(_table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packing.pack(tokens).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "padded")


def op9_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(_table(spark, sf_dir, "embeddings"), k=10, every=100)


OP9_SQL = """
with v as (
    select vec_id, list_transform(embedding::double[], lambda x: floor(1024 * x)::bigint) as q from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as (select vec_id, unnest(q) as x, unnest(range(len(q))) as i from v),
score as (
    select a.vec_id as query_id, b.vec_id, sum(a.x * b.x)::bigint as score
    from part a join part b on a.i = b.i and a.vec_id <> b.vec_id
    where a.vec_id % 100 = 0 group by all),
best as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from score)
select query_id, rank::integer as rank, vec_id, score from best where rank <= 10
"""


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", main_text.extract("html").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = attention_quality.train(docs, labels.filter(~held_out), "quality")
    out = docs.select("doc_id", held_out.alias("held_out"), attention_quality.scores(model, "text").alias("s"))
    return out.select("doc_id", "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
                      "s.n_passages")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=8)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = fields | {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = merkle.verify(docs, "doc_id", "lang", list(fields.values()), list(claimed.values()))
    return out.withColumnRenamed("id", "doc_id")


OP13_SQL = """
with recursive digested as (
    select doc_id, coalesce('=' || lang, '') as tree, encoded_head, encoded_text, n_chars,
        list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(doc_id::varchar) + 1),
                lambda i: list_transform(range(8), lambda b: (ascii(substr(doc_id::varchar, i::int, 1)) >> b::int) & 1)))),
            lambda c, b: case when xor(c, b) & 1 = 1 then xor(xor(c, b) >> 1, 3988292384) else xor(c, b) >> 1 end) as crc
    from (select doc_id, lang, n_chars,
        coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') as encoded_head,
        coalesce(strlen(text) || ':' || text, '-') as encoded_text from documents)),
claims as (
    select doc_id, tree, sha256(encoded_head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || encoded_text) as leaf,
        case when xor(crc, 4294967295) % 7 = 0 then sha256(encoded_head
            || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || encoded_text) end as changed
    from digested),
leaves as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i,
        count(*) over (partition by tree) as n from claims),
node as (
    select tree, 0 as level, i, leaf as h, n from leaves
    union all
    select tree, level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2
    from node where n > 1 group by tree, level, i // 2, n),
subroots as (
    select tree, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from node where n = 1),
top as (
    select 0 as level, i, h, n from subroots
    union all
    select level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2
    from top where n > 1 group by level, i // 2, n),
climb as (
    select doc_id, leaf, tree, 0 as level, i, n, '' as proof, coalesce(changed, leaf) as folded from leaves
    union all
    select c.doc_id, c.leaf, c.tree, c.level + 1, c.i // 2, (c.n + 1) // 2, c.proof || coalesce(s.h, ''),
        sha256(case when c.i % 2 = 0 then c.folded || coalesce(s.h, '') else s.h || c.folded end)
    from climb c left join node s on s.tree = c.tree and s.level = c.level and s.i = xor(c.i, 1::bigint) where c.n > 1),
ascent as (
    select c.doc_id, c.leaf, s.h as subroot, 0 as level, s.i, s.n, c.proof, c.folded
    from climb c join subroots s on s.tree = c.tree where c.n = 1
    union all
    select c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 2, (c.n + 1) // 2, c.proof || coalesce(s.h, ''),
        sha256(case when c.i % 2 = 0 then c.folded || coalesce(s.h, '') else s.h || c.folded end)
    from ascent c left join top s on s.level = c.level and s.i = xor(c.i, 1::bigint) where c.n > 1)
select a.doc_id, a.leaf, a.subroot, t.h as root, sha256(a.proof) as proof_sha256, a.folded as folded_root,
    a.folded = t.h as verified
from ascent a, top t where a.n = 1 and t.n = 1
"""


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_bpe": op3_bpe,
        "op4_token_files": op4_token_files,
        "op5_prefix_forest": op5_prefix_forest,
        "op6_licenses": op6_licenses,
        "op7_near_dups": op7_near_dups,
        "op8_packing": op8_packing,
        "op9_threshold_topk": op9_threshold_topk,
        "op10_main_text": op10_main_text,
        "op11_quality": op11_quality,
        "op12_whitening": op12_whitening,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op9_threshold_topk": OP9_SQL,
        "op13_merkle": OP13_SQL,
    }
