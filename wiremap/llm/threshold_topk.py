"""Exact top-k inner products by the three-phase uniform threshold method.

The vectors are cut into ``groups`` ranges of components.  A range is a node:
its local score of a vector is the inner product over its components.  Nodes
work in blocks: a cell scores a block of vectors against a block of queries.

1. Every node gives its ``LOCAL * k`` best local scores of each query and its
   smallest one.  The totals of these few vectors are computed; t1 is the k-th
   best.  (Bounds from below, with smallest scores for the unknown ones, would
   be far too low, as scores here can be negative.)
2. With scores counted from each node's smallest, a total of t1 needs at least
   (t1 - sum of smallest) / groups in one node.  This cutoff goes out with the
   queries, and nodes give every entry that reaches it.  A vector whose bound
   from above stays below t1 is out.
3. Totals that are still incomplete are computed from the whole vectors.

All numbers are whole, so the result is exact.  k counts classes of equal
vectors and one more, for the query's own.  Scores must fit 64 bits.  Defined
cases: see ``vectors``; with fewer vectors than k every one is returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from wiremap.llm.common import stored
from wiremap.llm.vectors import best_columns, classes, clean_vectors, ranked

ROWS, QUERIES = 4_096, 2_048
LOCAL = 4
RESULT = "query_id long, rank int, vec_id long, score long"


def local_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whole inner products: in doubles where these are exact, else in 64-bit integers."""
    if len(q) and len(v) and float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2.0 ** 52:
        return np.rint(q.astype(float) @ v.astype(float).T).astype(np.int64)
    return q @ v.T


def top_k(rows: DataFrame, k: int, every: int, scale: int = 1024, groups: int = 2,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k best of each row whose id is divisible by ``every``, as ``RESULT``.

    Components count as floor(scale * x).
    """
    spark = rows.sparkSession
    rows = clean_vectors(rows, id_col, vec_col).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * float(scale))))
    members, asked = classes(rows, k + 1, F.col("vec_id") % every == 0)
    about = members.agg(F.count("*").alias("n"), F.first(F.size("v")).alias("dim")).first()
    if not about["n"]:
        return spark.createDataFrame([], RESULT)
    dim = about["dim"]
    groups = min(groups, dim)
    cuts = [dim * g // groups for g in range(groups + 1)]
    queries = stored(members.join(asked.select("class_id").distinct(), "class_id", "left_semi")
                     .select("class_id", "v"), "topk-queries")
    row_blocks = max(1, -(-about["n"] // ROWS))
    query_blocks = max(1, -(-queries.count() // QUERIES))
    numbers = lambda m: F.sequence(F.lit(0), F.lit(m - 1))

    def parts(table: DataFrame, name: str, own: str, own_blocks: int, other: str, other_blocks: int,
              *more: str) -> DataFrame:
        """Each vector's ranges of components, in the cells of its block."""
        one = table.withColumn(own, F.pmod(F.xxhash64("class_id"), F.lit(own_blocks)).cast("int"))
        one = one.withColumn("g", F.explode(numbers(groups))).withColumn(other, F.explode(numbers(other_blocks)))
        at = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("g") + 1)
        end = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("g") + 2)
        return one.select("g", "i", "j", F.col("class_id").alias(name), F.slice("v", at + 1, end - at).alias("v"), *more)

    def cell(own: pa.Table, ask: pa.Table):
        width = len(own["v"][0])
        v = own["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        q = ask["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        return local_scores(q, v), own["other"].to_numpy(), ask["class_id"].to_numpy(), own["g"][0].as_py()

    some = LOCAL * (k + 1)
    local = "g int, class_id long, other long, s long, low long"

    def result(g, q, o, s, low):
        n = sum(map(len, q))
        join = lambda x, d: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), d)
        return pa.table({"g": pa.array(np.full(n, g), pa.int32()), "class_id": join(q, pa.int64()),
                         "other": join(o, pa.int64()), "s": join(s, pa.int64()), "low": join(low, pa.int64())})

    def gather(own: pa.Table, ask: pa.Table) -> pa.Table:
        q, o, s, low = [], [], [], []
        g = 0
        if own.num_rows and ask.num_rows:
            scores, ids, names, g = cell(own, ask)
            for row, name, at in zip(scores, names, best_columns(scores, some)):
                at = at[np.lexsort((ids[at], -row[at]))[:some]]
                q.append(np.full(len(at), name))
                o.append(ids[at])
                s.append(row[at])
                low.append(np.full(len(at), row.min()))
        return result(g, q, o, s, low)

    def collect(own: pa.Table, ask: pa.Table) -> pa.Table:
        q, o, s, low = [], [], [], []
        g = 0
        if own.num_rows and ask.num_rows:
            scores, ids, names, g = cell(own, ask)
            for row, name, base, need in zip(scores, names, ask["low"].to_pylist(), ask["need"].to_pylist()):
                at = np.arange(len(row)) if need is None else np.flatnonzero(groups * (row - base) >= need)
                q.append(np.full(len(at), name))
                o.append(ids[at])
                s.append(row[at])
                low.append(np.full(len(at), base))
        return result(g, q, o, s, low)

    left = parts(members.select("class_id", "v"), "other", "i", row_blocks, "j", query_blocks)
    key = ("g", "i", "j")
    right = parts(queries, "class_id", "j", query_blocks, "i", row_blocks)
    lists = stored(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(gather, local), "topk-lists")
    lows = lists.groupBy("g", "class_id").agg(F.min("low").alias("low"))
    base = lows.groupBy("class_id").agg(F.sum("low").alias("base"))
    best = F.row_number().over(Window.partitionBy("g", "class_id").orderBy(F.desc("s"), "other"))
    gathered = lists.withColumn("n", best).filter(F.col("n") <= some).select("class_id", "other").distinct()
    total = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x)

    def totals(pairs: DataFrame) -> DataFrame:
        others = members.select(F.col("class_id").alias("other"), F.col("v").alias("w"))
        return pairs.join(queries, "class_id").join(others, "other").select(
            "class_id", "other", total.alias("score"))

    place = F.row_number().over(Window.partitionBy("class_id").orderBy(F.desc("score"), "other"))
    kth = totals(gathered).withColumn("n", place).filter(F.col("n") == k + 1).select("class_id", F.col("score").alias("t1"))
    limits = stored(base.join(kth, "class_id", "left").select("class_id", "base", (F.col("t1") - F.col("base")).alias("need")),
                    "topk-limits")
    cut = lows.join(limits, "class_id")
    asked_again = queries.join(cut.groupBy("class_id").agg(
        F.map_from_entries(F.collect_list(F.struct("g", "low"))).alias("lows"), F.first("need").alias("need")), "class_id")
    right = parts(asked_again, "class_id", "j", query_blocks, "i", row_blocks, "lows", "need").withColumn(
        "low", F.element_at("lows", F.col("g"))).drop("lows")
    entries = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(collect, local)
    have = stored(entries.groupBy("class_id", "other").agg(
        F.sum(F.col("s") - F.col("low")).alias("bound"), F.count("*").alias("nodes")), "topk-entries")
    # A missing local score lies below need / groups.
    left_over = have.join(limits, "class_id").filter(
        F.col("need").isNull() | (groups * F.col("bound") >= F.col("nodes") * F.col("need")))
    whole = left_over.filter(F.col("nodes") == groups).select(
        "class_id", "other", (F.col("bound") + F.col("base")).alias("score"))
    solved = totals(left_over.filter(F.col("nodes") < groups).select("class_id", "other"))
    found = stored(whole.unionByName(solved), "topk-found")
    return ranked(found, members, asked, k)
