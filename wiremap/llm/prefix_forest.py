"""Approximate nearest neighbours by a hash-prefix forest.

Each of ``trees`` trees hashes a vector to a string of 64 bits (signs of
random projections); a tree is the array of all its strings in sorted order,
cut into blocks that hold whole prefixes.  A query descends in every tree: its
home block counts the strings that share a prefix of each length with it, from
the longest match upwards, and block totals give the counts above the block.
All trees then ascend together, one bit at a time, until their prefixes hold
``share`` times as many strings (over all trees) as there are vectors; the
vectors under the prefixes of that length are the query's candidates.  They
are scored where they lie, exactly.  The home blocks go first; their k-th best
score goes out with the query to its other blocks, which return only what
reaches it.

Inner products are turned into angles by one more component that makes all
vectors equally long (zero in queries), so vectors need no common length.  The
blocks come from a sample of ``SAMPLE`` vectors, chosen by a hash; every vector
is indexed.  A query's candidates are not capped.  ``share`` trades work for
recall: on vectors without structure (the test tables: neighbours at a cosine
of 0.4 in 64 dimensions) a forest must look at most of the rows to reach a
recall of 0.97; on clustered vectors a far smaller share does.

Defined cases: see ``vectors``; zero vectors take no part; an empty table
gives no rows; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from wiremap.llm.common import hash_sample, stored
from wiremap.llm.vectors import best_columns, classes, clean_vectors, matrix, ranked

BITS = 64
SAMPLE = 20_000
BLOCK_ROWS = 4_096
RESULT = "query_id long, rank int, vec_id long, score double"


def projections(trees: int, dim: int) -> np.ndarray:
    return np.random.default_rng(20_240_501).standard_normal((trees * BITS, dim + 1))


def hash_strings(v: np.ndarray, extra: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The hash strings (uint64, first bit highest) of each vector: (rows, trees)."""
    bits = np.column_stack((v, extra)) @ planes.T > 0
    return np.packbits(bits.reshape(len(v), -1, BITS), axis=2).view(">u8")[:, :, 0].astype(np.uint64)


def span(key: int, depth: int) -> tuple[int, int]:
    """The first and last string that share ``depth`` bits with ``key``."""
    rest = (1 << (BITS - depth)) - 1
    return key & ~rest & ((1 << BITS) - 1), key | rest


def cut_blocks(keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """First strings and prefix lengths of the blocks of one tree, from a sample."""
    keys, todo, out = np.sort(keys), [(0, 0)], []
    while todo:
        low, depth = todo.pop()
        a, b = span(low, depth)
        held = np.searchsorted(keys, np.uint64(b), "right") - np.searchsorted(keys, np.uint64(a))
        if held > limit and depth < BITS:
            todo += [(low, depth + 1), (low | 1 << (BITS - depth - 1), depth + 1)]
        else:
            out.append((a, depth))
    out.sort()
    return np.array([a for a, _ in out], np.uint64), np.array([d for _, d in out])


def nearest(rows: DataFrame, k: int, every: int, trees: int = 8, share: float = 1.5,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``, as ``RESULT``."""
    spark = rows.sparkSession
    rows = clean_vectors(rows, id_col, vec_col).filter(F.exists("v", lambda x: x != 0))
    groups, asked = classes(rows, k + 1, F.col("vec_id") % every == 0)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    about = groups.agg(F.count("*").alias("n"), F.max(norm2).alias("top"), F.first(F.size("v")).alias("dim")).first()
    n = about["n"]
    if not n:
        return spark.createDataFrame([], RESULT)
    top, dim, planes = about["top"], about["dim"], projections(trees, about["dim"])
    sample = hash_sample(groups, "class_id", SAMPLE).select("v").collect()
    sample = np.array([r["v"] for r in sample])
    lengths = lambda v: np.sqrt(np.maximum(top - (v * v).sum(1), 0))
    keys = hash_strings(sample, lengths(sample), planes)
    limit = max(1, BLOCK_ROWS * len(sample) // n)
    blocks = [cut_blocks(keys[:, t], limit) for t in range(trees)]

    def place(as_query: bool):
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                v = b.column("v").flatten().to_numpy().reshape(b.num_rows, dim)
                found = hash_strings(v, np.zeros(len(v)) if as_query else lengths(v), planes)
                raw = pa.array([x.tobytes() for x in v], pa.binary())
                for t in range(trees):
                    at = np.searchsorted(blocks[t][0], found[:, t], "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), t, np.int32)), pa.array(at.astype(np.int32)),
                         pa.array(found[:, t].view(np.int64)), b.column("class_id"), raw],
                        names=["tree", "block", "key", "class_id", "v"])
        return run

    kind = "tree int, block int, key long, class_id long, v binary"
    index = stored(groups.select("class_id", "v").mapInArrow(place(False), kind), "forest")
    queries = stored(groups.join(asked.select("class_id").distinct(), "class_id", "left_semi")
                     .select("class_id", "v").mapInArrow(place(True), kind), "forest-queries")
    totals = [np.zeros(len(b[0]) + 1, np.int64) for b in blocks]
    for t, block, c in index.groupBy("tree", "block").count().collect():  # a row for each block
        totals[t][block + 1] = c
    totals = [np.cumsum(t) for t in totals]

    def descend(own: pa.Table, ask: pa.Table) -> pa.Table:
        """For each query: how many of the tree's strings share 0, 1, ... bits with it."""
        ids, counts = [], []
        if ask.num_rows:
            t, block = ask["tree"][0].as_py(), ask["block"][0].as_py()
            keys = np.sort(own["key"].to_numpy().view(np.uint64)) if own.num_rows else np.zeros(0, np.uint64)
            first, depth = blocks[t]
            for i, key in zip(ask["class_id"].to_pylist(), ask["key"].to_numpy().view(np.uint64).tolist()):
                ends = [span(key, d) for d in range(BITS + 1)]
                low = np.array([e[0] for e in ends], np.uint64)
                high = np.array([e[1] for e in ends], np.uint64)
                inside = np.searchsorted(keys, high, "right") - np.searchsorted(keys, low)
                above = totals[t][np.searchsorted(first, high, "right")] - totals[t][np.searchsorted(first, low)]
                ids.append(i)
                counts.append(np.where(np.arange(BITS + 1) < depth[block], above, inside))
        return pa.table({"class_id": pa.array(ids, pa.int64()),
                         "counts": pa.array([c.tolist() for c in counts], pa.list_(pa.int64()))})

    key = ("tree", "block")
    seen = (index.select("tree", "block", "key").groupBy(*key)
            .cogroup(queries.select("tree", "block", "key", "class_id").groupBy(*key))
            .applyInArrow(descend, "class_id long, counts array<long>"))
    total = F.aggregate("all", F.array_repeat(F.lit(0).cast("long"), BITS + 1),
                        lambda a, c: F.zip_with(a, c, lambda x, y: x + y))
    depth = F.size(F.filter(total, lambda c: c >= float(share) * n)) - 1
    level = seen.groupBy("class_id").agg(F.collect_list("counts").alias("all")).select(
        "class_id", F.greatest(depth, F.lit(0)).alias("depth"))
    queries = queries.join(level, "class_id")

    def route(home: bool):
        """Each query to its own block, or to the other blocks under its prefix."""
        def run(batches):
            for b in batches:
                src, dst = [], []
                for i, (t, own, q, d) in enumerate(zip(b.column("tree").to_pylist(), b.column("block").to_pylist(),
                                                       b.column("key").to_numpy().view(np.uint64).tolist(),
                                                       b.column("depth").to_pylist())):
                    low, high = span(q, d)
                    first = blocks[t][0]
                    under = [own] if home else [
                        x for x in range(int(np.searchsorted(first, np.uint64(low), "right")) - 1,
                                         int(np.searchsorted(first, np.uint64(high), "right"))) if x != own]
                    src += [i] * len(under)
                    dst += under
                out = b.take(pa.array(src, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [out.column("tree"), pa.array(dst, pa.int32())]
                    + [out.column(c) for c in ("key", "class_id", "v", "depth", "cut")],
                    names=["tree", "block", "key", "class_id", "v", "depth", "cut"])
        return run

    def found_in(asked_at: DataFrame, home: bool) -> DataFrame:
        sent = asked_at.select("tree", "block", "key", "class_id", "v", "depth", "cut").mapInArrow(
            route(home), "tree int, block int, key long, class_id long, v binary, depth int, cut double")
        return stored(index.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(
            search, "class_id long, other long, score double"), "forest-found")

    def search(own: pa.Table, ask: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if own.num_rows and ask.num_rows:
            keys = own["key"].to_numpy().view(np.uint64)
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], own["class_id"].to_numpy()[order]
            v = matrix(own["v"].to_pylist(), np.float64)[order]
            q, name = matrix(ask["v"].to_pylist(), np.float64), ask["class_id"].to_numpy()
            cut = np.array([-np.inf if c is None else c for c in ask["cut"].to_pylist()])
            ends = [span(x, d) for x, d in zip(ask["key"].to_numpy().view(np.uint64).tolist(),
                                               ask["depth"].to_pylist())]
            low = np.searchsorted(keys, np.array([e[0] for e in ends], np.uint64))
            high = np.searchsorted(keys, np.array([e[1] for e in ends], np.uint64), "right")
            for a, b in sorted(set(zip(low.tolist(), high.tolist()))):
                if a == b:
                    continue
                for part in np.array_split(np.flatnonzero((low == a) & (high == b)), 1 + (b - a) // 1024):
                    if not len(part):
                        continue
                    rough = q[part] @ v[a:b].T
                    slack = 1e-9 * max(1.0, float(np.abs(rough).max()))
                    for i, row, at in zip(part, rough, best_columns(rough, k + 1, slack)):
                        at = at[row[at] >= cut[i] - slack]
                        exact = np.zeros(len(at))
                        for j in range(dim):  # one order of additions, so equal vectors tie
                            exact += q[i, j] * v[a:b][at, j]
                        best = np.lexsort((ids[a:b][at], -exact))[:k + 1]
                        out[0].extend([name[i]] * len(best))
                        out[1].extend(ids[a:b][at][best].tolist())
                        out[2].extend(exact[best].tolist())
        return pa.table({"class_id": pa.array(out[0], pa.int64()), "other": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    first = found_in(queries.withColumn("cut", F.lit(None).cast("double")), True)
    place = F.row_number().over(Window.partitionBy("class_id").orderBy(F.desc("score"), "other"))
    cuts = first.distinct().withColumn("n", place).filter(F.col("n") == k + 1).select(
        "class_id", F.col("score").alias("cut"))
    rest = found_in(queries.join(cuts, "class_id", "left"), False)
    return ranked(first.unionByName(rest).distinct(), groups, asked, k)
