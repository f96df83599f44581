"""Vector searches against brute force."""

import duckdb
import numpy as np

from wiremap.llm import prefix_forest, queries, threshold_topk

from .conftest import SF

ODD = [(None, [1.0, 2.0, 3.0]), (7, None), (8, [1.0, None, 2.0]), (9, [float("nan"), 1.0, 1.0]),
       (13, [float("inf"), 1.0, 1.0]), (12, [1.0, 2.0]), (14, [])]


def brute(v, ids, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = sum(v[i, j] * v[:, j] for j in range(v.shape[1]))
        order = [x for x in np.lexsort((ids, -s)) if x != i][:k]
        out[int(ids[i])] = [(int(ids[x]), s[x]) for x in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def table(spark, v, ids):
    rows = [(int(i), x.tolist()) for i, x in zip(ids, v)]
    return spark.createDataFrame(rows + rows[:3] + ODD, "vec_id long, embedding array<double>")


def clustered(n, hot):
    rng = np.random.default_rng(5)
    v = np.round(rng.standard_normal((n, 3)), 1) + 0.05
    v[100:100 + hot] = v[100]
    return v, np.arange(n) * 5


def test_topk_is_exact(spark):
    v, ids = clustered(400, 150)
    whole = np.floor(1024 * v).astype(np.int64)
    assert found(threshold_topk.top_k(table(spark, v, ids), 10, 100)) == brute(whole, ids, 100, 10)
    few = table(spark, v[:6], ids[:6])
    assert found(threshold_topk.top_k(few, 10, 5)) == brute(whole[:6], ids[:6], 5, 10)


def test_forest_on_ties_and_hot_vectors(spark):
    v, ids = clustered(400, 150)
    df = table(spark, v, ids).union(spark.createDataFrame([(11, [0.0, 0.0, 0.0])], "vec_id long, embedding array<double>"))
    got, want = found(prefix_forest.nearest(df, 20, 20)), brute(v, ids, 20, 20)
    assert got.keys() == want.keys()
    assert all(len(got[q]) == 20 for q in want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert all(dict(want[q]).get(i, s) == s for q in got for i, s in got[q])


def test_recall_on_the_table(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    v, ids = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy()
    got, want = found(queries.op5_prefix_forest(spark, "/root/testdata/sf0.01")), brute(v, ids, 20, 20)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_topk_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(queries.OP9_SQL).fetchall()
    got = queries.op9_threshold_topk(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    odd = spark.createDataFrame(ODD[:5], empty.schema)
    for df in (empty, odd.filter("vec_id < 9")):
        assert threshold_topk.top_k(df, 10, 1).count() == 0 and prefix_forest.nearest(df, 20, 1).count() == 0
