"""The near-dedup stage of the corpus pipeline against brute force at 0.8."""

import corpus_pipeline as cp

from .conftest import SF
from .test_near_dups import shingles


def brute(rows, percent=80):
    """The ids that stay: the smallest of each group of linked texts."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, t in rows}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i for i in root if find(i) == i}


def test_copies_between_80_and_85_are_linked(spark):
    rows = []
    for group in range(20):
        words = [f"g{group}w{k}" for k in range(104)]
        # 100 shingles, 10 of the copy's differ: 90 of 110 are shared; 12 differ: 88 of 112, not linked.
        rows += [(3 * group, " ".join(words)), (3 * group + 1, " ".join(words[:-10] + [f"x{k}" for k in range(10)])),
                 (3 * group + 2, " ".join([f"y{k}" for k in range(12)] + words[12:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len(want) == 40 and len(brute(rows, 85)) == 60
    assert {r.doc_id for r in cp.keep_one_of_each(spark, docs, SF).collect()} == want


def test_documents_against_brute_force(spark):
    docs = cp.drop_toxic(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    docs = spark.createDataFrame(cp.drop_common_lines(spark, docs, SF).collect(), docs.schema)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in cp.keep_one_of_each(spark, docs, SF).collect()} == brute(rows) < brute(rows, 85)
