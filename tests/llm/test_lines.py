"""Line dedup against its definition, and its reversibility."""

import collections
import random
import string

import numpy as np

from wiremap.llm.line_dedup import Cuckoo, LineIndex, _pairs, line_keys

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    texts = [t or "" for _, t in rows]
    seen = collections.Counter(k for t in texts for k in {key(x) for x in t.split("\n")} if k)
    out = []
    for (i, _), t in zip(rows, texts):
        lines = t.split("\n")
        kept = [x for x in lines if seen[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def cleaned(index, docs):
    rows = index.clean(docs).select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", "line_dedup.kept")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    common = ["Share this", " share THIS\t", "é É", "cookie", "", " "]
    return [(i, "\n".join(rng.choice(common + [f"line {rng.random()}"]) for _ in range(rng.randint(0, 6))))
            for i in range(n)]


def test_clean_equals_brute_force(spark, odd):
    rows = random_rows(60, 1) + [(r.doc_id, r.text) for r in odd.collect()] + [(None, "cookie")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert cleaned(LineIndex.create(spark, 5).insert(docs), docs) == brute(rows, 5)


def test_extra_columns_and_empty_tables(spark, odd, none):
    index = LineIndex.create(spark, 2).insert(odd)
    out = index.clean(odd.drop("line_dedup"))
    assert set(out.columns) == set(odd.columns) and out.count() == odd.count()
    empty = LineIndex.create(spark, 2).insert(none)
    assert empty.clean(none).count() == 0 and empty.clean(odd.drop("line_dedup")).count() == odd.count()


def test_deletion_undoes_insertion(spark):
    rows = random_rows(40, 2)
    first = spark.createDataFrame(rows[:25], "doc_id long, text string")
    second = spark.createDataFrame(rows[25:], "doc_id long, text string")
    one = LineIndex.create(spark, 6).insert(first)
    back = one.insert(second).delete(second)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, one.counts.collect()))
    assert cleaned(LineIndex.open(spark, back.path), first) == brute(rows[:25], 6)
    both = spark.createDataFrame(rows, "doc_id long, text string")
    assert cleaned(one.insert(second), both) == brute(rows, 6)


def test_deleting_what_was_not_inserted_fails(spark):
    import pytest
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="never inserted"):
        LineIndex.create(spark, 2).delete(docs)


def test_cuckoo_filter():
    keys = _pairs([k for k in line_keys("\n".join(map(str, range(4000))))])
    f = Cuckoo.of(keys)
    assert f.contains(keys).all()
    assert all(f.delete(a, b) for a, b in keys[:2000].tolist())
    assert f.contains(keys[2000:]).all() and f.contains(keys[:2000]).mean() < 0.05
    f = Cuckoo.read(f.bytes())
    assert all(f.insert(a, b) for a, b in keys[:2000].tolist()) and f.contains(keys).all()
    assert not Cuckoo.of(np.zeros((0, 2), np.uint64)).contains(keys).any()
