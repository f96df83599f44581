"""Near duplicates against brute force over all pairs of full sets."""

import random
import re
import string

import numpy as np

from wiremap.llm import near_dups
from wiremap.llm.common import sieve
from wiremap.llm.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
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
    return {i: (len(sets[i]), find(i), find(i) == i) for i in root}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return " ".join(out)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for group in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((6, 40, 200)))]
        for _ in range(rng.choice((1, 2, 5))):
            rows.append((len(rows), edited(base, rng, rng.choice((0, 0, 1, 2, 4)))))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "Two Words"), (len(rows) + 3, "two  WORDS"),
             (len(rows) + 4, "é É"), (len(rows) + 5, "É é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dups.near_duplicates(docs)) == brute(rows)


def test_large_group_of_near_copies(spark, monkeypatch):
    """More members than a small node holds, some of them linked through others only."""
    monkeypatch.setattr(near_dups, "SMALL", 32)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, edited(base, rng, rng.choice((1, 2, 3, 5, 7)))) for i in range(150)]
    rows += [(1000 + i, edited(base, rng, 40)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dups.near_duplicates(docs)) == brute(rows)


def test_blocks_of_a_large_node(spark, monkeypatch):
    """Only pairs between components, each block against each, none lost."""
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    monkeypatch.setattr(near_dups, "SMALL", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(base, rng, rng.choice((2, 8, 9)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dups.near_duplicates(docs)) == brute(rows)


def test_awkward_rows(spark, odd, none):
    out = near_dups.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in out}
    assert got[(None, 0)] == (None, True) and got[(2, 0)] == (2, True) and got[(5, 2)] == (4, False)
    assert near_dups.near_duplicates(none).count() == 0


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_links_of_small_nodes_across_components(spark, monkeypatch):
    """Chains of texts around the limit, sets dealt to several cells: no link lost."""
    monkeypatch.setattr(near_dups, "CELL_BYTES", 4000)
    rng = random.Random(8)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(200)]
        for _ in range(14):
            base = edited(base, rng, rng.choice((2, 3, 4))).split(" ")
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, edited(base, rng, rng.choice((1, 3, 6))))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dups.near_duplicates(docs)) == brute(rows)


def test_linked_counts_whole_sets(monkeypatch):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in rng.integers(1, 400, 40)]
    want = [[100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y)) for y in sets] for x in sets]
    assert near_dups.linked(sets, 60).tolist() == want
    assert near_dups.linked([np.array([1], np.uint64), np.array([2], np.uint64)], 60).tolist() == np.eye(2, dtype=bool).tolist()


def test_sketch_keeps_linked_pairs():
    """Sets at the limit never differ in more bits than allowed, also very small ones."""
    rng = np.random.default_rng(10)
    most = near_dups.different_bits(0.85)
    for shared, own in ((17, 3), (340, 60), (6, 1)):
        for _ in range(100):
            x = rng.integers(0, 1 << 63, shared + own).astype(np.uint64)
            a, b = x, x[:shared]
            bits = near_dups.sketch(np.stack([near_dups.signature(a), near_dups.signature(b)]))
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= most


def test_forest_spans_near_rows():
    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 63, (4, 2)).astype(np.uint64)
    bits = np.repeat(base, 5, axis=0)
    bits[:, 0] ^= np.left_shift(np.uint64(1), rng.integers(0, 8, 20).astype(np.uint64))
    links = near_dups.forest(bits, near_dups.different_bits(0.85))
    assert len(links) == 16 and all(i // 5 == j // 5 for i, j in links)
    assert near_dups.forest(bits[[0, 1]], 2) == [(0, 1)] and near_dups.forest(bits[[0, 5]], 2) == []


def test_sieve_keeps_every_wanted_row(spark):
    """And lets few others through, so that a join shuffles only what it needs."""
    rows = spark.range(20_000).selectExpr("id - 500 as k", "cast(id as string) as text")
    rows = rows.unionByName(spark.createDataFrame([(None, "null key")], "k long, text string"))
    wanted = spark.createDataFrame([(k,) for k in range(-500, 19_500, 40)], "k long")
    got = [r.k for r in sieve(rows, "k", wanted).collect()]
    assert set(range(-500, 19_500, 40)) <= set(got) and len(got) < 600
    assert sieve(rows, "k", wanted.limit(0)).count() == 0


def test_texts_without_near_ones_are_not_shuffled(spark):
    """The bitmap comes before the join with the wanted ids."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    wanted = docs.select("doc_id").filter("doc_id < 3")
    joined = near_dups.wanted_texts(docs, wanted)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (doc_id") < plan.index("bitmap_construct_agg")
    assert "LeftSemi" not in plan and sorted(r.doc_id for r in joined.collect()) == [0, 1, 2]
