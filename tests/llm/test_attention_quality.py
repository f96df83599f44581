"""Attention-based quality: gradient, encoding, pieces, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from wiremap.llm import attention_quality as Q

BIG = "/root/testdata/sf0.1"


def plain_passages(text):
    words = [w for w in __import__("re").split(rb"[ \t-\r]+", text) if w]
    return [words[i:i + Q.PASSAGE] for i in range(0, len(words), Q.PASSAGE)] or [[]]


def test_encoding_of_passages():
    texts = [b"", b"  \n ", b"one two Two two. " * 50, b"x" * 400, " ".join(f"é{i}" for i in range(130)).encode()]
    owner, x = Q.features(texts)
    want = [(i, p) for i, t in enumerate(texts) for p in plain_passages(t)]
    assert owner.tolist() == [i for i, _ in want] and x.shape == (len(want), Q.WIDTH)
    col = Q.CLASSES ** 2 + Q.LENGTHS
    for line, (_, words) in zip(x, want):
        low = [w.lower() for w in words]
        n = max(len(low), 1)
        shape = [len(low) / Q.PASSAGE, len(set(low)) / n, max([low.count(w) for w in low], default=0) / n,
                 sum(a == b for a, b in zip(low, low[1:])) / n]
        assert np.allclose(line[col:col + 4], shape)
        lengths = np.bincount([min(len(w), Q.LENGTHS) - 1 for w in words], minlength=Q.LENGTHS)
        assert np.allclose(line[Q.CLASSES ** 2:col], np.sqrt(lengths / n))


def test_pieces_keep_every_byte():
    texts = [b"", b"short", b"word " * 400_000, b"y" * (3 * Q.SLICE + 5), b"end"]
    got = [b""] * len(texts)
    for owners, parts in Q.pieces(texts):
        assert sum(map(len, parts)) <= 2 * Q.SLICE
        for i, part in zip(owners, parts):
            got[i] += part
    assert got == texts
    # Passages of a long text are the same whatever lies beside it.
    model = Q.fit(*_bags(40, 1))
    whole = model.scores(texts)[0]
    assert all(np.isclose(model.scores([t])[0][0], s) for t, s in zip(texts, whole))


def _bags(n, seed):
    """Documents of clean passages; those of label 0 hold one passage of symbols."""
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for i in range(n):
        parts = [" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(Q.PASSAGE)) for _ in range(5)]
        if i % 2:
            parts[int(rng.integers(5))] = " ".join("#$%" for _ in range(Q.PASSAGE))
        texts.append(" ".join(parts).encode())
        y.append(float(i % 2 == 0))
    owner, x = Q.features(texts)
    return owner, x, np.array(y)


def test_gradient_and_attention():
    owner, x, y = _bags(60, 2)
    model = Q.fit(owner, x, y)
    # The bad passage of a bag decides, so it gets the attention.
    rng = np.random.default_rng(9)
    good = [" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(Q.PASSAGE)).encode() for _ in range(5)]
    texts = [b" ".join([*good[:2], b"#$% " * 63 + b"#$%", *good[2:]]), b" ".join(good)]
    low, high = model.scores(texts)[0]
    assert low < 0.5 < high
    p = Q._split(model.flat.astype(float))
    _, rows = Q.features([texts[0]])
    h = np.tanh(((rows - model.centre) / model.spread) @ p["W"] + p["b"])
    a = np.exp((np.tanh(h @ p["T"]) * Q._sigmoid(h @ p["G"])) @ p["v"])
    share = (a / a.sum())
    assert share.max() > 2 / len(share) and abs(Q._sigmoid((share @ h) @ p["c"] + p["d"])[0] - low) < 1e-6


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = Q.train(docs, labels.filter(~held), max_rows=1500)
    test = docs.join(labels.filter(held), "doc_id").select("quality", Q.scores(model, "text").alias("s")).select(
        "quality", "s.*").toPandas()
    good, bad = test[test.quality == 1], test[test.quality == 0]
    assert (good.score >= 0.5).mean() > 0.99 and (bad.score < 0.5).mean() > 0.95


def test_plain_score_of_a_document(spark):
    """The column equals the model worked out passage by passage."""
    model = Q.fit(*_bags(60, 3))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    p = Q._split(model.flat.astype(float))
    for r in docs.withColumn("s", Q.scores(model, "text")).limit(40).collect():
        _, rows = Q.features([(r.text or "").encode()])
        weights = []
        for row in rows.astype(float):
            h = np.tanh(((row - model.centre) / model.spread) @ p["W"] + p["b"])
            weights.append((np.exp(np.dot(np.tanh(h @ p["T"]) / (1 + np.exp(-(h @ p["G"]))), p["v"])), h))
        z = sum(a * h for a, h in weights) / sum(a for a, _ in weights)
        assert abs(r.s.score - 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))) < 1e-4
        assert r.s.n_passages == len(weights)


def test_odd_rows_and_no_labels(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    out = odd.select("doc_id", Q.scores(Q.train(odd, empty), "text").alias("s")).select("s.*").collect()
    assert {r.score for r in out} == {0.5} and len(out) == odd.count()
    some = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (7, 1)], "doc_id long, quality int")
    model = Q.train(odd, some)
    assert model.flat is None and model.share == 0.75
    both = spark.createDataFrame([(4, 1), (5, 1), (6, 0), (7, 0)], "doc_id long, quality int")
    out = odd.select(Q.scores(Q.train(odd, both), "text").alias("s")).select("s.*").collect()
    assert all(0 <= r.score <= 1 and r.n_passages >= 1 for r in out)
    assert none.select(Q.scores(model, "text")).count() == 0
