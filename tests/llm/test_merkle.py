"""The Merkle manifest against a plain Python tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wiremap.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(row, more=0):
    values = list(row)
    values[3] = None if row[3] is None else row[3] + more
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in order:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, row_digest(r)))
        trees[k] = levels_of([row_digest(r) for r in groups[k]])
    top = levels_of([trees[k][-1][0] for k in order])
    out = []
    for t, k in enumerate(order):
        for i, r in enumerate(groups[k]):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded, siblings = row_digest(r, int(changed)), []
            for levels, at in ((trees[k], i), (top, t)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    siblings += [other] * bool(other)
                    folded = digest(other, folded) if at % 2 else digest(folded, other)
                    at //= 2
            out.append((r[0], row_digest(r), trees[k][-1][0], top[-1][0], digest(*siblings), folded,
                        folded == top[-1][0]))
    return sorted(out, key=repr)


def run(docs, stride):
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = fields | {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = merkle.verify(docs, "doc_id", "lang", list(fields.values()), list(claimed.values()), stride)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def rows_of(sizes):
    return [(100 * g + i * 3, f"s{i % 3}" if i % 5 else None, lang, i if i % 4 else None, f"täxt {i}" if i % 6 else "")
            for g, (lang, n) in enumerate(sizes) for i in range(n)]


ODD = [(None, None, None, None, None), (None, "a", None, 1, "x"), (5, "a", None, 1, "x"), (5, "a", None, 1, "x"),
       (5, "b", None, 1, "x"), (-7, "a", "", 2, ""), (7, "a", "", 2, "long " * 20000), (9, "a", "top", 1, "y"),
       (9, "a", "root", 1, "y"), (9, "a", "é", 1, "日本")]


@pytest.mark.parametrize("stride,rows", [
    (6, rows_of([("en", 150), ("de", 65), ("fr", 64), ("es", 1), (None, 2)]) + ODD),
    (2, rows_of([("en", 67), ("de", 16), ("fr", 17), (None, 3)])),
    (1, rows_of([("en", 9), ("de", 3), ("fr", 1)])),
    (6, rows_of([("en", 5)])), (6, rows_of([("en", 1)])),
])
def test_manifest_matches_plain_tree(spark, stride, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = ["tree", "idx", "path", "copy", "id", "leaf", "claim", "grp", "n"]
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in clash])
    assert run(docs, stride) == brute(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA), 6) == []


def test_proof_detects_only_the_tampered(spark):
    rows = rows_of([("en", 90), ("de", 40)])
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None}
    assert {r[0] for r in run(spark.createDataFrame(rows, SCHEMA), 6) if not r[-1]} == changed and changed


def test_copies_of_upper_rows(spark):
    """Rows near the top come in copies, one for about 2^stride leaves below."""
    docs = spark.createDataFrame(rows_of([("en", 130)]), SCHEMA)
    leaves = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"),
                         merkle.row_digest([F.col("text")]).alias("leaf"))
    low, upper = merkle.build(leaves.withColumn("claim", F.col("leaf")), stride=2)
    assert low.count() == 130
    got = upper.groupBy("tree", "step", "idx").agg(F.count("*").alias("n"), F.max("weight").alias("weight")).collect()
    assert all(1 <= r.n <= max(1, r.weight) and r.weight <= 8 * r.n for r in got) and max(r.n for r in got) >= 32
