"""The corpus pipeline against the operators' definitions, and its registration."""

import collections

import corpus_pipeline as cp
import __spark_entry__ as entry

from .conftest import SF
from .test_lines import brute as brute_lines
from .test_near_dups import brute as brute_near


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    kept = cp.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    marks = ("idiot", "moron", "scum", "worthless")
    bad = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert all(r.doc_id not in bad for r in docs.collect() if not any(m in r.text.lower() for m in marks))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    lines = cp.drop_common_lines(spark, kept, SF)
    assert lines.columns == docs.columns
    got = {r.doc_id: r for r in lines.collect()}
    assert {i: t for i, _, _, t in brute_lines(rows, 10)} == {i: r.text for i, r in got.items()}
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text != dict(rows)[r.doc_id])
    one = cp.keep_one_of_each(spark, lines, SF)
    want = brute_near([(i, r.text) for i, r in got.items()], percent=80)
    assert {r.doc_id for r in one.collect()} == {i for i, (_, _, keep) in want.items() if keep}
    assert one.columns == docs.columns


def test_run_packs_what_is_left(spark):
    out = cp.run(spark, SF).collect()
    tokens = collections.Counter()
    for r in out:
        tokens[r.doc_id] += r.length
    assert {r.doc_id: r.doc_tokens for r in out} == dict(tokens)
    assert 0 < len(tokens) < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        docs = docs.drop("line_dedup")
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
        cp.STAGES[-1][1](spark, docs, SF).count()
