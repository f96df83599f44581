"""Toxicity, licence notices and main text."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wiremap.llm import licenses, main_text, toxicity

BIG = "/root/testdata/sf0.1"


def test_ordinal_model_learns_graded_words():
    rng = np.random.default_rng(1)
    texts, grades = [], []
    for _ in range(600):
        g = int(rng.integers(0, 3))
        bad = ["awful"] * (2 * g) + ["vileness", "vilest"][:g]
        words = [f"w{rng.integers(300)}" for _ in range(30)] + bad
        rng.shuffle(words)
        texts.append(" ".join(words))
        grades.append(g)
    r, b, c = toxicity.word_counts(pa.array(texts))
    model = toxicity.fit(r, b, c, np.array(grades))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.bins) < 40
    p = model.at_least(r, b, c, len(texts))
    assert (((p >= 0.5).sum(1)) == grades).mean() > 0.95 and (p[:, 0] >= p[:, 1]).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    test = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id").select(
        "toxic", toxicity.scores(model, "text").alias("s")).select("toxic", "s.*").toPandas()
    clean, bad = test[test.toxic == 0], test[test.toxic == 1]
    assert (clean.grade > 0).mean() < 0.005 and (bad.grade > 0).mean() > 0.85
    assert bad.severity.mean() > 10 * clean.severity.mean()


def test_toxicity_without_labels_and_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    out = odd.select(toxicity.scores(model, "text").alias("s")).select("s.*").collect()
    assert {tuple(r) for r in out} == {(0.0, 0.0, 0)}
    assert none.select(toxicity.scores(model, "text")).count() == 0
    some = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.train(odd, some).thresholds == ()


@pytest.fixture(scope="module")
def model():
    return licenses.fit([f"plain words of text number {i} under the sun" for i in range(300)])


def test_licence_families(spark, model, odd, none):
    lines = {"mit": "Some code. Released under the MIT License.", "apache-2.0": "LICENSED under the Apache License, Version 2.0.",
             "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
             "cc-by-nc-4.0": "licensed under CC BY-NC 4.0", "cc-by-4.0": "Licensed under CC BY 4.0."}
    none_of = ["her driving license was renewed by the public office", "the software is free of charge", "",
               "a general version of this work is under the sun", "permission was granted"]
    rows = [(i, "first line\n" + t) for i, t in enumerate([*lines.values(), *none_of])]
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [[n.family for n in out[i].notices] for i in range(len(rows))] == [[f] for f in lines] + [[]] * len(none_of)
    assert all(n.paragraph == 1 and n.probability >= 0.5 for r in out.values() for n in r.notices)
    assert licenses.scan(odd, model).count() == odd.count() and licenses.scan(none, model).count() == 0


def test_licence_probabilities_equal_the_model(spark, model):
    texts = ["Released under the MIT License", "see Licensed under CC BY 4.0. for more words of text", "Released under the ISC License."]
    rows = list(enumerate(texts))
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        p = model.probabilities(licenses.words(texts[r.doc_id]))
        assert [n.family for n in r.notices] == [licenses.FAMILIES[p.argmax()]]
        assert abs(r.notices[0].probability - p.max()) < 1e-3


def test_licence_plan_is_native(spark, model):
    plan = licenses.scan(spark.range(1).selectExpr("id doc_id", "'x' text"), model)._jdf.queryExecution().executedPlan()
    assert not any(w in plan.toString() for w in ("Python", "Pandas", "Arrow", "Exchange"))


def test_licences_on_the_table(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    marks = {"MIT License": "mit", "Apache License": "apache-2.0", "GNU General": "gpl-3.0", "CC BY-NC": "cc-by-nc-4.0"}
    out = licenses.scan(docs, licenses.train(docs)).collect()
    got = {r.doc_id: {n.family for n in r.notices} for r in out}
    texts = dict(duckdb.sql(f"select doc_id, text from '{BIG}/documents.parquet'").fetchall())
    assert got == {i: {f for m, f in marks.items() if m in t} for i, t in texts.items()}


PAGES = [
    ("<html><body><div class='nav'><a href=x>a</a></div><div id='content'><h2>T</h2><p>Hello world this is a long "
     "paragraph, really long enough.</p><p>Short.</p><form>no</form><p>Another long one with &amp; refs &eacute; in "
     "it.</p></div><div class='comments'><p>Nice post, a fairly long comment by a reader.</p></div></body></html>",
     "T\nHello world this is a long paragraph, really long enough.\nShort.\nAnother long one with & refs é in it."),
    ("<article><p>a<br>b  c</p><div class='comment-list'><article><p>reader says things</p></article></div></article>",
     "a b c"),
    ("<body><header>Site</header><main><article><header><h1>Title</h1></header><p>x</p><aside>see also</aside>"
     "<script>var a='</p>'</script><p>y<i>z</i></p></article></main><footer>(c)</footer></body>", "Title\nx\nyz"),
    ("<p>plain", "plain"), ("just text &amp; more", "just text & more"), ("", ""), (None, ""), ("<!-- only -->", ""),
    ("<article><p>kept<p>also &lt;kept&gt;<div class=ad>buy</div><p>end</article>", "kept\nalso <kept>\nend"),
]


def test_main_text(spark):
    rows = [(i, h) for i, (h, _) in enumerate(PAGES)] + [(None, "<p>n</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = df.withColumn("text", main_text.extract("html")).collect()
    assert [r.text for r in sorted(got[:-1], key=lambda r: r.page_id)] == [t for _, t in PAGES]
    assert df.limit(0).withColumn("text", main_text.extract("html")).count() == 0


def test_article_of_generated_pages():
    import html
    import re
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        words = html.unescape(re.sub(r"<[^>]+>", " ", inner)).split()
        assert main_text.main_text(page).split() == words


def test_smoothing_keeps_length():
    for n in (1, 2, 3, 50):
        assert len(main_text.smooth(np.ones(n))) == n and np.allclose(main_text.smooth(np.ones(n)), 1)
