"""Wrapped licence notices, and near relatives of the families."""

import textwrap

import pytest

from wiremap.llm import licenses


@pytest.fixture(scope="module")
def model():
    return licenses.fit([f"plain words of text number {i} under the sun" for i in range(300)])


def found(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.notices for r in sorted(licenses.scan(rows, model).collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices(spark, model, mark):
    long = [(f, t) for f in licenses.FAMILIES for t in licenses.TEMPLATES[f] if len(t) > 80]
    texts = []
    for width in (24, 40, 72):
        for _, t in long:
            body = ["some code here", "", *textwrap.wrap(t, width), "", "other text"]
            texts.append("\n".join(mark + x for x in body))
    got = found(spark, model, texts)
    assert [[n.family for n in g] for g in got] == [[f] for f, _ in long] * 3
    ends = [t.count("\n") - 1 for t in texts]
    assert all(2 <= g[0].paragraph and g[0].paragraph + g[0].lines <= e for g, e in zip(got, ends))


def test_a_notice_wrapped_inside_a_paragraph(spark, model):
    t = licenses.TEMPLATES["bsd-3-clause"][1]
    texts = ["\n".join(textwrap.wrap(f"plain words of text {a} {t} and number {a}", 60)) for a in ("", "x " * 9, "y " * 40)]
    assert [[n.family for n in g] for g in found(spark, model, texts)] == [["bsd-3-clause"]] * 3


def test_words_do_not_reach_over_blank_lines(spark, model):
    assert found(spark, model, ["Released under\n\nthe MIT\n\nLicense."]) == [[]]


def test_near_relatives_on_one_line(spark, model):
    header = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation; either version {} of the License, "
              "or (at your option) any later version.")
    texts = {header.format(2): "gpl-2.0", header.format(3): "gpl-3.0", "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
             "Licensed under CC BY 4.0.": "cc-by-4.0", "Released under the BSD 2-Clause License.": "bsd-2-clause",
             "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0"}
    assert [[n.family for n in g] for g in found(spark, model, list(texts))] == [[f] for f in texts.values()]
