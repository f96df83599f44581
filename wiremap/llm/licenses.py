"""Licence notices by a trained paragraph classifier, in DataFrame functions only.

A paragraph is a line, or a group of lines that follow each other without a
line free of words (comment marks are none); its words are its runs of a-z and
0-9 in lower case.  From each line on, all groups are scored up to the one whose
later lines hold as many words as the longest template, so a wrapped notice lies
whole in one of them, however narrow its lines.  Of overlapping groups the most
similar, then the shortest counts; a group gives way to a line of its family,
and a line to a more similar group of another one.
Multinomial logistic regression on the presence of word unigrams and bigrams
gives each licence family and the class ``unknown`` a probability; a
temperature fitted on paragraphs kept out of the training calibrates it.  A
prediction holds only if the paragraph also contains at least ``CONFIRM`` of
the word bigrams of one of the family's templates.

The model is trained on the templates below (whole, shortened, reworded by
dropped words, and inside other words) and on ``SAMPLE_LINES`` lines of the
corpus, chosen by a hash, as ``unknown``.  Scoring reads every paragraph of
every whole text; only those with two or more content words of the templates
go on to the classifier, which loses nothing, since a confirmed paragraph
holds more of a template's words than the stop words are.  No row is shuffled.

Defined cases: null and empty texts have one empty paragraph and no notice;
rows keep their ids, also null and repeated ones; very long lines are one
paragraph each; ties go to the family that comes first; a notice's number is
that of its first line.  The sentence that the BSD licences share is given to
bsd-3-clause.
"""

from __future__ import annotations

import json
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import hash_sample, id_text
from wiremap.llm.toxicity import minimise

SAMPLE_LINES = 2_000
CONFIRM = 0.6
UNKNOWN = "unknown"
STOP = frozenset("a an and any are as at be by for from in is it its not of on or that the this to under with you".split())

#: Customary wordings of licence notices.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an as is basis",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "apache.org",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Released under the GNU GPL version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "lgpl-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
        "Licensed under the Simplified BSD License.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nc-sa-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This is free and unencumbered work released into the public domain.",
    ],
}
FAMILIES = list(TEMPLATES)
LONGEST = max(len(re.findall("[a-z0-9]+", t.lower())) for ts in TEMPLATES.values() for t in ts)


def words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def bigrams(ws: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(ws, ws[1:])}


def grams(ws: list[str]) -> set[str]:
    return set(ws) | bigrams(ws)


def containment(ws: list[str]) -> tuple[float, str]:
    """The largest share of a template's bigrams that the words contain, and its family."""
    own = bigrams(ws)
    return max(((len(own & t) / len(t), f) for f in FAMILIES for t in (bigrams(words(x)) for x in TEMPLATES[f])),
               key=lambda p: p[0])


def training_set(lines: list[str], seed: int = 7) -> tuple[list[list[str]], list[int]]:
    """Word lists and classes: template variants, and corpus lines as unknown."""
    rng = random.Random(seed)
    others = [words(x) for x in lines]
    others = [w for w in others if containment(w)[0] < CONFIRM]
    filler = [w for ws in others for w in ws] or ["text"]
    xs, ys = [], []
    for k, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            ws = words(text)
            for _ in range(24):
                own = [w for w in ws if rng.random() > 0.1] if rng.random() < 0.6 else list(ws)
                a, b = ([rng.choice(filler) for _ in range(rng.choice((0, 0, 3, 20)))] for _ in range(2))
                xs.append(a + own + b)
                ys.append(k)
            for _ in range(6):  # too little of a template to tell
                n = max(1, len(ws) // 4)
                i = rng.randrange(len(ws) - n + 1)
                xs.append([rng.choice(filler) for _ in range(10)] + ws[i:i + n])
                ys.append(len(FAMILIES))
    every = [w for ts in TEMPLATES.values() for t in ts for w in words(t)]
    for ws in others:
        xs.append(ws)
        ys.append(len(FAMILIES))
        if rng.random() < 0.2:  # licence words without a notice
            mixed = ws + rng.sample(every, 4)
            rng.shuffle(mixed)
            xs.append(mixed)
            ys.append(len(FAMILIES))
    return xs, ys


class Model:
    """Vocabulary, weights (features x classes), biases, and the temperature."""

    def __init__(self, vocabulary: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.vocabulary, self.weights, self.bias, self.temperature = vocabulary, weights, bias, temperature

    def probabilities(self, ws: list[str]) -> np.ndarray:
        index = {g: i for i, g in enumerate(self.vocabulary)}
        own = [index[g] for g in grams(ws) if g in index]
        z = (self.bias + self.weights[own].sum(0)) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def _design(xs: list[list[str]], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    own = [[index[g] for g in grams(ws) if g in index] for ws in xs]
    return (np.repeat(np.arange(len(xs)), [len(o) for o in own]),
            np.array([i for o in own for i in o], np.int64))


def _log_probabilities(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def fit(lines: list[str], ridge: float = 1e-3) -> Model:
    """Logistic regression on two thirds of the set, temperature on the rest."""
    xs, ys = training_set(lines)
    vocabulary = sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(words(t))})
    index = {g: i for i, g in enumerate(vocabulary)}
    held = np.arange(len(xs)) % 3 == 2
    y, k, m = np.array(ys), len(FAMILIES) + 1, len(vocabulary)
    row, col = _design([x for x, h in zip(xs, held) if not h], index)
    target = np.eye(k)[y[~held]]

    def logits(w: np.ndarray, b: np.ndarray, row, col, n: int) -> np.ndarray:
        z = np.zeros((n, k))
        np.add.at(z, row, w[col])
        return z + b

    def cost(v: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = v[:m * k].reshape(m, k), v[m * k:]
        lp = _log_probabilities(logits(w, b, row, col, len(target)))
        d = (np.exp(lp) - target) / len(target)
        g = np.zeros((m, k))
        np.add.at(g, col, d[row])
        return (-(lp * target).sum() / len(target) + ridge * (w ** 2).sum() / 2,
                np.concatenate(((g + ridge * w).ravel(), d.sum(0))))

    v = minimise(cost, np.zeros(m * k + k), steps=60)
    w, b = v[:m * k].reshape(m, k), v[m * k:]
    row, col = _design([x for x, h in zip(xs, held) if h], index)
    z, y = logits(w, b, row, col, int(held.sum())), y[held]
    loss = {t: -_log_probabilities(z / t)[np.arange(len(y)), y].mean() for t in np.geomspace(0.1, 10, 41)}
    return Model(vocabulary, w, b, float(min(loss, key=loss.get)))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    lines = id_text(docs, id_col, text_col).select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.filter(F.length("line") <= 2_000)
    got = hash_sample(lines, "line", SAMPLE_LINES).collect()
    return fit([r["line"] for r in got])


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def notices(model: Model, text: Column) -> Column:
    """An array of the text's notices: paragraph (from 0), family, probability, similarity, lines."""
    content = sorted({w for ts in TEMPLATES.values() for t in ts for w in words(t)} - STOP)
    content = _constant(content, "array<string>")
    vocabulary = _constant(model.vocabulary, "array<string>")
    scale = lambda a: np.round(a / model.temperature, 6).tolist()
    weights = _constant(dict(zip(model.vocabulary, scale(model.weights))), "map<string,array<double>>")
    templates = _constant([[sorted(bigrams(words(t))) for t in TEMPLATES[f]] for f in FAMILIES],
                          "array<array<array<string>>>")
    families = F.array(*[F.lit(f) for f in FAMILIES])
    let = lambda v, f: F.element_at(F.transform(F.array(v), f), 1)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)

    def judged(at: Column, n_lines: Column, ws: Column) -> Column:
        pairs = F.zip_with(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0))),
                           F.slice(ws, F.lit(2), F.size(ws)), lambda a, b: F.concat(a, F.lit(" "), b))

        def classify(two: Column) -> Column:
            own = F.array_intersect(F.concat(ws, two), vocabulary)
            bias = F.array(*[F.lit(b) for b in scale(model.bias)])
            z = F.aggregate(own, bias, lambda acc, g: add(acc, F.element_at(weights, g)))
            return let(z, lambda z: let(F.array_max(z), lambda top: let(
                F.array_position(z, top).cast("int"), lambda k: F.struct(
                    at.alias("paragraph"),
                    F.when(k <= len(FAMILIES), F.element_at(families, F.least(k, F.lit(len(FAMILIES)))))
                    .otherwise(UNKNOWN).alias("family"),
                    (1 / F.aggregate(z, F.lit(0.0), lambda s, x: s + F.exp(x - top))).alias("probability"),
                    F.when(k <= len(FAMILIES), F.array_max(F.transform(
                        F.element_at(templates, F.least(k, F.lit(len(FAMILIES)))),
                        lambda t: F.size(F.array_intersect(two, t)) / F.size(t)))).otherwise(0.0)
                    .alias("similarity"), n_lines.alias("lines")))))

        return let(F.array_distinct(pairs), classify)

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line, i: let(
        F.split(F.lower(line), "[^a-z0-9]+"), lambda ws: F.struct(
            i.alias("at"), F.lit(1).alias("lines"), ws.alias("ws"),
            F.size(F.array_intersect(ws, content)).alias("n"))))
    n_words = lambda p: F.size(F.array_remove(p["ws"], ""))

    def reach(ls: Column, p: Column) -> Column:
        """Lines from this one on, until the later ones hold LONGEST words or one has none."""
        state = lambda k, n, more: F.struct(k.alias("k"), n.alias("n"), more.alias("more"))

        def step(acc: Column, q: Column) -> Column:
            n = n_words(q)
            more = acc["more"] & (n > 0) & (acc["n"] < LONGEST)
            return state(acc["k"] + more.cast("int"), acc["n"] + n, more)

        return F.aggregate(F.slice(ls, p["at"] + 2, F.lit(LONGEST)),
                           state(F.lit(1), F.lit(0), n_words(p) > 0), step, lambda acc: acc["k"])

    def groups(ls: Column) -> Column:
        starts = F.filter(ls, lambda p: p["n"] + F.coalesce(F.get(ls, p["at"] + 1)["n"], F.lit(0)) >= 1)
        made = F.transform(starts, lambda p: let(reach(ls, p), lambda k: F.transform(
            F.filter(F.sequence(F.lit(1), k), lambda size: size > 1), lambda size: let(
                F.slice(ls, p["at"] + 1, size), lambda own: F.struct(
                    p["at"].alias("at"), size.alias("lines"), F.flatten(own["ws"]).alias("ws"),
                    F.aggregate(own["n"], F.lit(0), lambda a, n: a + n).alias("n"))))))
        return F.flatten(made)

    def near(n: Column, m: Column) -> Column:
        return (m["paragraph"] < n["paragraph"] + n["lines"]) & (n["paragraph"] < m["paragraph"] + m["lines"])

    def outdone(n: Column, m: Column) -> Column:
        """Whether the group n gives way to m."""
        rank = lambda x: F.struct(x["similarity"], -x["lines"], x["paragraph"])
        return near(n, m) & F.when(m["lines"] == 1, m["family"] == n["family"]).otherwise(rank(m) > rank(n))

    def part(n: Column, m: Column) -> Column:
        """Whether the line n is a piece of the group m, which is of another family."""
        return near(n, m) & (m["lines"] > 1) & (m["similarity"] > n["similarity"])

    some = F.filter(let(lines, lambda ls: F.concat(ls, groups(ls))), lambda p: p["n"] >= 2)
    found = F.transform(some, lambda p: judged(p["at"], p["lines"], F.array_remove(p["ws"], "")))
    held = F.filter(found, lambda n: (n["family"] != UNKNOWN) & (n["probability"] >= 0.5)
                    & (n["similarity"] >= CONFIRM))
    kept = let(held, lambda all_: F.filter(all_, lambda n: (n["lines"] == 1) | ~F.exists(
        all_, lambda m: outdone(n, m))))
    return F.array_sort(let(kept, lambda all_: F.filter(all_, lambda n: (n["lines"] > 1) | ~F.exists(
        all_, lambda m: part(n, m)))))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_paragraphs, notices."""
    return id_text(docs, id_col, text_col).select(
        "doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_paragraphs"),
        notices(model, F.col("text")).alias("notices"))
