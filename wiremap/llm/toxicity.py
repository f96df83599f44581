"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

The model is ``P(grade >= k) = sigmoid(w . x - t_k)`` with one weight vector
for all ordered thresholds ``t_1 < t_2 < ...``; ``x`` holds log(1 + count) of
hashed lower-case letter runs and of their first four to six letters.  Features that go with
the grades by chance only get no weight; the others are fitted by maximum
likelihood with a small ridge, on at most ``max_rows`` labelled rows (chosen by
a hash of their id, the same at every size).  Scoring reads
whole texts of all rows and gives the expected severity ``sum_k P(grade >= k)``.

Labels that only say toxic or not become three grades: among toxic rows of the
sample, those with more marker words than the median (words with significantly
more toxic than clean rows) get grade 2, the others grade 1.

Defined cases: null and empty texts score like a text without any known word;
null labels are left out, of several labels of one id the largest holds; with
no labels, or labels of one grade only, nothing is toxic (severity 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import by_bytes, hash_sample, id_text

BINS = 1 << 22
PREFIXES = (4, 5, 6)
#: Bytes of text that a worker's arrays are built for at once.
SLICE = 2 << 20
MAX_ROWS = 4_000
SCORE = "struct<severity: double, p_toxic: double, grade: int>"


def word_bins(word: str) -> list[int]:
    """The hashed features of a word: itself and its beginnings (inflected forms)."""
    parts = [word] + [f"{word[:k]}-" for k in PREFIXES if len(word) >= k]
    return [xxhash.xxh3_64_intdigest(p) % BINS for p in parts] if word else []


def word_counts(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bin, count) of the features of each text's letter runs; ``known``: only these bins."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    cut = pc.split_pattern(pc.replace_substring_regex(plain, r"\PL+", " "), " ")
    coded = cut.flatten().dictionary_encode()
    features = [word_bins(w) for w in coded.dictionary.to_pylist()]
    sizes = np.array([len(f) for f in features], np.int64)
    flat = np.fromiter((b for f in features for b in f), np.int64, int(sizes.sum()))
    if known is not None:
        owner = np.repeat(np.arange(len(sizes)), sizes)[hit := np.isin(flat, known)]
        flat, sizes = flat[hit], np.bincount(owner, minlength=len(sizes))
    starts = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(texts)), np.diff(np.asarray(cut.offsets)))
    word = np.asarray(coded.indices)
    some = np.flatnonzero(sizes[word] > 0) if len(word) else np.zeros(0, int)
    word, rows = word[some], rows[some]
    n = sizes[word]
    at = np.repeat(starts[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
    cell, count = np.unique(np.repeat(rows, n) * BINS + flat[at], return_counts=True)
    return cell // BINS, cell % BINS, count


@dataclass(frozen=True)
class OrdinalModel:
    bins: tuple[int, ...]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def at_least(self, rows: np.ndarray, bins: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k) for each of ``n`` rows (lines) and k = 1, 2, ... (columns)."""
        if not self.thresholds:
            return np.zeros((n, 1))
        known, w = np.array(self.bins, np.int64), np.array(self.weights)
        score = np.zeros(n)
        if len(known):
            i = np.minimum(np.searchsorted(known, bins), len(known) - 1)
            hit = known[i] == bins
            score = np.bincount(rows[hit], np.log1p(counts[hit]) * w[i[hit]], minlength=n)
        return _sigmoid(score[:, None] - np.array(self.thresholds))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def minimise(cost, start: np.ndarray, steps: int = 200, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with backtracking; ``cost`` gives value and gradient."""
    x = start
    value, grad = cost(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(grad).max() < 1e-6:
            break
        way, alphas = grad.copy(), []
        for s, y, rho in reversed(pairs):
            alphas.append(rho * (s @ way))
            way -= alphas[-1] * y
        if pairs:
            s, y, _ = pairs[-1]
            way *= (s @ y) / (y @ y)
        for (s, y, rho), alpha in zip(pairs, reversed(alphas)):
            way += s * (alpha - rho * (y @ way))
        size, slope = 1.0, -(grad @ way)
        while size > 1e-10:
            value_next, grad_next = cost(x - size * way)
            if value_next <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        step, change = -size * way, grad_next - grad
        if step @ change > 1e-12:
            pairs = [*pairs, (step, change, 1 / (step @ change))][-memory:]
        x, value, grad = x + step, value_next, grad_next
    return x


def fit(rows: np.ndarray, bins: np.ndarray, counts: np.ndarray, grades: np.ndarray,
        ridge: float = 1e-4, chance: float = 0.01) -> OrdinalModel:
    """Minimise the mean negative log likelihood + ridge * |w|^2 / 2.

    Only features take part whose rows and grades above 0 go together by more
    than chance: a likelihood ratio that noise alone would reach for any of
    the sample's features with a probability of about ``chance``.
    """
    n, top = len(grades), int(grades.max()) if len(grades) else 0
    if not n or not top or (grades > 0).all():
        return OrdinalModel((), (), ())
    used, at = np.unique(bins, return_inverse=True)
    bad = grades > 0
    often = _ratio(np.bincount(at, bad[rows], minlength=len(used)),
                   np.bincount(at, ~bad[rows], minlength=len(used)), bad.sum(), n - bad.sum())
    often = often > 2 * np.log(max(1, len(used)) / chance)
    keep = often[at]
    r, c, x = rows[keep], (np.cumsum(often) - 1)[at[keep]], np.log1p(counts[keep])
    m, levels, each = int(often.sum()), np.arange(1, top + 1), np.arange(n)

    def cost(v: np.ndarray) -> tuple[float, np.ndarray]:
        w, q = v[:m], v[m:]
        # The first threshold, and the logarithms of the gaps to the next ones.
        t = np.cumsum(np.concatenate((q[:1], np.exp(q[1:]))))
        p = _sigmoid(np.bincount(r, x * w[c], minlength=n)[:, None] - t)
        lo = np.where(grades > 0, p[each, np.maximum(grades - 1, 0)], 1.0)
        hi = np.where(grades < top, p[each, np.minimum(grades, top - 1)], 0.0)
        prob = np.maximum(lo - hi, 1e-12)
        dlo, dhi = lo * (1 - lo) / prob, hi * (1 - hi) / prob
        g_t = np.array([dlo[grades == k].sum() - dhi[grades == k - 1].sum() for k in levels]) / n
        tail = g_t[::-1].cumsum()[::-1]
        g_w = np.bincount(c, x * ((dhi - dlo) / n)[r], minlength=m)
        return (-np.log(prob).mean() + ridge * (w @ w) / 2,
                np.concatenate((g_w + ridge * w, tail[:1], tail[1:] * np.exp(q[1:]))))

    share = np.clip((grades[:, None] >= levels).mean(0), 1 / (2 * n), 1 - 1 / (2 * n))
    t = -np.log(share / (1 - share))
    v = minimise(cost, np.concatenate((np.zeros(m), t[:1], np.log(np.maximum(np.diff(t), 1e-2)))))
    t = np.cumsum(np.concatenate((v[m:m + 1], np.exp(v[m + 1:]))))
    return OrdinalModel(tuple(used[often].tolist()), tuple(v[:m].tolist()), tuple(t.tolist()))


def _ratio(hit: np.ndarray, miss: np.ndarray, bad: int, good: int) -> np.ndarray:
    """Twice the log likelihood ratio of a word's rows against independence."""
    total, out = bad + good, 0.0
    for seen, size in ((hit, bad), (miss, good)):
        for part, share in ((seen, (hit + miss) / total), (size - seen, 1 - (hit + miss) / total)):
            with np.errstate(divide="ignore", invalid="ignore"):
                out = out + np.where(part > 0, part * np.log(part / (size * share)), 0.0)
    return 2 * out


def grade_labels(rows: np.ndarray, bins: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 clean, 1 toxic, 2 toxic with more marker words than the median toxic row."""
    bad = toxic > 0
    if not bad.any() or bad.all():
        return toxic.astype(int)
    used, at = np.unique(bins, return_inverse=True)
    hit = np.bincount(at, bad[rows], minlength=len(used))
    miss = np.bincount(at, ~bad[rows], minlength=len(used))
    p, q = (hit + 0.5) / (bad.sum() + 1), (miss + 0.5) / ((~bad).sum() + 1)
    marker = (hit >= 3) & (np.log(p / q) > 2.3) & (hit > miss)
    amount = np.bincount(rows, counts * marker[at], minlength=len(toxic))
    return np.where(bad, 1 + (amount > np.median(amount[bad])), 0)


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int):
    """Features and labels of at most ``max_rows`` labelled documents, at the driver."""
    wanted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .dropna().groupBy("doc_id").agg(F.max("y").alias("y")))
    wanted = hash_sample(wanted, "doc_id", max_rows)

    def features(batches):
        for b in by_bytes(batches, "text", SLICE):
            r, c, n = word_counts(b.column("text"))
            cut = np.searchsorted(r, np.arange(b.num_rows + 1)).tolist()
            raw = lambda v: pa.array([v[x:y].astype("<i4").tobytes() for x, y in zip(cut, cut[1:])],
                                     pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("y"), raw(c), raw(n)], names=["y", "bins", "counts"])

    # At most max_rows ids: within the bound of a broadcast.
    found = docs.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).select("text", "y")
    got = found.mapInArrow(features, "y int, bins binary, counts binary").collect()
    y = np.array([g["y"] for g in got], int)
    rows = np.repeat(np.arange(len(got)), [len(g["bins"]) // 4 for g in got])
    bins, counts = (np.frombuffer(b"".join(g[k] for g in got), "<i4") for k in ("bins", "counts"))
    return rows, bins, counts, y


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", binary: bool = True,
          max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on labelled documents; ``binary`` labels are graded by ``grade_labels``."""
    rows, bins, counts, y = sample(id_text(docs, id_col, text_col), labels, label, max_rows)
    grades = grade_labels(rows, bins, counts, y) if binary else np.maximum(y, 0)
    return fit(rows, bins, counts, grades)


def scores(model: OrdinalModel, text: Column | str) -> Column:
    """A struct (severity, p_toxic, grade) for each text."""

    known = np.array(model.bins, np.int64)

    @F.arrow_udf(SCORE)
    def score(texts: pa.Array) -> pa.Array:
        # Slices bound the memory for long texts.
        out = []
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes) // SLICE
        edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(texts)])).astype(int)
        for a, b in zip(edges[:-1], edges[1:]):
            out.append(model.at_least(*word_counts(texts.slice(a, b - a), known), b - a))
        p = np.concatenate(out)
        return pa.StructArray.from_arrays(
            [pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array((p >= 0.5).sum(1).astype(np.int32))],
            names=["severity", "p_toxic", "grade"])

    return score(F.col(text) if isinstance(text, str) else text)
