"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded
(``features``: pairs of character classes, word lengths, repetition, hashed
words) as ``h = tanh(W x + b)``; gated attention ``a = v . (tanh(T h) * sigmoid(G h))``
weighs the passages by softmax, and the weighted sum ``z`` of their ``h`` gives
the score ``sigmoid(c . z + d)``.  All weights are learned together, from
document labels only.

The fit takes at most ``max_rows`` labelled documents, chosen by a hash of
their ids, and at most ``max_passages`` evenly spaced passages of each.
Scoring encodes every passage of every whole text; texts are worked through in
pieces of about ``SLICE`` bytes, cut at white space, and the attention sums of
the pieces are added, so memory doesn't grow with a text's length.

Defined cases: null, empty and blank texts are one passage without words; null
labels and ids are left out, of several labels of one id the largest holds, and
of several texts of one id the smallest; without labels, or with labels of one
class only, every score is the (smoothed) share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import by_bytes, hash_sample, id_text
from wiremap.llm.toxicity import minimise

PASSAGE = 64
SLICE = 1 << 20
MAX_ROWS, MAX_PASSAGES = 4_000, 32
CODE, GATE = 16, 8
#: Character classes, by byte: space, lower, upper, digit, full stop, other pause, call,
#: quote or hyphen, bracket, other symbol, first and further bytes beyond ASCII.
CLASSES = 12
WORD_BINS, LENGTHS, SHAPE = 256, 12, 4
WIDTH = CLASSES * CLASSES + LENGTHS + SHAPE + WORD_BINS
RESULT = "struct<score: double, n_passages: int>"


def _classes() -> np.ndarray:
    table = np.full(256, 9, np.int64)
    for k, chars in ((0, b" \t\n\x0b\x0c\r"), (4, b"."), (5, b",;:"), (6, b"!?"), (7, b"\"'-"), (8, b"()[]{}")):
        table[list(chars)] = k
    table[97:123], table[65:91], table[48:58] = 1, 2, 3
    table[128:192], table[192:] = 11, 10
    return table


CLASS_OF = _classes()
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) < 91), np.arange(256) + 32, np.arange(256)).astype(np.uint64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, x): the text and the encoded input of each passage; every text has at least one."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    start = np.cumsum(sizes) - sizes
    kind = CLASS_OF[raw]
    solid = kind > 0
    first = solid & np.concatenate(([True], ~solid[:-1]))
    words = np.cumsum(first)
    before = words[start] - first[start]  # words of the texts before each one
    counts = np.append(before[1:], words[-1]) - before
    passages = np.maximum(-(-counts // PASSAGE), 1)
    base = np.cumsum(passages) - passages
    # A byte goes with the word that began last, those before all words with the first.
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = base[doc] + np.maximum(words - before[doc] - 1, 0) // PASSAGE
    total = int(passages.sum())

    # White space stands before every text.
    pairs = np.bincount(place * (CLASSES * CLASSES) + np.append(0, kind[:-1]) * CLASSES + kind,
                        minlength=total * CLASSES * CLASSES).reshape(total, -1)
    at = np.flatnonzero(first)
    x = np.zeros((total, WIDTH), np.float32)
    x[:, :CLASSES * CLASSES] = np.sqrt(pairs / np.maximum(pairs.sum(1, keepdims=True), 1))
    if len(at):
        owner = place[at]
        where = np.flatnonzero(solid)
        heads = np.searchsorted(where, at)
        length = np.diff(np.append(heads, len(where)))
        step = np.arange(len(where)) - np.repeat(heads, length)
        power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
        key = np.add.reduceat((LOWER[raw[where]] + np.uint64(1)) * power[step], heads)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        n = np.bincount(owner, minlength=total)
        some = np.maximum(n, 1)[:, None]
        col = CLASSES * CLASSES
        hist = np.bincount(owner * LENGTHS + np.minimum(length, LENGTHS) - 1, minlength=total * LENGTHS)
        x[:, col:col + LENGTHS] = np.sqrt(hist.reshape(total, -1) / some)
        col += LENGTHS
        order = np.lexsort((key, owner))
        o, k = owner[order], key[order]
        new = np.concatenate(([True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])))
        runs = np.diff(np.append(np.flatnonzero(new), len(o)))
        most = np.zeros(total)
        np.maximum.at(most, o[new], runs)
        twice = (owner[1:] == owner[:-1]) & (key[1:] == key[:-1])
        x[:, col] = n / PASSAGE
        x[:, col + 1] = np.bincount(o[new], minlength=total) / some[:, 0]
        x[:, col + 2] = most / some[:, 0]
        x[:, col + 3] = np.bincount(owner[1:][twice], minlength=total) / some[:, 0]
        col += SHAPE
        hist = np.bincount(owner * WORD_BINS + (key % np.uint64(WORD_BINS)).astype(np.int64),
                           minlength=total * WORD_BINS)
        x[:, col:] = np.sqrt(hist.reshape(total, -1) / some)
    return np.repeat(np.arange(len(texts)), passages), x


def pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Lists of (text number, piece) of about SLICE bytes; longer texts are cut after white space."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > SLICE:
                # The last white space of the piece; a longer word is cut where the piece ends.
                end = at + SLICE
                space = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r"))
                end = space + 1 if space > at else end
            owners.append(i)
            parts.append(text[at:end])
            size += end - at
            if size >= SLICE:
                yield owners, parts
                owners, parts, size = [], [], 0
            at = end
            if at >= len(text):
                break
    if parts:
        yield owners, parts


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: The parameters, in the order of one flat vector.
SHAPES = (("W", (WIDTH, CODE)), ("b", (CODE,)), ("T", (CODE, GATE)), ("G", (CODE, GATE)), ("v", (GATE,)),
          ("c", (CODE,)), ("d", (1,)))


def _split(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES:
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


@dataclass(frozen=True)
class AttentionModel:
    """Weights of the encoder, the gate and the score; ``flat`` is None where there was nothing to learn."""

    flat: np.ndarray | None
    centre: np.ndarray
    spread: np.ndarray
    share: float

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(score, passages) of each whole text."""
        count, weight, z = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros((len(texts), CODE))
        p = None if self.flat is None else _split(self.flat)
        for owners, parts in pieces(texts):
            own, x = features(parts)
            own = np.array(owners)[own]
            np.add.at(count, own, 1)
            if p is None:
                continue
            h = np.tanh(((x - self.centre) / self.spread) @ p["W"] + p["b"])
            a = np.exp(np.clip((np.tanh(h @ p["T"]) * _sigmoid(h @ p["G"])) @ p["v"], -50, 50))
            np.add.at(weight, own, a)
            np.add.at(z, own, a[:, None] * h)
        if p is None:
            return np.full(len(texts), self.share), count
        return _sigmoid((z / np.maximum(weight, 1e-300)[:, None]) @ p["c"] + p["d"][0]), count


def fit(owner: np.ndarray, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 120) -> AttentionModel:
    """Learn from passages ``x`` of documents ``owner`` (0, 1, ... ascending) with labels ``y`` by likelihood."""
    n = len(y)
    share = float((y.sum() + 1) / (n + 2)) if n else 0.5
    if not n or y.min() == y.max():
        return AttentionModel(None, np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), share)
    centre = x.mean(0)
    # Rare features are not blown up.
    spread = np.maximum(x.std(0), 0.02).astype(np.float32)
    x = (x - centre) / spread
    edges = np.searchsorted(owner, np.arange(n))
    rng = np.random.default_rng(0)
    start = np.concatenate([(rng.normal(0, 1, shape) / np.sqrt(shape[0]) if name in "WTG" else
                             rng.normal(0, 0.5, shape) if name in "vc" else np.zeros(shape)).ravel()
                            for name, shape in SHAPES])
    per_doc = lambda m: np.add.reduceat(m, edges, axis=0)

    def cost(flat: np.ndarray) -> tuple[float, np.ndarray]:
        p = _split(flat)
        h = np.tanh(x @ p["W"].astype(np.float32) + p["b"]).astype(float)
        t, g = np.tanh(h @ p["T"]), _sigmoid(h @ p["G"])
        e = np.exp(np.clip((t * g) @ p["v"], -50, 50))
        a = e / per_doc(e)[owner]
        z = per_doc(a[:, None] * h)
        q = _sigmoid(z @ p["c"] + p["d"][0])
        loss = -np.mean(np.where(y > 0, np.log(np.maximum(q, 1e-12)), np.log(np.maximum(1 - q, 1e-12))))
        err = (q - y) / n
        dz = (err[:, None] * p["c"])[owner]
        da = (dz * h).sum(1)
        ds = a * (da - per_doc(a * da)[owner])
        dt, dg = ds[:, None] * p["v"] * g * (1 - t * t), ds[:, None] * p["v"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["T"].T + dg @ p["G"].T) * (1 - h * h)
        grads = {"W": x.T @ dh.astype(np.float32), "b": dh.sum(0), "T": h.T @ dt, "G": h.T @ dg,
                 "v": ((t * g) * ds[:, None]).sum(0), "c": z.T @ err, "d": np.array([err.sum()])}
        grad = np.concatenate([np.asarray(grads[name], float).ravel() for name, _ in SHAPES])
        return float(loss + ridge * (flat @ flat) / 2), grad + ridge * flat

    flat = minimise(cost, start, steps)
    return AttentionModel(flat.astype(np.float32), centre.astype(np.float32), spread, share)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
          max_passages: int = MAX_PASSAGES, id_col: str = "doc_id", text_col: str = "text") -> AttentionModel:
    wanted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .dropna().groupBy("doc_id").agg(F.max("y").alias("y")))
    wanted = hash_sample(wanted, "doc_id", max_rows)

    def encode(batches):
        for b in by_bytes(batches, "text", SLICE):
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                some = np.concatenate([features(parts)[1] for _, parts in pieces([text.encode()])])
                if len(some) > max_passages:
                    some = some[np.linspace(0, len(some) - 1, max_passages).astype(int)]
                yield pa.RecordBatch.from_pydict({"y": pa.array([y], pa.int32()),
                                                  "x": pa.array([some.astype("<f2").tobytes()], pa.binary())})

    # At most max_rows ids: within the bound of a broadcast.
    found = id_text(docs, id_col, text_col).join(F.broadcast(wanted), "doc_id")
    found = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")).select("text", "y")
    got = found.mapInArrow(encode, "y int, x binary").collect()
    got.sort(key=lambda r: bytes(r["x"]))
    if not got:
        return fit(np.zeros(0, int), np.zeros((0, WIDTH), np.float32), np.zeros(0))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), "<f2").reshape(-1, WIDTH).astype(np.float32)
    owner = np.repeat(np.arange(len(got)), [len(r["x"]) // (2 * WIDTH) for r in got])
    return fit(owner, x, np.array([float(r["y"] > 0) for r in got]))


def scores(model: AttentionModel, text: Column | str) -> Column:
    """A struct (score, n_passages) for each whole text."""

    @F.arrow_udf(RESULT)
    def score(texts: pa.Array) -> pa.Array:
        out, size = [], pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(size) // SLICE
        edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(texts)])).astype(int)
        for a, b in zip(edges[:-1], edges[1:]):
            some = [(t or "").encode() for t in texts.slice(a, b - a).to_pylist()]
            out.append(model.scores(some))
        score, count = (np.concatenate(v) for v in zip(*out))
        return pa.StructArray.from_arrays([pa.array(score.astype(float)), pa.array(count.astype(np.int32))],
                                          names=["score", "n_passages"])

    return score(F.col(text) if isinstance(text, str) else text)
