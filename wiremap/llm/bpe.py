"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

Each task cuts its texts into pattern matches (words), block by block: a block
row holds the distinct words of up to ``BLOCK_BYTES`` of text and, for each document,
the numbers of its words.  Nothing is shuffled, and a word is encoded once for
each block.  A word is an array of one-byte strings (its bytes read as
Latin-1).  ``aggregate`` folds the merges over it: the state holds the pieces
and the rank of each neighbouring pair; a step joins the first pair of the
lowest rank and looks up the two pairs beside it.  Ranks come from one literal:
an array of small maps, indexed by a hash of the piece, because a lookup in
one of Spark's maps reads its entries in order.  A word that has a rank itself
is that one id.  Ids of a document are gathered from its block's words;
decoding concatenates the ids' binary pieces.

Defined cases: null and empty texts give no ids; every row is encoded, also
repeated ones and rows with a null id; an empty table gives no rows.  The cost
of a single word grows with the square of its length, so words beyond
``LONG_WORD`` bytes are folded in rounds, which join all pairs of the lowest
rank at once.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremap.llm.common import by_bytes, id_text, stored

BUCKETS = 1 << 16
NONE = 1 << 30
BLOCK_BYTES = 160 << 20
TASK_BYTES = 96 << 20
LONG_WORD = 200
BLOCK = "docs array<long>, codes array<binary>, words array<binary>"
ENCODED = "doc_id long, ids binary, decoded binary"
#: What the pattern's ``\s`` means to the reference library: Unicode White_Space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BARE = "\x1f"


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 piece and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The ranks as a constant array of maps; Spark folds it once per plan."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    pieces = spark.createDataFrame([(p.decode("latin-1"), r) for p, r in ranks.items()], "p string, r int")
    for bucket, piece, rank in pieces.select(F.pmod(F.hash("p"), F.lit(BUCKETS)), "p", "r").collect():
        buckets[bucket][piece] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_word(word: Column, ranks: Column) -> Column:
    """The ids (array<int>) of one binary word."""

    def rank(piece: Column) -> Column:
        bucket = F.get(ranks, F.pmod(F.hash(piece), F.lit(BUCKETS)))
        return F.coalesce(F.element_at(bucket, piece), F.lit(NONE))

    def pair_ranks(pieces: Column) -> Column:
        return F.when(F.size(pieces) < 2, F.array().cast("array<int>")).otherwise(
            F.zip_with(F.slice(pieces, F.lit(1), F.size(pieces) - 1),
                       F.slice(pieces, F.lit(2), F.size(pieces) - 1),
                       lambda a, b: rank(F.concat(a, b))))

    def state(pieces: Column, pairs: Column, at: Column) -> Column:
        return F.struct(pieces.alias("p"), pairs.alias("r"), at.alias("at"))

    none = F.array().cast("array<int>")

    def step(acc: Column, _: Column) -> Column:
        """Find the first pair of the lowest rank (at), or join the pair found.

        Two plain steps, as a nested function would copy the state each time.
        """
        p, r, at, n = acc["p"], acc["r"], acc["at"], F.size(acc["p"])
        low = F.array_min(r)
        found = F.when(low < NONE, F.array_position(r, low).cast("int")).otherwise(-1)
        piece = F.concat(F.get(p, at - 1), F.get(p, at))
        left = F.when(at > 1, F.array(rank(F.concat(F.get(p, at - 2), piece)))).otherwise(none)
        right = F.when(at + 1 < n, F.array(rank(F.concat(piece, F.get(p, at + 1))))).otherwise(none)
        pieces = F.concat(F.slice(p, F.lit(1), at - 1), F.array(piece), F.slice(p, at + 2, n))
        pairs = F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right,
                         F.slice(r, at + 2, n))
        return F.when(at < 0, acc).when(at == 0, state(p, r, found)).otherwise(
            state(pieces, pairs, F.lit(0)))

    def join_all(acc: Column, low: Column) -> Column:
        """Join every pair of this rank, from the left, without overlaps."""
        r, p, n = acc["r"], acc["p"], F.size(acc["p"])
        # The number of such pairs right before each place: odd ones overlap.
        runs = F.aggregate(r, F.array().cast("array<int>"), lambda a, x: F.concat(a, F.array(
            F.when(x == low, F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + 1).otherwise(0))))

        def joined(run: Column) -> Column:
            pieces = F.filter(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(
                F.coalesce(F.get(run, i), F.lit(0)) % 2 == 1, F.concat(F.get(p, i), F.get(p, i + 1))).when(
                    (i > 0) & (F.coalesce(F.get(run, i - 1), F.lit(0)) % 2 == 1), F.lit(None)).otherwise(
                        F.get(p, i))), lambda x: x.isNotNull())
            return _let(pieces, lambda q: state(q, pair_ranks(q), F.lit(0)))

        return _let(runs, joined)

    def round_(acc: Column, _: Column) -> Column:
        return _let(F.array_min(acc["r"]), lambda low: F.when(
            F.coalesce(low, F.lit(NONE)) == NONE, acc).otherwise(join_all(acc, low)))

    def fold(text: Column) -> Column:
        start = _let(F.split(text, ""), lambda p: state(p, pair_ranks(p), F.lit(0)))
        steps = F.greatest(F.length(text) - 1, F.lit(1))
        done = F.when(F.length(text) <= LONG_WORD, F.aggregate(F.sequence(F.lit(1), 2 * steps), start, step)).otherwise(
            F.aggregate(F.sequence(F.lit(1), steps), start, round_))
        return F.transform(done["p"], rank)

    return _let(F.decode(word, "ISO-8859-1"), lambda text: _let(rank(text), lambda whole: F.when(
        whole < NONE, F.array(whole)).otherwise(fold(text))))


class _Words:
    """The distinct words of a block and the numbers of each text's words."""

    def __init__(self, pattern: str):
        import regex
        spaced = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
        self.find = regex.compile(spaced.replace(r"\s", f"[{SPACE}]")).findall
        self.number: dict[str, int] = {}
        self.codes: list[bytes] = []
        self.pack = zstandard.ZstdCompressor(level=1).compress

    def _numbers(self, text: str) -> list[int]:
        number = self.number
        return [number.setdefault(w, len(number)) for w in self.find(text)]

    def add(self, texts: pa.Array) -> None:
        """Numbers of whole texts; plain texts by their distinct space-cut pieces.

        A match of the pattern never spans a single space or newline between
        two other characters: a space begins a match, a newline is one.
        """
        from wiremap.llm.tokens import ODD
        odd = np.asarray(pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False), bool)
        out: list = [None] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            some = pc.replace_substring(texts.take(pa.array(plain)).cast(pa.large_string()),
                                        "\n", f" {BARE}\n {BARE}")
            cut = pc.split_pattern(pc.binary_join_element_wise(
                pa.scalar(BARE, pa.large_string()), some, pa.scalar("", pa.large_string())), " ")
            pieces = cut.flatten().dictionary_encode()
            parts = [self._numbers(p[1:] if p[:1] == BARE else " " + p)
                     for p in pieces.dictionary.to_pylist()]
            sizes = np.array([len(p) for p in parts], np.int64)
            pool = np.fromiter((x for p in parts for x in p), np.uint32, int(sizes.sum()))
            starts, at = np.cumsum(sizes) - sizes, np.asarray(pieces.indices)
            n = sizes[at]
            ends = np.cumsum(n)
            flat = pool[np.repeat(starts[at] - ends + n, n) + np.arange(int(n.sum()))]
            offsets = np.asarray(cut.offsets)
            bounds = np.concatenate(([0], ends))[offsets - offsets[0]]
            for i, a, b in zip(plain, bounds[:-1], bounds[1:]):
                out[i] = flat[a:b]
        for i, x in enumerate(out):
            if x is None:
                x = np.array(self._numbers(texts[i].as_py()), np.uint32)
            low, high = (x & 0xFFFF).astype("<u2"), (x >> 16).astype("<u2")
            self.codes.append(self.pack(low.tobytes() + high.tobytes()))


def word_blocks(docs: DataFrame, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Block rows (``BLOCK``) of a (doc_id, text) table."""

    def run(batches):
        words, ids, size = _Words(pattern), [], 0

        def flush():
            kinds = (pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()))
            values = (ids, words.codes, [w.encode() for w in words.number])
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              names=["docs", "codes", "words"])

        for b in by_bytes(batches, "text", 4 << 20):
            words.add(b.column("text"))
            ids += b.column("doc_id").to_pylist()
            size += b.column("text").nbytes
            if size >= block_bytes:
                yield flush()
                words, ids, size = _Words(pattern), [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, BLOCK)


def large_tasks(docs: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Fewer and larger tasks where the scan's are small: a word is encoded once a block.

    About ``task_bytes`` of input each, in whole rounds of the cluster's cores.
    """
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = max(1, spark.sparkContext.defaultParallelism)
    tasks = max(1, -(-size // task_bytes // cores) * cores or cores)
    return docs.coalesce(min(tasks, 1 << 30))


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    n = sizes[at]
    return values[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Each row's ids (little-endian uint32) and the bytes decoded from them."""
    ranks = load_ranks(rank_file)
    literal = rank_literal(docs.sparkSession, ranks)
    blocks = stored(word_blocks(id_text(large_tasks(docs), id_col, text_col), pattern), "word-blocks")
    blocks = blocks.select("docs", "codes", F.transform(
        "words", lambda w: encode_word(w, literal)).alias("ids"))

    def assemble(batches):
        table = load_ranks(rank_file)
        size = max(table.values()) + 1
        pieces = [b""] * size
        for p, r in table.items():
            pieces[r] = p
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts, joined = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(pieces), np.uint8)
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for row in range(b.num_rows):
                own = b.column("ids")[row].values
                flat = own.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
                n = np.diff(np.asarray(own.offsets)).astype(np.int64)
                first = np.cumsum(n) - n
                out: tuple[list, list, list] = ([], [], [])
                held = 0
                for doc, code in zip(b.column("docs")[row].values, b.column("codes")[row].values):
                    raw = np.frombuffer(unpack(code.as_py()), "<u2").astype(np.int64).reshape(2, -1)
                    ids = _gather(flat, first, n, raw[0] | raw[1] << 16)
                    for o, v in zip(out, (doc.as_py(), ids.astype("<u4").tobytes(),
                                          _gather(joined, starts, lengths, ids.astype(np.int64)).tobytes())):
                        o.append(v)
                    held += len(ids)
                    if held > 1 << 20:
                        yield _encoded(out)
                        out, held = ([], [], []), 0
                if out[0]:
                    yield _encoded(out)

    return blocks.mapInArrow(assemble, ENCODED)


def _encoded(columns) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["doc_id", "ids", "decoded"])
