"""Token operators against the libraries that define their results."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from wiremap.llm import bpe, elias_fano, packing, token_files
from wiremap.llm.tokens import WordEncoder
from wiremap.session import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [" ", " ", "\n", "\t", "\x1d", "\r", "a", "b", "'s", "ä", "1", ".", "日本", " ", "<|endoftext|>", "\x85", " \n",
          "_", "x" * 70, "'", "½", "²", "①", "\x1f", "the", "The"]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(JSON)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_word_encoder_on_text_of_the_corpus(library):
    import duckdb
    some = [t or "" for (t,) in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    e = WordEncoder(JSON, max_pieces=20_000)
    for i in range(0, len(some), 100):
        part = some[i:i + 100]
        for text, ids in zip(part, e.encode(pa.array(part))):
            assert ids.tolist() == library(text), text


def test_word_encoder_equals_whole_texts(library):
    some = texts(3000, 1)
    small = WordEncoder(JSON, max_pieces=50)      # its tables overflow all the time
    for e in (WordEncoder(JSON), small):
        for i in range(0, len(some), 500):
            part = some[i:i + 500]
            assert [x.tolist() for x in e.encode(pa.array(part, pa.string()))] == [library(t) for t in part]


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (1, 1 << 40), (5, 2), (1000, 10), (3000, 1 << 45), (200, 200)):
        v = np.sort(rng.integers(0, top, n).astype(np.uint64))
        data = b"??" + elias_fano.encode(v) + b"tail"
        f = elias_fano.EliasFano(data, 2)
        assert f.size == len(data) - 6 and f.values().tolist() == v.tolist()
        assert [f[i] for i in range(0, n, 7)] == v[::7].tolist()
    dense = np.arange(100_000) * 37
    assert len(elias_fano.encode(dense)) * 8 / len(dense) < 2 + np.log2(37) + 1.5
    with pytest.raises(ValueError):
        elias_fano.encode(np.array([2, 1]))


def test_token_files(spark, odd, none, library):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    path = scratch_path(spark, "files")
    manifest = token_files.write_token_files(odd, path, JSON, end_id=2, file_tokens=50)
    assert manifest.count() > 4
    out = token_files.read_token_files(spark, path).collect()
    got = collections.Counter((r.doc_id, bytes(r.ids)) for r in out)
    assert got == collections.Counter((i, np.array(library(t) + [2], "<u4").tobytes()) for i, t in rows)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    known = [i for i in ids if i is not None]
    assert ids == [None] * (len(ids) - len(known)) + sorted(known)
    empty = scratch_path(spark, "files")
    token_files.write_token_files(none, empty, JSON)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_select_in_a_token_file():
    ids = [np.arange(n, dtype=np.uint32) for n in (3, 1, 500)]
    f = token_files.TokenFile(token_files.pack_file(7, 11, [None, 5, 9], ids, 2))
    assert [f.doc_id(i) for i in range(3)] == [None, 5, 9] and f.before == 11
    assert all(f.ids(i).tolist() == x.tolist() for i, x in enumerate(ids))


@pytest.mark.parametrize("length", [1024, 7])
def test_packing(spark, odd, library, length):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    pieces = packing.pack(packing.token_table(odd, JSON, end_id=0), length).cache()
    got = pieces.collect()
    total = sum(len(library(t)) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total
    by_seq = collections.defaultdict(list)
    for r in got:
        by_seq[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    assert sorted(by_seq) == list(range(-(-total // length)))
    for s, rs in by_seq.items():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == (length if s < total // length else total % length)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces).collect()}
    rest = total % length
    assert all(len(x) == 4 * length for s, x in whole.items() if s < total // length)
    if rest:
        assert len(whole[total // length]) == 4 * (rest if rest & (rest - 1) == 0 else length)
    docs = collections.Counter((i, np.array(library(t) + [0], "<u4").tobytes()) for i, t in rows)
    unique = {i: x for (i, x), n in docs.items() if n == 1 and [k[0] for k in docs].count(i) == 1}
    for i, x in unique.items():
        own = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == i)
        assert b"".join(p for _, p in own) == x and zlib.crc32(x) == zlib.crc32(b"".join(p for _, p in own))


def test_packing_of_nothing(spark, none):
    assert packing.pack(packing.token_table(none, JSON)).count() == 0


def test_bpe_equals_library(spark, odd, none):
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS),
                          special_tokens={})
    rng = random.Random(5)
    rows = list(enumerate(texts(300, 2))) + [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(1, "".join(rng.choice("etaoinshr") for _ in range(900))), (2, "ab" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = collections.Counter((i, np.array(e.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())
                               for i, t in rows)
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out) == want
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
