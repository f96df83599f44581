"""Byte-level BPE ids through the ``tokenizers`` library, piece by piece.

The library needs most of a microsecond per byte of running text; nearly all
words of a corpus repeat.  ``WordEncoder`` cuts texts at places where the
library's own pre-tokenizer cuts too, lets the library encode each distinct
piece, and gathers the pieces' ids.  The result equals encoding whole texts
(tests compare both on random texts).

Where the byte-level pre-tokenizer surely cuts
(``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|\\s+(?!\\S)|\\s+``):

* before a single space between two non-spaces: the space starts a match;
* on both sides of a single newline between two non-spaces;
* between a letter or digit and the punctuation that ends a piece.

Texts that hold an added token of the vocabulary (``<|endoftext|>``) are encoded
whole, so it gets its own id as in the library.  Texts with runs of white space,
or with the four separators that Python calls
white space and the library doesn't, are cut by a slower rule or not at all.
"""

from __future__ import annotations

import re
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ODD = r"[\s\p{Z}\x{85}]{2}|[\x1c-\x1f]"
RUNS = re.compile(r"(\s{2,})")
SEPARATOR = re.compile("[\x1c-\x1f]")
#: Punctuation that may end a piece; an apostrophe may begin a contraction.
ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Marks a piece that no space precedes.
BARE = "\x1f"
LONG = 64
#: Pieces that the library encodes as one text.
JOINED = 4096
#: Known pieces (each half of the table) and bytes of text that are cut into pieces at once.
MAX_PIECES, SLICE = 500_000, 8 << 20


class WordEncoder:
    """``encode(texts)``: the ids of each whole text as an array of uint32.

    ``max_pieces`` bounds each half of the table of known pieces; which are
    known changes the time, never the ids.
    """

    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        # Strings that the library takes as one token wherever they stand.
        self.added = [t.content for t in tok.get_added_tokens_decoder().values() if t.content]
        self.max_pieces = max_pieces
        self.batch = lambda texts: tok.encode_batch_fast(texts, add_special_tokens=False)
        (self.newline,) = self.batch(["\n"])[0].ids
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.batch([text])[0].ids
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if not len(texts):
            return []
        holds = lambda mask: np.asarray(mask.to_numpy(zero_copy_only=False), bool)
        odd = holds(pc.match_substring_regex(texts, ODD))
        out: list = [None] * len(texts)
        for token in self.added:
            some = holds(pc.match_substring(texts, token))
            odd |= some
            for i in np.flatnonzero(some):
                out[i] = np.frombuffer(self.whole(texts[i].as_py()), "<u4")
        plain = np.flatnonzero(~odd)
        if len(plain):
            for i, ids in zip(plain, self._plain(texts.take(pa.array(plain)))):
                out[i] = ids
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = np.frombuffer(self._odd(texts[i].as_py()), "<u4")
        return out

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.replace_substring(texts.cast(pa.large_string()), "\n", f" {BARE}\n {BARE}")
        cut = pc.split_pattern(pc.binary_join_element_wise(
            pa.scalar(BARE, pa.large_string()), texts, pa.scalar("", pa.large_string())), " ")
        pieces = cut.flatten().dictionary_encode()
        parts = self._ids(pieces.dictionary.to_pylist())
        sizes = np.array([len(p) for p in parts], np.int64) // 4
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(parts), "<u4")
        word = np.asarray(pieces.indices)
        n = sizes[word]
        ends = np.cumsum(n)
        ids = pool[np.repeat(starts[word] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.asarray(cut.offsets)
        bounds = np.concatenate(([0], ends))[offsets - offsets[0]]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.max_pieces:
            self.old, self.known = self.known, {}
        out = list(map(self.known.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            once = self._learn([pieces[i] for i in missing])
            for i in missing:
                out[i] = self.known[pieces[i]]
            for p in once:
                del self.known[p]
        return out

    def _learn(self, new: list[str]) -> list[str]:
        """Make pieces known; returns those too long to be kept."""
        known = self.known
        cut, heads, tails, rest = [], [], [], []
        for p in self._recall(new):
            head = p.rstrip(ENDS) if len(p) <= LONG else p
            if len(head) < len(p) and head[-1:].isalnum():
                cut.append(p)
                heads.append(head)
                tails.append(BARE + p[len(head):])
            else:
                rest.append(p)
        cores = self._recall(dict.fromkeys([*heads, *tails, *rest]))
        text = lambda p: p[1:] if p[:1] == BARE else " " + p
        # Pieces that end in white space, or are nothing else, would run into a newline.
        own = [p for p in cores if not (q := p.removeprefix(BARE)) or q[0].isspace() or q[-1].isspace()]
        got = self.batch([text(p) for p in own])
        known.update(zip(own, [pack(f"<{len(e)}I", *e.ids) for e in got]))
        if own:
            alone = set(own)
            cores = [p for p in cores if p not in alone]
        for i in range(0, len(cores), JOINED):
            part = cores[i:i + JOINED]
            known.update(zip(part, self._joined([text(p) for p in part])))
        for p, head, tail in zip(cut, heads, tails):
            known[p] = known[head] + known[tail]
        return [p for p in [*own, *cores] if len(p) > LONG]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """The ids of many pieces from one text with newlines between them.

        A newline between two non-spaces, or before a space and a non-space, is a match of its
        own, and no piece here holds one or begins or ends with other white space.
        """
        ids = np.array(self.batch(["\n".join(pieces)])[0].ids, "<u4")
        ends = np.append(np.flatnonzero(ids == self.newline), len(ids))
        raw, a, out = ids.tobytes(), 0, []
        for b in (4 * ends).tolist():
            out.append(raw[a:b])
            a = b + 4
        return out

    def _recall(self, pieces) -> list[str]:
        """The pieces not known yet, after taking back what the old half knows."""
        known, old = self.known, self.old
        new = [p for p in pieces if p not in known]
        if not old:
            return new
        known.update([(p, old[p]) for p in new if p in old])
        return [p for p in new if p not in old]

    def _odd(self, text: str) -> bytes:
        """Runs of two or more: all but the last character are one match if the
        text goes on; a last character that is a space starts the next match."""
        if SEPARATOR.search(text):
            return self.whole(text)
        out, lead, parts = [], BARE, RUNS.split(text)
        for i in range(0, len(parts), 2):
            seg, run = parts[i], parts[i + 1] if i + 1 < len(parts) else ""
            if seg:
                cut = (lead + seg.replace("\n", f" {BARE}\n {BARE}")).split(" ")
                out += self._ids(cut)
            lead = BARE
            if run and i + 2 < len(parts) and parts[i + 2]:
                out.append(self.whole(run[:-1]))
                if run[-1] == " ":
                    lead = ""
                else:
                    out.append(self.whole(run[-1]))
            elif run:
                out.append(self.whole(run))
        return b"".join(out)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, max_pieces: int = MAX_PIECES) -> WordEncoder:
    """One encoder for each Python worker, kept between its tasks."""
    key = path, max_pieces
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, max_pieces)
    return _ENCODERS[key]
