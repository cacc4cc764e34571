"""Vectorised use of a public tokenizer file: each distinct piece of a batch is encoded once.

A byte-level BPE never merges across the pieces that its pattern cuts. The cuts are found on whole batches of UTF-8
bytes from the class of each character (letter, number, white space, other); distinct pieces are encoded by the
tokenizers library, and the ids are put back together. Texts with characters outside KNOWN, whose classes differ between
versions of Unicode, or with the text of a special token are encoded whole by the library. Null text is empty text.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
CACHE_PIECES = 200_000  # bound of a worker's memory of encoded pieces,
CACHE_PIECE_BYTES = 64  # none of which is longer
JOINED = 48  # new pieces that are encoded as one text; the library's time grows faster than a text's length
SLICE_BYTES = 2 << 20  # of text that is encoded at once; a longer text is alone
#: Code points whose classes have been the same in every version of Unicode of this century.
KNOWN = ((0, 0x250), (0x2010, 0x2040))
SPACE_MARK = "\u0120"  # stands for a space in vocabularies of bytes
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
#: Endings that the pattern cuts off at an apostrophe.
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")
_MADE: dict[str, TokenEncoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, UNKNOWN, np.uint8)
    for low, high in KNOWN:
        for c in range(low, high):
            ch = chr(c)
            out[c] = LETTER if regex.match(r"\p{L}", ch) else NUMBER if regex.match(r"\p{N}", ch) else SPACE if regex.match(r"\s", ch) else OTHER
    return out


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes, or of a single longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).tolist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size + 1
    if start < len(sizes):
        yield start, len(sizes)


class TokenEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that start with a space
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t[0] == SPACE_MARK]] = True
        self.special = "|".join(regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.classes = _classes()
        self.pieces: dict[bytes, int] = {}  # number of each piece in memory
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    @classmethod
    def of(cls, path: str) -> TokenEncoder:
        """One per worker process and file."""
        if path not in _MADE:
            _MADE[path] = cls(path)
        return _MADE[path]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per piece, all ids): pieces that start with their only space stay apart when they are joined, so they are
        encoded JOINED at a time; each begins at the one id that stands for a space and more."""
        counts, ids = [], []
        for at in range(0, len(pieces), JOINED):
            own = pieces[at : at + JOINED]
            if all(p[0] == 32 and len(p) > 1 and p[1] != 32 and p[1] < 128 for p in own):
                found = np.array(self._whole([b"".join(own).decode()])[0], self.dtype)
                first = np.flatnonzero(self.spaced[found])
                if len(first) == len(own):
                    counts.append(np.diff(np.append(first, len(found))))
                    ids.append(found)
                    continue
            each = self._whole([p.decode() for p in own])
            counts.append(np.fromiter(map(len, each), np.int64, len(each)))
            ids.append(np.fromiter(chain.from_iterable(each), self.dtype))
        return np.concatenate(counts), np.concatenate(ids)

    def _look_up(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, ids per piece, ids that starts point into)."""
        known = self.pieces
        row = np.array(list(map(known.get, pieces, repeat(-1))), np.int64)
        new = np.flatnonzero(row < 0)
        if not len(new):
            return self.start[row], self.size[row], self.ids
        order = sorted(new.tolist(), key=lambda i: pieces[i][0] != 32 or not 32 < pieces[i][1:2].ljust(1)[0] < 128)
        counts, fresh = self._fresh([pieces[i] for i in order])
        ids = np.concatenate((self.ids, fresh))
        start, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        old = row >= 0
        start[old], size[old] = self.start[row[old]], self.size[row[old]]
        start[order], size[order] = len(self.ids) + np.cumsum(counts) - counts, counts
        kept = [i for i in order[: CACHE_PIECES - len(known)] if len(pieces[i]) <= CACHE_PIECE_BYTES]
        if kept:
            known.update(zip([pieces[i] for i in kept], range(len(known), len(known) + len(kept)), strict=True))
            self.ids, self.start, self.size = ids, np.concatenate((self.start, start[kept])), np.concatenate((self.size, size[kept]))
        return start, size, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids in order)."""
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, self.dtype)
        texts = texts.fill_null("").cast(pa.large_string())
        gc.disable()  # many short-lived lists without cycles
        try:
            parts = [self._encode(texts.slice(a, b - a)) for a, b in slices(texts)]
        finally:
            gc.enable()
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, ends, odd = self._readable(texts)
        whole = {}
        if len(odd):
            whole = dict(zip(odd.tolist(), self._whole(texts.take(pa.array(odd)).to_pylist()), strict=True))
            mask = np.zeros(len(texts), bool)
            mask[odd] = True
            data, ends, _ = self._readable(pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), texts))
        counts, ids = self._from_pieces(data, ends)
        if whole:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, own in whole.items():
                parts[i] = np.array(own, self.dtype)
            counts, ids = np.fromiter(map(len, parts), np.int64, len(parts)), np.concatenate(parts)
        return counts, ids

    def _readable(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
        """((bytes, class of each byte's character), end of each text, texts that pieces can't be trusted for)."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) if buffer is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        ends = offsets[1:] - offsets[0]
        kind = self.classes[:256][data]
        lead = np.flatnonzero(data >= 0xC0)
        odd = np.zeros(len(texts), bool)
        if len(lead):
            first = data[lead].astype(np.int32)
            size = 2 + (first >= 0xE0) + (first >= 0xF0)
            code = first & (0xFF >> (size + 1))
            for k in range(1, 4):
                more = size > k
                code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
            own = self.classes[code]
            for k in range(4):
                part = size > k
                kind[lead[part] + k] = own[part]
            odd[np.searchsorted(ends, lead[own == UNKNOWN], "right")] = True
        if self.special:
            odd |= np.asarray(pc.match_substring_regex(texts, self.special))
        return (data, kind), ends, np.flatnonzero(odd)

    def _from_pieces(self, readable: tuple[np.ndarray, np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, kind = readable
        if not len(data):
            return np.zeros(len(ends), np.int64), np.zeros(0, self.dtype)
        at = _piece_starts(data, kind, ends)
        offsets = np.append(at, len(data))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        start, size, held = self._look_up(pieces.dictionary.to_pylist())
        used = pieces.indices.to_numpy()
        run = size[used]
        stop = np.cumsum(run)
        ids = held[np.repeat(start[used] - (stop - run), run) + np.arange(stop[-1])]
        before = np.concatenate(([0], stop))[np.searchsorted(at, ends)]
        return np.diff(before, prepend=0), ids


def _piece_starts(data: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pattern's pieces start: at each change of class, or at the single space before it; white space of
    several characters keeps its last one for the piece that follows."""
    n = len(data)
    head = np.zeros(n + 1, bool)  # of a text
    head[0] = True
    head[ends] = True
    change = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change |= head
    start = change[:n].copy()
    blank = kind == SPACE
    joins = np.flatnonzero((data[:-1] == 32) & ~blank[1:] & ~head[1:n])  # spaces that belong to what follows
    start[joins + 1] = False
    start[joins] = True
    gaps = np.flatnonzero(blank[:-1] & ~blank[1:] & ~head[1:n] & (data[:-1] != 32))  # the last other white space before a word
    while len(gaps):  # its character's first byte
        inner = (data[gaps] & 0xC0) == 0x80
        start[gaps[~inner]] = True
        gaps = gaps[inner] - 1
    quote = np.flatnonzero(data[:-1] == 39)
    quote = quote[change[quote]]
    quote = quote[head[quote] | (data[quote - 1] != 32)]
    for ending in _ENDINGS:
        size, own = len(ending), quote
        for k in range(size):
            inside = own + 1 + k < n
            own = own[inside]
            own = own[(data[own + 1 + k] == ending[k]) & ~head[own + 1 + k]]
        start[own] = True
        start[own + 1] = False
        after = own + 1 + size
        after = after[after < n]
        start[after[~((data[after] == 32) | blank[after])]] = True
    return np.flatnonzero(start)
