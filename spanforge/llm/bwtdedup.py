"""Exact substring dedup over bytes, by column-wise multi-document construction of a collection's BWT.

Windows of WINDOW bytes that share a minimiser travel as one string to its bucket. A window holds at least half of its
other bytes on one side of the minimiser, so a first exchange of the hashes of the minimiser with that many bytes before
it, and after it, drops strings both of whose sides occur once in the corpus: they can't hold a repeated window. Equal strings of a chunk
travel once, with a count. A bucket cuts its strings into words of WORD bytes, aligned at the minimiser so that equal
windows are cut alike, and builds the Burrows-Wheeler transform of the collection column by column: each round inserts
one word of every string that has any left, at its LF position, and updates the common-prefix array. Columns and the
two growing arrays lie in sequential temporary files, read and written once per round. Runs of rows with a long common
prefix are the repeats; windows that end inside a word are confirmed on the bytes around the common words.

Null text is empty. Every row counts as a text of its own, with or without an id, repeated or not.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from spanforge.llm import chunks as C

WINDOW, MINIMISER, WORD = 200, 16, 8
BLOB = "bucket int, chunk int, hashes binary, counts binary, shape binary, bytes binary"
HASHES = "bucket int, chunk int, hashes binary, many binary"
BLOCK = 64
COLLECTION_BYTES = 2 << 20
BUCKET_CHUNKS = 4  # chunks for each bucket: where buckets are many, a chunk's strings for one get few and compress badly


def document_runs(data: np.ndarray, window: int, minimiser: int) -> list[tuple[int, int, int, int, int, int]]:
    """(first window, windows, minimiser hash, minimiser offset from the first window, hash of the minimiser and the
    bytes before it, and after it; 0 where the string has too few)."""
    if len(data) < window:
        return []
    h, down = C.prefix_hash(data), C.powers(len(data))[1]
    least = C.mix((h[minimiser:] - h[:-minimiser]) * down[: len(h) - minimiser])
    first, last, at = C.minimiser_runs(least, window - minimiser + 1)
    before = (window - minimiser) // 2
    after = window - minimiser - before + 1
    a, b = np.maximum(at - before, 0), np.minimum(at + minimiser + after, len(data))
    left = np.where(at - first >= before, C.mix((h[at + minimiser] - h[a]) * down[a]), np.uint64(0))
    right = np.where(last + window - 1 - at - minimiser >= after, C.mix((h[b] - h[at]) * down[at] + np.uint64(1)), np.uint64(0))
    return list(zip(first.tolist(), (last - first).tolist(), least[at].tolist(), (at - first).tolist(), left.tolist(), right.tolist(), strict=True))


class Collection:
    """Strings of words, and the transform of all their suffixes, grown by one word per string and round."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.n, self.lengths = len(lengths), lengths
        self.first = np.cumsum(lengths) - lengths
        self.symbols = symbols  # 1.. ; 0 ends a string

    def build(self) -> tuple[np.ndarray, np.ndarray]:
        """(word index of each suffix in sorted order, common prefix in words with the suffix before)."""
        with tempfile.TemporaryFile() as columns, tempfile.TemporaryFile() as one, tempfile.TemporaryFile() as two:
            rounds = self._spool(columns)
            return self._rounds(columns, rounds, [one, two])

    def _spool(self, columns) -> int:
        """Write column r of the collection: the word that is r from the end, of every string that has one."""
        rounds = int(self.lengths.max()) if self.n else 0
        for r in range(rounds):
            live = np.flatnonzero(self.lengths > r)
            self.symbols[self.first[live] + self.lengths[live] - 1 - r].astype("<i4").tofile(columns)
        columns.flush()
        columns.seek(0)
        return rounds

    def _rounds(self, columns, rounds: int, files: list) -> tuple[np.ndarray, np.ndarray]:
        live = np.arange(self.n)  # strings in the order of their newest suffix's row
        row = np.arange(self.n)
        column = self._column(columns, 0, rounds)
        bwt, lcp = column.copy(), np.zeros(self.n, np.int16)
        origin = np.full(self.n, -1, np.int64)
        for r in range(rounds):
            self._write(files[r & 1], bwt, lcp, origin)
            bwt, lcp, origin = self._read(files[r & 1], len(bwt))
            go = bwt[row] > 0
            live, row = live[go], row[go]
            held = np.flatnonzero(bwt > 0)
            order = np.argsort((bwt[held].astype(np.int64) << 32) | held)  # the LF mapping of the whole transform
            source = held[order]
            rank = np.empty(len(bwt), np.int64)
            rank[source] = np.arange(len(source))
            new = self.n + rank[row]
            by_row = np.argsort(new)
            live, new = live[by_row], new[by_row]
            symbol = self._column(columns, r + 1, rounds)
            fresh = symbol[live]
            starts = bwt[source]  # first word of every suffix but the empty ones, in row order
            grown = self._insert(lcp, new, 0)
            self._update(grown, lcp, np.unique(np.concatenate((new, new[new + 1 < len(grown)] + 1))) - self.n, source, starts)
            bwt, lcp = self._insert(bwt, new, fresh), grown
            origin = self._insert(origin, new, self.first[live] + self.lengths[live] - 1 - r)
            row = new
        keep = origin >= 0
        return origin[keep], lcp[keep].astype(np.int64)

    def _column(self, columns, r: int, rounds: int) -> np.ndarray:
        """The column by string; 0 where a string has no word left."""
        out = np.zeros(self.n, np.int32)
        if r < rounds:
            has = np.flatnonzero(self.lengths > r)
            out[has] = np.fromfile(columns, "<i4", len(has))
        return out

    @staticmethod
    def _write(file, *arrays: np.ndarray) -> None:
        file.seek(0)
        for a in arrays:
            a.tofile(file)
        file.flush()
        file.seek(0)

    @staticmethod
    def _read(file, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.fromfile(file, np.int32, n), np.fromfile(file, np.int16, n), np.fromfile(file, np.int64, n)

    @staticmethod
    def _insert(old: np.ndarray, at: np.ndarray, values) -> np.ndarray:
        out = np.empty(len(old) + len(at), old.dtype)
        kept = np.ones(len(out), bool)
        kept[at] = False
        out[at] = values
        out[kept] = old
        return out

    def _update(self, lcp: np.ndarray, old: np.ndarray, ranks: np.ndarray, source: np.ndarray, starts: np.ndarray) -> None:
        """Common prefixes of rows beside an inserted one: one word more than the least between the rows they extend."""
        ranks = ranks[ranks > 0]
        same = starts[ranks] == starts[ranks - 1]
        lcp[self.n + ranks[~same]] = 0
        ranks = ranks[same]
        lcp[self.n + ranks] = 1 + _range_min(old, source[ranks - 1] + 1, source[ranks])
        if len(lcp) > self.n:
            lcp[self.n] = 0


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low..high]``, both included: ends by BLOCK-wide gathers, the middle by a sparse table of blocks."""
    n = len(values)
    top = np.iinfo(values.dtype).max
    blocks = -(-n // BLOCK)
    padded = np.concatenate((values, np.full(blocks * BLOCK - n, top, values.dtype))).reshape(blocks, BLOCK)
    lo_b, hi_b = low // BLOCK, high // BLOCK
    columns = np.arange(BLOCK)
    left = np.where((columns >= (low % BLOCK)[:, None]) & (columns <= np.where(lo_b == hi_b, high % BLOCK, BLOCK)[:, None]), padded[lo_b], top).min(1)
    right = np.where(columns <= (high % BLOCK)[:, None], padded[hi_b], top).min(1)
    out = np.where(lo_b == hi_b, left, np.minimum(left, right))
    level = padded.min(1)
    a, b = lo_b + 1, hi_b
    span, k = b - a, 0
    while (span > 0).any():
        wide = 1 << k
        own = (span >= wide) & (span < 2 * wide)
        if own.any():
            out[own] = np.minimum(out[own], np.minimum(level[a[own]], level[b[own] - wide]))
        if not (span >= 2 * wide).any():
            break
        level = np.minimum(level[:-wide], level[wide:])
        k += 1
    return out


def repeated_windows(strings: list[bytes], offsets: np.ndarray, counts: np.ndarray, window: int) -> list[np.ndarray]:
    """Per string a flag for each of its windows: does it start at two places or more of the collection?

    ``offsets``: of the minimiser in each string; ``counts``: how often each string occurs.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    data = np.frombuffer(b"".join(strings) + b"\0" * WORD, np.uint8)
    base = np.cumsum(sizes) - sizes
    lead = offsets % WORD
    lengths = (sizes - lead) // WORD
    ends = np.cumsum(lengths)
    word_at = np.repeat(base + lead - WORD * (ends - lengths), lengths) + WORD * np.arange(ends[-1])
    wide = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WORD)[word_at]).view("<u8").ravel()
    symbols = np.unique(wide, return_inverse=True)[1].astype(np.int32) + 1
    origin, lcp = Collection(symbols, lengths).build()
    owner = np.repeat(np.arange(len(strings)), lengths)[origin]
    at = word_at[origin]
    limit = (base + sizes)[owner]
    lcp[:1] = 0
    after = np.append(lcp[1:], 0)
    many = counts[owner] > 1
    cover = np.zeros(len(data) + 1, np.int64)  # by first byte of a window
    whole = np.maximum(lcp, after) * WORD
    own = np.flatnonzero(whole >= window)
    np.add.at(cover, at[own], 1)
    np.add.at(cover, at[own] + whole[own] - window + 1, -1)
    hit = np.cumsum(cover[:-1]) > 0
    core = window // WORD - 1  # words that a window holds wherever it is cut
    group = np.cumsum(lcp < core)
    for e in range(WORD):
        first = at - e
        ok = (first >= base[owner]) & (first + window <= limit)
        open_ = ok & ~hit[np.where(ok, first, 0)] & ~many
        rows = np.flatnonzero(ok & np.isin(group, np.unique(group[open_ & ((lcp >= core) | (after >= core))])))
        if not len(rows):
            continue
        span = np.concatenate((np.arange(e), np.arange(e + core * WORD, window)))
        edges = np.ascontiguousarray(data[first[rows][:, None] + span])
        code = C.mix(group[rows].astype(np.uint64))
        for k in range(edges.shape[1]):
            code = code * np.uint64(C.BASE) + edges[:, k]
        code = C.mix(code)
        order = np.argsort(code, kind="stable")
        sorted_rows, sorted_edges = rows[order], edges[order]
        same = (group[sorted_rows[1:]] == group[sorted_rows[:-1]]) & (sorted_edges[1:] == sorted_edges[:-1]).all(1)
        equal_code = code[order][1:] == code[order][:-1]
        if (equal_code & ~same).any():  # hashes collide: sort by the bytes themselves
            order = np.lexsort([*edges.T[::-1], group[rows]])
            sorted_rows, sorted_edges = rows[order], edges[order]
            same = (group[sorted_rows[1:]] == group[sorted_rows[:-1]]) & (sorted_edges[1:] == sorted_edges[:-1]).all(1)
        both = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        hit[first[sorted_rows[both]]] = True
    out = []
    for k, (b, s) in enumerate(zip(base.tolist(), sizes.tolist(), strict=True)):
        out.append(np.ones(s - window + 1, bool) if counts[k] > 1 else hit[b : b + s - window + 1])
    return out


def chunk_strings(rows: list, window: int, minimiser: int, n_buckets: int) -> tuple[list, dict]:
    """Each row's (id, bytes, runs), and per bucket its distinct strings: [number, windows before, hash, offset, count,
    hashes of both sides]."""
    docs, found = [], {}
    for doc, text, _ in rows:
        text, runs = text or b"", []
        for first, n, least, offset, left, right in document_runs(np.frombuffer(text, np.uint8), window, minimiser):
            own = found.setdefault(bucket := least % n_buckets, [{}, 0])
            string = text[first : first + n + window - 1]
            seen = own[0].get(string)
            if seen is None:
                seen = own[0][string] = [len(own[0]), own[1], least, offset, 0, left, right]
                own[1] += n
            seen[4] += 1
            runs.append((first, n, bucket, seen))
        docs.append((doc, text, runs))
    return docs, found


def repeated_bytes(docs: DataFrame, schema: str, emit, window: int = WINDOW, minimiser: int = MINIMISER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``emit(doc, bytes, removed flags) -> row tuple`` of ``schema`` for every row of ``docs``."""
    if window % WORD or minimiser > window - 2 * WORD:
        raise ValueError("the window is a multiple of the word, and longer than the minimiser by two words")
    chunk_text, n_chunks = C.chunked(docs, key, text)
    n_buckets = n_chunks // BUCKET_CHUNKS + 1

    def count(chunk: int, rows: list, _: dict) -> Iterator[pa.RecordBatch]:
        times: dict[int, list] = {}
        for _, text_, _ in rows:
            for *_, left, right in document_runs(np.frombuffer(text_ or b"", np.uint8), window, minimiser):
                for side in (left, right):
                    if side:
                        times.setdefault(side % n_buckets, []).append(side)
        for bucket, found in times.items():
            hashes, many = np.unique(np.array(found, np.uint64), return_counts=True)
            yield C.batch(HASHES, [bucket], [chunk], [hashes.tobytes()], [np.packbits(many > 1).tobytes()])

    def tally(bucket: int, blobs: list[dict]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(r["hashes"], np.uint64) for r in blobs]
        many = [np.unpackbits(np.frombuffer(r["many"], np.uint8))[: len(p)] for r, p in zip(blobs, parts, strict=True)]
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        often = np.bincount(at, 1 + np.concatenate(many))[at] > 1
        for r, flags in zip(blobs, np.split(often, np.cumsum([len(p) for p in parts])[:-1]), strict=True):
            if flags.any():
                yield C.batch(C.NOTE, [r["chunk"]], [bucket], ["often"], [np.frombuffer(r["hashes"], np.uint64)[flags].tobytes()])

    def chosen(found: dict, told: dict) -> dict[int, list]:
        """Per bucket the strings one of whose sides occurs more than once, in order."""
        often = {h for (kind, _), payload in told.items() if kind == "often" for h in np.frombuffer(payload, np.uint64).tolist()}
        return {bucket: own for bucket, (strings, _) in found.items() if (own := [(s, seen) for s, seen in strings.items() if seen[5] in often or seen[6] in often])}

    def send(chunk: int, rows: list, told: dict) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for bucket, own in chosen(chunk_strings(rows, window, minimiser, n_buckets)[1], told).items():
            shape = np.array([[len(s), seen[3]] for s, seen in own], "<i4")
            hashes, counts = np.array([seen[2] for _, seen in own], np.uint64), np.array([min(seen[4], 2) for _, seen in own], np.uint8)
            yield C.batch(BLOB, [bucket], [chunk], [hashes.tobytes()], [counts.tobytes()], [pack.compress(shape.tobytes())], [pack.compress(b"".join(s for s, _ in own))])

    def judge(bucket: int, blobs: list[dict]) -> Iterator[pa.RecordBatch]:
        undo = zstandard.ZstdDecompressor()
        index: dict[bytes, int] = {}
        offsets, counts, hashes, refs = [], [], [], []
        for r in blobs:
            shape, raw, at, own = np.frombuffer(undo.decompress(r["shape"]), "<i4").reshape(-1, 2).tolist(), undo.decompress(r["bytes"]), 0, []
            for (size, offset), times, least in zip(shape, r["counts"], np.frombuffer(r["hashes"], np.uint64).tolist(), strict=True):
                k = index.setdefault(raw[at : at + size], len(index))
                at += size
                if k == len(counts):
                    counts.append(0)
                    offsets.append(offset)
                    hashes.append(least)
                counts[k] += times
                own.append(k)
            refs.append(own)
        strings = list(index)
        del index
        order = np.argsort(np.array(hashes, np.uint64), kind="stable").tolist()
        flags: list = [None] * len(strings)
        held, size = [], 0
        for k, nxt in zip(order, [*order[1:], None], strict=True):  # whole minimisers, a few MB at a time
            held.append(k)
            size += len(strings[k])
            if nxt is None or size >= COLLECTION_BYTES and hashes[nxt] != hashes[k]:
                for own, f in zip(held, repeated_windows([strings[i] for i in held], np.array([offsets[i] for i in held]), np.array([counts[i] for i in held]), window), strict=True):
                    flags[own] = f
                held, size = [], 0
        for r, own in zip(blobs, refs, strict=True):
            yield C.batch(C.NOTE, [r["chunk"]], [bucket], ["flags"], [np.packbits(np.concatenate([flags[k] for k in own])).tobytes()])

    def apply(chunk: int, rows: list, told: dict) -> Iterator[pa.RecordBatch]:
        docs_, found = chunk_strings(rows, window, minimiser, n_buckets)
        place: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
        for bucket, own in chosen(found, told).items():
            bits, before = np.unpackbits(np.frombuffer(told["flags", bucket], np.uint8)).astype(bool), 0
            for s, seen in own:
                place[bucket, seen[0]] = bits[before : before + len(s) - window + 1]
                before += len(s) - window + 1
        out = []
        for doc, data, runs in docs_:
            cover = np.zeros(len(data) + 1, np.int64)
            for first, n, bucket, seen in runs:
                if (flags := place.get((bucket, seen[0]))) is not None and flags.any():
                    at = first + np.flatnonzero(flags)
                    cover[at] += 1
                    np.subtract.at(cover, at + window, 1)
            out.append(emit(doc, data, np.cumsum(cover[:-1]) > 0))
        yield C.batch(schema, *map(list, zip(*out, strict=True)))

    often = C.per_bucket(C.per_chunk(chunk_text, count, HASHES), tally)
    flags = C.per_bucket(C.per_chunk(chunk_text, send, BLOB, often), judge)
    return C.per_chunk(chunk_text, apply, schema, often, flags)


def dedup_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""

    def emit(doc, data, gone):
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
        return doc, len(data), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()

    return repeated_bytes(docs, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", emit, key=key, text=text, **kw).withColumnRenamed("id", key)
