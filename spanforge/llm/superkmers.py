"""Substring dedup over word windows, by super-k-mer partitioning.

Consecutive windows of WINDOW words that share a minimiser (the leftmost least hash of MINIMISER words inside) travel
as one packed string to the minimiser's bucket. Equal strings of a chunk travel once, with the chunk's smallest id, so
copies are aggregated before the exchange. FAN buckets travel together, since a chunk's strings for one alone get few, and
compress badly, where buckets are many. A bucket sorts its windows by a hash of exact word numbers, confirms equal
neighbours word by word, and returns one bit per window: does a smaller id than the string's own hold it too?

Null or wordless text has no words. Rows without an id rank after all others and never cause a removal; rows that
repeat an id don't remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import chunks as C

WINDOW, MINIMISER = 13, 3
BLOB = "bucket int, chunk int, strings binary"
FAN = 8  # buckets that travel together
SMALL = 512  # bytes under which a blob isn't compressed alone, but left to the codec of the exchange


def packed(buckets: list[dict[bytes, tuple[int, int, int]]], pack: zstandard.ZstdCompressor) -> bytes:
    """The strings of FAN buckets: their numbers and bytes by bucket, their ids, the strings joined by line feeds."""
    joined = [b"\n".join(strings) for strings in buckets]
    shape = np.array([list(map(len, buckets)), list(map(len, joined))], "<i8")
    ids = np.fromiter((s[1] for strings in buckets for s in strings.values()), "<i8")
    raw = b"".join([shape.tobytes(), ids.tobytes(), *joined])
    return b"\0" + raw if len(raw) < SMALL else b"\1" + pack.compress(raw)


def unpacked(data: bytes, undo: zstandard.ZstdDecompressor) -> list[tuple[np.ndarray, bytes]]:
    """(ids, strings joined by line feeds) of each of the FAN buckets."""
    raw = undo.decompress(data[1:]) if data[0] else data[1:]
    shape = np.frombuffer(raw, "<i8", 2 * FAN).reshape(2, FAN)
    ids = np.frombuffer(raw, "<i8", int(shape[0].sum()), 16 * FAN)
    start = 8 * (2 * FAN + len(ids))
    return [(ids[a:b], raw[start + c : start + d]) for (a, b), (c, d) in zip(_spans(shape[0].tolist()), _spans(shape[1].tolist()), strict=True)]


def document_runs(joined: bytes, window: int, minimiser: int) -> list[tuple[int, int, int, int, int]]:
    """(first window, windows, minimiser hash, first byte, one past the last byte) of a text of single-spaced words."""
    data = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(data == 32)
    if len(gaps) + 1 < window:
        return []
    starts, ends = np.concatenate(([0], gaps + 1)), np.append(gaps, len(data))
    h, down = C.prefix_hash(data), C.powers(len(data))[1]
    least = C.mix((h[ends[minimiser - 1 :]] - h[starts[: len(starts) - minimiser + 1]]) * down[starts[: len(starts) - minimiser + 1]])
    first, last, at = C.minimiser_runs(least, window - minimiser + 1)
    return list(zip(first.tolist(), (last - first).tolist(), least[at].tolist(), starts[first].tolist(), ends[last + window - 2].tolist(), strict=True))


def chunk_strings(rows: list, window: int, minimiser: int, n_buckets: int) -> tuple[list, dict[int, dict[bytes, tuple[int, int, int]]]]:
    """Each row's (row, words, runs), and per bucket its distinct strings: number, smallest id, windows before it."""
    docs, found = [], {}
    for row in rows:
        doc, text, _ = row
        rank = C.NO_ID if doc is None else doc
        words = (text or b"").split()
        joined, runs = b" ".join(words), []
        for first, n, least, a, b in document_runs(joined, window, minimiser) if len(words) >= window else ():
            own = found.setdefault(bucket := least % n_buckets, [{}, 0])
            string = joined[a:b]
            seen = own[0].get(string)
            if seen is None:
                seen = own[0][string] = (len(own[0]), rank, own[1])
                own[1] += n
            runs.append((first, n, bucket, seen, rank))
        docs.append((row, words, runs))
    return docs, found


def window_flags(groups: list[tuple[np.ndarray, bytes]], window: int) -> list[np.ndarray]:
    """Per group of (smallest id of each string, strings joined by line feeds): a flag for each window in order."""
    data = np.frombuffer(b"".join(w + b"\n" for _, w in groups), np.uint8)
    line_end = np.flatnonzero(data == 10)
    breaks = np.flatnonzero((data == 10) | (data == 32))
    spaced = np.where(data == 10, 32, data).astype(np.uint8)
    offsets = np.concatenate(([0], breaks + 1)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(breaks), [None, pa.py_buffer(offsets), pa.py_buffer(spaced)])
    number = words.dictionary_encode().indices.to_numpy().astype(np.uint64)
    last = np.searchsorted(breaks, line_end)  # a string's last word
    first = np.concatenate(([0], last[:-1] + 1))
    per = last - first + 2 - window
    ids = np.concatenate([i for i, _ in groups])
    ends = np.cumsum(per)
    start = np.repeat(first - (ends - per), per) + np.arange(ends[-1])
    own = np.repeat(ids, per)
    code, reach = C.mix(number + np.uint64(1)), 1
    while reach < window:
        step = min(reach, window - reach)
        code = C.mix(code[:-step] * np.uint64(C.BASE) + code[step:] * np.uint64(0xC2B2AE3D27D4EB4F))
        reach += step
    order = np.argsort(code[start], kind="stable")
    at = start[order]
    same = code[at[1:]] == code[at[:-1]]
    pair = np.flatnonzero(same)
    for k in range(window):
        if (number[at[pair] + k] != number[at[pair + 1] + k]).any():  # hashes collide: sort by the words themselves
            order = np.lexsort([number[start + j] for j in range(window - 1, -1, -1)])
            at = start[order]
            same = np.ones(len(at) - 1, bool)
            for j in range(window):
                same &= number[at[1:] + j] == number[at[:-1] + j]
            break
    edge = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.repeat(np.minimum.reduceat(own[order], edge), np.diff(np.append(edge, len(order))))
    flag = np.empty(len(order), bool)
    flag[order] = least < own[order]
    counts = np.cumsum([int(per[a:b].sum()) for a, b in _spans([len(i) for i, _ in groups])])
    return np.split(flag, counts[:-1])


def _spans(sizes: list[int]) -> list[tuple[int, int]]:
    ends = np.cumsum(sizes)
    return list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))


def repeated_words(docs: DataFrame, schema: str, emit, window: int = WINDOW, minimiser: int = MINIMISER, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``emit((id, text bytes, rest), words, removed flags) -> row tuple`` of ``schema`` for every row of ``docs``."""
    chunk_text, n_chunks = C.chunked(docs, key, text, carry=carry)
    n_buckets = FAN * (n_chunks // 4 + 1)

    def send(chunk: int, rows: list, _: dict) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        _, found = chunk_strings(rows, window, minimiser, n_buckets)
        for together in sorted({bucket // FAN for bucket in found}):
            buckets = [found.get(together * FAN + k, ({}, 0))[0] for k in range(FAN)]
            yield C.batch(BLOB, [together], [chunk], [packed(buckets, pack)])

    def judge(together: int, blobs: list[dict]) -> Iterator[pa.RecordBatch]:
        undo = zstandard.ZstdDecompressor()
        held = [(r["chunk"], unpacked(r.pop("strings"), undo)) for r in blobs]
        for k in range(FAN):
            groups = [(chunk, buckets[k]) for chunk, buckets in held if len(buckets[k][0])]
            if not groups:
                continue
            for (chunk, _), flags in zip(groups, window_flags([g for _, g in groups], window), strict=True):
                if flags.any():
                    yield C.batch(C.NOTE, [chunk], [together * FAN + k], ["flags"], [np.packbits(flags).tobytes()])

    def apply(chunk: int, rows: list, told: dict) -> Iterator[pa.RecordBatch]:
        out = []
        flags = {bucket: np.unpackbits(np.frombuffer(bits, np.uint8)) for (_, bucket), bits in told.items()}
        for row, words, runs in chunk_strings(rows, window, minimiser, n_buckets)[0]:
            cover = np.zeros(len(words) + 1, np.int64)
            for first, n, bucket, (_, least, before), rank in runs:
                if rank > least:  # a smaller id of this chunk holds the whole string
                    cover[first] += 1
                    cover[first + n + window - 1] -= 1
                elif bucket in flags:
                    for i in np.flatnonzero(flags[bucket][before : before + n]).tolist():
                        cover[first + i] += 1
                        cover[first + i + window] -= 1
            out.append(emit(row, words, np.cumsum(cover[:-1]) > 0))
        yield C.batch(schema, *map(list, zip(*out, strict=True)))

    flags = C.per_bucket(C.per_chunk(chunk_text, send, BLOB), judge)
    return C.per_chunk(chunk_text, apply, schema, flags, carry=bool(carry))


def _kept(words: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)


def dedup_text(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """Rows of ``docs``, all columns, with the repeated words cut out of ``text``, plus ``n_words, n_removed``.

    A text that loses nothing stays as it is; of others the kept words are joined by one space. Other columns of any type
    are carried unchanged; those that are called ``n_words`` or ``n_removed`` are returned as ``<name>_input``.
    """
    docs = C.set_aside(docs, ["n_words", "n_removed"])

    def emit(row, words, gone):
        doc, data, place = row
        kept = _kept(words, gone) if gone.any() else data
        return doc, None if kept is None else kept.decode("utf-8", "replace"), len(words), int(gone.sum()), place

    carry = [c for c in docs.columns if c not in (key, text)]
    out = repeated_words(docs, "id long, t string, n_words long, n_removed long, rest long", emit, key=key, text=text, carry=carry, **kw)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    columns = {key: F.col("id").cast(kinds[key]), text: F.col("t")} | {c: F.col(f"rest.c{i}") for i, c in enumerate(carry)}
    return out.select(*[columns[c].alias(c) for c in docs.columns], "n_words", "n_removed")


def dedup_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` of every row."""
    emit = lambda row, words, gone: (row[0], len(words), int(gone.sum()), hashlib.sha256(_kept(words, gone)).hexdigest())
    return repeated_words(docs, "id long, n_words long, n_removed long, kept_sha256 string", emit, key=key, text=text, **kw).withColumnRenamed("id", key)


