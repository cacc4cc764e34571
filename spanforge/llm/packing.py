"""Packing along a space-filling curve.

A document's token counts, hashed to VECTOR places and scaled to length one, are projected to a few dimensions by
random signs; the cell's Hilbert key orders documents, and neighbours along the curve are laid end to end into sequences, cut wherever one fills up.
Only a partition's last sequence is padded. Null text is empty and holds the end id alone; rows with null or repeated
ids are packed like any other.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.chunks import release, small_batches
from spanforge.llm.tokens import TokenEncoder, default_path, slices
from spanforge.session import cut

DIMS, BITS = 3, 10
SPREAD = 4.0  # projections are clipped to this many standard deviations
VECTOR = 256  # places of a document's hashed vector
ROUTE_SAMPLE = 4_000  # documents expected in the sample that places the partitions' borders; routing only
PART_BYTES = 16 << 20  # of text in a partition, more where MAX_PARTS of them are too few; partitions stream, so any size will do
MAX_PARTS = 20_000  # bound of the borders and of their sample, which pass through the driver
BATCH_BYTES = 8 << 20  # of text whose ids are held at once


def hashed(n: int, salt: int) -> np.ndarray:
    """A well-mixed 64-bit value for each whole number under ``n``."""
    x = np.arange(n, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15 + (salt << 32))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def sign_table(dims: int = DIMS) -> np.ndarray:
    """Random signs: a row per place of the hashed vector."""
    return np.where(hashed(VECTOR * dims, 1) >> np.uint64(63) != 0, 1.0, -1.0).reshape(VECTOR, dims)


def place_table(vocab: int) -> np.ndarray:
    """The place of each token id in the hashed vector."""
    return (hashed(vocab, 2) % np.uint64(VECTOR)).astype(np.int32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows; one column per dimension)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):  # undo the rotations from the coarsest level down
        low = (1 << b) - 1
        for d in range(dims):
            high = (x[d] >> b) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def vector_keys(counts: np.ndarray, ids: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Hilbert key of each document from its ids; a document without ids lies in the middle."""
    n = len(counts)
    if not n:
        return np.zeros(0, np.int64)
    vectors = np.bincount(np.repeat(np.arange(n) * VECTOR, counts) + places[ids], minlength=n * VECTOR).reshape(n, VECTOR)
    length = np.sqrt((vectors.astype(float) ** 2).sum(1))
    unit = vectors @ signs / np.maximum(length, 1)[:, None]
    cells = np.clip((unit + SPREAD) / (2 * SPREAD) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_key(cells)


def keyed_tokens(docs: DataFrame, path: str, end_id: int, key: str, text: str, borders: list[tuple[int, int]] | None = None) -> DataFrame:
    """``(key, curve, ids, part)`` of every row; ids are little-endian, two or four bytes each. ``part``: by ``borders``."""
    borders = borders or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder.of(path)
        signs, places = sign_table(), place_table(len(encoder.spaced))
        for whole in batches:
            for at, stop in slices(whole.column(1), BATCH_BYTES):
                b = whole.slice(at, stop - at)
                counts, ids = encoder.encode(b.column(1))
                curve = vector_keys(counts, ids, places, signs)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                offsets = np.concatenate(([0], ends + np.arange(1, len(ends) + 1))) * ids.itemsize
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                pairs = zip(curve.tolist(), b.column(0).fill_null(-1).to_pylist(), strict=True)
                part = pa.array([bisect.bisect_right(borders, p) for p in pairs], pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(curve), packed, part], names=["id", "curve", "ids", "part"])
        release()

    rows = small_batches(docs).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, curve long, ids binary, part int")


def pack(docs: DataFrame, length: int = 1024, path: str | None = None, end_id: int = 0, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, offset`` and its place, ids as little-endian bytes.

    ``digest``: ``ids_crc32``, over little-endian unsigned 32-bit ids, in place of ``ids``.

    Documents are dealt to partitions of about PART_BYTES by (Hilbert key, id), whose borders come from a sample of
    ROUTE_SAMPLE documents or 20 a partition, 400 000 at most, and packed while they stream by. Sequence numbers are made consecutive from each partition's count.
    """
    path = path or default_path()
    wide = 2 if TokenEncoder.of(path).dtype == np.uint16 else 4
    spark = docs.sparkSession
    found = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text).cast("string"))).alias("size")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (found["size"] or 0) // PART_BYTES + 1)
    parts = min(parts, MAX_PARTS)
    sample = docs.sample(min(1.0, max(ROUTE_SAMPLE, 20 * parts) / max(1, found["n"])), seed=1)
    seen = sorted((r["curve"], r["id"] if r["id"] is not None else -1) for r in keyed_tokens(sample, path, end_id, key, text).select("curve", "id").collect())
    borders = [seen[len(seen) * i // parts] for i in range(1, parts)] if seen else []

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total, done = len(ids) // wide, 0
                while done < total:
                    take = min(total - done, length - at % length)
                    piece = ids[done * wide : (done + take) * wide]
                    row = (doc, done, take, zlib.crc32(wide_ids(piece, wide)) if digest else piece, total, at // length, at % length)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    done, at = done + take, at + take
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(out[0]), pa.int32())], names=["doc_id", "start", "length", name, "doc_tokens", "local", "offset", "part"])

    name = "ids_crc32" if digest else "ids"
    tokens = keyed_tokens(docs, path, end_id, key, text, borders)
    dealt = tokens.repartitionById(parts, F.col("part")).sortWithinPartitions("curve", "id").select("id", "ids")
    return dealt.mapInArrow(lay, f"doc_id long, start long, length long, {name} {'long' if digest else 'binary'}, doc_tokens long, local long, offset long, part int")


def number_sequences(pieces: DataFrame) -> DataFrame:
    """Replace ``part, local`` by ``sequence_id``, consecutive over all partitions. ``pieces`` must be materialised."""
    counts = pieces.groupBy("part").agg((F.max("local") + 1).alias("n")).collect()  # a row per partition
    before, rows = 0, []
    for r in sorted(counts, key=lambda r: r["part"]):
        rows.append((r["part"], before))
        before += r["n"]
    base = F.broadcast(pieces.sparkSession.createDataFrame(rows, "part int, base long"))
    return pieces.join(base, "part").withColumn("sequence_id", F.col("base") + F.col("local")).drop("part", "base", "local")


def wide_ids(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def pack_digest(docs: DataFrame, **kw) -> DataFrame:
    """``pack`` with each piece's ids replaced by their checksum."""
    return number_sequences(cut(pack(docs, digest=True, **kw)))
