"""Token-id files: Simple-8b word-aligned coding with escapes and per-frame offsets.

A 64-bit word holds a 4-bit selector and 60 payload bits: as many ids as fit at the selector's width. Selector 1 is an
escape: the next word is one raw value of more than 60 bits. Ids are coded in frames of FRAME values; a block keeps the
word offset of each frame, so frames can be decoded alone, and all words of a block are decoded at once, vectorised.

Files are Parquet rows of one block each (Spark's own committer writes and Spark's own reader reads them, so any store
that Spark reaches will do): ``part, block, doc_ids, doc_tokens, frame_words, words``. Blocks hold whole documents.
Null text is empty and holds the end id alone; null ids sort first; repeated ids keep one entry each.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.chunks import release, small_batches
from spanforge.llm.tokens import TokenEncoder, default_path, slices
from spanforge.session import ensure_checkpoint_dir

#: Selector to (values, bits). Fixed values of the published code, but for selector 1.
LAYOUT = {0: (240, 0), 2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7), 9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60)}
ESCAPE = 1
FRAME = 1024
BLOCK_IDS = 1 << 17
PART_BYTES = 32 << 20  # of text in a partition, more where MAX_PARTS of them are too few; blocks keep their size
MAX_PARTS = 20_000  # a row for each reaches the driver
#: (values, bits, selector) of words of several values, by rising count.
RUNS = sorted((count, bits, selector) for selector, (count, bits) in LAYOUT.items() if count > 1)
ESCAPED = 255  # in place of a count
_STEPS = np.where(np.arange(256) == ESCAPED, 1, np.arange(256))
_SELECTORS = np.zeros(256, np.int64)
_SELECTORS[[count for count, _ in LAYOUT.values()]] = list(LAYOUT)
_SELECTORS[ESCAPED] = ESCAPE
_WIDTHS = np.ceil(np.log2(np.arange(1 << 16) + 1)).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit words, word offset of each frame). Any unsigned 64-bit values, any count."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    widest, reach = bit_widths(values), 1  # of each run of ``reach`` values
    take = np.where(widest <= 60, 1, ESCAPED).astype(np.uint8)
    for count, bits, selector in RUNS:  # a longer run has fewer bits a value: where it fits, the shorter ones do
        if n < count:
            break
        while reach < count:
            step = min(reach, count - reach)
            widest = np.maximum(widest[: len(widest) - step], widest[step:])
            reach += step
        fits = np.flatnonzero(widest <= bits)
        fits = fits[fits % FRAME <= FRAME - count]
        if not len(fits):
            if not (widest <= bits).any():
                break
            continue
        take[fits] = count
    return _lay_out(values, take)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned value; of the common small ones by a table."""
    if values.dtype.itemsize > 2:
        out = np.zeros(len(values), np.uint8)
        for bits in sorted({bits for _, bits in LAYOUT.values()} - {60}):
            out[values.astype(np.uint64) >> np.uint64(bits) != 0] = bits + 1
        out[values.astype(np.uint64) >> np.uint64(60) != 0] = 61
        return out
    return _WIDTHS[values]


def _lay_out(v: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Follow every frame's chain of words in step, then fill the words selector by selector.

    ``take``: how many values the word that starts at a value holds, or ESCAPED.
    """
    n = len(v)
    at = np.arange(0, n, FRAME)
    ends = np.minimum(at + FRAME, n)
    chain = np.zeros(n, bool)
    step = _STEPS[take]
    while len(at):
        chain[at] = True
        at = at + step[at]
        live = at < ends
        at, ends = at[live], ends[live]
    start = np.flatnonzero(chain)
    sel = _SELECTORS[take[start]]
    place = np.cumsum(1 + (sel == ESCAPE)) - 1 - (sel == ESCAPE)
    words = np.zeros(int(place[-1]) + 1 + int(sel[-1] == ESCAPE), np.uint64)
    for selector, (count, bits) in LAYOUT.items():
        own = np.flatnonzero(sel == selector)
        if not len(own):
            continue
        word = np.full(len(own), selector << 60, np.uint64)
        if bits:
            for k in range(count):
                word |= v[start[own] + k].astype(np.uint64) << np.uint64(bits * k)
        words[place[own]] = word
    escaped = np.flatnonzero(sel == ESCAPE)
    words[place[escaped]] = np.uint64(ESCAPE << 60)
    words[place[escaped] + 1] = v[start[escaped]]
    return words, place[np.searchsorted(start, np.arange(0, n, FRAME))]


def decode(words: np.ndarray) -> np.ndarray:
    """All values of a run of words; works on a whole block or on any range of its frames."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (sel == ESCAPE).any():  # a raw word may look like anything: step over it
        i, marks = 0, np.flatnonzero(sel == ESCAPE)
        for m in marks.tolist():
            if m >= i:
                raw[m + 1] = True
                i = m + 2
    count = np.zeros(16, np.int64)
    for selector, (values, _) in LAYOUT.items():
        count[selector] = values
    per = count[sel]
    per[raw] = 1
    per[(sel == ESCAPE) & ~raw] = 0
    ends = np.cumsum(per)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    first = ends - per
    for selector, (values, bits) in LAYOUT.items():
        own = np.flatnonzero((sel == selector) & ~raw)
        if len(own) and bits:
            mask = np.uint64((1 << bits) - 1)
            for k in range(values):
                out[first[own] + k] = words[own] >> np.uint64(bits * k) & mask
    out[first[raw]] = words[raw]
    return out


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end_id``, and write blocks in ascending order of ``key`` to ``folder``."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = TokenEncoder.of(path), TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, held
            counts, ids = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            words, frames = encode(ids)
            row = ([part], [block], [[d for h in held for d in h[0]]], [counts.tolist()], [frames.tolist()], [words.astype("<u8").tobytes()])
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            block, held = block + 1, []
            names = ["part", "block", "doc_ids", "doc_tokens", "frame_words", "words"]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)

        size = 0
        for whole in batches:
            for at, stop in slices(whole.column(1)):
                b = whole.slice(at, stop - at)
                counts, ids = encoder.encode(b.column(1))
                held.append((b.column(0).to_pylist(), counts + 1, np.insert(ids, np.cumsum(counts), end_id)))
                size += len(held[-1][2])
                if size >= BLOCK_IDS:
                    yield flush()
                    size = 0
        if held:
            yield flush()
        release()

    rows = small_batches(docs).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES + 1)
    parts = min(parts, MAX_PARTS)
    # Rows that repeat an id, or lack one, may lie in several ranges: the text's hash tells them apart.
    ordered = rows.withColumn("h", F.xxhash64("t")).repartitionByRange(parts, "id", "h").sortWithinPartitions("id", "h").select("id", "t")
    schema = "part int, block int, doc_ids array<long>, doc_tokens array<long>, frame_words array<long>, words binary"
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").mode("overwrite").parquet(folder)


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = decode(np.frombuffer(r["words"], "<u8")).astype("<u4")
                counts = np.array(r["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[s:e]) for s, e in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                n = len(counts)
                arrays = [pa.array(r["doc_ids"], pa.int64()), pa.array([r["part"]] * n, pa.int32()), pa.array([r["block"]] * n, pa.int32()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "block", "at", "n_tokens", "ids_crc32"])

    files = spark.read.parquet(folder)
    sizes = files.select("part", "block", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    by_block = sizes.withColumn("before", F.sum("n").over(_blocks()) - F.col("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n")).collect()  # a row per partition
    base, rows = 0, []
    for t in sorted(totals, key=lambda t: t["part"]):
        rows.append((t["part"], base))
        base += t["n"]
    bases = F.broadcast(spark.createDataFrame(rows, "part int, base long"))
    starts = by_block.join(bases, "part").select("part", "block", (F.col("base") + F.col("before")).alias("base"))
    docs = files.mapInArrow(run, "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "block"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _blocks():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_and_read(docs: DataFrame, **kw) -> DataFrame:
    folder = shared_folder(docs.sparkSession, "ids")
    write_ids(docs, folder, **kw)
    return read_digest(docs.sparkSession, folder)
