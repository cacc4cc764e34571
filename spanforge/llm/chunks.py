"""Chunks of documents that are read several times in the same order.

A chunk holds the documents of one hash of the id and is small enough for a worker's memory; the number of chunks
follows the corpus. Exchanging text by chunk once serves every pass, because Spark reuses the identical exchange.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_ROWS = 2_000
CHUNK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max  # rows without an id rank after all others


def release() -> None:
    """Give freed memory back to the system, so that idle workers stay small."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """Keep the batches of texts that workers get small: a session still at Spark's default gets BATCH_ROWS a batch."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
    return df


def set_aside(df: DataFrame, own: list[str]) -> DataFrame:
    """Rename columns that bear the name of one of an operator's ``own`` columns: ``<name>_input``, until it is free."""
    taken = {c.lower() for c in [*df.columns, *own]}
    for c in df.columns:
        if c.lower() in {o.lower() for o in own}:
            name = f"{c}_input"
            while name.lower() in taken:
                name += "_input"
            taken.add(name.lower())
            df = df.withColumnRenamed(c, name)
    return df


def chunked(docs: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """(``chunk, id, t, rest``) exchanged by chunk, and the number of chunks. ``rest``: a struct of the columns ``carry``, as c0, c1, ..."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n = int(size // chunk_bytes) + 1
    rows = docs.select(F.pmod(F.xxhash64(F.col(key).cast("long"), F.lit("chunk")), F.lit(n)).cast("int").alias("chunk"), F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"), F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("rest") if carry else F.lit(0).alias("rest"))
    return rows.repartition("chunk"), n


def ordered(ids: list, texts: list) -> list[tuple[int | None, bytes | None, int]]:
    """(id, text, place) of the chunk's rows in one order whatever the order of arrival: by id, rows without one last,
    then by text. Rows that repeat id and text are alike to every pass."""
    return sorted(zip(ids, texts, range(len(ids)), strict=True), key=lambda r: (NO_ID if r[0] is None else r[0], r[0] is None, r[1] is None, r[1] or b""))


def per_chunk(text: DataFrame, run: Callable, schema: str, *notes: DataFrame, carry: bool = False) -> DataFrame:
    """Apply ``run(rows, notes) -> record batches`` to every chunk.

    ``rows`` are the chunk's ordered (id, text bytes, place); ``notes`` its (kind, bucket, payload) rows from earlier
    passes. ``carry``: the last column of ``schema``, a place, becomes the row's ``rest``, as Arrow holds it.
    """

    def body(rows: pa.Table, extra: pa.Table | None) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        chunk = rows.column("chunk")[0].as_py()
        told = {} if extra is None else {(r["kind"], r["bucket"]): r["payload"] for r in extra.to_pylist()}
        got = ordered(rows.column("id").to_pylist(), rows.column("t").cast(pa.binary()).to_pylist())
        yield from run(chunk, got, told)
        release()

    def whole(rows: pa.Table, extra: pa.Table | None) -> pa.Table:
        out = pa.Table.from_batches(list(body(rows, extra)), arrow_schema(schema))
        if carry:
            places = out.column(out.num_columns - 1)
            out = out.set_column(out.num_columns - 1, "rest", rows.column("rest").combine_chunks().take(places))
        return out

    kinds: str | StructType = schema
    if carry:
        kinds = StructType([*StructType.fromDDL(schema).fields[:-1], text.schema["rest"]])
    if not notes:
        return text.groupBy("chunk").applyInArrow(lambda rows: whole(rows, None), kinds)
    told = notes[0]
    for more in notes[1:]:
        told = told.unionByName(more)
    return text.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(whole, kinds)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in schema.split(", "))])


NOTE = "chunk int, bucket int, kind string, payload binary"


def per_bucket(blobs: DataFrame, run: Callable, schema: str = NOTE) -> DataFrame:
    """Stream blobs sorted by bucket through ``run(bucket, rows) -> record batches``, a whole bucket at a time."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from run(held[0]["bucket"], held)
                    held = []
                held.append(row)
        if held:
            yield from run(held[0]["bucket"], held)
        release()

    return blobs.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(body, schema)


def batch(schema: str, *columns: list) -> pa.RecordBatch:
    fields = arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses, at least ``n``; kept per worker up to 8 M."""
    size = 1 << max(20, int(n).bit_length())
    if size not in _POWERS:
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        made = np.cumprod(up), np.cumprod(down)
        if size > 1 << 23:
            return made
        _POWERS.clear()
        _POWERS[size] = made
    return _POWERS[size]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``h`` such that ``(h[b] - h[a]) * inverse_power[a]`` depends on the bytes from a to b only."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)])))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost of the smallest values, by their upper halves, in each run of ``width``."""
    low, reach = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64), 1
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def minimiser_runs(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, one past the last, minimiser position) of each run of windows that share a minimiser."""
    at = leftmost_minima(values, width)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return first, np.append(first[1:], len(at)), at[first]
