"""SimHash near-duplicates: fingerprints, pivot distance tables, and components of linked fingerprints.

Null or wordless text has fingerprint 0 and links like any other. Repeated rows are kept; rows with a null id get the
component of their fingerprint, which is null only if no row of that component has an id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.chunks import small_batches
from spanforge.operators.components import connected_components
from spanforge.session import cut

SEED = 42
PIVOTS = 24  # reference fingerprints, chosen among
PIVOT_SAMPLE = 1024  # fingerprints of the smallest hashes
CELL_ROWS = 4096  # larger cells are dealt out as pairs of parts
CHUNK_ROWS = 1 << 16
ROW_PAIRS = 64  # pairs of a cell that cost as much as one row sent to it (25 ns against 1.6 microseconds, measured)


def hash_fingerprint(hashes: np.ndarray) -> int:
    """Majority bit of unsigned 64-bit hashes; a bit is set only if more than half have it."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Unsigned 64-bit hashes of the ASCII-lower-cased text's word shingles, repeats included."""
    words = text.lower().split()  # bytes.split: space and the control characters 9 to 13
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) > shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), last.tolist(), strict=False)), np.uint64, len(last))


def text_fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of the text's word shingles."""
    return hash_fingerprint(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)`` for every row; batches stream through, one text in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [text_fingerprint(t or b"", shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    rows = small_batches(docs).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, fp long").withColumnRenamed("id", key)


def pivot_fingerprints(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """At most ``n`` of the sample, farthest first: each lies as far as possible from those before it."""
    if not len(sample):
        return np.zeros(1, np.uint64)
    chosen, far = [], np.full(len(sample), 64)
    for _ in range(min(n, len(sample))):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.bitwise_count(sample ^ sample[chosen[-1]]))
    return sample[chosen]


def spare_blocks(n: int, radius: int) -> int:
    """Blocks beyond the radius for ``n`` fingerprints. Any number is exact: two fingerprints within the radius agree on
    at least that many. More of them mean more cells for each fingerprint and fewer strangers in a cell; this is the
    number, two at least, at which rows sent and pairs met in cells cost least together, so the pairs of a fingerprint
    stay few however many fingerprints there are."""
    cost = lambda s: math.comb(radius + s, s) * (1 + n / 2 ** (64 * s // (radius + s)) / (2 * ROW_PAIRS))
    return min(range(2, 9), key=cost)


def block_masks(radius: int, spare: int) -> list[int]:
    """Masks of every choice of ``spare`` out of ``radius + spare`` bit blocks: fingerprints within the radius agree
    under at least one, since ``radius`` differing bits touch at most ``radius`` blocks."""
    n = radius + spare
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, spare)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index linked to each of ``n`` indexes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        live = root[a] != root[b]
        a, b = a[live], b[live]
    return root


def link_cells(cell: np.ndarray, fp: np.ndarray, radius: int, pivots: np.ndarray) -> np.ndarray:
    """Root index of each row, linking rows of equal cell within ``radius``; rows are sorted by cell.

    ``table`` holds the distances to the pivots. Inside a cell rows are put in order of the first coordinate, and only
    rows whose first coordinates differ by at most the radius ever become a pair; a pair is discarded at the first
    further coordinate that differs by more (the triangle inequality rules it out), and survivors are verified.
    """
    table = np.bitwise_count(fp[None, :] ^ pivots[:, None]).astype(np.int8)
    order = np.lexsort((table[0], cell))
    root = _link_ordered(cell[order], fp[order], table[:, order], radius)
    low = np.full(len(fp), len(fp))
    np.minimum.at(low, root, order)  # a tree hangs on its smallest row
    out = np.empty(len(fp), np.int64)
    out[order] = low[root]
    return out


def _link_ordered(cell: np.ndarray, fp: np.ndarray, table: np.ndarray, radius: int) -> np.ndarray:
    n = len(fp)
    root = np.arange(n)
    near_a, near_b, held = [], [], 0
    alive, step = np.arange(n), 0
    while True:
        step += 1
        alive = alive[: np.searchsorted(alive, n - step)]
        alive = alive[(cell[alive] == cell[alive + step]) & (table[0][alive + step] - table[0][alive] <= radius)]
        if not len(alive):
            break
        left = alive
        for row in table[1:]:
            left = left[np.abs(row[left] - row[left + step]) <= radius]
            if not len(left):
                break
        left = left[np.bitwise_count(fp[left] ^ fp[left + step]) <= radius]
        near_a.append(left)
        near_b.append(left + step)
        held += len(left)
        if held > 8 * n:
            root = forest(n, np.concatenate([*near_a, np.arange(n)]), np.concatenate([*near_b, root]))
            near_a, near_b, held = [], [], 0
    if held:
        root = forest(n, np.concatenate([*near_a, np.arange(n)]), np.concatenate([*near_b, root]))
    return root


def fingerprint_links(nodes: DataFrame, radius: int, spare: int | None = None, n_pivots: int = PIVOTS) -> DataFrame:
    """Edges ``(a, b)`` between ids of distinct fingerprints that connect all pairs within ``radius``.

    ``nodes``: one row ``(node, fp)`` per distinct fingerprint. Every fingerprint goes to one cell per block choice, and
    the distances to pivots, taken from a bounded sample of the fingerprints, pair the rows of a cell.
    A cell of more than CELL_ROWS rows is dealt out as pairs of its parts, so no task holds a whole hot cell, and each
    task returns a spanning forest instead of all pairs. Trees hang on their smallest node, so that the cells in which
    a group meets again return the same edges.
    """
    masks = block_masks(radius, spare or spare_blocks(nodes.count(), radius))
    sample = nodes.orderBy(F.xxhash64("fp"), "fp").limit(PIVOT_SAMPLE).select("fp").collect()
    pivots = pivot_fingerprints(np.array([r[0] for r in sample], np.int64).view(np.uint64), n_pivots)
    cells = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64)))) for i, m in enumerate(masks)])
    spread = nodes.select("node", "fp", F.explode(cells).alias("cell"))
    hot = spread.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS).select("cell", F.ceil(F.col("n") * 2 / CELL_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts"))
    ways = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64("cell", F.least(j, part), F.greatest(j, part)))
    dealt = spread.join(hot, "cell", "left").select("node", "fp", F.explode(F.when(F.col("parts").isNull(), F.array("cell")).otherwise(ways)).alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: np.ndarray) -> pa.RecordBatch:
            root = link_cells(rows[0], rows[1].view(np.uint64), radius, pivots)
            own = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(rows[2][root[own]]), pa.array(rows[2][own])], names=["a", "b"])

        held: list[np.ndarray] = []
        for b in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]))
            if sum(x.shape[1] for x in held) < CHUNK_ROWS:
                continue
            rows = np.concatenate(held, axis=1)
            whole = int(np.searchsorted(rows[0], rows[0][-1]))  # the last cell may go on in the next batch
            held = [rows[:, whole:]]
            if whole:
                yield links(rows[:, :whole])
        if held:
            yield links(np.concatenate(held, axis=1))

    return dealt.select("cell", "fp", "node").repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``(key, fp, component_id)`` for every row: the smallest key reachable over links of at most ``radius`` bits."""
    prints = cut(fingerprints(docs, shingle, key, text))
    nodes = cut(prints.groupBy("fp").agg(F.min(key).alias("node")))
    # Fingerprints whose rows all lack an id still link others: they take a negative stand-in derived from their bits.
    stand_in = F.coalesce("node", -(F.col("fp").bitwiseAND(F.lit((1 << 62) - 1))) - (1 << 62))
    named = nodes.select(stand_in.alias("node"), "fp", F.col("node").alias("id"))
    found = connected_components(fingerprint_links(named.select("node", "fp"), radius, **kw))
    labels = named.join(found, "node", "left").select("fp", "id", F.coalesce("component", "node").alias("class"))
    least = labels.groupBy("class").agg(F.min("id").alias("component_id"))
    by_fp = labels.join(least, "class").select("fp", "component_id")
    return prints.join(by_fp, "fp").select(key, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int, radius: int, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """Rows of ``docs`` whose key is its component's smallest; rows with a null key stay."""
    found = near_duplicates(docs, shingle, radius, key, text, **kw).where(f"{key} <> component_id").select(key).distinct()
    return docs.join(found, key, "left_anti")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
