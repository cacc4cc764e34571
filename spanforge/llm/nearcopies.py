"""Near copies: candidates by fingerprint and by bands of minimum hashes, each verified by the Jaccard similarity of its
word shingles before it links.

Texts are compared ASCII-lower-cased and split at white space; a text shorter than a shingle is one shingle. Texts of
equal shingle sets are one node, so copies are never expanded. Nodes and shingles are 64-bit hashes. Wordless texts are
copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.chunks import release, small_batches
from spanforge.llm.simhash import SEED, fingerprint_links, hash_fingerprint, shingle_hashes
from spanforge.operators.components import connected_components
from spanforge.session import cut

#: Sets of similarity 0.8 share a band with probability 1 - (1 - 0.8**4)**20, 99.997 %.
BANDS, BAND_ROWS = 20, 4
SET_CHUNK = 1 << 15
CELL_ITEMS = 2 << 20  # shingles of a band that a worker holds
_SALTS = np.array([[xxhash.xxh64_intdigest(f"band {i} {k}", SEED) for i in range(BANDS * BAND_ROWS)] for k in "xm"], np.uint64)
_SALTS[1] |= np.uint64(1)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def band_keys(items: np.ndarray) -> np.ndarray:
    """A key for each band of minimum hashes of a set; none for the empty set."""
    if not len(items):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), SET_CHUNK):
        np.minimum(low, ((items[None, at : at + SET_CHUNK] ^ _SALTS[0][:, None]) * _SALTS[1][:, None]).min(1), out=low)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(low.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def node_of(items: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(items.tobytes(), SEED)).view(np.int64))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, th, t)`` of every row; rows of equal id and ``th``, the text's hash, hold the same text."""
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("th"), F.col(text).cast("string").alias("t"))


def _rows(docs: DataFrame, shingle: int, fp_shingle: int, key: str, text: str) -> DataFrame:
    """``(id, th, node, fp, size, bands)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t in b.column(2).cast(pa.binary()).to_pylist():
                items = shingle_set(t or b"", shingle)
                for column, value in zip(out, (node_of(items), hash_fingerprint(shingle_hashes(t or b"", fp_shingle)), len(items), band_keys(items)), strict=True):
                    column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names=["id", "th", "node", "fp", "size", "bands"])

    return small_batches(_texts(docs, key, text)).mapInArrow(run, "id long, th long, node long, fp long, size long, bands array<long>")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``(node, items)`` of every row of ``t``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                sets = [shingle_set(t or b"", shingle) for t in b.column(0).slice(at, 64).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "items"])

    return small_batches(texts).select("t").mapInArrow(run, "node long, items array<long>")


def band_pairs(members: DataFrame, num: int, den: int, steps: int = 2) -> DataFrame:
    """Distinct pairs ``(a, b)`` of nodes that share a band, whose sizes allow a similarity of ``num / den``, and that
    follow each other by at most ``steps`` places in order of size: most of what is alike, and at most ``steps`` rows for
    each of a node's bands.

    ``members``: ``(band, size, node)``.
    """

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        band, size, node = rows
        for step in range(1, steps + 1):
            near = np.flatnonzero((band[:-step] == band[step:]) & (num * size[step:] <= den * size[:-step]) & (node[:-step] != node[step:]))
            a, b = node[near], node[near + step]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.zeros((3, 0), np.int64)
        for b in batches:
            rows = np.concatenate([tail, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])], axis=1)
            yield from pairs(rows)
            tail = rows[:, -steps:]  # pairs within the tail come up again; they are made distinct below

    dealt = members.select("band", "size", "node").repartition("band").sortWithinPartitions("band", "size", "node")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def band_links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` that connect all nodes of different ``class`` that share a band and have a similarity of at least
    ``num / den``. Sets travel to the bands of several classes, where every pair of classes is compared in place and only
    a spanning forest comes back, so no pairs are listed. A band of more than CELL_ITEMS shingles is dealt out as pairs
    of its parts.

    ``members``: ``(band, size, node, class)``.
    """
    mixed = members.groupBy("band").agg(F.min("class").alias("_least"), F.max("class").alias("_most"), F.sum("size").alias("_items")).where("_least <> _most")
    mixed = mixed.select("band", F.ceil(2 * F.col("_items") / CELL_ITEMS).cast("int").alias("parts"))
    held = members.join(mixed, "band").join(sets, "node")
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts"))
    ways = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64("band", F.least(j, part), F.greatest(j, part)))
    dealt = held.select("node", "class", "items", F.explode(F.when(F.col("parts") <= 2, F.array("band")).otherwise(ways)).alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []
        cell = None
        for b in batches:
            cells, nodes, groups = (b.column(i).to_pylist() for i in range(3))
            ends = np.asarray(b.column(3).offsets)
            flat = b.column(3).values.to_numpy(zero_copy_only=False)
            for i, c in enumerate(cells):
                if c != cell and held:
                    yield link_sets(held, num, den)
                    held = []
                cell = c
                held.append((nodes[i], groups[i], flat[ends[i] : ends[i + 1]].copy()))
        if held:
            yield link_sets(held, num, den)
        release()

    return dealt.select("cell", "node", "class", "items").repartition("cell").sortWithinPartitions("cell", "class", "node").mapInArrow(run, "a long, b long").distinct()


def link_sets(rows: list[tuple[int, int, np.ndarray]], num: int, den: int) -> pa.RecordBatch:
    """A forest of links between rows ``(node, class, set)`` of different classes that are alike enough."""
    names, root = np.unique(np.array([g for _, g, _ in rows], np.int64), return_inverse=True)
    sizes = np.array([len(x) for *_, x in rows], np.int64)
    first = np.cumsum(sizes) - sizes
    found: list[tuple[int, int]] = []
    if len(names) > 1 and sizes.all():
        used, local = np.unique(np.concatenate([x for *_, x in rows]), return_inverse=True)
        mark = np.zeros(len(used), np.int32)
        for i in np.flatnonzero(root != np.bincount(root).argmax()).tolist():  # rows of the largest class meet the others here
            own = local[first[i] : first[i] + sizes[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[local], first)
            mark[own] = 0
            near = np.flatnonzero(((num + den) * both >= num * (sizes + sizes[i])) & (root != root[i]))
            while len(near):
                found.append((rows[i][0], rows[int(near[0])][0]))
                root[root == root[near[0]]] = root[i]
                near = near[root[near] != root[i]]
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends.min(1) if len(ends) else ends[:, 0]), pa.array(ends.max(1) if len(ends) else ends[:, 0])], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have a Jaccard similarity of at least ``num / den``, exactly."""
    left, right = (sets.select(F.col("node").alias(c), F.col("items").alias(f"_{c}")) for c in "ab")
    both = F.size(F.array_intersect("_a", "_b"))
    return pairs.join(left, "a").join(right, "b").where((num + den) * both >= num * (F.size("_a") + F.size("_b"))).select("a", "b")


def classes(docs: DataFrame, rows: DataFrame, shingle: int, num: int, den: int, radius: int, key: str, text: str) -> DataFrame:
    """``(node, class)`` of the nodes that verified links connect, by smallest node."""
    name = F.struct(F.col("id").isNull().alias("last"), "id", "th")
    nodes = cut(rows.groupBy("node").agg(F.min(name).alias("name"), F.min("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    members = nodes.select("node", "size", F.explode("bands").alias("band"))
    busy = members.groupBy("band").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("band")
    members = cut(members.join(busy, "band"))
    prints = nodes.groupBy("fp").agg(F.min("node").alias("a"))
    alike = nodes.join(prints, "fp").where("node <> a").select("a", F.col("node").alias("b"))
    near = fingerprint_links(prints.select(F.col("a").alias("node"), "fp"), radius)
    sizes = nodes.select("node", "size")
    close = alike.unionByName(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    close = close.join(sizes.toDF("a", "_na"), "a").join(sizes.toDF("b", "_nb"), "b").where(f"{num} * greatest(_na, _nb) <= {den} * least(_na, _nb)").select("a", "b")
    pairs = cut(close.unionByName(band_pairs(members, num, den)).distinct())
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(members.select("node")).distinct()
    wanted = nodes.join(used, "node").select(F.col("name.id").alias("_id"), F.col("name.th").alias("_th"))
    texts = _texts(docs, key, text)
    texts = texts.join(wanted, texts["id"].eqNullSafe(wanted["_id"]) & (texts["th"] == wanted["_th"]))
    sets = cut(_sets(texts, shingle).groupBy("node").agg(F.first("items").alias("items")))
    links = cut(verified(pairs, sets, num, den))
    found = connected_components(links)
    linked = members.join(found, "node", "left").select("band", "size", "node", F.coalesce("component", "node").alias("class"))
    rest = cut(band_links(linked, sets, num, den))
    return connected_components(links.unionByName(rest)).withColumnRenamed("component", "class")


def drop_near_copies(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (4, 5), fp_shingle: int = 2, radius: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near copies, the one of the smallest key; rows without a key come last.

    Two texts are near copies if their sets of ``shingle`` words have a Jaccard similarity of at least ``similarity``
    (numerator, denominator); groups are the components of such links. Rows are told apart by key and text, so repeated
    and null keys lose copies too, and a text isn't lost to another one under its key.
    """
    num, den = similarity
    rows = cut(_rows(docs, shingle, fp_shingle, key, text))
    found = classes(docs, rows, shingle, num, den, radius, key, text)
    each = rows.groupBy("id", "th", "node").agg(F.count("*").alias("n")).join(found, "node", "left")
    each = cut(each.select("id", "th", "n", F.coalesce("class", "node").alias("class"), F.struct(F.col("id").isNull().alias("last"), "id", "th").alias("name")))
    first = each.groupBy("class").agg(F.min("name").alias("first"))
    fate = each.join(first, "class").select(F.col("id").alias("_id"), F.col("th").alias("_th"), (~F.col("name").eqNullSafe(F.col("first"))).alias("_gone"), (F.col("n") > 1).alias("_many")).where("_gone or _many")
    named = docs.withColumn("_text_hash", F.xxhash64(F.col(text).cast("string")))
    told = named.join(fate, named[key].cast("long").eqNullSafe(fate["_id"]) & (named["_text_hash"] == fate["_th"]), "left").where("_gone is null or not _gone")
    row = F.struct(*docs.columns)
    repeated = told.where("_many").groupBy(key, "_text_hash").agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_row.*")
    return told.where("_many is null").select(*docs.columns).unionByName(repeated)
