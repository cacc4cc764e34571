"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Shingles are SHINGLE consecutive lower-cased words, hashed to 64 bits; a text of fewer words is one shingle, and items of
so few words are sought among the runs of as many words. A window is as many shingles as an item has, or a whole shorter
document. Every window that may reach the similarity gets a fingerprint: it must hold a share of shingles of items of its
size that is counted exactly, in whatever order. A fingerprint is cut into BLOCKS blocks; the items' index lists all
values near their own blocks' values, so that equal-block joins find every item fingerprint of that size within RADIUS
bits. The weighted Jaccard similarity of the two bags of shingles then decides.

The radius is the one loss: of windows at the least similarity about one in twenty differ by more bits.

Null or wordless texts and items have no shingles and are never found. Results are distinct per (doc_id, item_id), so
repeated rows and null ids give one row each. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.quality import _held, _joined, words_of
from spanforge.session import cut

SHINGLE = 5
RADIUS = 14
BLOCKS = 5  # of 12 or 13 bits each
SIMILARITY = 0.8
MAX_FILTER_BITS = 27  # log2 of the shingle filter's largest size: 16 MB; false hits only cost time
MAX_BROADCAST_ROWS = 2_000_000
PART_WORDS = 100_000  # of the items in one partition of their tables


def shingles(df: DataFrame, text: Column, name: str, words: int = SHINGLE) -> DataFrame:
    """Add the array of hashes of runs of ``words`` words under ``name``, of the whole text where it has fewer."""
    hashed = _held(df, _hashes=F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w)))
    short = F.when(F.size("_hashes") > 0, F.array(F.xxhash64("_hashes"))).otherwise(F.array().cast("array<bigint>"))
    return _held(hashed, **{name: F.when(F.size("_hashes") >= words, _joined("_hashes", words)).otherwise(short)}).drop("_hashes")


def simhash(bag: Column) -> Column:
    """Bits that more than half of the hashes have: 32 sums of two lanes each, one pass over the bag."""
    lanes = (1 << 32) + 1
    zero = F.struct(*[F.lit(0).cast("long").alias(f"s{i}") for i in range(32)])
    add = lambda a, x: F.struct(*[(a[f"s{i}"] + F.shiftrightunsigned(x, i).bitwiseAND(F.lit(lanes))).alias(f"s{i}") for i in range(32)])

    def finish(a: Column) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            for lane, bit in ((a[f"s{i}"].bitwiseAND(F.lit((1 << 32) - 1)), i), (F.shiftrightunsigned(a[f"s{i}"], 32), i + 32)):
                out = out.bitwiseOR(F.when(2 * lane > F.size(bag), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long")))
        return out

    return F.aggregate(bag, zero, add, finish)


def _edges() -> list[tuple[int, int]]:
    at = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    return list(zip(at, at[1:], strict=False))


def blocks(fp: str) -> Column:
    """(number, value) of each block."""
    value = lambda a, b: F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
    return F.array(*[F.struct(F.lit(i).alias("block"), value(a, b).alias("value")) for i, (a, b) in enumerate(_edges())])


def near_blocks(fp: str, radius: int) -> Column:
    """All (number, value) within ``radius // BLOCKS`` bits of a block: fingerprints within ``radius`` have at least one
    block that differs by so little, else every block would differ by more and the sum would pass the radius."""
    def near(i: int, bits: int) -> Column:
        masks = [sum(1 << k for k in c) for size in range(radius // BLOCKS + 1) for c in combinations(range(bits), size)]
        own = F.get(blocks(fp), F.lit(i))["value"]
        return F.transform(F.from_json(F.lit(json.dumps(masks)), "array<bigint>"), lambda m: F.struct(F.lit(i).alias("block"), own.bitwiseXOR(m).alias("value")))

    return F.concat(*[near(i, b - a) for i, (a, b) in enumerate(_edges())])


def weighted_jaccard(a: str, b: str) -> Column:
    """Of two bags of hashes: a shingle weighs as often as it occurs."""
    times = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    again = lambda c: F.array_distinct(F.filter(F.col(c), lambda x, i: F.array_position(F.col(c), x) <= i))
    both = (F.size(F.array_distinct(a)) < F.size(a)) & (F.size(F.array_distinct(b)) < F.size(b))
    repeated = F.when(both, F.array_intersect(again(a), again(b))).otherwise(F.array().cast("array<bigint>"))
    common = F.aggregate(repeated, F.size(F.array_intersect(a, b)), lambda s, x: s + F.least(times(a, x), times(b, x)) - 1)
    return common / (F.size(a) + F.size(b) - common)


def least_common(n: Column, m: Column, similarity: float) -> Column:
    """Shingles that bags of ``n`` and ``m`` must share to reach the similarity."""
    return F.greatest(F.ceil(F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(1e-9)), F.lit(1)).cast("int")


def shingle_filter(hashes: DataFrame, n: int) -> tuple[Column, int]:
    """A folded array of 64-bit words with two bits set for each hash, and log2 of its bits."""
    bits = min(MAX_FILTER_BITS, max(16, math.ceil(math.log2(16 * n))))
    spot = lambda x: F.struct(F.shiftright(x.bitwiseAND(F.lit((1 << bits) - 1)), 6).cast("int").alias("word"), F.lit(1).cast("long").alias("one"), x.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    spots = hashes.select(F.explode(F.array(spot(F.col("h")), spot(F.shiftright("h", 24)))).alias("s"))
    rows = spots.groupBy("s.word").agg(F.bit_or(F.call_function("shiftleft", F.col("s.one"), F.col("s.bit"))).alias("w")).collect()
    words = [0] * (1 << (bits - 6))
    for r in rows:
        words[r["word"]] = r["w"]
    return F.from_json(F.lit(json.dumps(words)), "array<bigint>"), bits


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, hamming, window_start``: the best window of every leaked pair."""
    items = benchmark.select("item_id", F.col(item_text).alias("_item_text")).withColumn("_words", F.size(words_of(F.col("_item_text")))).where("_words > 0")
    totals = {r["kind"]: r["total"] for r in items.groupBy(F.least("_words", F.lit(SHINGLE)).alias("kind")).agg(F.sum("_words").alias("total")).collect()}
    parts = {words: math.ceil(total / PART_WORDS) for words, total in totals.items()}
    found = _search(docs, items.where(F.col("_words") >= SHINGLE), SHINGLE, parts.pop(SHINGLE, 1), text, radius, similarity)
    for words in sorted(parts):  # at most SHINGLE - 1 lengths, and none in an ordinary benchmark
        found = found.unionByName(_search(docs, items.where(F.col("_words") == words), words, parts[words], text, radius, similarity))
    return found


def _search(docs: DataFrame, items: DataFrame, words: int, parts: int, text: str, radius: int, similarity: float) -> DataFrame:
    """Leaks of items of at least ``words`` words, by shingles of ``words`` words.

    The items' tables are laid down in at most ``parts`` partitions, however many the session shuffles to: each is a file
    of the checkpoint folder, and for each file Hadoop may start processes that share the executor's memory.

    Documents are read once. What of a document lies around dense hits of the fixed-size shingle filter is regrouped by
    document and size of item; nothing else of it is exchanged. Tables of the items are broadcast while they number at
    most MAX_BROADCAST_ROWS rows, else joined by shuffle.
    """
    items = shingles(items, F.col("_item_text"), "item", words).select("item_id", "item").distinct().withColumn("n", F.size("item"))
    items = cut(items.withColumn("item_fp", simhash(F.col("item"))).coalesce(parts))
    sizes = cut(items.select(F.explode("item").alias("anchor"), "n").distinct().coalesce(parts))
    about = items.agg(F.max("n").alias("longest"), F.min("n").alias("least"), F.count(F.lit(1)).alias("items")).first()
    if not about["items"]:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("hamming"), F.lit(0).alias("window_start")).limit(0)
    n_sizes = sizes.count()
    table, bits = shingle_filter(sizes.select(F.col("anchor").alias("h")).distinct(), n_sizes)
    one = lambda y: F.getbit(F.get(table, F.shiftright(y.bitwiseAND(F.lit((1 << bits) - 1)), 6).cast("int")), y.bitwiseAND(F.lit(63)).cast("int")) == 1
    may_hit = lambda x: one(x) & one(F.shiftright(x, 24))
    share = 1 - similarity / (1 + similarity) * 2  # of a window's shingles that may be strange to its item
    gap = int(share * about["longest"] + 1e-9) + 1  # between hits of one window, at most
    least = max(1, math.ceil(similarity * about["least"] - 1e-9))  # hits of any window, at least

    read = shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text")), F.col("_text"), "bag", words).select("doc_id", "bag")
    marked = _held(read, _at=F.filter(F.transform("bag", lambda x, i: F.when(may_hit(x), i)), lambda i: i.isNotNull())).where(F.size("_at") >= least)
    first = F.filter("_at", lambda x, i: (i == 0) | (x - F.get("_at", i - 1) > gap))
    last = F.filter("_at", lambda x, i: F.coalesce(F.get("_at", i + 1) - x > gap, F.lit(True)))
    dense = F.filter(F.arrays_zip(first.alias("a"), last.alias("b")), lambda s: s["b"] - s["a"] + 1 >= least)
    spans = _held(marked, _dense=dense).select("doc_id", "bag", F.explode("_dense").alias("s"))
    spans = spans.select("doc_id", F.size("bag").alias("size"), F.greatest(F.col("s.a") - gap, F.lit(0)).alias("from"), F.slice("bag", F.greatest(F.col("s.a") - gap, F.lit(0)) + 1, F.col("s.b") - F.greatest(F.col("s.a") - gap, F.lit(0)) + 1 + gap).alias("around"))
    spans = _held(spans, mark=F.xxhash64("around"))
    hits = spans.select("*", F.posexplode("around").alias("p", "anchor")).where(may_hit(F.col("anchor")))
    met = hits.join(F.broadcast(sizes) if n_sizes <= MAX_BROADCAST_ROWS else sizes, "anchor")
    # The hits of a span come from one task, so they meet before the exchange.
    grouped = met.groupBy("doc_id", "from", "size", "mark", "n").agg(F.array_sort(F.collect_list("p")).alias("hits"), F.first("around").alias("around"))
    grouped = grouped.withColumn("width", F.least("n", "size")).withColumn("need", least_common(F.col("n"), F.col("width"), similarity))
    grouped = _held(grouped.where("size(hits) >= need"), _hits=F.array_distinct("hits")).drop("hits")
    # The i-th to the (i + need - 1)-th hit lie in the windows that start after the latter less the width, up to the former.
    start = lambda x, i: F.greatest(F.get("_hits", i + F.col("need") - 1) - F.col("width") + 1, F.lit(0))
    stop = lambda x: F.least(x, F.size("around") - F.col("width"))
    runs = F.transform("_hits", lambda x, i: F.when(start(x, i) <= stop(x), F.sequence(start(x, i), stop(x))).otherwise(F.array().cast("array<int>")))
    windows = grouped.select("*", F.explode(F.array_distinct(F.flatten(F.filter(runs, lambda r: r.isNotNull())))).alias("at"))
    windows = windows.select("doc_id", "n", (F.col("from") + F.col("at")).alias("window_start"), F.slice("around", F.col("at") + 1, F.col("width")).alias("window"))
    prints = _held(windows, fp=simhash(F.col("window"))).select("*", F.explode(blocks("fp")).alias("b"))
    index = items.select("item_id", "item_fp", F.col("n").alias("item_n"), F.explode(near_blocks("item_fp", radius)).alias("ib"))
    small = about["items"] * len(_edges()) * sum(math.comb(13, k) for k in range(radius // BLOCKS + 1)) <= MAX_BROADCAST_ROWS
    same_block = (F.col("n") == F.col("item_n")) & (F.col("b.block") == F.col("ib.block")) & (F.col("b.value") == F.col("ib.value"))
    pairs = prints.join(F.broadcast(index) if small else index, same_block).withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("hamming") <= radius)
    # A pair may meet in several blocks: the first one that differs by little enough speaks for all.
    each = F.array(*[F.bit_count(F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("item_fp")), a).bitwiseAND(F.lit((1 << (b - a)) - 1))) for a, b in _edges()])
    pairs = pairs.where(F.col("b.block") == F.array_position(F.transform(each, lambda d: d <= radius // BLOCKS), F.lit(True)) - 1)
    bags = items.select(F.col("item_id").alias("_id"), F.col("item_fp").alias("_fp"), "item")
    met = pairs.join(F.broadcast(bags) if n_sizes <= MAX_BROADCAST_ROWS else bags, pairs["item_id"].eqNullSafe(bags["_id"]) & (pairs["item_fp"] == bags["_fp"]))
    verified = met.withColumn("similarity", weighted_jaccard("window", "item")).where(F.col("similarity") >= similarity)
    best = F.struct("similarity", (-F.col("hamming")).alias("h"), (-F.col("window_start")).alias("s"))
    found = verified.groupBy("doc_id", "item_id").agg(F.max(best).alias("b"))
    return found.select("doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.h")).cast("int").alias("hamming"), (-F.col("b.s")).cast("int").alias("window_start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Rows of ``docs`` whose id has no leaked pair; rows with a null id stay."""
    return docs.join(find_leaks(docs, benchmark, **kw).select("doc_id").distinct(), "doc_id", "left_anti")
