"""Point clouds over crowns: ground minimum per cell, gap fill, heights, exact percentiles, flags."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators.spatial_join import points_in_boxes
from spanforge.session import cut

GROUND = 2
SQUARE = 4  # side of the squares that crowns are dealt to, in extents of the largest crown of their level
CROWNS_AT_ONCE = 1024
CROWNS_OF_TASK = 50_000  # so many different ids fit a dictionary page of Parquet, twice over
BITS = 1 << 25  # crowns times points around them whose bits are held at once
SAME = 8  # equal heights around a block of crowns, on average, from which they are counted
MOST_COPIES = 4096  # of a height that one row stands for
ROWS_OUT = 100_000
SQUARE_KEY = ["_level", "_cx", "_cy"]


def point_cells(points: DataFrame, cell: float, width: int | None = None, height: int | None = None) -> DataFrame:
    """Add ``(r, c)``; points outside a raster of ``width`` by ``height`` cells are dropped."""
    out = points.withColumn("c", F.floor(F.col("x") / cell)).withColumn("r", F.floor(F.col("y") / cell))
    if width is not None and height is not None:
        out = out.where((F.col("c") >= 0) & (F.col("c") < width) & (F.col("r") >= 0) & (F.col("r") < height))
    return out


def dtm_min(points: DataFrame, cell: float) -> DataFrame:
    """Lowest ground point per cell: partial minima before the exchange."""
    return point_cells(points.where(F.col("cls") == GROUND), cell).groupBy("r", "c").agg(F.min("z").alias("g"))


def fill_dtm(dtm: DataFrame, width: int, height: int, reach: int = 3) -> DataFrame:
    """Cells without ground take the inverse-distance mean of ground cells up to ``reach`` cells away.

    An approximation of a raster gap fill, as offsets and an equi-join; cells with none in reach stay out.
    """
    spark = dtm.sparkSession
    grid = spark.range(width * height).select(F.expr(f"id div {width}").alias("r"), F.expr(f"id % {width}").alias("c"))
    holes = grid.join(dtm, ["r", "c"], "left_anti")
    offsets = F.expr(f"explode(sequence({-reach}, {reach}))")
    around = holes.select("r", "c", offsets.alias("dr")).select("r", "c", "dr", offsets.alias("dc")).where("dr <> 0 or dc <> 0")
    near = around.withColumn("nr", F.col("r") + F.col("dr")).withColumn("nc", F.col("c") + F.col("dc"))
    known = dtm.select(F.col("r").alias("nr"), F.col("c").alias("nc"), "g")
    weight = 1 / F.sqrt(F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc"))
    filled = near.join(known, ["nr", "nc"]).groupBy("r", "c").agg((F.sum(F.col("g") * weight) / F.sum(weight)).alias("g"))
    return dtm.select("r", "c", "g").unionByName(filled.select("r", "c", "g"))


def points_above(points: DataFrame, dtm: DataFrame, cell: float) -> DataFrame:
    """``(x, y, z_norm)`` of points other than ground, where the ground is known."""
    above = point_cells(points.where(F.col("cls") != GROUND), cell).join(dtm, ["r", "c"]).where("g is not null and not isnan(g)")
    return above.select("x", "y", (F.col("z") - F.col("g")).alias("z_norm"))


def normalised_points(points: DataFrame, dtm: DataFrame, crowns: DataFrame, cell: float) -> DataFrame:
    """``(tree_id, z_norm)`` of points other than ground inside crowns, where the ground is known.

    In the squares of ``crown_stats``; a crown's equal heights leave the task as one row with their number. Rows come crown
    by crown with equal heights together, so that files of them take run lengths, not a value for each row.
    """
    above = points_above(points, dtm, cell)
    boxes = crowns.select("tree_id", "x0", "y0", "x1", "y1")
    squares = _in_squares(above, boxes)
    if squares is None:
        return points_in_boxes(above, boxes).select("tree_id", "z_norm")
    dealt, spread, n = squares
    blank = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    both = dealt.select(*SQUARE_KEY, F.lit(False).alias("_point"), "tree_id", "x0", "y0", "x1", "y1", "_reach", blank(spread, "z_norm").alias("z_norm")).unionByName(
        spread.select(*SQUARE_KEY, F.lit(True).alias("_point"), blank(dealt, "tree_id").alias("tree_id"), F.col("x").alias("x0"), F.col("y").alias("y0"), *[F.lit(None).cast("double").alias(c) for c in ("x1", "y1", "_reach")], "z_norm"))
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // CROWNS_OF_TASK))
    kinds = [dealt.schema["tree_id"].dataType.simpleString(), spread.schema["z_norm"].dataType.simpleString()]
    counted = both.repartition(tasks, *SQUARE_KEY).sortWithinPartitions(*SQUARE_KEY).mapInArrow(_counted, f"tree_id {kinds[0]}, z_norm {kinds[1]}, n int")
    return counted.select("tree_id", F.explode(F.array_repeat("z_norm", F.col("n"))).alias("z_norm"))


def tree_stats(heights: DataFrame, threshold: float = 3.0, quantile: float = 0.99) -> DataFrame:
    """Exact interpolated quantile, counts and share above the threshold (strict), per tree."""
    above = F.count_if(F.col("z_norm") > threshold)
    stats = heights.groupBy("tree_id").agg(F.percentile("z_norm", quantile).alias("p99_height"), F.count("*").alias("n_total"), above.alias("n_above"))
    return stats.withColumn("pct_above", F.col("n_above") / F.col("n_total"))


def crown_stats(points: DataFrame, dtm: DataFrame, crowns: DataFrame, cell: float, threshold: float = 3.0, quantile: float = 0.99) -> DataFrame:
    """``tree_stats`` of the ``normalised_points``, without a row for each point in each crown.

    Crowns go to the square that holds their lower corner, points to every square whose crowns may reach them (their own
    and a margin as wide as the largest crown), so a crown's points are all in one group, where they are counted and ranked
    as bits. Crowns under a quarter, a sixteenth... of the largest have squares of their own size. Ids with several boxes
    pool their points, so they go by the rows.
    """
    above = points_above(points, dtm, cell)
    ids = crowns.select("tree_id", "x0", "y0", "x1", "y1")
    repeated = cut(ids.groupBy("tree_id").count().where("count > 1").select("tree_id"))
    several = bool(repeated.limit(1).count())
    single = ids.join(repeated.withColumnRenamed("tree_id", "_again"), F.expr("tree_id <=> _again"), "left_anti") if several else ids
    stats = None
    if (squares := _in_squares(above, single)) is not None:
        dealt, spread, _ = squares
        kind = crowns.schema["tree_id"].dataType.simpleString()
        spread = spread.withColumn("z_norm", F.col("z_norm").cast("double"))
        stats = dealt.groupBy(*SQUARE_KEY).cogroup(spread.groupBy(*SQUARE_KEY)).applyInArrow(_ranker(threshold, quantile), f"tree_id {kind}, p99_height double, n_total long, n_above long")
    if several or stats is None:
        again = ids.join(repeated.withColumnRenamed("tree_id", "_again"), F.expr("tree_id <=> _again"), "left_semi")
        rest = tree_stats(points_in_boxes(above, again).select("tree_id", "z_norm"), threshold, quantile).drop("pct_above")
        stats = rest if stats is None else stats.unionByName(rest)
    return stats.withColumn("pct_above", F.col("n_above") / F.col("n_total"))


def _in_squares(above: DataFrame, crowns: DataFrame) -> tuple[DataFrame, DataFrame, int] | None:
    """(crowns, points) dealt to SQUARE_KEY, and how many crowns; None without a crown that has an area."""
    boxes = crowns.select("tree_id", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]).where("x1 > x0 and y1 > y0")
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    top, n = boxes.agg(F.max(extent), F.count(F.lit(1))).first()
    if top is None:
        return None
    level = F.floor(F.log(F.lit(top) / extent) / math.log(4) + 1e-9).cast("int")
    boxes = boxes.withColumn("_level", level)
    levels = sorted(r[0] for r in boxes.select("_level").distinct().collect())
    reach = F.element_at(F.array(*[F.lit(top / 4**k * (1 + 1e-6)) for k in range(levels[-1] + 1)]), F.col("_level") + 1)
    square = lambda v: F.floor(v / (SQUARE * reach)).cast("long")
    dealt = boxes.select("*", reach.alias("_reach"), square(F.col("x0")).alias("_cx"), square(F.col("y0")).alias("_cy"))
    spread = above.where("abs(x) < double('inf') and abs(y) < double('inf')").select(*[F.col(c).cast("double").alias(c) for c in ("x", "y")], "z_norm", F.explode(F.array(*[F.lit(k) for k in levels])).alias("_level"))
    spread = spread.select("*", F.explode(F.sequence(square(F.col("x") - reach), square(F.col("x")))).alias("_cx"))
    return dealt, spread.select("*", F.explode(F.sequence(square(F.col("y") - reach), square(F.col("y")))).alias("_cy")), n


def _flat(column: pa.ChunkedArray) -> pa.Array:
    flat = column.combine_chunks()
    return pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(tree_id, z_norm, n)``: equal heights of a crown's points and their number, from rows sorted by SQUARE_KEY."""
    for rows in _whole_squares(batches):
        point = rows.column("_point").to_numpy()
        crowns, points = rows.filter(pa.array(~point)), rows.filter(pa.array(point))
        if not len(crowns) or not len(points):
            continue
        ids, heights = _flat(crowns.column("tree_id")), _flat(points.column("z_norm"))
        held, many = [], 0
        for crown, height, n in _counts(crowns, points, _height_codes(heights)):
            if (n > MOST_COPIES).any():
                again = -(-n // MOST_COPIES)
                crown, height, last = np.repeat(crown, again), np.repeat(height, again), np.cumsum(again) - 1
                rest = n - (again - 1) * MOST_COPIES
                n = np.full(len(crown), MOST_COPIES)
                n[last] = rest
            held.append((crown, height, n))
            many += len(crown)
            if many >= ROWS_OUT:
                yield from _told(ids, heights, held)
                held, many = [], 0
        yield from _told(ids, heights, held)


def _told(ids: pa.Array, heights: pa.Array, held: list) -> Iterator[pa.RecordBatch]:
    if held:
        crown, height, n = (np.concatenate(v) for v in zip(*held, strict=True))
        for i in range(0, len(crown), ROWS_OUT):
            at = slice(i, i + ROWS_OUT)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(crown[at])), heights.take(pa.array(height[at])), pa.array(n[at].astype("int32"))], names=["tree_id", "z_norm", "n"])


def _whole_squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(k).to_numpy() for k in SQUARE_KEY])
        turns = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        for s, e in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True):
            if at is not None and (keys[s] != at).any():
                yield pa.Table.from_batches(held)
                held = []
            at = keys[s]
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _height_codes(heights: pa.Array) -> np.ndarray:
    """Equal numbers for equal heights, bit by bit where they are floating; null has one of its own."""
    if pa.types.is_floating(heights.type):
        z = heights.to_numpy(zero_copy_only=False)
        code = np.unique(z.view(f"i{z.itemsize}"), return_inverse=True)[1]
    else:
        code = heights.dictionary_encode().indices.fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
    code[heights.is_null().to_numpy(zero_copy_only=False)] = len(heights)
    return code


def _counts(crowns: pa.Table, points: pa.Table, code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(crown, a point of that height in it, number of such points) as indexes, crown by crown."""
    x0, y0, x1, y1, reach = (crowns.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1", "_reach"))
    x, y = (points.column(c).to_numpy() for c in ("x0", "y0"))
    for own, near in _blocks(x0, y0, x, y, reach[0]):
        near = near[np.argsort(code[near], kind="stable")]
        starts = np.flatnonzero(np.r_[True, code[near][1:] != code[near][:-1]])
        ends = np.r_[starts, len(near)]
        word, bit = np.minimum(ends >> 6, -(-len(near) // 64) - 1), ends & 63
        low = np.where(ends >> 6 > word, np.uint64(2**64 - 1), (np.uint64(1) << bit.astype("uint64")) - np.uint64(1))
        few = max(1, min(CROWNS_AT_ONCE, BITS // len(near)))
        for part in np.array_split(own, -(-len(own) // few)):
            bits = _bits(x[near], y[near], (x0[part], y0[part], x1[part], y1[part]))
            if len(starts) * SAME > len(near):
                crown, at = np.nonzero(np.unpackbits(bits.view("uint8"), axis=1, bitorder="little"))
                yield part[crown], near[at], np.ones(len(crown), "int64")
                continue
            count = np.cumsum(np.bitwise_count(bits), axis=1, dtype="int64")
            upto = np.where(word > 0, count[:, word - 1], 0) + np.bitwise_count(bits[:, word] & low)
            n = np.diff(upto, axis=1)
            crown, at = np.nonzero(n)
            yield part[crown], near[starts[at]], n[crown, at]


def _blocks(x0: np.ndarray, y0: np.ndarray, x: np.ndarray, y: np.ndarray, side: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(crowns, points that they may hold), by blocks as wide as the largest crown: a block's crowns reach into the next
    block at most."""
    by, bx = np.floor(y0 / side).astype("int64"), np.floor(x0 / side).astype("int64")
    py, px = np.floor(y / side).astype("int64"), np.floor(x / side).astype("int64")
    order = np.lexsort((px, py))
    lowest, wide = min(px.min(), bx.min()), max(px.max(), bx.max()) - min(px.min(), bx.min()) + 3
    at = (py * wide + (px - lowest))[order]
    crown_order = np.lexsort((bx, by))
    block = (by * wide + (bx - lowest))[crown_order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for s, e in zip(starts, np.r_[starts[1:], len(block)], strict=True):
        ends = np.searchsorted(at, [block[s], block[s] + 2, block[s] + wide, block[s] + wide + 2])
        near = order[np.r_[ends[0] : ends[1], ends[2] : ends[3]]]
        if len(near):
            yield crown_order[s:e], near


def _ranker(threshold: float, quantile: float):
    def rank(crowns: pa.Table, points: pa.Table) -> pa.Table:
        out = {"tree_id": [], "p99_height": [], "n_total": [], "n_above": []}
        kind = crowns.schema.field("tree_id").type
        ids = _flat(crowns.column("tree_id"))
        if len(crowns) and len(points):
            x0, y0, x1, y1, reach = (crowns.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1", "_reach"))
            x, y = (points.column(c).to_numpy() for c in ("x", "y"))
            z = points.column("z_norm")
            known = ~z.is_null().to_numpy()
            z = z.to_numpy()
            for own, near in _blocks(x0, y0, x, y, reach[0]):
                near = near[np.argsort(z[near], kind="stable")]
                near, blank = near[known[near]], near[~known[near]]
                for part in np.array_split(own, -(-len(own) // CROWNS_AT_ONCE)):
                    box = x0[part], y0[part], x1[part], y1[part]
                    n, value, n_above = _ranks(x[near], y[near], z[near], box, threshold, quantile)
                    total = n + (_ranks(x[blank], y[blank], z[blank], box, threshold, quantile)[0] if len(blank) else 0)
                    hit = total > 0
                    out["tree_id"].append(ids.take(pa.array(part[hit])))
                    out["p99_height"].append(pa.array(value[hit], mask=(n == 0)[hit]))
                    out["n_total"].append(pa.array(total[hit]))
                    out["n_above"].append(pa.array(n_above[hit]))
        types = [kind, pa.float64(), pa.int64(), pa.int64()]
        return pa.table({k: pa.chunked_array(v, type=t) for (k, v), t in zip(out.items(), types, strict=True)})

    return rank


def _bits(x, y, box):
    """A bit for each point tells whether a box holds it: two bounds on either axis, each a row of bits that all boxes share."""
    m, words = len(box[0]), -(-len(x) // 64)

    def between(v, low, high):
        bounds, where = np.unique(np.concatenate([low, high]), return_inverse=True)
        below = np.zeros((len(bounds), words * 8), "uint8")
        packed = np.packbits(v[None, :] < bounds[:, None], axis=1, bitorder="little")
        below[:, : packed.shape[1]] = packed
        below = below.view("<u8")
        return below[where[m:]] & ~below[where[:m]]

    return between(x, box[0], box[2]) & between(y, box[1], box[3])


def _ranks(x, y, z, box, threshold, quantile):
    """Number of points, interpolated quantile and number above the threshold of each box; ``z`` ascends."""
    m, words = len(box[0]), -(-len(x) // 64)
    none = np.zeros(m, "int64")
    if not words:
        return none, np.zeros(m), none

    bits = _bits(x, y, box)
    count = np.cumsum(np.bitwise_count(bits), axis=1, dtype="int64")
    n = count[:, -1]
    first = int(np.searchsorted(z, threshold, side="right"))  # NaN sorts last and counts as above, as in SQL
    word, bit = divmod(first, 64)
    low = count[:, word - 1] if word else none
    if bit:
        low = low + np.bitwise_count(bits[:, word] & np.uint64((1 << bit) - 1))
    rows = np.arange(m)

    def nth(k):
        w = np.argmax(count > k[:, None], axis=1)
        left = k - np.where(w > 0, count[rows, w - 1], 0)
        inside = np.cumsum(np.unpackbits(bits[rows, w].astype("<u8")[:, None].view("uint8"), axis=1, bitorder="little"), axis=1, dtype="int64")
        return z[np.minimum(w * 64 + np.argmax(inside > left[:, None], axis=1), len(z) - 1)]

    place = np.maximum(n - 1, 0) * quantile
    a, b = np.floor(place), np.ceil(place)
    za, zb = nth(a.astype("int64")), nth(b.astype("int64"))
    with np.errstate(invalid="ignore"):
        value = np.where((a == b) | (za == zb), za, (b - place) * za + (place - a) * zb)
    return n, value, n - low


def flag_heights(crowns: DataFrame, stats: DataFrame, min_share: float = 0.30, drop: bool = False) -> DataFrame:
    """Crowns with their statistics (0 where no point fell) and a flag; rows are flagged, dropped only on demand."""
    joined = crowns.join(stats, "tree_id", "left")
    filled = joined.select(*[c for c in joined.columns if c not in ("p99_height", "n_total", "n_above", "pct_above")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("p99_height", "n_total", "n_above", "pct_above")])
    flagged = filled.withColumn("is_tree", F.col("pct_above") >= min_share)
    return flagged.where("is_tree") if drop else flagged


def hash_buckets(df: DataFrame, key: str, n: int = 64) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.col(key), F.lit(n)))
