"""Duplicate boxes merged inside the tasks: of a cell's boxes only each group's anchor and the spans of its union travel on."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.operators import box_links as L
from spanforge.operators import spans as S
from spanforge.operators.components import ROWS_OUT, roots_of, settle
from spanforge.session import cut, laid_down

PARTS = "kind int, root long, a long, b long, c long"
LINK, ANCHOR, SPAN, WHOLE_ANCHOR, WHOLE_SPAN = range(5)  # whole: of a group with no box that reaches beyond the cell


def merge_boxes(objects: DataFrame, side: int, iou: float, containment: float) -> tuple[DataFrame, DataFrame]:
    """(anchors ``(id, tile_id)``, disjoint spans ``(id, row, c0, c1)``) of the components that ``box_links`` would connect.

    The anchor is a component's largest box, then that of the smallest tile, then of the smallest id. Boxes go to every
    block they touch, and a pair is met in the block of its smaller box's middle pixel. A task settles a block's groups and
    unites their boxes there; groups are joined through the boxes that reach into several blocks.
    """
    side *= L.BLOCK
    box = [F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")]
    touched = lambda a: F.explode(F.sequence(F.floor(F.col(f"{a}0") / side).cast("long"), F.floor((F.col(f"{a}1") - 1) / side).cast("long"))).alias(f"_c{a}")
    dealt = objects.select(F.col("id").cast("long").alias("id"), F.col("tile_id").cast("long").alias("tile_id"), *box).select("*", touched("x")).select("*", touched("y"))
    dealt = dealt.repartition("_cx", "_cy").sortWithinPartitions("_cx", "_cy").select("_cx", "_cy", "id", "tile_id", "x0", "y0", "x1", "y1")
    limits = [Fraction(str(t)) for t in (iou, containment)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in L.whole_cells(batches, _without_copies):
            yield from _parts(rows, side, *limits)

    parts = laid_down(dealt.mapInArrow(run, PARTS))
    kind = lambda k: parts.where(F.col("kind") == k)
    before = F.lag("root").over(Window.partitionBy("a").orderBy("root")).alias("before")
    found = cut(settle(kind(LINK).select("root", before).where("root <> before").distinct(), "root", "before"))
    groups = kind(ANCHOR).join(found, F.col("root") == F.col("node"), "left").withColumn("component", F.coalesce("component", "root"))
    firsts = cut(groups.groupBy("component").agg(F.min(F.struct((-F.col("a")).alias("_a"), F.col("b").alias("tile_id"), F.col("c").alias("id"))).alias("_f")).select("component", "_f.id", "_f.tile_id"))
    names = groups.select("root", "component").distinct().join(firsts, "component").select("root", "id")
    run_of = [F.col("a").alias("row"), F.col("b").alias("c0"), F.col("c").alias("c1")]
    joined = S.union_spans(kind(SPAN).join(names, "root").select("id", *run_of), ["id"])
    anchors = kind(WHOLE_ANCHOR).select(F.col("c").alias("id"), F.col("b").alias("tile_id")).unionByName(firsts.select("id", "tile_id"))
    return anchors, kind(WHOLE_SPAN).select(F.col("root").alias("id"), *run_of).unionByName(joined)


def _without_copies(rows: np.ndarray) -> np.ndarray:
    """Of equal boxes in a cell that of the smallest tile, then of the smallest id, so that many copies are neither held nor
    compared. Copies that a clash of hashes keeps apart both stay, which only costs time."""
    places = [0, 1, 4, 5, 6, 7]
    h = np.zeros(rows.shape[1], np.int64)
    for i in places:
        h = (h ^ rows[i]) * -7046029254386353131
        h ^= h >> 29
    order = np.argsort(h)
    twice = h[order][1:] == h[order][:-1]
    if not twice.any():
        return rows
    some = np.flatnonzero(np.r_[twice, False] | np.r_[False, twice])
    some = order[some]
    some = some[np.lexsort((rows[2, some], rows[3, some], *rows[places][:, some], h[some]))]
    left = np.ones(rows.shape[1], bool)
    left[some[1:][(rows[places][:, some[1:]] == rows[places][:, some[:-1]]).all(axis=0)]] = False
    return rows[:, left]


def _parts(rows: np.ndarray, side: int, iou: Fraction, containment: Fraction) -> Iterator[pa.RecordBatch]:
    """Links, anchors and spans of the groups of whole cells. A box gives its spans in the cell of its middle pixel alone;
    where none of a group has its middle, the group is a single box, which nothing is said about."""
    cx, cy, ids, tiles, x0, y0, x1, y1 = rows
    cell = np.cumsum(np.r_[0, (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])])
    left, top = cx * side, cy * side
    x0, y0, x1, y1 = x0 - left, y0 - top, x1 - left, y1 - top
    mx, my = (x0 + x1) // 2, (y0 + y1) // 2
    own = (mx >= 0) & (mx < side) & (my >= 0) & (my < side)
    root = _roots(cell, (x0, y0, x1, y1), np.flatnonzero(own), side, iou, containment)
    beyond = (x0 < 0) | (y0 < 0) | (x1 > side) | (y1 > side)
    area = (x1 - x0) * (y1 - y0)
    order = np.lexsort((ids, tiles, -area, ~own, root))
    fresh = np.r_[True, root[order][1:] != root[order][:-1]]
    start = np.flatnonzero(fresh)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    anchor, open_ = order[start], np.logical_or.reduceat(beyond[order], start)
    name = np.where(open_, np.minimum.reduceat(ids[order], start), ids[anchor])
    at = np.flatnonzero(beyond & own[anchor][group])
    yield from _rows(np.full(len(at), LINK), name[group[at]], ids[at], ids[at], ids[at])
    at = np.flatnonzero(own[anchor])
    yield from _rows(np.where(open_, ANCHOR, WHOLE_ANCHOR)[at], name[at], area[anchor[at]], tiles[anchor[at]], ids[anchor[at]])
    if own.any():
        g, row, c0, c1 = _union(group[own], x0[own], y0[own], x1[own], y1[own])
        yield from _rows(np.where(open_, SPAN, WHOLE_SPAN)[g], name[g], row + top[anchor][g], c0 + left[anchor][g], c1 + left[anchor][g])


def _rows(kind: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(kind), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(kind[i : i + ROWS_OUT].astype(np.int32)), *[pa.array(c[i : i + ROWS_OUT]) for c in columns]], names=["kind", "root", "a", "b", "c"])


def _lines(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(box, row) of every row of pixels of the boxes."""
    tall = high - low
    of = np.repeat(np.arange(len(tall)), tall)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(tall) - tall - low, tall)


def _roots(cell: np.ndarray, box: tuple, own: np.ndarray, side: int, iou: Fraction, containment: Fraction) -> np.ndarray:
    """For each box, which is placed relative to its cell, one box of its group; ``own`` have their middle in the cell.

    Rows of pixels are read from the middles of the boxes outwards. Pairs of a group that is connected already are not
    compared, and rows whose boxes are all in one group not even listed: in dense places that leaves few.
    """
    x0, y0, x1, y1 = box
    n, area = len(cell), (x1 - x0) * (y1 - y0)
    mx, my = (x0 + x1) // 2, (y0 + y1) // 2
    key = (cell[own] * side + my[own]) * side + mx[own]
    order = np.argsort(key, kind="stable")
    own, key = own[order], key[order]
    keys = (int(cell[-1]) + 1) * side * side
    before = np.r_[0, np.cumsum(np.bincount(key, minlength=keys))] if keys <= 64 * n else None
    root = np.arange(n)
    for s in range(0, n, L.CHUNK_ROWS):
        part = slice(s, s + L.CHUNK_ROWS)
        of, y = _lines(np.maximum(y0[part], 0), np.minimum(y1[part], side))
        of += s
        away = np.abs(y - my[of])
        order = np.argsort(away.astype(np.uint16) if away.max() < 1 << 16 else away, kind="stable")
        of, y = of[order], y[order]
        line = (cell[of] * side + y) * side
        low, high = line + np.maximum(x0[of], 0), line + np.minimum(x1[of], side)
        low, high = (np.searchsorted(key, low), np.searchsorted(key, high)) if before is None else (before[low], before[high])
        met = np.flatnonzero(high > low)
        of, low, high = of[met], low[met], high[met]
        at, many = 0, min(n - s, L.CHUNK_ROWS)
        while at < len(of):
            here = slice(at, at + many)
            at, many = at + many, 2 * many
            root = _joined(root, own, of[here], low[here], high[here], box, area, iou, containment)
    return root


def _joined(root: np.ndarray, own: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray, box: tuple, area: np.ndarray, iou: Fraction, containment: Fraction) -> np.ndarray:
    """Roots after the boxes ``of`` are compared to the boxes of their ranges of ``own``."""
    x0, y0, x1, y1 = box
    while True:
        of_own = root[own]
        ends = np.r_[np.flatnonzero(of_own[1:] != of_own[:-1]) + 1, len(own)]
        stop = np.repeat(ends, np.diff(np.r_[0, ends]))
        live = np.flatnonzero((stop[low] < high) | (of_own[low] != root[of]))
        if not len(live):
            return root
        of, low, high = of[live], low[live], high[live]
        ends = np.cumsum(high - low)
        to = max(1, int(np.searchsorted(ends, L.CANDIDATES, side="right")))
        n = high[:to] - low[:to]
        large = np.repeat(of[:to], n)
        small = own[np.arange(len(large)) + np.repeat(low[:to] - (ends[:to] - n), n)]
        of, low, high = of[to:], low[to:], high[to:]
        fits = np.flatnonzero((root[small] != root[large]) & (area[small] <= area[large]))
        small, large = small[fits], large[fits]
        inter = (np.minimum(x1[small], x1[large]) - np.maximum(x0[small], x0[large])) * (np.minimum(y1[small], y1[large]) - np.maximum(y0[small], y0[large]))
        less, more = area[small], area[large]
        far = (inter * iou.denominator > (less + more - inter) * iou.numerator) | (inter * containment.denominator > less * containment.numerator)
        if far.any():
            root = roots_of(len(root), root[small[far]], root[large[far]])[root]


def _union(group: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, ...]:
    """Disjoint runs (group, row, start, end) of the boxes of equal group."""
    left, top = int(x0.min()), int(y0.min())
    wide, high = int(x1.max()) - left, int(y1.max()) - top
    found = []
    for s in range(0, len(group), L.CHUNK_ROWS):
        part = slice(s, s + L.CHUNK_ROWS)
        of, y = _lines(y0[part] - top, y1[part] - top)
        found.append(_islands(group[part][of] * high + y, x0[part][of] - left, x1[part][of] - left, wide))
    line, c0, c1 = found[0] if len(found) == 1 else _islands(*map(np.concatenate, zip(*found, strict=True)), wide)
    return line // high, line % high + top, c0 + left, c1 + left


def _islands(line: np.ndarray, c0: np.ndarray, c1: np.ndarray, wide: int) -> tuple[np.ndarray, ...]:
    """Touching runs of a line become one; ends are ``wide`` at most."""
    bits = wide.bit_length()
    if int(line.max()).bit_length() + 2 * bits < 63:
        packed = np.sort((line << 2 * bits) | (c0 << bits) | c1)
        line, c0, c1 = packed >> 2 * bits, (packed >> bits) & ((1 << bits) - 1), packed & ((1 << bits) - 1)
    else:
        order = np.lexsort((c0, line))
        line, c0, c1 = line[order], c0[order], c1[order]
    lift = line * (wide + 1)  # ends of a line lie above all ends of the lines before it
    far = np.maximum.accumulate(c1 + lift)
    start = np.flatnonzero(np.r_[True, (c0 + lift)[1:] > far[:-1]])
    end = np.r_[start[1:], len(far)] - 1
    return line[start], c0[start], (far - lift)[end]
