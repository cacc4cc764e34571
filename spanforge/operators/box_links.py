"""Components of duplicate boxes: links are found and replaced by trees inside the tasks, so no list of pairs ever travels."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators.components import TREES, trees_of
from spanforge.operators.spatial_join import COPIES, cell_for, extents

SIDE = 4  # side of a cell, in cells of the boxes' joins
BLOCK = 4  # cells of a block on either axis; a block's cells share a task
CHUNK_ROWS = 1 << 16
CANDIDATES = 1 << 20  # pairs that are compared at once


def box_links_side(objects: DataFrame) -> int | None:
    """The side of ``box_links``' cells; None where its rule doesn't hold, as an area isn't that of a whole-numbered box."""
    whole = F.lit(True)
    for c in ("x0", "y0", "x1", "y1"):
        whole = whole & (F.col(c) == F.col(c).cast("long"))
    even = whole & F.expr("x1 > x0 and y1 > y0 and id is not null and area = (x1 - x0) * (y1 - y0)")
    row = objects.agg(*extents(), F.bool_and(F.coalesce(even, F.lit(False))).alias("even")).first()
    return None if row["even"] is False else SIDE * int(cell_for(row["wh"] or 0.0, row["s"] or 0.0, COPIES))


def box_links(objects: DataFrame, side: int, iou: float, containment: float) -> DataFrame:
    """Trees ``(node, root)`` that connect the boxes whose intersection over union, or over the smaller area, exceeds its
    threshold.

    Thresholds are a half at least: then a pair's smaller box lies in the larger one by more than half on either axis, so
    its middle pixel does. Boxes go to every cell they touch; a pair is met in the cell of that pixel alone.
    """
    box = [F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")]
    touched = lambda a: F.explode(F.sequence(F.floor(F.col(f"{a}0") / side).cast("long"), F.floor((F.col(f"{a}1") - 1) / side).cast("long"))).alias(f"_c{a}")
    dealt = objects.select(F.col("id").cast("long").alias("id"), *box).select("*", touched("x")).select("*", touched("y"))
    dealt = dealt.repartition(F.floor(F.col("_cx") / BLOCK), F.floor(F.col("_cy") / BLOCK)).sortWithinPartitions("_cx", "_cy")
    limits = [Fraction(str(t)) for t in (iou, containment)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return trees_of(_found(batches, side, *limits))

    return dealt.select("_cx", "_cy", "id", "x0", "y0", "x1", "y1").mapInArrow(run, TREES)


def _found(batches: Iterator[pa.RecordBatch], side: int, iou: Fraction, containment: Fraction) -> Iterator[pa.RecordBatch]:
    """Links of the rows ``(cell, cell, id, box)``, which come cell by cell."""
    for rows in whole_cells(batches):
        yield from _linked(rows, side, iou, containment)


def whole_cells(batches: Iterator[pa.RecordBatch], slim: Callable[[np.ndarray], np.ndarray] = lambda rows: rows) -> Iterator[np.ndarray]:
    """The columns of rows ``(cell, cell, ...)``, which come cell by cell, of some whole cells at a time; ``slim`` drops
    rows that needn't be held."""
    held: list[np.ndarray] = []
    n, many = 0, CHUNK_ROWS
    for b in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
        n += b.num_rows
        if n < many:
            continue
        rows = slim(np.concatenate(held, axis=1))
        same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
        whole = int(np.argmax(same))  # the last cell may go on in the next batch
        if whole:
            yield rows[:, :whole]
        held, n = [rows[:, whole:]], rows.shape[1] - whole
        many = max(CHUNK_ROWS, 2 * n)
    if n:
        yield slim(np.concatenate(held, axis=1))


def _linked(rows: np.ndarray, side: int, iou: Fraction, containment: Fraction) -> Iterator[pa.RecordBatch]:
    cx, cy, ids, x0, y0, x1, y1 = rows
    cell = np.cumsum(np.r_[0, (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])])
    left, top = cx * side, cy * side
    area = (x1 - x0) * (y1 - y0)
    mx, my = (x0 + x1) // 2 - left, (y0 + y1) // 2 - top
    own = np.flatnonzero((mx >= 0) & (mx < side) & (my >= 0) & (my < side))
    key = (cell[own] * side + my[own]) * side + mx[own]
    order = np.argsort(key, kind="stable")
    own, key = own[order], key[order]
    # Every row of pixels of a box, within its cell, is a range of keys.
    y_low, y_high = np.maximum(y0 - top, 0), np.minimum(y1 - top, side)
    tall = y_high - y_low
    of = np.repeat(np.arange(len(ids)), tall)
    y = np.arange(len(of)) - np.repeat(np.cumsum(tall) - tall, tall) + y_low[of]
    line = (cell[of] * side + y) * side
    low, high = line + np.maximum(x0 - left, 0)[of], line + np.minimum(x1 - left, side)[of]
    keys = (int(cell[-1]) + 1) * side * side
    if keys <= 16 * len(of):
        before = np.r_[0, np.cumsum(np.bincount(key, minlength=keys))]
        low, high = before[low], before[high]
    else:
        low, high = np.searchsorted(key, low), np.searchsorted(key, high)
    met = np.flatnonzero(high > low)
    of, low, high = of[met], low[met], high[met]
    ends = np.cumsum(high - low)
    at = 0
    while at < len(of):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
        n = high[at:to] - low[at:to]
        large = np.repeat(of[at:to], n)
        small = own[np.arange(len(large)) + np.repeat(low[at:to] - (ends[at:to] - n - done), n)]
        at = to
        fits = np.flatnonzero((area[small] <= area[large]) & (small != large))
        small, large = small[fits], large[fits]
        inter = (np.minimum(x1[small], x1[large]) - np.maximum(x0[small], x0[large])) * (np.minimum(y1[small], y1[large]) - np.maximum(y0[small], y0[large]))
        less, more = area[small], area[large]
        far = (inter * iou.denominator > (less + more - inter) * iou.numerator) | (inter * containment.denominator > less * containment.numerator)
        yield pa.RecordBatch.from_arrays([pa.array(ids[small[far]]), pa.array(ids[large[far]])], names=["u", "v"])
