"""Bucketed spatial joins: boxes are exploded into grid cells and joined on the cell, never by nested loops."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = 4.0  # cells that a box touches on average


def _cells(prefix: str, axis: str, cell: int) -> Column:
    low, high = F.floor(F.col(f"{prefix}{axis}0") / cell), F.floor((F.ceil(F.col(f"{prefix}{axis}1")) - 1) / cell)
    return F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))


def cell_size(boxes: DataFrame, copies: float = COPIES) -> float:
    """The cell that boxes touch ``copies`` of on average, 1 at least, by one pass over their extents.

    Of boxes about as large as the cell few pairs meet in vain; larger cells make the pairs of a dense area explode, smaller
    ones the rows. Few very large boxes enlarge it, so the rows stay bounded whatever the extents.
    """
    row = boxes.agg(*extents()).first()
    return cell_for(row["wh"] or 0.0, row["s"] or 0.0, copies)


def extents() -> tuple[Column, Column]:
    w, h = (F.greatest(F.col(f"{a}1") - F.col(f"{a}0"), F.lit(0)).cast("double") for a in "xy")
    return F.avg(w * h).alias("wh"), F.avg(w + h).alias("s")


def cell_for(wh: float, s: float, copies: float) -> float:
    """The cell that boxes of mean area ``wh`` and mean half perimeter ``s`` touch ``copies`` of."""
    # wh / c^2 + s / c + 1 = copies
    return float(max(1, math.ceil((s + math.sqrt(s * s + 4 * wh * (copies - 1))) / (2 * (copies - 1)))))


def bucketed(boxes: DataFrame, prefix: str, cell: float) -> DataFrame:
    """A row per cell that the half-open box touches; cells are whole numbers wide."""
    rows = boxes.select("*", F.explode(_cells(prefix, "x", cell)).alias("_cx"))
    return rows.select("*", F.explode(_cells(prefix, "y", cell)).alias("_cy"))


def overlap_join(left: DataFrame, right: DataFrame, cell: float | None = None) -> DataFrame:
    """Pairs of overlapping boxes: columns of ``left`` get the prefix ``a_``, of ``right`` ``b_``.

    A pair may meet in several cells; it is kept in the one that holds the lower corner of the intersection, so no
    distinct is needed. The cell is about as large as a typical box of ``left``; skewed cells are left to AQE's skew join.
    """
    cell = cell or cell_size(left)
    a = bucketed(left.select(*[F.col(c).alias(f"a_{c}") for c in left.columns]), "a_", cell)
    b = bucketed(right.select(*[F.col(c).alias(f"b_{c}") for c in right.columns]), "b_", cell)
    pairs = a.join(b, ["_cx", "_cy"]).where("a_x0 < b_x1 and b_x0 < a_x1 and a_y0 < b_y1 and b_y0 < a_y1")
    own = (F.floor(F.greatest("a_x0", "b_x0") / cell) == F.col("_cx")) & (F.floor(F.greatest("a_y0", "b_y0") / cell) == F.col("_cy"))
    return pairs.where(own).drop("_cx", "_cy")


def box_intersection() -> Column:
    return (F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")) * (F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0"))


def span_intersections(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """Add ``inter``, the common pixels of each pair ``a_id, b_id``, from exploded spans ``(id, row, c0, c1)``."""
    a = spans.select(F.col("id").alias("a_id"), "row", F.col("c0").alias("ac0"), F.col("c1").alias("ac1"))
    b = spans.select(F.col("id").alias("b_id"), "row", F.col("c0").alias("bc0"), F.col("c1").alias("bc1"))
    met = pairs.select("a_id", "b_id").join(a, "a_id").join(b, ["b_id", "row"]).where("ac0 < bc1 and bc0 < ac1")
    sums = met.groupBy("a_id", "b_id").agg(F.sum(F.least("ac1", "bc1") - F.greatest("ac0", "bc0")).alias("inter"))
    return pairs.join(sums, ["a_id", "b_id"])


def points_in_boxes(points: DataFrame, boxes: DataFrame, cell: float | None = None) -> DataFrame:
    """Points ``(x, y)`` with every half-open box that holds them: each point has one cell, boxes are exploded."""
    cell = cell or cell_size(boxes, 2 * COPIES)
    p = points.withColumn("_cx", F.floor(F.col("x") / cell).cast("long")).withColumn("_cy", F.floor(F.col("y") / cell).cast("long"))
    met = p.join(bucketed(boxes, "", cell), ["_cx", "_cy"])
    return met.where("x >= x0 and x < x1 and y >= y0 and y < y1").drop("_cx", "_cy")
