"""Tile, chunk and training grids, built as small DataFrames from ``sequence``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def axis_starts(size: int, window: int, stride: int) -> Column:
    """Starts along one axis: every stride until a window reaches the end, that last one flush with the end."""
    if size <= 0 or window <= 0 or stride <= 0:
        raise ValueError("size, window and stride are positive")
    if size <= window:
        return F.array(F.lit(0).cast("long"))
    last = -(-(size - window) // stride)
    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")), lambda i: F.least(i * stride, F.lit(size - window)))


def tile_grid(spark: SparkSession, width: int, height: int, window: int = 1024, stride: int = 768) -> DataFrame:
    """Row-major tiles with read windows, crop and write rectangles that cover the raster once, and edge flags."""
    half = max(0, (window - stride) // 2)
    base = spark.range(1).select(F.posexplode(axis_starts(height, window, stride)).alias("iy", "read_y"), axis_starts(width, window, stride).alias("xs"))
    tiles = base.select("iy", "read_y", F.size("xs").alias("nx"), F.posexplode("xs").alias("ix", "read_x"))
    out = tiles.withColumn("tile_id", (F.col("iy") * F.col("nx") + F.col("ix")).cast("long"))
    for axis, size, length in (("x", width, "w"), ("y", height, "h")):
        read, win = F.col(f"read_{axis}"), min(window, size)
        first, last = read == 0, read + win >= size
        crop = F.when(first, 0).otherwise(half)
        extent = F.when(first & last, win).when(first | last, win - half).otherwise(stride)
        out = out.withColumn(f"win_{length}", F.lit(win)).withColumn(f"crop_{axis}", crop).withColumn(f"write_{axis}", read + crop).withColumn(f"write_{length}", extent)
        out = out.withColumn("is_image_edge_w" if axis == "x" else "is_image_edge_n", first).withColumn("is_image_edge_e" if axis == "x" else "is_image_edge_s", last)
    return out.drop("iy", "ix", "nx")


def tile_rects(tiles: DataFrame, affine: tuple[float, ...]) -> DataFrame:
    """World rectangles of tiles under ``(a, b, c, d, e, f)``, corners normalised to min and max."""
    a, b, c, d, e, f = affine
    xs, ys = [], []
    for dx in (0, 1):
        for dy in (0, 1):
            px, py = F.col("read_x") + dx * F.col("win_w"), F.col("read_y") + dy * F.col("win_h")
            xs.append(px * a + py * b + c)
            ys.append(px * d + py * e + f)
    return tiles.select("*", F.least(*xs).alias("minx"), F.least(*ys).alias("miny"), F.greatest(*xs).alias("maxx"), F.greatest(*ys).alias("maxy"))


def train_tile_origins(spark: SparkSession, width: int, height: int, tile: int = 512, stride: int = 384) -> DataFrame:
    """Origins ``(x, y)``: every stride while a tile fits, plus one flush with the end; no origin comes twice."""

    def axis(size: int) -> Column:
        fit = F.sequence(F.lit(0).cast("long"), F.lit(max(0, size - tile)).cast("long"), F.lit(stride).cast("long"))
        return F.array_union(fit, F.array(F.lit(max(0, size - tile)).cast("long")))

    return spark.range(1).select(F.explode(axis(height)).alias("y"), axis(width).alias("xs")).select(F.explode("xs").alias("x"), "y")


def tile_centres(origins: DataFrame, tile: int, affine: tuple[float, ...]) -> DataFrame:
    a, _, c, _, e, f = affine
    return origins.select("*", ((F.col("x") + tile / 2) * a + c).alias("centre_x"), ((F.col("y") + tile / 2) * e + f).alias("centre_y"))


def chunk_grid(spark: SparkSession, minx: float, miny: float, maxx: float, maxy: float, size: float = 1024.0, buffer: float = 15.0) -> DataFrame:
    """Core cells from the lower left, x inner, the last one cut short; extents grow by the buffer on inner sides."""
    eps = 1e-9
    if size <= 0 or buffer < 0:
        raise ValueError("size is positive and buffer not negative")
    nx, ny = (max(1, int(-(-(hi - lo - eps) // size))) for lo, hi in ((minx, maxx), (miny, maxy)))
    cells = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(ny - 1))).alias("iy")).select("iy", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))).alias("ix"))
    out = cells.select((F.col("iy") * nx + F.col("ix")).cast("long").alias("chunk_id"), "ix", "iy")
    for axis, lo, hi in (("x", minx, maxx), ("y", miny, maxy)):
        low = F.lit(float(lo)) + F.col(f"i{axis}") * float(size)
        high = F.least(low + float(size), F.lit(float(hi)))
        out = out.withColumn(f"core_min{axis}", low).withColumn(f"core_max{axis}", high)
        out = out.withColumn(f"ext_min{axis}", F.when(low <= lo + eps, low).otherwise(low - buffer)).withColumn(f"ext_max{axis}", F.when(high >= hi - eps, high).otherwise(high + buffer))
    return out.drop("ix", "iy")


def assign_chunks(boxes: DataFrame, minx: float, miny: float, maxx: float, maxy: float, size: float, buffer: float) -> DataFrame:
    """One row per (box, chunk whose extent it touches), by arithmetic on the box: no theta join."""
    nx, ny = (max(1, int(-(-(hi - lo - 1e-9) // size))) for lo, hi in ((minx, maxx), (miny, maxy)))

    def span(axis: str, lo: float, n: int) -> Column:
        first = F.floor((F.col(f"{axis}0") - lo - buffer) / size)
        last = F.floor((F.col(f"{axis}1") - lo + buffer) / size)
        exact = F.when((F.col(f"{axis}0") - lo - buffer) == first * size, first - 1).otherwise(first)  # extents are closed
        low, high = F.least(F.greatest(exact, F.lit(0)), F.lit(n)).cast("int"), F.least(last, F.lit(n - 1)).cast("int")
        return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    spread = boxes.select("*", F.explode(span("y", miny, ny)).alias("_iy")).select("*", F.explode(span("x", minx, nx)).alias("_ix"))
    return spread.select(*boxes.columns, (F.col("_iy") * nx + F.col("_ix")).cast("long").alias("chunk_id"))


def intersection_window(left: float, top: float, right: float, bottom: float, affine: tuple[float, ...], tol_px: float = 1e-3) -> tuple[int, int, int, int]:
    """(col, row, width, height) of a world box on a north-up grid; off-grid boxes are refused."""
    a, _, c, _, e, f = affine
    exact = ((left - c) / a, (top - f) / e, (right - left) / a, (bottom - top) / e)
    whole = tuple(round(v) for v in exact)
    if max(abs(v - w) for v, w in zip(exact, whole, strict=True)) > tol_px:
        raise ValueError("the box does not lie on the pixel grid")
    return whole


def overlap_windows(one: dict, two: dict) -> tuple[tuple, tuple, tuple]:
    """Windows of the common area in two rasters ``{affine, width, height}`` and its transform."""
    (a1, _, c1, _, e1, f1), (a2, _, c2, _, e2, f2) = one["affine"], two["affine"]
    if abs(a1 - a2) > 1e-9 or abs(e1 - e2) > 1e-9:
        raise ValueError("pixel sizes differ")
    shift = ((c2 - c1) / a1, (f2 - f1) / e1)
    if max(abs(s - round(s)) for s in shift) > 1e-3:
        raise ValueError("pixel grids are not aligned")
    left, right = max(c1, c2), min(c1 + a1 * one["width"], c2 + a2 * two["width"])
    top, bottom = min(f1, f2), max(f1 + e1 * one["height"], f2 + e2 * two["height"])
    if left >= right or bottom >= top:
        raise ValueError("the rasters do not overlap")
    window = lambda r: intersection_window(left, top, right, bottom, r["affine"])
    return window(one), window(two), (a1, 0.0, left, 0.0, e1, top)


def choose_aoi(full: tuple, override: tuple | None = None, picked: tuple | None = None) -> tuple:
    """The box to work on: an override goes before a picked box, that before the whole; clipped to the whole."""
    box = override or picked or full
    box = max(box[0], full[0]), max(box[1], full[1]), min(box[2], full[2]), min(box[3], full[3])
    if box[0] >= box[2] or box[1] >= box[3]:
        raise ValueError("the area of interest does not meet the raster")
    return box


def clip_to_aoi(objects: DataFrame, box: tuple) -> DataFrame:
    """Objects that share some area with the box; the comparisons are pushed down to the scan."""
    return objects.where((F.col("x0") < box[2]) & (F.col("x1") > box[0]) & (F.col("y0") < box[3]) & (F.col("y1") > box[1]))
