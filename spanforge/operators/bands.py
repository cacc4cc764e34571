"""Raster tiles as pixel rows: gating, masking, band selection, percentile stretch, kernels and a default segmenter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semantic_gate(tiles: DataFrame, mask: str, class_id: int = 2) -> DataFrame:
    """Add ``gated``: does the tile's mask array hold a pixel of the class?"""
    return tiles.withColumn("gated", F.exists(mask, lambda x: x == class_id))


def mask_pixels(pixels: Column, mask: Column) -> Column:
    """Pixels of an array where the mask array is 0 become 0; also clamps labels."""
    return F.zip_with(pixels, mask, lambda p, m: F.when(m == 0, F.lit(0)).otherwise(p))


def select_bands(bands: Column, indices: list[int]) -> Column:
    """Three bands of an array of bands, by one-based index; the last one chosen is repeated if fewer are named."""
    if not 1 <= len(indices) <= 3 or min(indices) < 1:
        raise ValueError("one to three one-based band indices")
    return F.array(*[F.element_at(bands, i) for i in (indices + [indices[-1]] * 3)[:3]])


def stretch_bounds(pixels: DataFrame, keys: list[str], low: float = 2, high: float = 98) -> DataFrame:
    """Exact interpolated percentiles of the finite values per key."""
    finite = pixels.where("v is not null and not isnan(v) and abs(v) < double('infinity')")
    return finite.groupBy(*keys).agg(F.percentile("v", [low / 100, high / 100]).alias("_b")).select(*keys, F.get("_b", F.lit(0)).alias("lo"), F.get("_b", F.lit(1)).alias("hi"))


def stretch_to_uint8(pixels: DataFrame, keys: list[str], low: float = 2, high: float = 98) -> DataFrame:
    """Add ``u8``: linear between the percentiles, clipped, truncated; 0 for constant bands and values that aren't finite."""
    met = pixels.join(stretch_bounds(pixels, keys, low, high), keys, "left")
    scaled = (F.col("v") - F.col("lo")) * 255.0 / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    bad = F.col("v").isNull() | F.isnan("v") | scaled.isNull()
    return met.withColumn("u8", F.when(bad, 0).otherwise(F.floor(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(255.0)))).cast("int"))


def tile_stats(tiles: DataFrame) -> DataFrame:
    """Counts of tiles, of those skipped and computed, and of detections (``n_det`` per tile)."""
    return tiles.agg(
        F.count("*").alias("n_tiles"), F.count_if(~F.col("gated")).alias("n_skipped"), F.count_if("gated").alias("n_compute"),
        F.count_if(F.col("gated") & (F.col("n_det") > 0)).alias("n_compute_detections"), F.coalesce(F.sum(F.when(F.col("gated"), F.col("n_det"))), F.lit(0)).cast("long").alias("n_raw"),
    )


def gaussian_kernel(size: int) -> np.ndarray:
    sigma = max(0.5, size / 6)
    x = np.arange(-int(4 * sigma + 0.5), int(4 * sigma + 0.5) + 1)
    k = np.exp(-0.5 * (x / sigma) ** 2)
    return k / k.sum()


def gaussian_blur(image: np.ndarray, size: int) -> np.ndarray:
    """Separable blur of a 2-D image with mirrored borders; sizes of 0 or less leave it as it is."""
    if size <= 0:
        return image
    k, out = gaussian_kernel(size), image.astype(float)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (len(k) // 2, len(k) // 2)
        wide = np.pad(out, pad, mode="symmetric")
        out = sum(w * np.take(wide, range(i, i + image.shape[axis]), axis=axis) for i, w in enumerate(k))
    return out


def label_components(mask: np.ndarray, min_size: int = 1) -> np.ndarray:
    """Labels 1..N of 8-connected foreground components of at least ``min_size`` pixels, in row-major order."""
    fore = mask > 0
    labels = np.where(fore, np.arange(1, mask.size + 1).reshape(mask.shape), 0).astype(np.int64)
    while True:
        wide = np.pad(np.where(fore, labels, mask.size + 1), 1, constant_values=mask.size + 1)
        least = np.minimum.reduce([wide[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(3) for j in range(3)])
        new = np.where(fore, least, 0)
        new[fore] = np.minimum(new[fore], new.ravel()[new[fore] - 1])  # jump to the label's own label
        if (new == labels).all():
            break
        labels = new
    names, at, counts = np.unique(labels, return_inverse=True, return_counts=True)
    kept = (names > 0) & (counts >= min_size)
    return np.where(kept, np.cumsum(kept), 0)[at].reshape(mask.shape)


def threshold_segmenter(image: np.ndarray, mask: np.ndarray, min_size: int = 1) -> np.ndarray:
    return label_components((image > 0) & (mask > 0), min_size)


def segment_tiles(tiles: DataFrame, segmenter: Callable[[np.ndarray, np.ndarray], np.ndarray] = threshold_segmenter, width: int = 8, blur: int = 0) -> DataFrame:
    """``(tile_id, row, c0, c1, label)`` runs of instances from tiles ``(tile_id, px, mask)`` with row-major arrays.

    The segmenter is any callable on a 2-D image and mask; the default labels connected pixels above 0.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for tile, px, mask in zip(frame["tile_id"], frame["px"], frame["mask"], strict=True):
                image, m = np.array(px, float).reshape(-1, width), np.array(mask).reshape(-1, width)
                labels = segmenter(gaussian_blur(image, blur), m) * (m > 0)
                edges = np.diff(np.pad(labels, ((0, 0), (1, 1))), axis=1)
                for r, c in zip(*np.nonzero(edges), strict=True):
                    if c < width and labels[r, c]:
                        stop = c + np.flatnonzero(edges[r, c + 1 :])[0] + 1
                        out.append((tile, r, c, stop, labels[r, c]))
            yield pd.DataFrame(out, columns=["tile_id", "row", "c0", "c1", "label"])

    return tiles.select("tile_id", "px", "mask").mapInPandas(run, "tile_id long, row long, c0 long, c1 long, label long")


def rasterize_polygon(rings: list[np.ndarray], width: int, height: int) -> list[tuple[int, int, int]]:
    """Runs ``(row, c0, c1)`` of pixels whose centre lies inside, by the even-odd rule over all rings."""
    out = []
    for row in range(height):
        y, xs = row + 0.5, []
        for ring in rings:
            a, b = ring, np.roll(ring, -1, axis=0)
            hit = (a[:, 1] <= y) != (b[:, 1] <= y)
            xs += (a[hit, 0] + (y - a[hit, 1]) * (b[hit, 0] - a[hit, 0]) / (b[hit, 1] - a[hit, 1])).tolist()
        xs.sort()
        for s, e in zip(xs[::2], xs[1::2], strict=True):
            c0, c1 = max(0, int(np.ceil(s - 0.5))), min(width, int(np.ceil(e - 0.5)))
            if c1 > c0:
                out.append((row, c0, c1))
    return out


def rasterize(polygons: DataFrame, width: int, height: int) -> DataFrame:
    """``(id, row, c0, c1)`` from polygons ``(id, rings array<array<array<double>>>)`` in pixel coordinates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(i, *run_) for i, rings in zip(frame["id"], frame["rings"], strict=True) for run_ in rasterize_polygon([np.array([list(p) for p in r], float) for r in rings], width, height)]
            yield pd.DataFrame(out, columns=["id", "row", "c0", "c1"])

    return polygons.select("id", "rings").mapInPandas(run, "id long, row long, c0 long, c1 long")


def augment(image: np.ndarray, seed: int, gamma=(0.6, 1.4), brightness: float = 0.2, contrast: float = 0.2, noise=(5.0, 25.0), p: float = 0.4) -> np.ndarray:
    """Seeded gamma, brightness and contrast, and noise on a uint8 image, each with probability ``p``."""
    rng, out = np.random.default_rng(seed), image.astype(float)
    if rng.random() < p:
        out = 255 * (out / 255) ** rng.uniform(*gamma)
    if rng.random() < p:
        out = (out - 127.5) * (1 + rng.uniform(-contrast, contrast)) + 127.5 + 255 * rng.uniform(-brightness, brightness)
    if rng.random() < p:
        out = out + rng.normal(0, rng.uniform(*noise) ** 0.5, out.shape)
    return np.clip(out, 0, 255).astype(np.uint8)


def augment_tiles(tiles: DataFrame, seed: int, width: int = 8, **kw) -> DataFrame:
    """``(tile_id, px)`` with each tile's image augmented from a seed of its own."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            px = [augment(np.array(p).reshape(-1, width), seed + int(t), **kw).ravel().astype(int).tolist() for t, p in zip(frame["tile_id"], frame["px"], strict=True)]
            yield pd.DataFrame({"tile_id": frame["tile_id"], "px": px})

    return tiles.select("tile_id", "px").mapInPandas(run, "tile_id long, px array<int>")


def join_semantic(ortho: DataFrame, semantic: DataFrame) -> DataFrame:
    """Tiles ``(tile_id, read_x, read_y, px, mask)`` of two rasters read through the same windows; a tile that only one
    of them has, or whose arrays differ in size, is left out."""
    return ortho.join(semantic.select("tile_id", "read_x", "read_y", "mask"), ["tile_id", "read_x", "read_y"]).where("size(px) = size(mask)")
