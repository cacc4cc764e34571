"""The composite pipelines: detections to crowns, points to flagged crowns, crowns to training tiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.config import DetectionConfig, HeightConfig, TrainingConfig
from spanforge.operators import bands as B
from spanforge.operators import grid as G
from spanforge.operators import points as P
from spanforge.operators import reconcile as R
from spanforge.operators import spans as S
from spanforge.operators import training_tiles as TT
from spanforge.session import cut

LABEL_BITS = 20  # instances per tile; tile ids take the bits above


def detect(tiles: DataFrame, cfg: DetectionConfig, segmenter: Callable = B.threshold_segmenter, width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(objects, spans) in global pixels from tiles ``(tile_id, read_x, read_y, px, mask)``.

    The class gate runs before the segmenter sees a pixel; pixels outside the mask are 0, and so are labels there.
    """
    gated = B.semantic_gate(tiles, "mask", cfg.tree_class_id).where("gated")
    keep = F.transform("mask", lambda m: F.when(m == cfg.tree_class_id, 1).otherwise(0))
    runs = B.segment_tiles(gated.select("tile_id", B.mask_pixels(F.col("px"), keep).alias("px"), keep.alias("mask")), segmenter, width or cfg.window, cfg.blur_size)
    placed = runs.join(tiles.select("tile_id", "read_x", "read_y"), "tile_id")
    name = F.col("tile_id") * (1 << LABEL_BITS) + F.col("label")
    spans = placed.select(name.alias("id"), "tile_id", (F.col("row") + F.col("read_y")).alias("row"), (F.col("c0") + F.col("read_x")).alias("c0"), (F.col("c1") + F.col("read_x")).alias("c1"))
    spans = cut(spans)
    objects = S.measures(spans, ["id", "tile_id"]).withColumnRenamed("area_px", "area").drop("centroid_x", "centroid_y").where(F.col("area") >= cfg.min_size)
    return objects, spans.select("id", "row", "c0", "c1")


def crowns(objects: DataFrame, tiles: DataFrame, image: tuple[int, int], cfg: DetectionConfig, spans: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(final crowns, culled) of detections on a ``tile_grid``, numbered, measured and tagged at the image edge."""
    borders = tiles.select(
        "tile_id", F.col("read_x").alias("tx0"), F.col("read_y").alias("ty0"), (F.col("read_x") + F.col("win_w")).alias("tx1"), (F.col("read_y") + F.col("win_h")).alias("ty1"),
        *[F.col(f"is_image_edge_{e}").alias(f"edge_{e}") for e in "wens"],
    )
    found, _, culled = R.reconcile(objects, borders, cfg.stitch_shift, cfg.iou, cfg.containment, cfg.dust, spans)
    tagged = R.tag_image_edge(found, *image)
    if cfg.drop_image_edge:
        tagged = tagged.where("not touches_image_edge")
    chunked = tagged.withColumn("chunk_id", F.floor(F.col("centroid_x") / cfg.chunk_size) + 100_000 * F.floor(F.col("centroid_y") / cfg.chunk_size))
    numbered = R.instance_ids(chunked, area="merged_area")
    return numbered.select("instance_id", "id", "area_px", (F.col("area_px") * cfg.pixel_area_m2).alias("area_m2"), "centroid_x", "centroid_y", "touches_image_edge", "x0", "y0", "x1", "y1"), culled


def height_filter(points: DataFrame, trees: DataFrame, cfg: HeightConfig, raster: tuple[int, int] | None = None, reach: int = 3) -> DataFrame:
    """Crowns with height statistics and flag; with ``raster`` (cells across and down) the ground model's gaps are filled."""
    dtm = P.dtm_min(points, cfg.cell)
    dtm = P.fill_dtm(cut(dtm), *raster, reach=reach) if raster else dtm
    stats = P.crown_stats(points, dtm, trees, cfg.cell, cfg.threshold, cfg.quantile)
    return P.flag_heights(trees, stats, cfg.min_share, cfg.drop)


def training_tiles(crowns_by_source: dict[str, DataFrame], cfg: TrainingConfig) -> tuple[DataFrame, DataFrame]:
    """(routed tiles of all sources, counts per source and in total)."""
    routed = None
    for s in cfg.sources:
        found = crowns_by_source[s.name]
        origins = G.train_tile_origins(found.sparkSession, s.width, s.height, cfg.tile, cfg.stride)
        tiles = origins.select(F.concat_ws("_", F.lit(s.name), F.col("x").cast("string"), F.col("y").cast("string")).alias("tile_id"), F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + cfg.tile).alias("x1"), (F.col("y") + cfg.tile).alias("y1"), (F.col("x") + cfg.tile / 2).alias("mx"), (F.col("y") + cfg.tile / 2).alias("my"))
        one = TT.route_tiles(tiles, found, TT.qc_pass(s.qc_field, s.qc_pass_values), TT.split_of("mx", "my", s.val, s.bbox), cfg.min_instances, s.name)
        routed = one if routed is None else routed.unionByName(one)
    return routed, TT.split_counts(routed)
