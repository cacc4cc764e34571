"""The composite pipelines end to end on tiny inputs."""

import numpy as np
import pytest

from spanforge.config import DetectionConfig, HeightConfig, TrainingConfig, TrainingSource
from spanforge.operators import grid as G
from spanforge.plans import pipelines as P


def test_detections_to_crowns(spark):
    image = np.zeros((20, 32), int)
    image[3:8, 10:15] = image[12:18, 0:4] = image[2:6, 25:31] = 9
    grid = G.tile_grid(spark, 32, 20, 20, 12)
    tiles = [(t.tile_id, t.read_x, t.read_y, image[t.read_y : t.read_y + 20, t.read_x : t.read_x + 20].ravel().astype(float).tolist(), [2] * 400) for t in grid.collect()]
    df = spark.createDataFrame([*tiles, (9, 0, 0, [1.0] * 400, [0] * 400)], "tile_id long, read_x long, read_y long, px array<double>, mask array<int>")
    cfg = DetectionConfig(window=20, stride=12, blur_size=0, min_size=4, stitch_shift=1, chunk_size=16, pixel_area_m2=0.25)
    objects, spans = P.detect(df, cfg)
    assert objects.count() == 4  # the crown in the overlap is seen twice
    final, _ = P.crowns(objects, grid, (32, 20), cfg, spans)
    got = {(r.x0, r.y0, r.x1, r.y1, r.area_px, r.area_m2, r.touches_image_edge) for r in final.collect()}
    assert got == {(10, 3, 15, 8, 25, 6.25, False), (0, 12, 4, 18, 24, 6.0, True), (25, 2, 31, 6, 24, 6.0, False)}
    assert sorted(r.instance_id for r in final.collect()) == [1, 2, 3]


def test_heights(spark):
    points = spark.createDataFrame([(0.5, 0.5, 1.0, 2), (0.6, 0.6, 9.0, 1), (0.7, 0.2, 2.0, 1), (1.5, 0.5, 7.0, 1)], "x double, y double, z double, cls int")
    trees = spark.createDataFrame([(1, 0, 0, 1, 1), (2, 1, 0, 2, 1), (3, 5, 5, 6, 6)], "tree_id long, x0 long, y0 long, x1 long, y1 long")
    bare = {r.tree_id: (r.n_total, r.n_above, r.is_tree) for r in P.height_filter(points, trees, HeightConfig()).collect()}
    assert bare == {1: (2, 1, True), 2: (0, 0, False), 3: (0, 0, False)}
    filled = {r.tree_id: (r.n_total, r.p99_height) for r in P.height_filter(points, trees, HeightConfig(), raster=(4, 4)).collect()}
    assert filled[2] == (1, 6.0)


def test_training_tiles(spark):
    crowns = spark.createDataFrame([(1, 10, 10, 20, 20, "ok"), (2, 600, 10, 620, 20, None), (3, 700, 700, 720, 720, "ok")], "id long, x0 long, y0 long, x1 long, y1 long, qc string")
    cfg = TrainingConfig([TrainingSource("a", 896, 896, "qc", None, None, (500, 500, 900, 900)), TrainingSource("b", 512, 512)])
    routed, counts = P.training_tiles({"a": crowns, "b": crowns}, cfg)
    routes = {r.tile_id: r.route for r in routed.collect()}
    assert routes == {"a_0_0": "train", "a_384_0": "review", "a_0_384": "skipped_no_crowns", "a_384_384": "val", "b_0_0": "train"}
    assert {r.source: (r.train, r.val, r.review, r.skipped_qc_failed) for r in counts.collect()} == {"a": (1, 1, 1, 1), "b": (1, 0, 0, 0), None: (2, 1, 1, 1)}
    with pytest.raises(ValueError):
        TrainingConfig([])
