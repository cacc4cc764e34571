"""Hand-made cases and brute force for the spatial operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.operators import bands as B
from spanforge.operators import grid as G
from spanforge.operators import monitor as M
from spanforge.operators import reconcile as R
from spanforge.operators import spans as S
from spanforge.operators import training_tiles as TT
from spanforge.operators.components import connected_components

OBJ = "id long, tile_id long, x0 long, y0 long, x1 long, y1 long"


def objects(spark, rows):
    return spark.createDataFrame(rows, OBJ).withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))


def greedy(boxes, dust):
    taken, kept = set(), {}
    for i, t, x0, y0, x1, y1 in sorted(boxes, key=lambda b: (-(b[4] - b[2]) * (b[5] - b[3]), b[1], b[0])):
        left = {(x, y) for x in range(x0, x1) for y in range(y0, y1)} - taken
        if len(left) > dust:
            kept[i] = len(left)
            taken |= left
    return kept


@pytest.mark.parametrize("dust", [0, 3, 12])
def test_mosaic_equals_sequential_rule(spark, dust):
    rng = np.random.default_rng(dust)
    boxes = [(i, 0, int(x), int(y), int(x + w), int(y + h)) for i, (x, y, w, h) in enumerate(np.column_stack([rng.integers(0, 30, (40, 2)), rng.integers(2, 9, (40, 2))]))]
    kept, runs, culled = R.resolve_mosaic(objects(spark, boxes), dust)
    want = greedy(boxes, dust)
    assert {r.id: r.remnant for r in kept.collect()} == want
    pixels = [(r.row, c) for r in runs.collect() for c in range(r.c0, r.c1)]
    assert len(pixels) == len(set(pixels)) == sum(want.values())
    assert {r.id for r in culled.collect() if r.phase == "mosaic_dropped"} == {b[0] for b in boxes} - set(want)


def test_components_are_transitive(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (10, 11), (7, 7), (None, 3)], "a long, b long")
    assert {r.node: r.component for r in connected_components(edges).collect()} == {5: 2, 4: 2, 3: 2, 2: 2, 10: 10, 11: 10}


def test_components_of_a_long_path_settle(spark):
    order = [0, *range(149, 0, -1)]  # the least label had to walk it node by node
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert {(r.node, r.component) for r in connected_components(edges).collect()} == {(i, 0) for i in range(150)}


def test_thresholds_are_strict(spark):
    o = objects(spark, [(1, 0, 0, 0, 17, 1), (2, 0, 3, 0, 20, 1)])  # intersection 14 of union 20: exactly 0.7
    assert R.duplicate_edges(o, containment=1).count() == 0
    assert R.duplicate_edges(o, iou=0.69, containment=1).count() == 1


def test_merge_keeps_anchor_and_union(spark):
    o = objects(spark, [(1, 0, 0, 0, 10, 10), (2, 1, 0, 0, 10, 11), (3, 0, 50, 50, 60, 60)])
    merged, _, culled = R.merge_duplicates(o)
    assert {(r.id, r.n_members, r.area) for r in merged.collect()} == {(2, 2, 110), (3, 1, 100)}
    assert [(r.id, r.winner_id) for r in culled.collect()] == [(1, 2)]


def test_stitch_keeps_edge_objects_only_at_the_image_edge(spark):
    tiles = spark.createDataFrame([(0, 0, 0, 100, 100, True, False, True, True)], "tile_id long, tx0 long, ty0 long, tx1 long, ty1 long, edge_w boolean, edge_e boolean, edge_n boolean, edge_s boolean")
    o = objects(spark, [(1, 0, 0, 0, 5, 5), (2, 0, 90, 5, 100, 9), (3, 0, 80, 5, 94, 9), (4, 9, 1, 1, 2, 2)])
    assert sorted(r.id for r in R.stitch(o, tiles, 6).collect()) == [1, 3]
    assert R.stitch(o, tiles, 200).count() == 0


def test_empty_inputs(spark):
    o = objects(spark, [])
    assert R.resolve_mosaic(o)[0].count() == R.duplicate_edges(o).count() == R.merge_duplicates(o)[0].count() == 0


def test_chunked_equals_global_with_wide_buffer(spark):
    rng = np.random.default_rng(3)
    boxes = [(i, 0, int(x), int(y), int(x + w), int(y + h)) for i, (x, y, w, h) in enumerate(np.column_stack([rng.integers(1, 180, (150, 2)), rng.integers(4, 12, (150, 2))]))]
    tiles = spark.createDataFrame([(0, 0, 0, 200, 200, True, True, True, True)], "tile_id long, tx0 long, ty0 long, tx1 long, ty1 long, edge_w boolean, edge_e boolean, edge_n boolean, edge_s boolean")
    whole, _, _ = R.reconcile(objects(spark, boxes), tiles)
    parts = R.run_chunked(objects(spark, boxes), tiles, (0, 0, 200, 200), size=80, buffer=60)
    assert sorted((r.id, r.area_px) for r in whole.collect()) == sorted((r.id, r.area_px) for r in parts.collect())
    assert sorted(r.instance_id for r in parts.collect()) == list(range(1, parts.count() + 1))


def test_centroid_on_a_border_belongs_to_the_upper_cell(spark):
    o = objects(spark, [(1, 0, 95, 10, 105, 20)]).withColumn("centroid_x", F.lit(100.0)).withColumn("centroid_y", F.lit(15.0))
    o = o.withColumn("chunk_id", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    assert [r.chunk_id for r in R.core_owned(o, G.chunk_grid(spark, 0, 0, 200, 100, 100, 10)).collect()] == [1]


def test_grid_covers_once_and_short_axes(spark):
    tiles = G.tile_grid(spark, 2500, 1000).collect()
    seen = np.zeros((1000, 2500), int)
    for t in tiles:
        seen[t.write_y : t.write_y + t.write_h, t.write_x : t.write_x + t.write_w] += 1
    assert len(tiles) == 3 and seen.min() >= 1
    assert G.train_tile_origins(spark, 100, 100).count() == 1
    with pytest.raises(ValueError):
        G.tile_grid(spark, 0, 10)
    assert G.overlap_windows({"affine": (1, 0, 0, 0, -1, 10), "width": 10, "height": 10}, {"affine": (1, 0, 4, 0, -1, 8), "width": 10, "height": 10})[0] == (4, 2, 6, 8)


def test_span_algebra(spark):
    a = spark.createDataFrame([(0, 1, 0, 10), (0, 1, 10, 12), (0, 2, 5, 6)], "k long, row long, c0 long, c1 long")
    b = spark.createDataFrame([(0, 1, 2, 4), (0, 1, 3, 5), (0, 1, 11, 20)], "k long, row long, c0 long, c1 long")
    got = lambda d: sorted((r.row, r.c0, r.c1) for r in d.collect())
    assert got(S.union_spans(a, ["k"])) == [(1, 0, 12), (2, 5, 6)]
    assert got(S.subtract_spans(a, b, ["k"])) == [(1, 0, 2), (1, 5, 11), (2, 5, 6)]
    assert got(S.intersect_spans(S.union_spans(a, ["k"]), S.union_spans(b, ["k"]), ["k"])) == [(1, 2, 5), (1, 11, 12)]


def test_labels_and_kernels():
    m = np.array([[1, 0, 0, 1], [0, 1, 0, 0], [0, 0, 0, 1]])
    assert B.label_components(m).tolist() == [[1, 0, 0, 2], [0, 1, 0, 0], [0, 0, 0, 3]]
    assert B.label_components(m, 2).max() == 1
    flat = np.full((5, 7), 3.0)
    assert np.allclose(B.gaussian_blur(flat, 3), flat) and B.gaussian_blur(flat, 0) is flat
    runs = B.rasterize_polygon([np.array([(1, 1), (5, 1), (5, 4), (1, 4)], float), np.array([(2, 2), (3, 2), (3, 3), (2, 3)], float)], 8, 8)
    assert runs == [(1, 1, 5), (2, 1, 2), (2, 3, 5), (3, 1, 5)]
    assert (B.augment(np.full((4, 4), 100, np.uint8), 1) == B.augment(np.full((4, 4), 100, np.uint8), 1)).all()


def test_stretch_of_constant_and_missing_bands(spark):
    px = spark.createDataFrame([(0, 5.0), (0, 5.0), (1, float("nan")), (2, 0.0), (2, 100.0), (2, 50.0)], "k long, v double")
    got = {(r.k, str(r.v)): r.u8 for r in B.stretch_to_uint8(px, ["k"]).collect()}
    assert got == {(0, "5.0"): 0, (1, "nan"): 0, (2, "0.0"): 0, (2, "100.0"): 255, (2, "50.0"): 127}


def test_monitor_by_hand(spark):
    rows = [(e, 10.0 - e, 5.0 + e, float(e)) for e in range(1, 6)]
    s = spark.createDataFrame(rows, "epoch long, train_loss double, val_loss double, wall_s double")
    assert [r.warn for r in M.overfit_warnings(s, 1, 3).orderBy("epoch").collect()] == [False, False, False, True, True]
    assert [r.bad_rounds for r in M.early_stop(s, 1, 2).orderBy("epoch").collect()] == [0, 1, 2, 3, 4]
    pad = spark.range(1).select(M.pad_losses(F.array(F.lit(1.0), F.lit(2.0)), 4, True).alias("a"), M.pad_losses(F.array().cast("array<double>"), 2, True).alias("b"), M.pad_losses(F.array(F.lit(1.0)), 3, False).alias("c")).first()
    assert (pad.a, pad.b, pad.c) == ([1.0, 2.0, 2.0, 2.0], [0.0, 0.0], [1.0, None, None])
    with pytest.raises(ValueError):
        M.eta_window(s, 0)


def test_polygon_borders_are_outside(spark):
    p = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (3.0, 1.0), (2.0, 2.0)], "x double, y double")
    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert [r.x for r in p.where(TT.in_polygon(F.col("x"), F.col("y"), [square])).collect()] == [1.0]
