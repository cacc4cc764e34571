"""Cases of the third review."""

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from spanforge.operators import box_links as L
from spanforge.operators import components as C
from spanforge.operators import reconcile as R
from spanforge.operators import spans as S

KIND = "id long, tile_id long, x0 long, y0 long, x1 long, y1 long, area long"


def boxes(seed, n, span, low, high):
    rng = np.random.default_rng(seed)
    made = np.column_stack([rng.integers(-span, span, (n, 2)), rng.integers(low, high, (n, 2))])
    return [(i * 11 % n, i % 3, int(x), int(y), int(x + w), int(y + h), int(w * h)) for i, (x, y, w, h) in enumerate(made)]


@pytest.mark.parametrize("side", [None, 5, 1000])
def test_components_without_a_list_of_pairs(spark, monkeypatch, side):
    o = spark.createDataFrame(boxes(5, 700, 40, 2, 16) + [(9001, 0, 500, 500, 501, 501, 1)], KIND)
    want = {r.node: r.component for r in C.connected_components(R.duplicate_edges(o), "a_id", "b_id").collect()}
    found = C.joined_trees(L.box_links(o, side or L.box_links_side(o), 0.7, 0.92))
    assert {r.node: r.component for r in found.collect()} == want and len(want) > 200
    monkeypatch.setattr(R, "duplicate_edges", None)  # pairs that are rows grow with the density squared
    got = {r.id: r.component for r in R.duplicate_components(o).collect()}
    assert got == {i: want.get(i, i) for i in got} and len(got) == 701


def test_other_areas_and_low_thresholds_take_the_pairs(spark):
    rows = boxes(6, 300, 20, 2, 16)
    o = spark.createDataFrame([(*r[:6], r[6] + 1) for r in rows], KIND)
    assert L.box_links_side(o) is None and L.box_links_side(o.limit(0)) == 4
    low = spark.createDataFrame(rows, KIND)
    for objects, kw in ((o, {}), (low, {"iou": 0.3, "containment": 0.4})):
        want = {r.node: r.component for r in C.connected_components(R.duplicate_edges(objects, **kw), "a_id", "b_id").collect()}
        got = {r.id: r.component for r in R.duplicate_components(objects, **kw).collect()}
        assert got == {i: want.get(i, i) for i in got}


def test_small_graphs_settle_in_one_task(spark, monkeypatch):
    edges = spark.range(200).selectExpr("id * 3 as a", "(id + 1) * 3 as b").union(spark.range(50).selectExpr("id * 3 + 1 as a", "id * 3 + 601 as b"))
    by_rounds = monkeypatch.setattr(C, "HELD_EDGES", 0) or {r.node: r.component for r in C.settle(edges, "a", "b").collect()}
    monkeypatch.undo()
    taken, kept = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df: taken.append(1) or kept(df))
    assert {r.node: r.component for r in C.settle(edges, "a", "b").collect()} == by_rounds and len(taken) == 1


def test_union_of_boxes_sends_no_spans(spark):
    rows = [(i % 5, *r[2:6]) for i, r in enumerate(boxes(7, 200, 30, 1, 12))] + [(7, 4, 4, 4, 9), (8, 0, -70, 3, 70), (8, 3, -70, 5, 70)]
    o = spark.createDataFrame(rows, "id long, x0 long, y0 long, x1 long, y1 long")
    spans = S.explode_spans(o.select("id", S.box_spans().alias("spans")))
    want = sorted(map(tuple, S.union_spans(spans, ["id"]).select("id", "row", "c0", "c1").collect()))
    assert sorted(map(tuple, S.union_boxes(o).collect())) == want and (8, 69, 0, 5) in want


@pytest.mark.parametrize("chunk", [1, 7, 40])
def test_chunks_change_nothing(monkeypatch, chunk):
    found = boxes(8, 200, 30, 1, 14)
    batches = lambda rows: (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 9], strict=True)], names=list("abcdefg")[: len(rows[0])]) for i in range(0, len(rows), 9))
    taken = lambda made: sorted(r for b in made for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
    banded = sorted((i % 4, b, x0, max(y0, b * S.BAND), x1, min(y1, (b + 1) * S.BAND)) for i, _, x0, y0, x1, y1, _ in found for b in range(y0 // S.BAND, (y1 - 1) // S.BAND + 1))
    celled = sorted((cx, cy, i, x0, y0, x1, y1) for i, _, x0, y0, x1, y1, _ in found for cx in range(x0 // 9, (x1 - 1) // 9 + 1) for cy in range(y0 // 9, (y1 - 1) // 9 + 1))
    limits = Fraction("0.7"), Fraction("0.92")
    whole = taken(S._union(batches(banded))), taken(L._found(batches(celled), 9, *limits))
    monkeypatch.setattr(S, "CHUNK_BOXES", chunk)
    monkeypatch.setattr(L, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(L, "CANDIDATES", chunk)
    assert (taken(S._union(batches(banded))), taken(L._found(batches(celled), 9, *limits))) == whole and all(whole)


def test_merged_shapes_send_no_spans(spark, monkeypatch):
    o = spark.createDataFrame(boxes(5, 700, 40, 2, 16), KIND)
    spans = R.box_to_spans(o)
    merged, runs, culled = R.merge_duplicates(o, spans=spans)
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    want = key(merged), key(runs), key(culled)
    monkeypatch.setattr(S, "union_spans", None)  # sorted a row for each pixel row of each member
    assert tuple(map(key, R.merge_duplicates(o))) == want


def test_merged_spans_are_laid_down_once(spark, monkeypatch):
    rows = [(r[0], 0, r[2] + 50, r[3] + 50, r[4] + 50, r[5] + 50, r[6]) for r in boxes(9, 500, 40, 2, 14)]
    o = spark.createDataFrame(rows, KIND)
    tiles = spark.createDataFrame([(0, 0, 0, 110, 110, True, True, True, True)], "tile_id long, tx0 long, ty0 long, tx1 long, ty1 long, edge_w boolean, edge_e boolean, edge_n boolean, edge_s boolean")
    laid, kept = [], R.laid_down
    monkeypatch.setattr(R, "laid_down", lambda df: laid.append(df.columns) or kept(df))
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    want = [key(df) for df in R.reconcile(o, tiles, spans=R.box_to_spans(o))]
    assert [key(df) for df in R.reconcile(o, tiles)] == want and all(want)
    whole = R.run_chunked(o, tiles, (0, 0, 110, 110), size=110, buffer=10)
    assert {(r.id, r.area_px) for r in whole.collect()} == {(r.id, r.area_px) for r in R.reconcile(o, tiles)[0].collect()}
    assert laid.count(["id", "row", "c0", "c1"]) == 4  # each reader of the objects and of the spans merged them anew
