"""Cases of the fourth review."""

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from spanforge.operators import box_links as L
from spanforge.operators import box_merge as M
from spanforge.operators import reconcile as R
from spanforge.operators import spans as S
from tests.test_round3 import KIND, boxes

TILE = "tile_id long, tx0 long, ty0 long, tx1 long, ty1 long, edge_w boolean, edge_e boolean, edge_n boolean, edge_s boolean"


def key(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def long_boxes():
    """A box over many cells, links that only join through it, and copies of several tiles."""
    far = [(9000, 0, -300, -2, 300, 3, 3000), (9001, 2, -300, -2, 299, 3, 2995), (9002, 1, 280, -2, 300, 3, 100), (9003, 1, 280, -2, 300, 3, 100), (9004, 0, 900, 900, 901, 901, 1)]
    return boxes(5, 700, 40, 2, 16) + far


@pytest.mark.parametrize("side", [None, 2, 1000])
def test_boxes_merged_in_their_cells(spark, side):
    o = spark.createDataFrame(long_boxes(), KIND)
    merged, spans, _ = R.merge_duplicates(o)
    anchors, found = M.merge_boxes(o, side or L.box_links_side(o), 0.7, 0.92)
    assert key(anchors) == key(merged.select("id", "tile_id")) and anchors.count() < 600
    assert key(S.union_spans(found, ["id"])) == key(S.union_spans(spans, ["id"])) == key(found)


@pytest.mark.parametrize("chunk", [1, 7, 40])
def test_chunks_of_cells_change_nothing(monkeypatch, chunk):
    celled = np.array(sorted((cx, cy, i, t, x0, y0, x1, y1) for i, t, x0, y0, x1, y1, _ in long_boxes() for cx in range(x0 // 9, (x1 - 1) // 9 + 1) for cy in range(y0 // 9, (y1 - 1) // 9 + 1)))
    batches = lambda: (pa.RecordBatch.from_arrays([pa.array(c) for c in celled[i : i + 9].T], names=list("abcdefgh")) for i in range(0, len(celled), 9))
    taken = lambda: sorted(r for rows in L.whole_cells(batches()) for b in M._parts(rows, 9, Fraction("0.7"), Fraction("0.92")) for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
    whole = taken()
    monkeypatch.setattr(L, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(L, "CANDIDATES", chunk)
    assert taken() == whole and {r[0] for r in whole} == {M.LINK, M.ANCHOR, M.SPAN, M.WHOLE_ANCHOR, M.WHOLE_SPAN}


def test_copies_are_neither_held_nor_compared(monkeypatch):
    many = [(0, 0, 90_000 - i, i % 3, 2, 3, 9, 9) for i in range(40_000)]
    few = [(0, 0, 100_000 + i, 1, 2 + i, 3, 9 + i, 9) for i in range(2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=list("abcdefgh")) for rows in [few, *[many[i : i + 1000] for i in range(0, 40_000, 1000)]]]
    monkeypatch.setattr(L, "CHUNK_ROWS", 500)
    (rows,) = L.whole_cells(batches, M._without_copies)
    assert rows[2:4].T.tolist() == [[100_001, 1], [50_001, 0]]  # the smallest id of the smallest tile


def test_rows_of_one_group_are_not_listed(monkeypatch):
    n, listed, kept = 3000, [], M.roots_of
    x = np.arange(n) % 3
    box = x, np.zeros(n, int), x + 90, np.full(n, 90)
    monkeypatch.setattr(L, "CANDIDATES", 10_000)
    monkeypatch.setattr(M, "roots_of", lambda n, a, b: listed.append(len(a)) or kept(n, a, b))
    root = M._roots(np.zeros(n, int), box, np.arange(n), 100, Fraction("0.7"), Fraction("0.92"))
    assert set(root) == {0} and sum(listed) < 40_000  # of nine million pairs


def test_wide_coordinates_are_not_packed():
    line, c0, c1 = np.array([1 << 20, 0, 0, 0]), np.array([5, 1 << 40, 0, 3]), np.array([9, (1 << 40) + 1, 3, 4])
    for wide in (1 << 41, 1 << 42):
        assert [v.tolist() for v in M._islands(line, c0, c1, wide)] == [[0, 0, 1 << 20], [0, 1 << 40, 5], [4, (1 << 40) + 1, 9]]


@pytest.mark.parametrize("dust", [0, 3])
def test_chunked_boxes_travel_once(spark, monkeypatch, dust):
    rows = [(r[0], r[1], r[2] + 50, r[3] + 50, r[4] + 50, r[5] + 50, r[6]) for r in boxes(9, 600, 40, 2, 14)]
    rows += [(1000 + r[0], (r[1] + 1) % 3, *r[2:]) for r in rows[::3]]  # copies of other tiles
    o = spark.createDataFrame(rows, KIND)
    tiles = spark.createDataFrame([(i, 0, 0, 110, 110, True, True, True, True) for i in range(3)], TILE)
    taken = lambda: key(R.run_chunked(o, tiles, (0, 0, 110, 110), size=40, buffer=12, dust=dust))
    with monkeypatch.context() as m:
        m.setattr(R, "box_links_side", lambda _: None)
        want = taken()
    for name in ("duplicate_components", "drop_exact_copies", "clean"):  # each sent all boxes through exchanges of their own
        monkeypatch.setattr(R, name, None)
    assert taken() == want and len(want) > 30
