"""Cases of the fifth review."""

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanforge.operators import dust as D
from spanforge.operators import points as P
from spanforge.operators import reconcile as R
from spanforge.plans import queries as plans
from tests.compare import rows_of, spark_rows
from tests.test_round3 import KIND


@pytest.mark.parametrize("name", ["crown_export", "image_edge_tag", "drop_image_edge"])
def test_crowns_wholly_beyond_the_image(spark, tmp_path, name):
    """Of the first order's crown only the column 6248 is left beside the second's; the fourth's lies at negative rows and columns."""
    orders = spark.createDataFrame([(44901, 0), (70225, 467), (1, 1), (-900, -1)], "o_orderkey long, o_custkey long")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    db = duckdb.connect()
    db.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    want = db.execute(plans.SQL[name])
    names = [d[0] for d in want.description]
    assert spark_rows(plans.QUERIES[name](spark, str(tmp_path))) == (sorted(names), rows_of(names, want.fetchall()))

def sequential(o, dust, spans=None):
    shapes = {}
    for i, r, a, b in spans or [(i, r, x0, x1) for i, _, x0, y0, x1, y1, _ in o for r in range(y0, y1)]:
        shapes.setdefault(i, set()).update((r, c) for c in range(a, b))
    taken, kept = set(), {}
    for b in sorted(o, key=lambda b: (-b[6], b[1], b[0])):
        left = shapes.get(b[0], set()) - taken
        if len(left) > dust:
            kept[b[0]] = len(left)
            taken |= left
    return kept


def layers(n=700, wide=70, seed=3):
    rng = np.random.default_rng(seed)
    sized = np.column_stack([rng.integers(-wide // 2, wide // 2, (n, 2)), rng.integers(3, 12, (n, 2))])
    rows = [(i, i % 3, int(x), int(y), int(x + w), int(y + h), int(w * h)) for i, (x, y, w, h) in enumerate(sized)]
    rows += [(n, 0, -40, -2, 60, 1, 300), (n + 1, 0, 5, 5, 5, 9, 0)]  # across many windows; empty
    return rows + [(n + 2 + i, 0, 200 + 6 * i, 0, 208 + 6 * i, 8, 64) for i in range(40)]  # each hangs on the one before


@pytest.mark.parametrize("sizes", [None, (16, 4), (7, 0), (64, 30)])
def test_dust_is_settled_in_windows(spark, monkeypatch, sizes):
    rows, seen = layers(), []
    monkeypatch.setattr(D, "MANY", 5)
    monkeypatch.setattr(R, "dense", lambda _: True)
    monkeypatch.setattr(R, "survivors", lambda *a: D.survivors(*a, sizes=sizes))
    monkeypatch.setattr(R, "ownership", lambda objects, spans=None, kept=R.ownership: seen.append(objects.count()) or kept(objects, spans))
    o = spark.createDataFrame(rows, KIND)
    kept, runs, culled = R.resolve_mosaic(o, 18)
    want = sequential(rows, 18)
    assert {r.id: r.remnant for r in kept.collect()} == want and seen == [len(want)] and len(want) < len(rows) / 3
    pixels = [(r.row, c) for r in runs.collect() for c in range(r.c0, r.c1)]
    assert len(pixels) == len(set(pixels)) == sum(want.values())
    assert {r.id for r in culled.collect() if r.phase == "mosaic_dropped"} == {r[0] for r in rows} - set(want)


@pytest.mark.parametrize("many", [True, False])
def test_dust_of_shapes_in_many_batches(spark, monkeypatch, many):
    rows = layers(300, 40, 5)
    spans = [(i, r, x0 + (r % 3), x1 - (r % 2)) for i, _, x0, y0, x1, y1, _ in rows for r in range(y0, y1)] + [(3, rows[3][3], rows[3][2], rows[3][4])]
    o, s = spark.createDataFrame(rows, KIND), spark.createDataFrame(spans, "id long, row long, c0 long, c1 long")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        monkeypatch.setattr(R, "dense", lambda _: many)
        monkeypatch.setattr(R, "survivors", lambda *a: D.survivors(*a, sizes=(16, 4)))
        kept, _, _ = R.resolve_mosaic(o, 9, s)
        assert {r.id: r.remnant for r in kept.collect()} == sequential(rows, 9, spans)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_long_chains_of_dust_take_few_rounds(spark, monkeypatch):
    """Each crown hangs on the one before it, whether it stays; a round settled one link."""
    rows = [(i, 0, 6 * i, 0, 6 * i + 8, 8, 64) for i in range(150)]
    rounds = []
    monkeypatch.setattr(D, "cut", lambda df, kept=D.cut: rounds.append(1) or kept(df))
    monkeypatch.setattr(R, "cut", lambda df, kept=R.cut: rounds.append(1) or kept(df))
    kept, _, _ = R.resolve_mosaic(spark.createDataFrame(rows, KIND), 48)
    assert {r.id: r.remnant for r in kept.collect()} == sequential(rows, 48) and len(rounds) < 25


def crowded(kind):
    """Copies of points and crowns, heights that repeat, null ones, crowns of many sizes; (points, crowns, pairs)."""
    rng = np.random.default_rng(8)
    at, z = rng.integers(-30, 40, (900, 2)) * 0.5, rng.integers(0, 9, 900) / (1 if kind == "bigint" else 2)
    points = [(float(x), float(y), None if k % 50 == 0 else float(v)) for k, ((x, y), v) in enumerate(zip(at, z, strict=True))]
    points += [(3.0, 3.0, None), (float("inf"), 1.0, 1.0)] + [(2.0, 2.0, 1.0)] * 30
    sized = np.column_stack([rng.integers(-20, 20, (80, 2)), rng.integers(1, 9, (80, 2))])
    crowns = [(i, int(x), int(y), int(x + w), int(y + h)) for i, (x, y, w, h) in enumerate(sized)]
    crowns += [(None, 0, 0, 3, 3), (3, -9, -9, 9, 9), crowns[5], (90, 1, 1, 1, 9), (91, -200, -200, 200, 200)]
    return points, crowns, [(i, v) for i, x0, y0, x1, y1 in crowns for x, y, v in points if x0 <= x < x1 and y0 <= y < y1]


def plain(pairs):
    return sorted((repr(i), "" if v is None else repr(float(v))) for i, v in pairs)


@pytest.mark.parametrize("kind", ["double", "decimal(9,2)", "bigint"])
def test_points_in_crowns_by_brute_force(spark, monkeypatch, kind):
    points, crowns, want = crowded(kind)
    monkeypatch.setattr(P, "points_above", lambda p, dtm, cell: p)
    p = spark.createDataFrame(points, "x double, y double, z_norm double").withColumn("z_norm", F.col("z_norm").cast(kind))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = P.normalised_points(p, None, spark.createDataFrame(crowns, "tree_id long, x0 long, y0 long, x1 long, y1 long"), 5.0)
        rows = [tuple(r) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got.schema["z_norm"].dataType.simpleString() == kind
    assert plain(rows) == plain(want) and len(want) > 1500


@pytest.mark.parametrize("same", [0, 8, 10**6])
def test_equal_heights_leave_a_task_once(monkeypatch, same):
    points, crowns, want = crowded("double")
    points = [p for p in points if p[0] < 1e9]
    for name, value in (("MOST_COPIES", 4), ("ROWS_OUT", 13), ("BITS", 9999), ("SAME", same)):
        monkeypatch.setattr(P, name, value)
    rows = [(0, 0, 0, False, i, float(a), float(b), float(c), float(d), 400.0, None) for i, a, b, c, d in crowns if c > a]
    rows += [(0, 0, 0, True, None, x, y, None, None, None, z) for x, y, z in points]
    names = [*P.SQUARE_KEY, "_point", "tree_id", "x0", "y0", "x1", "y1", "_reach", "z_norm"]
    kinds = [pa.int64()] * 3 + [pa.bool_(), pa.int64()] + [pa.float64()] * 6
    batches = pa.table({k: pa.array(c, t) for k, c, t in zip(names, zip(*rows, strict=True), kinds, strict=True)}).to_batches(max_chunksize=7)
    found = [r for b in P._counted(iter(batches)) for r in zip(*[c.to_pylist() for c in b.columns], strict=True)]
    assert plain((i, v) for i, v, n in found for _ in range(n)) == plain(want) and max(n for *_, n in found) == (1 if same > 8 else 4)


def test_points_in_crowns_fill_small_files(spark, tmp_path):
    """Heights come crown by crown, equal ones together: files hold runs (they took a byte and more for each row)."""
    rng = np.random.default_rng(2)
    made = lambda rows, names: spark.createDataFrame(pd.DataFrame(rows, columns=names))
    points = made(np.column_stack([rng.integers(0, 60, (20_000, 2)), rng.integers(1, 51, 20_000)]), ["x", "y", "z"]).selectExpr("x", "y", "cast(z as double) z", "1 as cls")
    corner = rng.integers(0, 45, (2000, 2))
    crowns = made(np.column_stack([np.arange(2000), corner, corner + 14]), ["tree_id", "x0", "y0", "x1", "y1"])
    dtm = spark.createDataFrame([(r, c, 1.0) for r in range(3) for c in range(3)], "r long, c long, g double")
    P.normalised_points(points, dtm, crowns, 25).write.parquet(f"{tmp_path}/out")
    n = spark.read.parquet(f"{tmp_path}/out").count()
    assert n > 1_500_000 and sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 0.4 * n
