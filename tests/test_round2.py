"""Cases of the second review."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import quality
from spanforge.operators import components as C
from spanforge.operators import points as P
from spanforge.operators import reconcile as R
from spanforge.operators import spatial_join as S
from spanforge.plans.queries import r6
from tests.test_operators import greedy


def test_rounding_of_ties_equals_sql(spark):
    want = duckdb.sql("select k, round(k / (2.0 * 320::bigint), 6) from range(1, 40000, 2) t(k)").fetchall()
    got = spark.range(1, 40000, 2).select("id", r6(F.col("id") / F.lit(640)).alias("v")).collect()
    assert sorted((r.id, r.v) for r in got) == sorted(want)


@pytest.mark.parametrize("part, parts", [(100_000, 8), (7_000, 8), (1_000, 2)])
def test_quality_counts_all_labelled_documents(spark, part, parts):
    docs = spark.range(24_000).selectExpr("id as doc_id", "concat('a b ', id % 2) as text")
    labels = spark.range(24_000).selectExpr("id as doc_id", "int(id < 22000) as quality", "int(id % 11 = 0) as toxic")
    texts = quality.labelled_texts(docs, labels, part=part, parts=parts)
    assert (texts.count(), texts.where("good").count(), texts.where("poor").count(), texts.where("toxic").count()) == (24_000, 20_000, 2_000, 2_182)
    if part == 100_000:
        fit = texts.where("good and fit").count()
        assert 9_000 < fit < 11_000  # a sample of 10 000 gave half as many
        want = {r.bucket: r.n for r in quality._bucket_counts(docs.where("doc_id < 22000 and doc_id % 11 <> 0"), "text", 64).collect()}
        got = {r.bucket: r.n for r in quality._bucket_counts(texts.where("good"), "text", 64).collect()}
        assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 999, 1001, 4003])
def test_quantile_equals_percentile(spark, n):
    rows = spark.range(n).selectExpr("double(id * 7919 % 1013) / 7 as v").cache()
    for share in (0.0, 0.001, 0.3, 0.999, 1.0):
        assert quality.quantile(rows, "v", share) == pytest.approx(rows.agg(F.expr(f"percentile(v, {share}D)")).first()[0], rel=1e-12)
    assert quality.quantile(rows.limit(0), "v", 0.5) is None


def test_crown_stats_equal_those_of_rows(spark):
    rng = np.random.default_rng(5)
    xy = [*rng.uniform(-20, 60, (3000, 2)).tolist(), *rng.integers(-20, 60, (3000, 2)).astype(float).tolist(), (float("nan"), 1.0)]
    points = spark.createDataFrame([(x, y, None if i % 50 == 0 else float(z), 1 + int(i % 9 == 0)) for i, ((x, y), z) in enumerate(zip(xy, rng.normal(5, 4, len(xy)), strict=True))], "x double, y double, z double, cls int")
    sizes = np.where(rng.random((400, 2)) < 0.8, rng.integers(0, 9, (400, 2)), rng.uniform(0, 45, (400, 2)))
    low = rng.integers(-25, 60, (400, 2)).astype(float)
    boxes = [(int(i) if i % 40 else 1, *a.tolist(), *(a + s).tolist()) for i, (a, s) in enumerate(zip(low, sizes, strict=True))] + [(None, 0.0, 0.0, 9.0, 9.0), (999, None, 0.0, 1.0, 1.0)]
    crowns = spark.createDataFrame(boxes, "tree_id long, x0 double, y0 double, x1 double, y1 double")
    dtm = P.dtm_min(points, 5.0)
    rows = lambda df: {r.tree_id: r for r in df.collect()}
    for quantile in (0.0, 0.5, 0.99, 1.0):
        want = rows(P.tree_stats(P.normalised_points(points, dtm, crowns, 5.0), 3.0, quantile))
        got = rows(P.crown_stats(points, dtm, crowns, 5.0, 3.0, quantile))
        assert want.keys() == got.keys() and len(want) > 300
        for k, w in want.items():
            assert (got[k].n_total, got[k].n_above, got[k].pct_above) == (w.n_total, w.n_above, w.pct_above)
            assert got[k].p99_height == pytest.approx(w.p99_height, abs=1e-12)
    assert P.crown_stats(points, dtm, crowns.limit(0), 5.0).count() == P.crown_stats(points.limit(0), dtm, crowns, 5.0).count() == 0


def test_cells_follow_the_boxes(spark):
    assert S.cell_size(spark.createDataFrame([(0, 0, 14, 14)] * 9, "x0 long, y0 long, x1 long, y1 long")) == 14
    assert S.cell_size(spark.createDataFrame([], "x0 long, y0 long, x1 long, y1 long")) == 1
    few = spark.range(2000).selectExpr("id % 40 as x0", "id div 40 as y0", "id % 40 + 6 as x1", "id div 40 + 6 as y1", "id")
    plan = S.overlap_join(few, few)
    assert plan.count() == spark.sql("select count(*) from {t} a join {t} b on a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1", t=few).first()[0]
    met = S.bucketed(few, "", S.cell_size(few)).groupBy("_cx", "_cy").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert met < 6 * plan.count()  # cells of 64 brought 2000 * 2000 pairs together


def test_spans_do_not_travel_for_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    boxes = [(i, 0, int(x), int(y), int(x + w), int(y + h), int(w * h) - 3) for i, (x, y, w, h) in enumerate(np.column_stack([rng.integers(0, 25, (150, 2)), rng.integers(4, 9, (150, 2))]))]
    o = spark.createDataFrame(boxes, "id long, tile_id long, x0 long, y0 long, x1 long, y1 long, area long")
    holed = R.box_to_spans(o).withColumn("c0", F.when(F.col("row") == F.col("id") % 25, F.col("c0") + 1).otherwise(F.col("c0")))
    monkeypatch.setattr(R, "span_intersections", None)  # a row for each span of each pair
    got = {(r.a_id, r.b_id, r.inter) for r in R.duplicate_edges(o, spans=holed).collect()}
    monkeypatch.undo()
    pairs = R.duplicate_pairs(o, holed).where("inter > 0").collect()
    want = {(r.a_id, r.b_id, r.inter) for r in pairs if 10 * r.inter > 7 * (r.a_area + r.b_area - r.inter) or 100 * r.inter > 92 * min(r.a_area, r.b_area)}
    assert got == want and 0 < len(want) < len(pairs) / 3


def test_components_reduce_edges_in_their_tasks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    ends = rng.integers(0, 3000, (20000, 2)) // 10 * 10 + rng.integers(0, 10, 20000)[:, None] % 7
    edges = spark.createDataFrame([*map(tuple, ends.tolist()), (None, 5), (4001, 4000), (4002, 4001)], "a long, b long")
    seen, kept = [], C.settle
    monkeypatch.setattr(C, "settle", lambda e, a, b: seen.append(e.count()) or kept(e, a, b))
    got = {r.node: r.component for r in C.connected_components(edges).collect()}
    near = edges.where("a <> b").select("a", "b")
    assert got == {r.node: r.component for r in kept(near, "a", "b").collect()}
    assert got[4002] == 4000 and seen[0] < 4 * len(got)  # all 20 000 edges went through every round


def test_dust_rounds_take_contested_pixels_only(spark, monkeypatch):
    rng = np.random.default_rng(11)
    boxes = [(i, 0, int(x), int(y), int(x + w), int(y + h), int(w * h)) for i, (x, y, w, h) in enumerate(np.column_stack([rng.integers(0, 120, (600, 2)), rng.integers(3, 11, (600, 2))]))]
    o = spark.createDataFrame(boxes, "id long, tile_id long, x0 long, y0 long, x1 long, y1 long, area long")
    taken, kept = [], R.ownership
    monkeypatch.setattr(R, "ownership", lambda objects, spans=None, **kw: taken.append(spans.agg(F.sum(F.col("c1") - F.col("c0"))).first()[0]) or kept(objects, spans, **kw))
    got, runs, _ = R.resolve_mosaic(o, 6)
    assert len(taken) > 2 and max(taken[1:]) < taken[0] / 3  # every round took all pixels anew
    want = greedy([b[:6] for b in boxes], 6)
    assert {r.id: r.remnant for r in got.collect()} == want
    pixels = [(r.row, c) for r in runs.collect() for c in range(r.c0, r.c1)]
    assert len(pixels) == len(set(pixels)) == sum(want.values())
