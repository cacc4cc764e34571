"""Reconciling per-tile observations into one non-overlapping set: stitch, merge duplicates, resolve the mosaic.

Objects are rows ``(id, tile_id, x0, y0, x1, y1, area)`` with half-open integer boxes and, for shapes other than boxes,
exploded spans ``(id, row, c0, c1)``. Larger objects come first; ties go to the smaller tile, then the smaller id.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from spanforge.operators import spans as S
from spanforge.operators.box_links import box_links, box_links_side
from spanforge.operators.box_merge import merge_boxes
from spanforge.operators.components import connected_components, joined_trees
from spanforge.operators.dust import dense, survivors
from spanforge.operators.spatial_join import box_intersection, cell_size, overlap_join, span_intersections
from spanforge.session import cut, laid_down

BOX = ["x0", "y0", "x1", "y1"]
RUN_CELL = 64
SPAN_COPIES = 2.5  # cells of an object that brings its spans to each
SOURCE_BITS = 40  # of an id within a chunk; the chunk takes the bits above
SOURCES = 1 << SOURCE_BITS


def box_to_spans(objects: DataFrame) -> DataFrame:
    return S.explode_spans(objects.select("id", S.box_spans().alias("spans")))


def stitch(objects: DataFrame, tiles: DataFrame, shift: int) -> DataFrame:
    """Objects within their tile, which is shrunk by ``shift`` on inner sides only (closed comparison).

    Objects of unknown tiles, and of tiles that the shift leaves nothing of, are dropped. ``tiles``:
    ``(tile_id, tx0, ty0, tx1, ty1, edge_w, edge_e, edge_n, edge_s)``; the grid is joined by tile, and AQE broadcasts
    it while it is small.
    """
    inner = tiles.select(
        "tile_id", *[(F.col(t) + sign * F.when(F.col(edge), 0).otherwise(shift)).alias(n) for t, edge, sign, n in (("tx0", "edge_w", 1, "_l"), ("ty0", "edge_n", 1, "_t"), ("tx1", "edge_e", -1, "_r"), ("ty1", "edge_s", -1, "_b"))]
    ).where("_l < _r and _t < _b")
    return objects.join(inner, "tile_id").where("x0 >= _l and x1 <= _r and y0 >= _t and y1 <= _b").drop("_l", "_t", "_r", "_b")


def drop_exact_copies(objects: DataFrame, geometry: list[str]) -> DataFrame:
    """One of equal geometries: that of the smallest tile, then of the smallest id."""
    rest = [c for c in objects.columns if c not in geometry]
    first = F.min_by(F.struct(*rest), F.struct("tile_id", "id"))
    return objects.groupBy(*geometry).agg(first.alias("_first")).select(*[F.col(c) if c in geometry else F.col(f"_first.{c}").alias(c) for c in objects.columns])


def duplicate_pairs(objects: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Overlapping pairs ``a_id < b_id`` with their areas and common pixels ``inter``."""
    slim = objects.select("id", "area", "x0", "y0", "x1", "y1")
    pairs = overlap_join(slim, slim).where("a_id < b_id")
    if spans is None:
        return pairs.withColumn("inter", box_intersection()).select("a_id", "b_id", "a_area", "b_area", "inter")
    return span_intersections(pairs, spans).select("a_id", "b_id", "a_area", "b_area", "inter")


def _over(share: str, whole, threshold: float):
    t = Fraction(str(threshold))
    return F.col(share) * t.denominator > whole * t.numerator


def duplicate_edges(objects: DataFrame, iou: float = 0.7, containment: float = 0.92, spans: DataFrame | None = None) -> DataFrame:
    """Pairs whose intersection over union, or over the smaller area, exceeds its threshold (strictly, in integers)."""
    union = F.col("a_area") + F.col("b_area") - F.col("inter")
    far = _over("inter", union, iou) | _over("inter", F.least("a_area", "b_area"), containment)
    if spans is None:
        return duplicate_pairs(objects).where("inter > 0").where(far)
    # Objects bring their spans to the cells, so that none travel for a pair; as common pixels can't exceed the common box,
    # spans are only compared by pairs whose boxes pass.
    packed = objects.select("id", "area", "x0", "y0", "x1", "y1").join(S.pack_spans(spans), "id")
    pairs = overlap_join(packed, packed, cell_size(objects, SPAN_COPIES)).where("a_id < b_id").withColumn("inter", box_intersection()).where("inter > 0").where(far)
    exact = pairs.select("a_id", "b_id", "a_area", "b_area", S.common_pixels("a__spans", "b__spans").alias("inter"))
    return exact.where("inter > 0").where(far)


def duplicate_components(objects: DataFrame, iou: float = 0.7, containment: float = 0.92, spans: DataFrame | None = None) -> DataFrame:
    """Every object with the component of its duplicates, named by the smallest id."""
    side = box_links_side(objects) if spans is None and min(iou, containment) >= 0.5 else None
    if side is None:
        found = connected_components(duplicate_edges(objects, iou, containment, spans), "a_id", "b_id")
    else:
        found = joined_trees(box_links(objects, side, iou, containment))
    return objects.join(found, objects["id"] == found["node"], "left").drop("node").withColumn("component", F.coalesce("component", "id"))


def merge_duplicates(objects: DataFrame, iou: float = 0.7, containment: float = 0.92, spans: DataFrame | None = None, reread: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged objects, their spans, culled members).

    The anchor is a component's largest member; its attributes stay, the geometry is the union of all members, and
    area and box are recomputed from it. ``reread``: the spans are laid down, so that they are not merged anew by those
    who read them besides the objects.
    """
    members = laid_down(duplicate_components(objects, iou=iou, containment=containment, spans=spans))
    order = F.struct((-F.col("area")).alias("a"), "tile_id", "id")
    anchors = members.groupBy("component").agg(F.min_by("id", order).alias("anchor"), F.count("*").alias("n_members"))
    owned = members.join(anchors, "component")
    if spans is None:
        alone = box_to_spans(owned.where("n_members = 1"))
        merged_spans = alone.unionByName(S.union_boxes(owned.where("n_members > 1").select(F.col("anchor").alias("id"), *BOX)))
    else:
        boxes = spans.join(owned.select("id", "anchor"), "id").select(F.col("anchor").alias("id"), F.col("c0").alias("x0"), F.col("row").alias("y0"), F.col("c1").alias("x1"), (F.col("row") + 1).alias("y1"))
        merged_spans = S.union_boxes(boxes)
    merged_spans = laid_down(merged_spans) if reread else merged_spans
    shape = S.measures(merged_spans, ["id"]).withColumnRenamed("area_px", "area")
    merged = owned.where("id = anchor").drop("area", "x0", "y0", "x1", "y1", "anchor", "component").join(shape, "id")
    culled = owned.where("id <> anchor").select(
        F.lit("merge_duplicate").alias("phase"), "tile_id", "id", F.col("anchor").alias("winner_id"), F.col("area").alias("original_area"), F.col("area").alias("removed_area")
    )
    return merged, merged_spans, culled


def ownership(objects: DataFrame, spans: DataFrame | None = None, cell: int = RUN_CELL) -> DataFrame:
    """Disjoint runs ``(id, row, c0, c1)``: every pixel goes to the first of its objects in order.

    Spans are cut at column cells and grouped by (row, cell), whose size is bounded by how many objects cover a few
    pixels. Within a group the elementary runs between span ends get the best covering object: no join.
    """
    order = objects.select("id", (-F.col("area")).alias("_a"), F.col("tile_id").alias("_t"))
    if spans is None:
        ranked = S.explode_spans(objects.select("id", (-F.col("area")).alias("_a"), F.col("tile_id").alias("_t"), S.box_spans().alias("spans")))
    else:
        ranked = spans.join(order, "id")
    low, high = F.floor(F.col("c0") / cell).cast("long"), F.floor((F.col("c1") - 1) / cell).cast("long")
    cells = ranked.select("*", F.explode(F.sequence(low, high)).alias("_cell"))
    clipped = F.struct("_a", "_t", "id", F.greatest("c0", F.col("_cell") * cell).alias("s"), F.least("c1", (F.col("_cell") + 1) * cell).alias("e"))
    groups = cells.groupBy("row", "_cell").agg(F.array_sort(F.collect_list(clipped)).alias("_in"))
    ends = F.array_sort(F.array_distinct(F.flatten(F.transform("_in", lambda x: F.array(x["s"], x["e"])))))
    groups = groups.select("row", "_in", F.explode(F.array(ends)).alias("_ends"))
    runs = groups.select("row", "_in", F.explode(F.arrays_zip(F.slice("_ends", F.lit(1), F.size("_ends") - 1).alias("s"), F.slice("_ends", F.lit(2), F.size("_ends")).alias("e"))).alias("_run"))
    owner = F.get(F.filter("_in", lambda x: (x["s"] <= F.col("_run.s")) & (x["e"] >= F.col("_run.e"))), F.lit(0))["id"]
    owned = runs.select(owner.alias("id"), "row", F.col("_run.s").alias("c0"), F.col("_run.e").alias("c1")).where("id is not null")
    return S.union_spans(owned, ["id"])


def _remnants(objects: DataFrame, runs: DataFrame) -> DataFrame:
    left = runs.groupBy("id").agg(F.sum(F.col("c1") - F.col("c0")).alias("remnant"))
    return objects.join(left, "id", "left").withColumn("remnant", F.coalesce("remnant", F.lit(0).cast("long")))


def resolve_mosaic(objects: DataFrame, dust: int = 0, spans: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept objects with ``remnant``, their disjoint spans, culled rows). An object stays iff its remnant exceeds ``dust``.

    The sequential rule (largest first, subtract what is kept). Where objects lie in many layers, who stays is settled
    first, and only they own pixels then. Else ownership is taken at once, and objects whose remnant is too small are
    settled after it: remnants only grow, so all pixels that ever change hands are those that the first ownership gives
    to them. With no dust nothing changes hands.
    """
    staying, settled = objects, dust <= 0
    if not settled:
        objects = laid_down(objects)
        staying, settled = objects, dense(objects)
        spans = spans if spans is None and settled else laid_down(box_to_spans(objects) if spans is None else spans)
        if settled:
            staying = cut(objects.join(survivors(objects, spans, dust), "id", "left_semi"))
    runs = cut(ownership(staying, spans))
    state = _remnants(staying, runs)
    if not settled:
        state = cut(state)
        state, runs = _settle_dust(objects, spans, state, runs, dust)
    kept, kept_runs = state.where(F.col("remnant") > dust), runs  # whoever is left out owns no pixel by now
    gone = objects.join(kept.select("id"), "id", "left_anti").select(
        F.lit("mosaic_dropped").alias("phase"), "tile_id", "id", F.col("area").alias("original_area"), F.col("area").alias("removed_area"))
    clipped = kept.where(F.col("area") - F.col("remnant") > dust).select(
        F.lit("mosaic_clipped").alias("phase"), "tile_id", "id", F.col("area").alias("original_area"), (F.col("area") - F.col("remnant")).alias("removed_area"))
    return kept, kept_runs, gone.unionByName(clipped)


def _settle_dust(objects: DataFrame, spans: DataFrame, state: DataFrame, runs: DataFrame, dust: int) -> tuple[DataFrame, DataFrame]:
    """(objects with their final remnants, owned runs) after all that fall short are dropped."""
    doomed = cut(state.where(F.col("remnant") <= dust).drop("remnant"))
    if not doomed.limit(1).count():
        return state, runs
    sure = state.join(doomed.select("id"), "id", "left_anti")
    contested = runs.join(doomed.select("id"), "id", "left_semi").select("row", F.col("c0").alias("_b0"), F.col("c1").alias("_b1"))
    in_cells = lambda df, s, e: df.select("*", F.explode(F.sequence(F.floor(F.col(s) / RUN_CELL), F.floor((F.col(e) - 1) / RUN_CELL))).alias("_cell"))
    met = in_cells(spans.where("c1 > c0"), "c0", "c1").join(in_cells(contested, "_b0", "_b1"), ["row", "_cell"]).where("c0 < _b1 and _b0 < c1")
    met = met.where(F.floor(F.greatest("c0", "_b0") / RUN_CELL) == F.col("_cell"))
    pieces = cut(met.select("id", "row", F.greatest("c0", "_b0").alias("c0"), F.least("c1", "_b1").alias("c1")))
    live = doomed
    while True:
        gained = cut(ownership(objects, pieces))
        left = gained.groupBy("id").agg(F.sum(F.col("c1") - F.col("c0")).alias("_gained"))
        short = cut(live.select("id").join(left, "id", "left").where(F.coalesce("_gained", F.lit(0)) <= dust).select("id"))
        if not short.limit(1).count():
            break
        dropped = cut(short.join(survivors(objects, pieces, dust, sure.select("id")), "id", "left_anti"))
        pieces = cut(pieces.join(dropped, "id", "left_anti"))
        live = cut(live.join(dropped, "id", "left_anti"))
    left = cut(left)
    whole = sure.unionByName(live.withColumn("remnant", F.lit(0).cast("long")))
    whole = whole.join(left, "id", "left").withColumn("remnant", F.col("remnant") + F.coalesce("_gained", F.lit(0).cast("long"))).drop("_gained")
    return cut(whole), cut(S.union_spans(runs.join(doomed.select("id"), "id", "left_anti").unionByName(gained.select(*runs.columns)), ["id"]))


def run_summary(crowns: DataFrame, image: tuple[int, int], pixel: float) -> DataFrame:
    """``n_crowns, pct_cover, density_km2, mean_area_m2`` of a run over ``image`` pixels of ``pixel`` metres."""
    km2 = image[0] * pixel / 1000 * (image[1] * pixel / 1000)
    return crowns.agg(
        F.count(F.lit(1)).alias("n_crowns"), (F.sum("area") * 100.0 / (image[0] * image[1])).alias("pct_cover"),
        F.floor(F.count(F.lit(1)) / F.lit(km2)).cast("long").alias("density_km2"), (F.avg("area") * pixel * pixel).alias("mean_area_m2"),
    )


def culled_in_core(culled: DataFrame, chunks: DataFrame) -> DataFrame:
    """Culled rows ``(…, chunk_id, x0, y0, x1, y1)`` whose box centre lies in their chunk's half-open core."""
    centred = culled.withColumn("_cx", (F.col("x0") + F.col("x1")) / 2).withColumn("_cy", (F.col("y0") + F.col("y1")) / 2)
    return core_owned(centred, chunks, "_cx", "_cy").drop("_cx", "_cy")


def culled_winners(culled: DataFrame, survivors: DataFrame) -> DataFrame:
    """Each culled row with the survivor of the largest common area (smaller id on ties), -1 where none meets it."""
    pairs = overlap_join(culled.select("id", "x0", "y0", "x1", "y1"), survivors.select("id", "x0", "y0", "x1", "y1")).withColumn("inter", box_intersection())
    best = pairs.groupBy(F.col("a_id").alias("id")).agg(F.min_by("b_id", F.struct((-F.col("inter")).alias("i"), "b_id")).alias("winner_instance_id"))
    return culled.join(best, "id", "left").withColumn("winner_instance_id", F.coalesce("winner_instance_id", F.lit(-1).cast("long")))


def tag_image_edge(objects: DataFrame, width: int, height: int, beyond: bool = False) -> DataFrame:
    """True where an object is not within the image shrunk by half a pixel, yet meets the image (closed).

    ``beyond``: objects wholly outside the image are tagged, too.
    """
    inside = (F.col("x0") >= 0.5) & (F.col("y0") >= 0.5) & (F.col("x1") <= width - 0.5) & (F.col("y1") <= height - 0.5)
    if beyond:
        return objects.withColumn("touches_image_edge", ~inside)
    meets = (F.col("x0") <= width) & (F.col("y0") <= height) & (F.col("x1") >= 0) & (F.col("y1") >= 0)
    return objects.withColumn("touches_image_edge", ~inside & meets)


def core_owned(objects: DataFrame, chunks: DataFrame, x: str = "centroid_x", y: str = "centroid_y") -> DataFrame:
    """Rows ``(…, chunk_id)`` whose centroid lies in their chunk's half-open core."""
    core = chunks.select("chunk_id", "core_minx", "core_maxx", "core_miny", "core_maxy")
    met = objects.join(core, "chunk_id").where(f"{x} >= core_minx and {x} < core_maxx and {y} >= core_miny and {y} < core_maxy")
    return met.drop("core_minx", "core_maxx", "core_miny", "core_maxy")


def instance_ids(objects: DataFrame, chunk: str = "chunk_id", area: str = "area", key: str = "id") -> DataFrame:
    """1..N in chunk order, within a chunk by area downwards; a prefix sum over chunk counts, no global window."""
    counts = objects.groupBy(chunk).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1))).select(chunk, F.coalesce("_before", F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(chunk).orderBy(F.desc(area), key))
    return objects.withColumn("_rank", rank).join(before, chunk).withColumn("instance_id", (F.col("_before") + F.col("_rank")).cast("long")).drop("_rank", "_before")


def reconcile(objects: DataFrame, tiles: DataFrame, shift: int = 6, iou: float = 0.7, containment: float = 0.92, dust: int = 0, spans: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stitch, drop exact copies, merge duplicates, resolve the mosaic: (crowns, their spans, culled).

    Without ``spans`` the objects are their boxes; with them, copies are told by a hash of all spans besides the box.
    """
    within, geometry = stitch(objects, tiles, shift), ["x0", "y0", "x1", "y1"]
    if spans is not None:
        shape = spans.groupBy("id").agg(F.xxhash64(F.array_sort(F.collect_list(F.struct("row", "c0", "c1")))).alias("_shape"))
        within, geometry = within.join(shape, "id"), [*geometry, "_shape"]
    stitched = laid_down(drop_exact_copies(within, geometry).drop("_shape"))
    merged, spans, culled = merge_duplicates(stitched, iou, containment, None if spans is None else spans.join(stitched.select("id"), "id", "left_semi"), reread=True)
    merged = cut(merged.select("id", "tile_id", "area", "x0", "y0", "x1", "y1"))
    kept, runs, lost = resolve_mosaic(merged, dust, spans)
    crowns = S.measures(runs, ["id"]).join(kept.select("id", "tile_id", F.col("area").alias("merged_area")), "id")
    return crowns, runs, culled.unionByName(lost, allowMissingColumns=True)


def clean(objects: DataFrame, area_threshold: int = 0, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Without tiles: area floor, merge, mosaic."""
    big = objects.where(F.col("area") > area_threshold) if area_threshold > 0 else objects
    merged, spans, culled = merge_duplicates(big, kw.get("iou", 0.7), kw.get("containment", 0.92), reread=True)
    kept, runs, lost = resolve_mosaic(cut(merged.select("id", "tile_id", "area", "x0", "y0", "x1", "y1")), kw.get("dust", 0), spans)
    return kept, runs, culled.unionByName(lost, allowMissingColumns=True)


def run_chunked(objects: DataFrame, tiles: DataFrame, bounds: tuple[int, int, int, int], size: int = 1024, buffer: int = 15, pixel: float = 1.0, **kw) -> DataFrame:
    """Reconcile chunk by chunk and keep each crown in the chunk that owns its centroid.

    Chunks become one composite id space (chunk x object), so all chunks are reconciled in the same distributed plan:
    copies of an object in several chunks lie in separate coordinate bands and never meet.
    """
    from spanforge.operators.grid import assign_chunks, chunk_grid

    spark = objects.sparkSession
    minx, miny, maxx, maxy = bounds
    chunks = chunk_grid(spark, minx, miny, maxx, maxy, size, buffer)
    stitched = laid_down(stitch(objects, tiles, kw.get("shift", 6)).select("id", "tile_id", *BOX, "area"))
    iou, containment, dust = kw.get("iou", 0.7), kw.get("containment", 0.92), kw.get("dust", 0)
    numbered = isinstance(stitched.schema["tile_id"].dataType, IntegralType)
    side = box_links_side(stitched) if numbered and 0.5 <= min(iou, containment) < 1 else None
    # Below 1 exact copies are duplicates of each other, so they fall to the same anchor without being dropped before.
    dealt = assign_chunks(stitched if side else drop_exact_copies(stitched, BOX), minx, miny, maxx, maxy, size, buffer)
    band = int(maxy - miny) + 4 * int(size)
    # Ordered like the ids within a chunk, so that ties between equal areas fall as they do without chunks.
    names = F.when(F.col("id").between(0, SOURCES - 1), F.col("chunk_id") * SOURCES + F.col("id")).otherwise(F.raise_error(F.lit("ids lie between 0 and 2**40")).cast("long"))
    apart = dealt.withColumn("id", names).withColumn("y0", F.col("y0") + F.col("chunk_id") * band).withColumn("y1", F.col("y1") + F.col("chunk_id") * band).drop("chunk_id")
    if side:
        anchors, spans = merge_boxes(apart, side, iou, containment)
        spans = laid_down(spans)
        merged = S.measures(spans, ["id"]).withColumnRenamed("area_px", "area").join(anchors, "id")
        kept, runs, _ = resolve_mosaic(cut(merged.select("id", "tile_id", "area", *BOX)), dust, spans)
    else:
        kept, runs, _ = clean(laid_down(apart), iou=iou, containment=containment, dust=dust)
    shape = S.measures(runs, ["id"]).join(kept.select("id", "area"), "id")
    shape = shape.withColumn("chunk_id", F.shiftright("id", SOURCE_BITS)).withColumn("_source", F.col("id").bitwiseAND(SOURCES - 1).cast(stitched.schema["id"].dataType))
    back = shape.withColumn("centroid_y", F.col("centroid_y") - F.col("chunk_id") * band).withColumn("y0", F.col("y0") - F.col("chunk_id") * band).withColumn("y1", F.col("y1") - F.col("chunk_id") * band)
    owned = core_owned(back, chunks).drop("id").withColumnRenamed("_source", "id")
    return instance_ids(owned)
