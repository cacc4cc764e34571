"""Training tiles: quality split, routing, counts, tile-local ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.operators.spatial_join import overlap_join


def qc_pass(field: str | None, values: list | None = None) -> Column:
    """No field: all pass. Values: membership, null fails. Else: anything but null passes."""
    if field is None:
        return F.lit(True)
    return F.coalesce(F.col(field).isin(values), F.lit(False)) if values is not None else F.col(field).isNotNull()


def in_region(x: str, y: str, region: tuple[float, float, float, float] | None) -> Column:
    """Point in a box, borders included; no region holds nothing."""
    if region is None:
        return F.lit(False)
    return F.col(x).between(region[0], region[2]) & F.col(y).between(region[1], region[3])


def in_polygon(x: Column, y: Column, rings: list[list[tuple[float, float]]]) -> Column:
    """Even-odd rule over all rings, in generated code; points on an edge count as outside."""
    crossings, edge = F.lit(0), F.lit(False)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (ax, ay) == (bx, by):
                continue
            cross = (x - ax) * (by - ay) - (y - ay) * (bx - ax)
            edge = edge | ((cross == 0) & x.between(min(ax, bx), max(ax, bx)) & y.between(min(ay, by), max(ay, by)))
            if ay != by:
                spans = F.lit(ay) > y if by < ay else F.lit(by) > y
                above = (y >= min(ay, by)) & spans
                crossings = crossings + F.when(above & (x < ax + (y - ay) * ((bx - ax) / (by - ay))), 1).otherwise(0)
    return (crossings % 2 == 1) & ~edge


def split_of(x: str, y: str, val: tuple | None, bbox: tuple | None) -> Column:
    """Validation region first, then the box filter (null: dropped), else training."""
    inside = F.lit(True) if bbox is None else in_region(x, y, bbox)
    return F.when(in_region(x, y, val), "val").when(~inside, F.lit(None)).otherwise("train")


def route_tiles(tiles: DataFrame, crowns: DataFrame, passed: Column, split: Column, min_instances: int = 1, source: str = "src") -> DataFrame:
    """Every tile ``(tile_id, x0, y0, x1, y1, …)`` with counts of passed and failed crowns it meets, and its route."""
    marked = crowns.select("id", "x0", "y0", "x1", "y1", passed.alias("ok"))
    met = overlap_join(tiles.select("tile_id", "x0", "y0", "x1", "y1"), marked, cell=512).groupBy(F.col("a_tile_id").alias("tile_id"))
    counts = met.agg(F.count_if("b_ok").alias("n_passed"), F.count_if(~F.col("b_ok")).alias("n_failed"))
    joined = tiles.join(counts, "tile_id", "left").withColumn("n_passed", F.coalesce("n_passed", F.lit(0))).withColumn("n_failed", F.coalesce("n_failed", F.lit(0)))
    joined = joined.withColumn("split", split).withColumn("source", F.lit(source))
    route = F.when(F.col("split").isNull(), "skipped_filtered").when(F.col("n_failed") > 0, "review").when(F.col("n_passed") < min_instances, "skipped_no_crowns").otherwise(F.col("split"))
    return joined.withColumn("route", route)


def split_counts(routed: DataFrame) -> DataFrame:
    """Counts per source and in total (null source); failed tiles count as review and as failed."""
    names = ("train", "val", "review", "skipped_no_crowns", "skipped_filtered")
    sums = [F.count_if(F.col("route") == n).alias(n) for n in names]
    return routed.rollup("source").agg(*sums, F.count_if(F.col("route") == "review").alias("skipped_qc_failed"))


def tile_local_ids(tiles: DataFrame, crowns: DataFrame, passed: Column) -> DataFrame:
    """``(tile_id, id, local_id)``: passed crowns of each tile numbered from 1 in id order."""
    met = overlap_join(tiles.select("tile_id", "x0", "y0", "x1", "y1"), crowns.where(passed).select("id", "x0", "y0", "x1", "y1"), cell=512)
    rank = F.row_number().over(Window.partitionBy("a_tile_id").orderBy("b_id"))
    return met.select(F.col("a_tile_id").alias("tile_id"), F.col("b_id").alias("id"), rank.alias("local_id"))
