"""Pixel-set algebra on run-length spans ``(row, c0, c1)``, half-open in columns; everything is exact in integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = "array<struct<row:bigint,c0:bigint,c1:bigint>>"
BAND = 64  # rows of a group of boxes
CHUNK_BOXES = 1 << 15
ROWS_OUT = 100_000


def box_spans(x0="x0", y0="y0", x1="x1", y1="y1") -> Column:
    c = lambda v: F.col(v).cast("long")
    rows = F.sequence(c(y0), c(y1) - 1)
    return F.when((c(x1) > c(x0)) & (c(y1) > c(y0)), F.transform(rows, lambda r: F.struct(r.alias("row"), c(x0).alias("c0"), c(x1).alias("c1")))).otherwise(F.array().cast(SPAN))


def explode_spans(df: DataFrame, spans: str = "spans") -> DataFrame:
    keep = [c for c in df.columns if c != spans]
    return df.select(*keep, F.explode(spans).alias("_s")).select(*keep, F.col("_s.row").alias("row"), F.col("_s.c0").alias("c0"), F.col("_s.c1").alias("c1"))


def union_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Merge touching and overlapping spans of equal keys and row (gaps and islands)."""
    w = Window.partitionBy(*keys, "row").orderBy("c0", "c1")
    before = F.max("c1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.where("c1 > c0").withColumn("_new", F.when(before.isNull() | (F.col("c0") > before), 1).otherwise(0))
    islands = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "row", "_island").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("_island")


def union_boxes(boxes: DataFrame) -> DataFrame:
    """Disjoint spans ``(id, row, c0, c1)`` of the union of the boxes of equal ``id``, touching ones merged.

    Boxes, not their spans, go to one group for each id and band of rows; there they are read from left to right, so a
    task holds a chunk of boxes and one open span for each row of a band, however many boxes an id has.
    """
    slim = boxes.select("id", *[F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")]).where("x1 > x0 and y1 > y0")
    band = F.explode(F.sequence(F.floor(F.col("y0") / BAND).cast("long"), F.floor((F.col("y1") - 1) / BAND).cast("long"))).alias("_band")
    dealt = slim.select("*", band).select("id", "_band", "x0", F.greatest("y0", F.col("_band") * BAND).alias("y0"), "x1", F.least("y1", (F.col("_band") + 1) * BAND).alias("y1"))
    kind = boxes.schema["id"].dataType.simpleString()
    return dealt.repartition("id", "_band").sortWithinPartitions("id", "_band", "x0").mapInArrow(_union, f"id {kind}, row long, c0 long, c1 long")


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n, still = [], 0, None  # ``still``: the last group's open spans as (row, c0, c1)

    def islands(last: bool):
        nonlocal still
        ids = pa.concat_arrays([b.column(0) for b in held])
        band, x0, y0, x1, y1 = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(1, 6))
        code = ids.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        group = np.cumsum(np.r_[0, (code[1:] != code[:-1]) | (band[1:] != band[:-1])])
        place = np.repeat(np.arange(len(group)), y1 - y0)
        row = np.arange(len(place)) - np.repeat(np.cumsum(y1 - y0) - (y1 - y0), y1 - y0) + y0[place]
        c0, c1 = x0[place], x1[place]
        if still is not None:
            place = np.concatenate([np.zeros(len(still[0]), place.dtype), place])
            row, c0, c1 = (np.concatenate(v) for v in zip(still, (row, c0, c1), strict=True))
        line = group[place] * BAND + row % BAND
        order = np.argsort(line, kind="stable")  # left to right within a line, as boxes came
        place, row, c0, c1, line = (v[order] for v in (place, row, c0, c1, line))
        fresh = np.r_[True, line[1:] != line[:-1]]
        base, wide = c0.min(), int(c1.max()) - int(c0.min()) + 1
        lift = (np.cumsum(fresh) - 1) * wide - base  # ends of a line lie above all ends of the lines before it
        far = np.maximum.accumulate(c1 + lift)
        start = np.flatnonzero(fresh | np.r_[True, (c0 + lift)[1:] > far[:-1]])
        end = np.r_[start[1:], len(far)] - 1
        place, row, c0, c1 = place[start], row[start], c0[start], (far - lift)[end]
        if not last:
            open_ = (group[place] == group[-1]) & np.r_[line[start][1:] != line[start][:-1], True]
            still = row[open_], c0[open_], c1[open_]
            place, row, c0, c1 = (v[~open_] for v in (place, row, c0, c1))
        return [pa.RecordBatch.from_arrays([ids.take(pa.array(place[i : i + ROWS_OUT])), *[pa.array(v[i : i + ROWS_OUT]) for v in (row, c0, c1)]], names=["id", "row", "c0", "c1"]) for i in range(0, len(place), ROWS_OUT)]

    for batch in batches:
        if not batch.num_rows:
            continue
        if n >= CHUNK_BOXES:
            # Spans stay open beyond a chunk's end only if its last group goes on.
            tail = held[-1].slice(held[-1].num_rows - 1)
            goes_on = tail.column(0)[0] == batch.column(0)[0] and tail.column(1)[0] == batch.column(1)[0]
            yield from islands(not goes_on)
            still = still if goes_on else None
            held, n = [], 0
        held.append(batch)
        n += batch.num_rows
    if held:
        yield from islands(True)


def collect_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    return spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row", "c0", "c1"))).alias("spans"))


def pack_spans(spans: DataFrame) -> DataFrame:
    """``(id, _spans)``: an object's spans as one array of numbers, three for each span, by row; compact in an exchange."""
    every = F.array_sort(F.collect_list(F.struct("row", "c0", "c1")))
    return spans.groupBy("id").agg(F.flatten(F.transform(every, lambda s: F.array(s["row"], s["c0"], s["c1"]))).alias("_spans"))


def common_pixels(a: str, b: str) -> Column:
    """Common pixels of two packed objects."""
    starts = lambda v: F.sequence(F.lit(0), F.size(v) - 1, F.lit(3))
    at = lambda v, i: F.get(F.col(v), i)

    def overlap(i, j):
        n = F.least(at(a, i + 2), at(b, j + 2)) - F.greatest(at(a, i + 1), at(b, j + 1))
        return F.when((at(a, i) == at(b, j)) & (n > 0), n).otherwise(F.lit(0).cast("long"))

    zero = F.lit(0).cast("long")
    return F.aggregate(starts(a), zero, lambda t, i: t + F.aggregate(starts(b), zero, lambda u, j: u + overlap(i, j)))


def labels_to_runs(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of equal label from pixels ``(keys, row, col, label)``; label 0 is background."""
    w = Window.partitionBy(*keys, "row", "label").orderBy("col")
    marked = pixels.where("label > 0").withColumn("_island", F.col("col") - F.row_number().over(w))
    return marked.groupBy(*keys, "label", "row", "_island").agg(F.min("col").alias("c0"), (F.max("col") + 1).alias("c1")).drop("_island")


def dissolve_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per instance: union of its parts, area, bounding box and pixel centroid."""
    return measures(union_spans(runs, keys), keys)


def measures(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Area, bounding box and centroid of disjoint spans, in pixels (a pixel's centre is at its index plus a half)."""
    n = F.col("c1") - F.col("c0")
    out = spans.groupBy(*keys).agg(
        F.sum(n).alias("area_px"), F.min("c0").alias("x0"), F.min("row").alias("y0"), F.max("c1").alias("x1"), (F.max("row") + 1).alias("y1"),
        F.sum(n * (F.col("c0") + F.col("c1"))).alias("_sx"), F.sum(n * (2 * F.col("row") + 1)).alias("_sy"),
    )
    return out.withColumn("centroid_x", F.col("_sx") / (2 * F.col("area_px"))).withColumn("centroid_y", F.col("_sy") / (2 * F.col("area_px"))).drop("_sx", "_sy")


def intersect_spans(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    other = b.select(*keys, "row", F.col("c0").alias("_b0"), F.col("c1").alias("_b1"))
    met = a.join(other, [*keys, "row"]).where("c0 < _b1 and _b0 < c1")
    cut = met.withColumn("_c0", F.greatest("c0", "_b0")).withColumn("_c1", F.least("c1", "_b1")).drop("c0", "c1", "_b0", "_b1")
    return cut.withColumnRenamed("_c0", "c0").withColumnRenamed("_c1", "c1")


def subtract_spans(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels of ``a`` that are not in ``b``: the gaps that b's merged spans leave in each span of a."""
    merged = union_spans(b, keys).groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("c0", "c1"))).alias("_cut"))
    met = union_spans(a, keys).join(merged, [*keys, "row"], "left").withColumn("_cut", F.filter(F.coalesce("_cut", F.array().cast("array<struct<c0:bigint,c1:bigint>>")), lambda s: (s["c1"] > F.col("c0")) & (s["c0"] < F.col("c1"))))
    starts = F.concat(F.array(F.col("c0")), F.transform("_cut", lambda s: s["c1"]))
    ends = F.concat(F.transform("_cut", lambda s: s["c0"]), F.array(F.col("c1")))
    gaps = F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("c0"), e.alias("c1"))), lambda s: s["c1"] > s["c0"])
    return met.select(*keys, "row", F.explode(gaps).alias("_g")).select(*keys, "row", F.col("_g.c0").alias("c0"), F.col("_g.c1").alias("c1"))
