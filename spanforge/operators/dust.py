"""Who survives the largest-first rule when remnants of up to ``dust`` pixels are dropped, decided inside windows of the plane."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.session import cut

FREE, MAYBE, TAKEN = 0, 1, 2  # a pixel by the objects so far: of nobody, of an open one at most, of one that is kept
OPEN, DROPPED, KEPT = 0, 1, 2
HALO, SIDE = (64, 512), 2048  # pixels around a window's core, and the most of a core's side
LAYERS = 2
MANY = 1000  # rows from which those that are beyond hope are told at once
EDGES = ["x0", "y0", "x1", "y1"]


def dense(objects: DataFrame) -> bool:
    """Whether objects lie in more than LAYERS layers, on average over their common extent."""
    area = F.greatest(F.col("x1") - F.col("x0"), F.lit(0)).cast("double") * F.greatest(F.col("y1") - F.col("y0"), F.lit(0))
    row = objects.agg(F.sum(area).alias("a"), *[f(c).cast("double").alias(c) for f, c in zip((F.min, F.min, F.max, F.max), EDGES, strict=True)]).first()
    return bool(row["a"]) and row["a"] > LAYERS * (row["x1"] - row["x0"]) * (row["y1"] - row["y0"])


def survivors(objects: DataFrame, spans: DataFrame | None, dust: int, sure: DataFrame | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """``id`` of the objects whose remnant exceeds ``dust``, as the sequential rule finds them.

    Objects are dealt to windows, each a core with a halo, and read there in order; a window holds its pixels and a batch.
    What can't be told inside a window stays open, and its pixels may or may not be taken, until an object that is surely
    kept takes them all. Free and possible pixels of open objects are summed over the cores, which don't overlap; what
    is still open then is read again with all that is kept, in its windows alone. The first open object has no possible
    pixels but free ones, so every round settles one at least. ``sure``: ids that are kept whatever they have; they are
    not returned. ``sizes``: side of a core and halo, else by the objects.
    """
    side, halo = sizes or _sizes(objects)
    pieces = _pieces(objects, spans)
    given = pieces.withColumn("_kept", F.lit(False)) if sure is None else pieces.join(sure.withColumn("_kept", F.lit(True)), "id", "left").withColumn("_kept", F.coalesce("_kept", F.lit(False)))
    dealt, kept = _in_windows(given, side, halo), None
    kind = objects.schema["id"].dataType.simpleString()
    columns = ["_wx", "_wy", "id", "_kept", *EDGES, *([] if spans is None else [f"_b{c}" for c in EDGES])]
    while True:
        read = dealt.repartition("_wx", "_wy").sortWithinPartitions("_wx", "_wy", "_a", "_t", "id").select(*columns)
        judged = read.mapInArrow(_judge(side, halo, dust), f"id {kind}, state int, free long, possible long")
        judged = judged.groupBy("id").agg(F.max("state").alias("state"), F.sum("free").alias("free"), F.sum("possible").alias("possible"))
        stays = (F.col("state") == KEPT) | (F.col("state") == OPEN) & (F.col("free") > dust)
        found = cut(judged.select("id", stays.alias("_kept"), ((F.col("state") == OPEN) & (F.col("free") + F.col("possible") > dust)).alias("_open")).where("_kept or _open"))
        fresh, still = found.where("_kept").select("id"), found.where("not _kept").select("id")
        kept = fresh if kept is None else cut(kept.unionByName(fresh))
        if not still.limit(1).count():
            return kept
        again = _in_windows(pieces.join(still, "id", "left_semi").withColumn("_kept", F.lit(False)), side, halo)
        settled = _in_windows(pieces.join(kept if sure is None else kept.unionByName(sure), "id", "left_semi").withColumn("_kept", F.lit(True)), side, halo)
        dealt = again.unionByName(settled.join(cut(again.select("_wx", "_wy").distinct()), ["_wx", "_wy"], "left_semi"))


def _sizes(objects: DataFrame) -> tuple[int, int]:
    mean = lambda a: F.avg(F.greatest(F.col(f"{a}1") - F.col(f"{a}0"), F.lit(0)).cast("double"))
    row = objects.agg(mean("x").alias("x"), mean("y").alias("y")).first()
    halo = int(min(max(HALO[0], 4 * max(row["x"] or 0.0, row["y"] or 0.0)), HALO[1]))
    return min(16 * halo, SIDE), halo


def _pieces(objects: DataFrame, spans: DataFrame | None) -> DataFrame:
    """``(id, _a, _t, x0, y0, x1, y1)``, in order of ``_a, _t, id``; of spans with their object's extent besides."""
    order = [(-F.col("area")).alias("_a"), F.col("tile_id").alias("_t")]
    if spans is None:
        return objects.select("id", *order, *[F.col(c).cast("long").alias(c) for c in EDGES]).where("id is not null and x1 > x0 and y1 > y0")
    flat = spans.where("c1 > c0").select("id", F.col("c0").alias("x0"), F.col("row").alias("y0"), F.col("c1").alias("x1"), (F.col("row") + 1).alias("y1"))
    extent = flat.groupBy("id").agg(F.min("x0").alias("_bx0"), F.min("y0").alias("_by0"), F.max("x1").alias("_bx1"), F.max("y1").alias("_by1"))
    return flat.join(objects.select("id", *order).join(extent, "id"), "id").select("id", "_a", "_t", *[F.col(c).cast("long").alias(c) for p in ("", "_b") for c in [f"{p}{e}" for e in EDGES]])


def _in_windows(pieces: DataFrame, side: int, halo: int) -> DataFrame:
    cells = lambda a: F.explode(F.sequence(F.floor((F.col(f"{a}0") - halo) / side).cast("long"), F.floor((F.col(f"{a}1") - 1 + halo) / side).cast("long"))).alias(f"_w{a}")
    return pieces.select("*", cells("x")).select("*", cells("y"))


def _judge(side: int, halo: int, dust: int):
    wide = side + 2 * halo

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pixels, at = None, None
        for whole in _whole_objects(batches):
            for window, rows, starts in _by_window(whole):
                if window != at:
                    pixels, at = np.zeros((wide, wide), "uint8"), window
                yield from read(pixels, window, rows, starts)

    def read(pixels: np.ndarray, window: tuple[int, int], rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.r_[starts[1:], len(rows)]
        edges = np.column_stack([rows.column(k).to_numpy() for k in range(4, rows.num_columns)])
        edges -= np.tile([window[0] * side - halo, window[1] * side - halo], edges.shape[1] // 2)
        extent = np.column_stack([f.reduceat(edges[:, (edges.shape[1] - 4 + k)], starts) for k, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum))])
        contained = (extent[:, :2] >= 0).all(1) & (extent[:, 2:] <= wide).all(1)
        inside = (extent[:, :2] >= halo).all(1) & (extent[:, 2:] <= halo + side).all(1)
        meets = (extent[:, :2] < halo + side).all(1) & (extent[:, 2:] > halo).all(1)
        known = rows.column(3).to_numpy()[starts]
        cut_to = np.clip(edges[:, :4], 0, wide)
        single = ends - starts == 1
        state, free, possible = np.full(len(starts), DROPPED), np.zeros(len(starts), "int64"), np.zeros(len(starts), "int64")
        todo = np.arange(len(starts))
        if len(starts) >= MANY:
            # Pixels that are taken stay so: whoever has too few others now is dropped.
            sums = np.zeros((wide + 1, wide + 1), "int32")
            np.cumsum(pixels != TAKEN, axis=0, dtype="int32", out=sums[1:, 1:])
            np.cumsum(sums, axis=1, out=sums)
            x0, y0, x1, y1 = cut_to[starts].T
            left = sums[y1, x1] - sums[y0, x1] - sums[y1, x0] + sums[y0, x0]
            todo = np.flatnonzero(known | ~contained | ~single | (left > dust))
        boxes = cut_to.tolist()
        for i, s, e, sure, fits in zip(todo.tolist(), starts[todo].tolist(), ends[todo].tolist(), known[todo].tolist(), contained[todo].tolist(), strict=True):
            parts = [pixels[y0:y1, x0:x1] for x0, y0, x1, y1 in boxes[s:e]]
            if not sure:
                if e - s == 1:
                    n = np.count_nonzero(parts[0] == FREE)
                    m = np.count_nonzero(parts[0] == MAYBE) if n <= dust else 0
                else:
                    n, m = _counts(pixels, boxes[s:e], 0, wide)
                if n <= dust and fits and n + m <= dust:
                    continue
                if n <= dust:
                    state[i] = OPEN
                    free[i], possible[i] = _counts(pixels, boxes[s:e], halo, halo + side)
                    for p in parts:
                        p[p == FREE] = MAYBE
                    continue
            state[i] = KEPT
            for p in parts:
                p[...] = TAKEN
        told = np.flatnonzero(meets & ~known & ((state != DROPPED) | ~inside))
        if len(told):
            ids = rows.column(2).combine_chunks()
            ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(starts[told])), pa.array(state[told].astype("int32")), pa.array(free[told]), pa.array(possible[told])], names=["id", "state", "free", "possible"])

    return judge


def _counts(pixels: np.ndarray, boxes: list, low: int, high: int) -> tuple[int, int]:
    """Free and possible pixels of an object's boxes between ``low`` and ``high`` on both axes; common ones count once."""
    boxes = [b for b in ([max(x0, low), max(y0, low), min(x1, high), min(y1, high)] for x0, y0, x1, y1 in boxes) if b[0] < b[2] and b[1] < b[3]]
    if not boxes:
        return 0, 0
    left, top, right, bottom = (f(b[k] for b in boxes) for k, f in enumerate((min, min, max, max)))
    seen = pixels[top:bottom, left:right]
    if len(boxes) > 1:
        mine = np.zeros(seen.shape, bool)
        for x0, y0, x1, y1 in boxes:
            mine[y0 - top : y1 - top, x0 - left : x1 - left] = True
        seen = seen[mine]
    return np.count_nonzero(seen == FREE), np.count_nonzero(seen == MAYBE)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _firsts(rows: pa.Table) -> np.ndarray:
    """Where an object begins in rows sorted by window and object."""
    x, y, i = rows.column(0).to_numpy(), rows.column(1).to_numpy(), _codes(rows.column(2))
    return np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (i[1:] != i[:-1])])


def _whole_objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of batches; a batch's last object waits for the next one, where it may go on."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            last = _firsts(rows)[-1]
            rest = rows.slice(last)
            if last:
                yield rows.slice(0, last)
    if rest is not None:
        yield rest


def _by_window(rows: pa.Table) -> Iterator[tuple[tuple[int, int], pa.Table, np.ndarray]]:
    """(window, its rows, where its objects begin among them)."""
    first = _firsts(rows)
    x, y = rows.column(0).to_numpy()[first], rows.column(1).to_numpy()[first]
    turns = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    for a, b in zip(turns, np.r_[turns[1:], len(first)], strict=True):
        end = first[b] if b < len(first) else len(rows)
        yield (int(x[a]), int(y[a])), rows.slice(first[a], end - first[a]), first[a:b] - first[a]
