"""Rasters: a Python data source for uncompressed and deflate GeoTIFF, one partition per tile of a window grid.

``spark.read.format("tiles").option("window", 1024).option("stride", 768).load(path)`` gives a row per tile and band:
``tile_id, band, read_x, read_y, width, height, px array<double>, transform array<double>``. Strips are read as needed.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8}
_CODES = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d"}


class Tiff:
    """Header and strips of a classic TIFF with chunky pixels."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as f:
            head = f.read(8)
            self.order = {b"II": "<", b"MM": ">"}[head[:2]]
            if struct.unpack(self.order + "H", head[2:4])[0] != 42:
                raise ValueError("not a classic TIFF")
            f.seek(struct.unpack(self.order + "I", head[4:])[0])
            n = struct.unpack(self.order + "H", f.read(2))[0]
            entries = [struct.unpack(self.order + "HHI4s", f.read(12)) for _ in range(n)]
            self.tags = {}
            for tag, kind, count, raw in entries:
                if kind not in _CODES:
                    continue
                if _SIZES[kind] * count > 4:
                    f.seek(struct.unpack(self.order + "I", raw)[0])
                    raw = f.read(_SIZES[kind] * count)
                self.tags[tag] = struct.unpack(f"{self.order}{count}{_CODES[kind]}", raw[: _SIZES[kind] * count])
        one = lambda t, d: self.tags.get(t, (d,))[0]
        self.width, self.height, self.bands = one(256, 0), one(257, 0), one(277, 1)
        self.rows, self.packing = one(278, self.height), one(259, 1)
        if self.packing not in (1, 8, 32946) or one(284, 1) != 1 or one(317, 1) != 1 or 322 in self.tags:
            raise ValueError("only chunky strips, plain or deflated, are read")
        kind = {1: "u", 2: "i", 3: "f"}[one(339, 1)]
        self.dtype = np.dtype(f"{self.order}{kind}{one(258, 8) // 8}")
        scale, tie = self.tags.get(33550, (1.0, 1.0, 0.0)), self.tags.get(33922, (0.0,) * 6)
        self.affine = (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])

    def window(self, x: int, y: int, w: int, h: int) -> np.ndarray:
        out = []
        with open(self.path, "rb") as f:
            for s in range(y // self.rows, -(-(y + h) // self.rows)):
                f.seek(self.tags[273][s])
                raw = f.read(self.tags[279][s])
                raw = raw if self.packing == 1 else zlib.decompress(raw)
                strip = np.frombuffer(raw, self.dtype).reshape(-1, self.width, self.bands)
                out.append(strip[max(0, y - s * self.rows) : y + h - s * self.rows, x : x + w])
        return np.concatenate(out)


def write_tiff(path: str, image: np.ndarray, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), rows: int = 16) -> None:
    """A deflated classic TIFF of ``(height, width, bands)`` unsigned pixels."""
    h, w, b = image.shape
    strips = [zlib.compress(np.ascontiguousarray(image[i : i + rows]).tobytes()) for i in range(0, h, rows)]
    data = b"".join(strips)
    sizes = [len(s) for s in strips]
    starts = [8 + sum(sizes[:i]) for i in range(len(sizes))]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [image.dtype.itemsize * 8] * b), (259, 3, [8]), (262, 3, [1]), (273, 4, starts), (277, 3, [b]), (278, 4, [rows]), (279, 4, sizes), (284, 3, [1]), (339, 3, [1] * b),
            (33550, 12, [affine[0], -affine[4], 0.0]), (33922, 12, [0.0, 0.0, 0.0, affine[2], affine[5], 0.0])]
    at = 8 + len(data)
    at += at % 2
    extra_at, extra, entries = at + 2 + 12 * len(tags) + 4, b"", b""
    for tag, kind, values in tags:
        raw = struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
        if len(raw) > 4:
            field, extra = struct.pack("<I", extra_at + len(extra)), extra + raw + b"\0" * (len(raw) % 2)
        else:
            field = raw.ljust(4, b"\0")
        entries += struct.pack("<HHI", tag, kind, len(values)) + field
    with open(path, "wb") as f:
        f.write(b"II*\0" + struct.pack("<I", at) + data.ljust(at - 8, b"\0") + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra)


@dataclass
class Tile(InputPartition):
    tile_id: int
    x: int
    y: int
    w: int
    h: int


def _starts(size: int, window: int, stride: int) -> list[int]:
    return [0] if size <= window else [min(i * stride, size - window) for i in range(-(-(size - window) // stride) + 1)]


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size, self.stride = options["path"], int(options.get("window", 1024)), int(options.get("stride", 768))
        self.bands = [int(b) for b in options.get("bands", "").split(",") if b]

    def partitions(self) -> list[Tile]:
        t = Tiff(self.path)
        xs, ys = _starts(t.width, self.size, self.stride), _starts(t.height, self.size, self.stride)
        return [Tile(j * len(xs) + i, x, y, min(self.size, t.width), min(self.size, t.height)) for j, y in enumerate(ys) for i, x in enumerate(xs)]

    def read(self, p: Tile) -> Iterator[tuple]:
        t = Tiff(self.path)
        image = t.window(p.x, p.y, p.w, p.h)
        a, _, c, _, e, f = t.affine
        for band in self.bands or range(1, t.bands + 1):
            yield p.tile_id, band, p.x, p.y, p.w, p.h, image[:, :, band - 1].astype(float).ravel().tolist(), [a, 0.0, c + a * p.x, 0.0, e, f + e * p.y]


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiles"

    def schema(self) -> str:
        return "tile_id long, band int, read_x int, read_y int, width int, height int, px array<double>, transform array<double>"

    def reader(self, schema) -> TileReader:
        return TileReader(dict(self.options))


def register(spark) -> None:
    """Make ``las``, ``gpkg`` and ``tiles`` readable through ``spark.read.format``."""
    from spanforge.sources.gpkg import GpkgSource
    from spanforge.sources.las import LasSource

    for source in (LasSource, GpkgSource, TileSource):
        spark.dataSource.register(source)
