"""Point clouds: a Python data source for uncompressed LAS 1.2 to 1.4, one partition per range of points.

Read with ``spark.read.format("las").load(folder)``; columns ``x, y, z, cls, stem``. Compressed LAZ is refused.
Files are opened on the executors by the path given, so the folder must be reachable from all of them.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

POINTS_PER_PARTITION = 2_000_000


@dataclass
class Header:
    offset: int
    record: int
    length: int
    count: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]


def read_header(path: str) -> Header:
    with open(path, "rb") as f:
        h = f.read(375)
    if h[:4] != b"LASF":
        raise ValueError(f"{path} is not a LAS file")
    minor, record = h[25], h[104]
    if record & 0x80:
        raise ValueError(f"{path} is compressed")
    offset = struct.unpack_from("<I", h, 96)[0]
    length = struct.unpack_from("<H", h, 105)[0]
    count = struct.unpack_from("<Q", h, 247)[0] if minor >= 4 else struct.unpack_from("<I", h, 107)[0]
    scale, shift = struct.unpack_from("<3d", h, 131), struct.unpack_from("<3d", h, 155)
    return Header(offset, record & 0x3F, length, count, scale, shift)


def write_las(path: str, x, y, z, cls) -> None:
    """A minimal LAS 1.2 file of point format 0, with millimetre steps; used for tests and small exports."""
    n = len(x)
    head = bytearray(227)
    head[:4], head[24], head[25] = b"LASF", 1, 2
    struct.pack_into("<H", head, 94, 227)
    struct.pack_into("<I", head, 96, 227)
    struct.pack_into("<BHI", head, 104, 0, 20, n)
    struct.pack_into("<3d", head, 131, 0.001, 0.001, 0.001)
    rows = np.zeros(n, np.dtype({"names": ["x", "y", "z", "c"], "formats": ["<i4", "<i4", "<i4", "u1"], "offsets": [0, 4, 8, 15], "itemsize": 20}))
    for name, v in (("x", x), ("y", y), ("z", z)):
        rows[name] = np.round(np.asarray(v) * 1000)
    rows["c"] = cls
    with open(path, "wb") as f:
        f.write(bytes(head) + rows.tobytes())


@dataclass
class Range(InputPartition):
    path: str
    start: int
    stop: int


class LasReader(DataSourceReader):
    def __init__(self, folder: str, batch: int):
        self.folder, self.batch = folder, batch

    def partitions(self) -> list[Range]:
        names = [self.folder] if self.folder.endswith(".las") else sorted(os.path.join(self.folder, n) for n in os.listdir(self.folder) if n.lower().endswith(".las"))
        return [Range(p, s, min(s + self.batch, n)) for p in names for n in [read_header(p).count] for s in range(0, n, self.batch)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        h = read_header(part.path)
        at = 16 if h.record >= 6 else 15
        kind = np.dtype({"names": ["x", "y", "z", "c"], "formats": ["<i4", "<i4", "<i4", "u1"], "offsets": [0, 4, 8, at], "itemsize": h.length})
        stem = os.path.splitext(os.path.basename(part.path))[0]
        step = 1 << 18
        with open(part.path, "rb") as f:
            f.seek(h.offset + part.start * h.length)
            for s in range(part.start, part.stop, step):
                rows = np.frombuffer(f.read(h.length * min(step, part.stop - s)), kind)
                axes = [pa.array(rows[n] * k + o) for n, k, o in zip("xyz", h.scale, h.shift, strict=True)]
                cls = rows["c"] if h.record >= 6 else rows["c"] & 0x1F
                yield pa.RecordBatch.from_arrays([*axes, pa.array(cls.astype(np.int32)), pa.array([stem] * len(rows))], names=["x", "y", "z", "cls", "stem"])


class LasSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return "x double, y double, z double, cls int, stem string"

    def reader(self, schema) -> LasReader:
        return LasReader(self.options["path"], int(self.options.get("pointsPerPartition", POINTS_PER_PARTITION)))
