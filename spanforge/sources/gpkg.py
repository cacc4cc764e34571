"""Vector layers: a Python data source for GeoPackage polygons over sqlite, with id-range partitions and a box filter.

``spark.read.format("gpkg").option("layer", ...).load(path)`` gives ``fid, x0, y0, x1, y1, rings`` plus the attributes
named in option ``columns`` (as strings). Option ``bbox`` ("minx,miny,maxx,maxy") drops features outside, and
``lo``/``hi`` bound the id. ``write_gpkg`` streams a result through one writer, as the format demands.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FEATURES_PER_PARTITION = 200_000
_ENVELOPES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def _polygon(wkb: bytes, at: int) -> tuple[list, int]:
    order = "<" if wkb[at] == 1 else ">"
    n = struct.unpack_from(order + "I", wkb, at + 5)[0]
    at, rings = at + 9, []
    for _ in range(n):
        m = struct.unpack_from(order + "I", wkb, at)[0]
        flat = struct.unpack_from(f"{order}{2 * m}d", wkb, at + 4)
        rings.append([[flat[i], flat[i + 1]] for i in range(0, 2 * m, 2)])
        at += 4 + 16 * m
    return rings, at


def parse_geometry(blob: bytes | None) -> list:
    """Rings of a GeoPackage polygon or multipolygon; null or empty geometry has none."""
    if blob is None:
        return []
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    at = 8 + _ENVELOPES[blob[3] >> 1 & 7]
    order = "<" if blob[at] == 1 else ">"
    kind, n = struct.unpack_from(order + "II", blob, at + 1)
    if kind == 3:
        return _polygon(blob, at)[0]
    if kind != 6:
        raise ValueError(f"geometry type {kind} is not a polygon")
    at, rings = at + 9, []
    for _ in range(n):
        own, at = _polygon(blob, at)
        rings += own
    return rings


def make_geometry(rings: list, srid: int = 0) -> bytes:
    body = b"".join(struct.pack(f"<I{2 * len(r)}d", len(r), *[v for p in r for v in p]) for r in rings)
    return b"GP\x00\x01" + struct.pack("<i", srid) + b"\x01" + struct.pack("<II", 3, len(rings)) + body


@dataclass
class Ids(InputPartition):
    lo: int
    hi: int


class GpkgReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.layer = options["path"], options.get("layer", "tree_crowns")
        self.columns = [c for c in options.get("columns", "").split(",") if c]
        self.box = [float(v) for v in options["bbox"].split(",")] if "bbox" in options else None
        self.lo, self.hi = (int(options[k]) if k in options else None for k in ("lo", "hi"))
        self.step = int(options.get("featurespartition", options.get("featuresPerPartition", FEATURES_PER_PARTITION)))

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[Ids]:
        with self._open() as db:
            lo, hi = db.execute(f'select min(fid), max(fid) from "{self.layer}"').fetchone()
        if lo is None:
            return [Ids(0, -1)]
        lo, hi = max(lo, self.lo if self.lo is not None else lo), min(hi, self.hi if self.hi is not None else hi)
        return [Ids(s, min(s + self.step - 1, hi)) for s in range(lo, hi + 1, self.step)] or [Ids(0, -1)]

    def read(self, part: Ids) -> Iterator[tuple]:
        names = "".join(f', "{c}"' for c in self.columns)
        with self._open() as db:
            for fid, blob, *rest in db.execute(f'select fid, geom{names} from "{self.layer}" where fid between ? and ?', (part.lo, part.hi)):
                rings = parse_geometry(blob)
                xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
                box = (min(xs), min(ys), max(xs), max(ys)) if xs else (None,) * 4
                if self.box and (not xs or box[0] > self.box[2] or box[2] < self.box[0] or box[1] > self.box[3] or box[3] < self.box[1]):
                    continue
                yield (fid, *box, rings, *[None if v is None else str(v) for v in rest])


class GpkgSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        extra = "".join(f", `{c}` string" for c in self.options.get("columns", "").split(",") if c)
        return "fid long, x0 double, y0 double, x1 double, y1 double, rings array<array<array<double>>>" + extra

    def reader(self, schema) -> GpkgReader:
        return GpkgReader(dict(self.options))


def write_gpkg(df: DataFrame, path: str, layer: str = "tree_crowns", srid: int = 0) -> int:
    """Write ``df`` (``rings`` plus scalar columns) as one layer; returns the count.

    Rows stream to the driver a partition at a time, since the format is one file; large results belong in Parquet.
    """
    names = [c for c in df.columns if c != "rings"]
    with sqlite3.connect(path) as db:
        db.execute("pragma application_id = 1196444487")
        db.execute("create table if not exists gpkg_contents (table_name text primary key, data_type text, identifier text, srs_id integer)")
        db.execute("create table if not exists gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z integer, m integer)")
        db.execute(f'drop table if exists "{layer}"')
        db.execute(f'create table "{layer}" (fid integer primary key, geom blob' + "".join(f', "{c}"' for c in names) + ")")
        db.execute("insert or replace into gpkg_contents values (?, 'features', ?, ?)", (layer, layer, srid))
        db.execute("insert into gpkg_geometry_columns values (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", (layer, srid))
        n = 0
        for row in df.toLocalIterator():
            n += 1
            db.execute(f'insert into "{layer}" values (?, ?' + ", ?" * len(names) + ")", (n, make_geometry(row["rings"], srid), *[row[c] for c in names]))
    return n
