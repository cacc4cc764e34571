"""Formatting and naming helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_int(n: Column) -> Column:
    """Thousands apart by a space."""
    return F.translate(F.format_number(n, 0), ",", " ")


def format_duration(seconds: Column) -> Column:
    """``1h23m``, ``12m04s``, ``45s``; a dash for null or negative."""
    s = F.floor(seconds).cast("long")
    h, m = F.expr("0"), F.expr("0")
    h, m = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long")
    out = F.when(h > 0, F.format_string("%dh%02dm", h, m)).when(m > 0, F.format_string("%dm%02ds", m, s % 60)).otherwise(F.format_string("%ds", s))
    return F.when(seconds.isNull() | F.isnan(seconds.cast("double")) | (seconds < 0), F.lit("—")).otherwise(out)


def format_bytes(n: Column) -> Column:
    out = F.format_string("%.1f GB", n / 1024.0**3)
    for unit, name in ((1024**2, "MB"), (1024, "KB")):
        out = F.when(n < unit * 1024, F.format_string(f"%.1f {name}", n / float(unit))).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n)).otherwise(out)


def stem(path: Column) -> Column:
    """File name without folders and its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def tile_stem(source: Column, x: Column, y: Column) -> Column:
    return F.concat_ws("_", source, x.cast("string"), y.cast("string"))
