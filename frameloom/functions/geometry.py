"""Boxes and crops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import let


def parse_box(line: Column, strict: bool = True) -> Column:
    """struct(x, y, w, h) of a line of 4 numbers (a box) or 8 (a polygon, of which the box around it is taken).

    Numbers are parted by commas, spaces or tabs. Lines of another length, and boxes that aren't finite or have no extent, are an error if
    strict, else null.
    """

    def box(v: Column) -> Column:
        xs, ys = F.filter(v, lambda _, i: i % 2 == 0), F.filter(v, lambda _, i: i % 2 == 1)
        x, y = F.array_min(xs), F.array_min(ys)
        four = F.struct(*[F.get(v, i).alias(k) for i, k in enumerate("xywh")])
        eight = F.struct(x.alias("x"), y.alias("y"), (F.array_max(xs) - x).alias("w"), (F.array_max(ys) - y).alias("h"))
        made = F.when(F.size(v) == 4, four).when(F.size(v) == 8, eight)
        whole = F.forall(v, lambda p: p.isNotNull() & ~F.isnan(p) & (F.abs(p) < F.lit(float("inf"))))
        return F.when(whole, let(made, lambda m: F.when((m["w"] > 0) & (m["h"] > 0), m)))

    parts = F.filter(F.split(F.trim(line), r"[,\s]+"), lambda p: p != "")
    found = let(F.transform(parts, lambda p: p.try_cast("double")), box)
    if not strict:
        return found
    return F.coalesce(found, F.when(line.isNotNull(), F.raise_error(F.concat(F.lit("no box: "), line)).cast("struct<x:double,y:double,w:double,h:double>")))


def crop_side(width: Column, height: Column, w: Column, h: Column, scale: float | Column) -> Column:
    return F.greatest(F.lit(2.0), F.least(F.greatest(w, h) * F.lit(scale).cast("double"), width.cast("double"), height.cast("double")))


def square_crop(width: Column, height: Column, x: Column, y: Column, w: Column, h: Column, scale: float | Column = 2.0) -> Column:
    """struct(left, top, right, bottom) in whole pixels: a square around the box, scale times its larger side, moved into the image.

    The square is at least 2 pixels and at most as large as the image's smaller side; corners are rounded outwards and kept inside.
    """
    side = crop_side(width, height, w, h, scale)
    left = F.greatest(F.lit(0.0), F.least(x + w / 2 - side / 2, width - side))
    top = F.greatest(F.lit(0.0), F.least(y + h / 2 - side / 2, height - side))
    return F.struct(
        F.greatest(F.lit(0), F.floor(left)).cast("int").alias("left"),
        F.greatest(F.lit(0), F.floor(top)).cast("int").alias("top"),
        F.least(width, F.ceil(left + side)).cast("int").alias("right"),
        F.least(height, F.ceil(top + side)).cast("int").alias("bottom"),
    )
