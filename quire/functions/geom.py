"""Box functions as columns. A box is four double columns x0, y0, x1, y1 in points, from the top left."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x0: Column
    y0: Column
    x1: Column
    y1: Column


def box(prefix: str = "") -> Box:
    return Box(*[F.col(f"{prefix}{k}") for k in ("x0", "y0", "x1", "y1")])


def area(b: Box) -> Column:
    return F.abs((b.x1 - b.x0) * (b.y1 - b.y0))


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
    h = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def overlap_min(a: Box, b: Box) -> Column:
    return intersection(a, b) / F.greatest(F.least(area(a), area(b)), F.lit(1e-6))


def overlap_self(a: Box, b: Box) -> Column:
    """Share of a that b covers."""
    return intersection(a, b) / F.greatest(area(a), F.lit(1.0))


def iou(a: Box, b: Box) -> Column:
    i = intersection(a, b)
    union = area(a) + area(b) - i
    return F.when(union > 0, i / union).otherwise(F.lit(0.0))


def v_overlap(a: Box, b: Box) -> Column:
    shared = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return shared > 0.6 * F.least(a.y1 - a.y0, b.y1 - b.y0)


def x_overlap_ratio(a: Box, b: Box) -> Column:
    shared = F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0))
    return shared / F.greatest(F.least(a.x1 - a.x0, b.x1 - b.x0), F.lit(1e-6))


def vgap(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), b.y0 - a.y1, a.y0 - b.y1)


def to_points(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    """From shares of the page with the origin at the bottom left."""
    return Box(x * width, (1 - y - h) * height, (x + w) * width, (1 - y) * height)


def turned_back(b: Box) -> Box:
    """From a page turned by 90 degrees, all in shares."""
    return Box(b.y0, 1 - b.x1, b.y1, 1 - b.x0)


def deskewed(b: Box, degrees: Column, width: Column, height: Column) -> Box:
    """Bounding box of the corners turned back about the page's centre, within the page."""
    cos, sin, cx, cy = F.cos(F.radians(degrees)), F.sin(F.radians(degrees)), width / 2, height / 2
    xs, ys = [], []
    for x, y in ((b.x0, b.y0), (b.x1, b.y0), (b.x0, b.y1), (b.x1, b.y1)):
        xs.append((x - cx) * cos - (y - cy) * sin + cx)
        ys.append((x - cx) * sin + (y - cy) * cos + cy)
    low, high = lambda c: F.greatest(F.lit(0.0), F.least(*c)), lambda c, most: F.least(most, F.greatest(*c))
    return Box(low(xs), low(ys), high(xs, width), high(ys, height))


def padded(b: Box, pad: Column, width: Column, height: Column) -> Box:
    return Box(F.greatest(F.lit(0.0), b.x0 - pad), F.greatest(F.lit(0.0), b.y0 - pad), F.least(width, b.x1 + pad), F.least(height, b.y1 + pad))


def adaptive_pad(b: Box) -> Column:
    return F.greatest(F.lit(2.0), 0.18 * F.greatest(b.x1 - b.x0, b.y1 - b.y0))


def robust_range(values: Column) -> Column:
    """Range of an array; from three values on, one extreme value may be left out."""
    s = F.sort_array(values)
    n = F.size(s)
    at = lambda i: F.get(s, i)
    whole = at(n - 1) - at(F.lit(0))
    return F.when(n >= 3, F.least(whole, at(n - 2) - at(F.lit(0)), at(n - 1) - at(F.lit(1)))).otherwise(whole)


def multi_align(lines: Column, size: Column) -> Column:
    """left, right or center of a unit of several lines (array<struct<x0,x1>>): the axis along which they agree."""
    tol = F.greatest(F.lit(1.5), 0.15 * size)
    spans = {
        "left": robust_range(F.transform(lines, lambda x: x["x0"])),
        "right": robust_range(F.transform(lines, lambda x: x["x1"])),
        "center": robust_range(F.transform(lines, lambda x: (x["x0"] + x["x1"]) / 2)),
    }
    ranked = F.array_sort(F.array(*[F.struct(s.alias("span"), F.lit(i).alias("i"), F.lit(k).alias("kind")) for i, (k, s) in enumerate(spans.items())]))
    best, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    clear = (best["span"] <= tol) & ((second["span"] <= 0) | (best["span"] <= 0.6 * second["span"]))
    return F.when(spans["left"] <= tol, "left").when(clear, best["kind"]).otherwise("left")


def axis_of(lines: Column, kind: Column) -> Column:
    centers = F.sort_array(F.transform(lines, lambda x: (x["x0"] + x["x1"]) / 2))
    middle = F.get(centers, F.floor(F.size(centers) / 2).cast("int"))
    return F.when(kind == "left", F.array_min(F.transform(lines, lambda x: x["x0"]))).when(kind == "right", F.array_max(F.transform(lines, lambda x: x["x1"]))).otherwise(middle)


def line_ratio(lineheight: Column, size: Column) -> Column:
    """Line height by size, from 1 to 1.8; where unknown 1.35 for text and 1.22 for titles."""
    known = F.when(lineheight.isNotNull(), F.least(F.lit(1.8), F.greatest(F.lit(1.0), lineheight / size)))
    return F.coalesce(known, F.when(size <= 14, 1.35).otherwise(1.22))


def baseline(size: Column, ratio: Column, measured: Column) -> Column:
    return F.coalesce(measured, size * (0.3 + 0.5 * ratio))


def lines_needed(text: Column, width: Column, size: Column) -> Column:
    """Lines that a text takes when set sign by sign in a width."""

    def add(acc: Column, ch: Column) -> Column:
        w = F.when(ch >= "⺀", size).otherwise(0.56 * size)
        full = (acc["used"] > 0) & (acc["used"] + w > width)
        return F.struct((acc["lines"] + F.when(full, 1).otherwise(0)).alias("lines"), F.when(full, w).otherwise(acc["used"] + w).alias("used"))

    start = F.struct(F.lit(1).alias("lines"), F.lit(0.0).alias("used"))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, add)["lines"]


def micro_size(h: Column) -> Column:
    return F.bround(F.least(F.lit(4.6), F.greatest(F.lit(3.6), 1.6 * h)), 2)


def size_hint(b: Box, n: Column, vertical: Column) -> Column:
    w, h = b.x1 - b.x0, b.y1 - b.y0
    hint = 0.78 * h
    return F.when(vertical, F.least(hint, w * 1.15, h / n * 1.35)).otherwise(F.least(hint, w / n * 1.25))


def is_vertical(b: Box) -> Column:
    w, h = b.x1 - b.x0, b.y1 - b.y0
    return (w < 34) & (h > 18) & (h > 1.4 * w)


def turns(b: Box, text: Column) -> Column:
    """Set upright: narrow and high boxes of two signs and more."""
    return (b.x1 - b.x0 < 14) & (b.y1 - b.y0 > 18) & (F.length(text) >= 2)
