"""Boxes: stated cases and properties."""

import random

from pyspark.sql import functions as F

from quire.functions import geom as G
from quire.functions import kernels as K


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("v")).first()["v"]


def test_overlaps_are_symmetric_shares(spark):
    random.seed(3)
    rows = [tuple(float(random.randint(0, 9)) for _ in range(4)) + tuple(float(random.randint(0, 9)) for _ in range(4)) for _ in range(200)]
    rows = [(a, b, a + w + 1, b + h + 1, c, d, c + p + 1, d + q + 1) for a, b, w, h, c, d, p, q in rows]
    df = spark.createDataFrame(rows, "ax0 double, ay0 double, ax1 double, ay1 double, bx0 double, by0 double, bx1 double, by1 double")
    a, b = G.box("a"), G.box("b")
    for r in df.select(G.overlap_min(a, b).alias("x"), G.overlap_min(b, a).alias("y"), G.iou(a, b).alias("i"), G.overlap_self(a, b).alias("s")).collect():
        assert r["x"] == r["y"] and 0 <= r["i"] <= r["x"] <= 1 and 0 <= r["s"] <= r["x"]


def test_points_have_their_origin_at_the_top(spark):
    b = G.to_points(F.lit(0.0), F.lit(0.9), F.lit(0.1), F.lit(0.05), F.lit(600.0), F.lit(800.0))
    assert round(one(spark, b.y0), 6) == 40.0 and round(one(spark, b.y1), 6) == 80.0


def test_deskew_is_undone_by_the_opposite_turn(spark):
    b = G.Box(F.lit(100.0), F.lit(100.0), F.lit(200.0), F.lit(120.0))
    d = G.deskewed(b, F.lit(0.0), F.lit(600.0), F.lit(800.0))
    assert [round(one(spark, c), 6) for c in d] == [100.0, 100.0, 200.0, 120.0]


def lines(*pairs):
    return F.array(*[F.struct(F.lit(float(a)).alias("x0"), F.lit(float(b)).alias("x1")) for a, b in pairs])


def test_alignment(spark):
    assert one(spark, G.multi_align(lines((10, 90), (20, 80), (30, 70)), F.lit(10.0))) == "center"
    assert one(spark, G.multi_align(lines((10, 90), (10, 80), (10, 70)), F.lit(10.0))) == "left"
    assert one(spark, G.multi_align(lines((10, 90), (30, 90), (50, 90)), F.lit(10.0))) == "right"
    # One widened last line doesn't hide the axis.
    assert one(spark, G.multi_align(lines((10, 90), (20, 80), (30, 76)), F.lit(10.0))) == "center"
    assert one(spark, G.multi_align(lines((10, 30), (11.74, 28.26)), F.lit(6.0))) == "center"


def test_line_ratio(spark):
    none = F.lit(None).cast("double")
    assert one(spark, G.line_ratio(none, F.lit(10.0))) == 1.35
    assert one(spark, G.line_ratio(none, F.lit(20.0))) == 1.22
    assert one(spark, G.line_ratio(F.lit(40.0), F.lit(10.0))) == 1.8


def test_lines_needed_agree_with_the_kernel(spark):
    for text, w, s in (("hello world", 20.0, 10.0), ("中文字", 10.0, 10.0), ("", 10.0, 5.0), ("ab中cd", 25.0, 9.0)):
        assert one(spark, G.lines_needed(F.lit(text), F.lit(w), F.lit(s))) == K.needed_lines(text, w, s)


def test_fitting_size_is_the_largest():
    size = K.fitting_size("some text that wraps", 60.0, 30.0, 20.0, 30.0)
    fits = lambda s: K.needed_lines("some text that wraps", 60.0, s) * s * 1.18 <= 0.94 * 30 + 0.4
    assert fits(size) and not fits(size + 0.01)


def test_turned_boxes(spark):
    b = G.Box(F.lit(0.0), F.lit(0.0), F.lit(13.9), F.lit(18.1))
    assert one(spark, G.turns(b, F.lit("ab"))) and not one(spark, G.turns(b, F.lit("a")))
