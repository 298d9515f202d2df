"""What goes where on the rebuilt page: text boxes, titles that stand in images, layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import geom as G
from quire.functions import text as T
from quire.operators.layout import room_below
from quire.operators.spatial import box_join, prefixed

#: Below this scale a unit counts as shrunk; the engine never scales below the second.
SHRUNK, LEAST_SCALE = 0.985, 0.7


def rebuilt_boxes(units: DataFrame, translations: DataFrame, measured: DataFrame, pages: DataFrame) -> DataFrame:
    """Box, size, room and scale of every translated unit.

    units: page, ln, x0, y0, x1, y1, baseline, size, lineheight, nlines, text, font, passthrough; translations: page, ln,
    zh; measured: size, ratio, k; pages: page, height. The box moves so that its first baseline stays, grows down to the
    next obstacle by at most three lines, and a single line gets the rest of its line height where that is no more than
    0.3 em. Spare room and scale are estimates by the width of the text.
    """
    size, ratio = F.col("size"), F.bround(G.line_ratio(F.col("lineheight"), F.col("size")), 4)
    rows = units.where(~F.coalesce("passthrough", F.lit(False))).withColumn("ratio", ratio)
    known = measured.select(F.col("size").alias("m_size"), F.col("ratio").alias("m_ratio"), "k")
    rows = rows.join(known, (size == F.col("m_size")) & (F.col("ratio") == F.col("m_ratio")), "left").drop("m_size", "m_ratio")
    rows = rows.withColumn("delta", F.col("baseline") - G.baseline(size, F.col("ratio"), F.col("k")) - F.col("y0"))
    room = room_below(units.select("page", "ln", "x0", "y0", "x1", "y1", (3 * ratio * size).alias("extra")))
    rows = rows.join(room, ["page", "ln"]).join(translations.where("zh <> ''"), ["page", "ln"]).join(pages.select("page", "height"), "page")
    end = F.least(F.col("bottom") + F.col("delta"), F.col("height") - 2)
    rows = rows.withColumns({"top": F.col("y0") + F.col("delta"), "end": end})
    need = F.col("ratio") * size
    deficit = need - (F.col("end") - F.col("top"))
    fill = (F.col("nlines") == 1) & (deficit > 0) & (deficit <= 0.3 * size)
    rows = rows.withColumns({"filled": fill, "end": F.when(fill, F.least(F.col("top") + need, F.col("height") - 2)).otherwise(F.col("end"))})
    lines = F.ceil(T.width_em(F.col("zh")) * size / F.greatest(F.col("x1") - F.col("x0"), F.lit(1.0)))
    tall, high = lines * need, F.col("end") - F.col("top")
    scale = F.greatest(F.lit(LEAST_SCALE), F.least(F.lit(1.0), F.greatest(high, F.lit(0.0)) / F.greatest(tall, F.lit(1e-6))))
    return rows.select("page", "ln", "font", "size", F.bround("top", 4).alias("y0"), F.bround("end", 4).alias("y1"), "filled", F.bround(high - tall * scale, 1).alias("spare"), F.bround(scale, 3).alias("scale"), F.length("text").alias("src_len"), F.length("zh").alias("zh_len"))


def untranslated(units: DataFrame, translations: DataFrame) -> DataFrame:
    """Units that keep their text for want of a translation."""
    rows = units.where(~F.coalesce("passthrough", F.lit(False)))
    return rows.join(translations.where("zh <> ''"), ["page", "ln"], "left_anti").select("page", "ln", F.substring("text", 1, 60).alias("text"))


def rebuild_report(boxes: DataFrame, missing: DataFrame, known_fonts: list[str]) -> DataFrame:
    """One row: units set, shrunk ones, ones without room, untranslated ones, fonts whose weight is a guess, and the gate."""
    one = boxes.agg(F.count(F.lit(1)).alias("n_set"), F.count_if(F.col("scale") < SHRUNK).alias("n_shrunk"), F.count_if(F.col("spare") < 0).alias("n_dropped"))
    fonts = boxes.where(~F.col("font").isin(*known_fonts)).agg(F.array_join(F.array_sort(F.collect_set("font")), " ").alias("unknown_fonts"))
    both = one.crossJoin(missing.agg(F.count(F.lit(1)).alias("n_missing"))).crossJoin(fonts)
    return both.withColumn("passed", F.col("n_dropped") == 0)


def most_shrunk(boxes: DataFrame, k: int = 20) -> DataFrame:
    return boxes.where(F.col("scale") < SHRUNK).orderBy("scale", "page", "ln").limit(k).select("page", "ln", "scale", "size", "src_len", "zh_len")


def alpha_mean(mask):
    """Mean opacity of an array of mask values, 1 where there is no mask."""
    total = F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(mask.isNull() | (F.size(mask) == 0), 1.0).otherwise(total / F.size(mask) / 255)


def title_bitmaps(images: DataFrame, titles: DataFrame, most_alpha: float = 0.35) -> DataFrame:
    """Images that show a title: for each the title that it covers best, and whether it may go.

    images: page, ln, xref, x0, y0, x1, y1, mask (array of alpha values or null); titles: page, ln, x0, y0, x1, y1. The
    page's largest image is its background; images of half its area and more, and copies of it, are none. Inline images
    (xref 0) and opaque panels stay.
    """
    area = G.area(G.box())
    back = images.groupBy("page").agg(F.max_by(F.struct("xref", "x0", "y0", "x1", "y1"), F.struct(area.alias("a"), (-F.col("ln")).alias("t"))).alias("bg"))
    rows = images.withColumn("alpha", alpha_mean(F.col("mask"))).drop("mask").join(back, "page")
    bg = G.Box(*[F.col(f"bg.{c}") for c in ("x0", "y0", "x1", "y1")])
    same = (F.col("xref") == F.col("bg.xref")) | ((F.col("x0") == bg.x0) & (F.col("y0") == bg.y0) & (F.col("x1") == bg.x1) & (F.col("y1") == bg.y1))
    rows = rows.where(~same & (area < 0.5 * G.area(bg))).drop("bg")
    w = F.least("l_x1", "r_x1") - F.greatest("l_x0", "r_x0")
    h = F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0")
    l_high, r_high = F.col("l_y1") - F.col("l_y0"), F.col("r_y1") - F.col("r_y0")
    down, across = h / F.greatest(F.least(l_high, r_high), F.lit(1e-6)), w / F.greatest(F.col("r_x1") - F.col("r_x0"), F.lit(1e-6))
    tall = l_high / F.greatest(r_high, F.lit(1e-6))
    theta = (w > 0) & (h > 0) & (down > 0.7) & (across > 0.5) & (tall >= 0.5) & (tall <= 2.5)
    met = box_join(prefixed(rows, "l_"), prefixed(titles.select("page", "ln", "x0", "y0", "x1", "y1"), "r_"), theta)
    best = met.groupBy(F.col("l_page").alias("page"), F.col("l_ln").alias("ln"), F.col("l_xref").alias("xref"), F.col("l_alpha").alias("alpha")).agg(F.max(F.struct(F.bround(down * across, 9).alias("score"), (-F.col("r_ln")).alias("t"))).alias("m"))
    why = F.when(F.col("xref") == 0, "inline image").when(F.col("alpha") > most_alpha, "panel").otherwise("")
    return best.select("page", "ln", (-F.col("m.t")).alias("title"), F.bround("m.score", 6).alias("score"), F.bround("alpha", 3).alias("alpha"), why.alias("why"), (why == "").alias("ok"))


def found_layers(layers: DataFrame, wanted: DataFrame, tol: float = 1.5) -> DataFrame:
    """For each wanted (page, name, w, h, x0, y0, x1, y1) the first layer (page, ln, w, h, x0, ...) of its pixels and place."""
    rows = layers.select("page", "w", "h", "ln", *[F.col(c).alias(f"l_{c}") for c in ("x0", "y0", "x1", "y1")])
    near = [F.abs(F.col(c) - F.col(f"l_{c}")) <= tol for c in ("x0", "y0", "x1", "y1")]
    met = wanted.join(rows, ["page", "w", "h"]).where(near[0] & near[1] & near[2] & near[3])
    return met.groupBy("page", "name").agg(F.min("ln").alias("layer"))


def shadows(layers: DataFrame, titles: DataFrame) -> DataFrame:
    """For each title layer (page, ln, xref, x0, ...) the other masked layer that covers most of it, if any does."""
    met = box_join(prefixed(titles, "l_"), prefixed(layers.where("masked").select("page", "ln", "xref", "x0", "y0", "x1", "y1"), "r_"), (F.col("l_xref") != F.col("r_xref")) & (G.intersection(G.box("l_"), G.box("r_")) > 0))
    share = F.bround(G.intersection(G.box("l_"), G.box("r_")) / F.greatest(G.area(G.box("l_")), F.lit(1e-6)), 9)
    best = met.groupBy(F.col("l_page").alias("page"), F.col("l_ln").alias("ln")).agg(F.max(F.struct(share.alias("share"), (-F.col("r_ln")).alias("t"))).alias("m"))
    return best.select("page", "ln", (-F.col("m.t")).alias("shadow"), F.bround("m.share", 6).alias("share"))
