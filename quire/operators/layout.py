"""Paragraph units from lines, their alignment, and the room around boxes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import geom as G
from quire.functions import text as T
from quire.operators.spatial import box_join, prefixed
from quire.plans.groups import map_groups

UNITS = "doc long, page long, unit int, x0 double, y0 double, x1 double, y1 double, text string, font string, size double, align string, lineheight double, nlines int, lines array<struct<x0: double, y0: double, x1: double, y1: double>>, passthrough boolean"
_PAGE_NUMBER = re.compile(T.PAGE_NUMBER)
ALIGNED = "doc long, page long, unit int, align string, why string"


def _joins(group: dict, line: dict) -> float | None:
    """Distance at which a line continues a group, or None."""
    last = group["lines"][-1]
    if line["font"] != last["font"] or abs(line["size"] - last["size"]) >= 0.15 or line["color"] != last["color"]:
        return None
    width = min(line["x1"] - line["x0"], last["x1"] - last["x0"])
    if max(0.0, min(line["x1"], last["x1"]) - max(line["x0"], last["x0"])) / max(width, 1e-6) <= 0.3:
        return None
    height = min(line["y1"] - line["y0"], last["y1"] - last["y0"])
    if min(line["y1"], last["y1"]) - max(line["y0"], last["y0"]) > 0.6 * height:
        return None
    h = last["y1"] - last["y0"]
    gap = line["y0"] - last["y1"]
    return abs(gap) if -0.35 * h <= gap <= max(0.55 * h, 5) else None


def _spread(values: list[float]) -> float:
    return max(values) - min(values)


def _rough(lines: list[dict]) -> str:
    if len(lines) == 1:
        return "left"
    for name, key in (("left", lambda x: x["x0"]), ("right", lambda x: x["x1"]), ("center", lambda x: (x["x0"] + x["x1"]) / 2)):
        if _spread([key(x) for x in lines]) < 1.5:
            return name
    return "left"


def _text(lines: list[dict]) -> str:
    out = ""
    for x in lines:
        part = " ".join(x["text"].split())
        out = out[:-1] + part if out.endswith("-") else f"{out} {part}".strip()
    return out


def page_units(lines: list[dict]) -> list[tuple]:
    """Units of one page: every line joins the open group that it continues at the smallest distance."""
    lines = sorted(lines, key=lambda x: (round(x["y0"], 1), x["x0"], x["ln"]))
    groups: list[dict] = []
    for line in lines:
        near = [(d, i) for i, g in enumerate(groups) if (d := _joins(g, line)) is not None]
        if near:
            groups[min(near)[1]]["lines"].append(line)
        else:
            groups.append({"lines": [line]})
    groups.sort(key=lambda g: (round(min(x["y0"] for x in g["lines"]), 1), min(x["x0"] for x in g["lines"])))
    rows = []
    for i, g in enumerate(groups):
        x = g["lines"]
        longest = max(x, key=lambda k: len(k["text"]))
        height = (x[-1]["y0"] - x[0]["y0"]) / (len(x) - 1) if len(x) > 1 else None
        rows.append((x[0]["doc"], x[0]["page"], i, min(k["x0"] for k in x), min(k["y0"] for k in x), max(k["x1"] for k in x), max(k["y1"] for k in x), _text(x), longest["font"], longest["size"], _rough(x), height, len(x), [{c: k[c] for c in ("x0", "y0", "x1", "y1")} for k in x], not re.search("[A-Za-z]", _text(x))))
    return rows


def units(lines: DataFrame) -> DataFrame:
    """lines: doc, page, ln, x0, y0, x1, y1, text, font, size, color. A task holds one page at a time.

    Units without a letter are passed through untranslated.
    """
    return map_groups(lines, ["doc", "page"], ["ln"], page_units, UNITS)


def _range(values: list[float]) -> float:
    """Range of which one end may be left out where there are three values and more."""
    v = sorted(values)
    return min(v[-1] - v[0], v[-1] - v[1], v[-2] - v[0]) if len(v) >= 3 else v[-1] - v[0]


def _axes(lines: list[dict]) -> dict[str, list[float]]:
    return {"left": [x["x0"] for x in lines], "right": [x["x1"] for x in lines], "center": [(x["x0"] + x["x1"]) / 2 for x in lines]}


def lines_align(lines: list[dict], size: float) -> str:
    """Alignment of a unit of several lines: left where it holds, else the axis that is clearly the tightest."""
    tol, spans = max(1.5, 0.15 * size), {k: _range(v) for k, v in _axes(lines).items()}
    if spans["left"] <= tol:
        return "left"
    (best, span), (_, second) = sorted(spans.items(), key=lambda x: x[1])[:2]
    return best if span <= tol and (second <= 0 or span <= 0.6 * second) else "left"


def _axis(lines: list[dict], kind: str) -> float:
    values = _axes(lines)[kind]
    return min(values) if kind == "left" else max(values) if kind == "right" else sorted(values)[len(values) // 2]


def page_align(rows: list[dict]) -> list[tuple]:
    """Alignment of a page's units; single lines go by anchors, their row, earlier units of the row, and the page's width."""
    multi = [r for r in rows if r["nlines"] > 1]
    width = rows[0]["width"]
    decided: dict[int, tuple[str, str]] = {r["unit"]: (lines_align(r["lines"], r["size"]), "multi") for r in multi}
    axes = {r["unit"]: _axis(r["lines"], decided[r["unit"]][0]) for r in multi}
    for r in rows:
        if r["nlines"] > 1:
            continue
        if _PAGE_NUMBER.match(r["text"]):
            decided[r["unit"]] = (r["align"], "number")
            continue
        tol = max(2.0, 0.15 * r["size"])
        own = {"left": r["x0"], "right": r["x1"], "center": (r["x0"] + r["x1"]) / 2}
        center = own["center"]
        share = lambda m, r=r: max(0.0, min(r["x1"], m["x1"]) - max(r["x0"], m["x0"])) / max(min(r["x1"] - r["x0"], m["x1"] - m["x0"]), 1e-6)
        near = sorted((m for m in multi if share(m) >= 0.5), key=lambda m, r=r: (max(0.0, m["y0"] - r["y1"], r["y0"] - m["y1"]), m["unit"]))
        found = next((decided[m["unit"]][0] for m in near if abs(own[decided[m["unit"]][0]] - axes[m["unit"]]) <= tol), None)
        if found:
            decided[r["unit"]] = (found, "anchor")
            continue
        row = [s for s in rows if s["unit"] != r["unit"] and min(s["y1"], r["y1"]) > max(s["y0"], r["y0"])]
        left = max((s["x1"] for s in row if s["x1"] <= r["x0"] + 1), default=None)
        right = min((s["x0"] for s in row if s["x0"] >= r["x1"] - 1), default=None)
        if left is not None and right is not None and right > left and abs(center - (left + right) / 2) <= tol:
            decided[r["unit"]] = ("center", "row-mid")
        elif any(abs(s["size"] - r["size"]) < 0.5 and decided.get(s["unit"], (s["align"],))[0] == "center" for s in row):
            decided[r["unit"]] = ("center", "row-inherit")
        elif not multi and width and r["x0"] > tol and abs(center - width / 2) <= tol:
            decided[r["unit"]] = ("center", "page")
        elif not multi and width and r["x1"] >= width - 12:
            decided[r["unit"]] = ("right", "page")
        else:
            decided[r["unit"]] = ("left", "default")
    return [(r["doc"], r["page"], r["unit"], *decided[r["unit"]]) for r in rows]


def aligned(units: DataFrame, pages: DataFrame) -> DataFrame:
    """Alignment of units(); pages: (page, width). Units of pages without a width get no alignment from the page."""
    return map_groups(units.join(pages.select("page", "width"), "page", "left"), ["doc", "page"], ["unit"], page_align, ALIGNED)


def multi_aligned(lines: DataFrame, size: Column) -> DataFrame:
    """Alignment of paragraphs (page, para) of several lines from the axes along which their lines agree."""
    per = lines.groupBy("page", "para").agg(F.collect_list(F.struct("x0", "x1")).alias("lines"), F.max(size).alias("size"))
    per = per.where(F.size("lines") > 1)
    return per.select("page", "para", F.size("lines").alias("n_lines"), G.multi_align(F.col("lines"), F.col("size")).alias("align"))


def room_below(boxes: DataFrame, slack: float = 2.0) -> DataFrame:
    """Lowest line that a box may grow to: the nearest box below that reaches more than `slack` into its width, at most
    `extra` below its end (a column; without it three times the box's height)."""
    if "extra" not in boxes.columns:
        boxes = boxes.withColumn("extra", 3 * (F.col("y1") - F.col("y0")))
    reach = F.col("l_y1") + F.col("l_extra") + 1.5
    theta = (
        (F.col("l_page") == F.col("r_page"))
        & (F.col("l_ln") != F.col("r_ln"))
        & (F.col("r_x1") > F.col("l_x0") + slack)
        & (F.col("r_x0") < F.col("l_x1") - slack)
        & (F.col("r_y0") >= F.col("l_y1") - 1)
        & (F.col("r_y0") <= reach)
    )
    # Only boxes within reach matter, so a page's boxes meet by bands and not all with all.
    band = lambda c: F.floor(c / 60.0)
    left = prefixed(boxes, "l_").withColumn("band", F.explode(F.sequence(band(F.col("l_y1") - 1), F.greatest(band(F.col("l_y1") - 1), band(reach)))))
    right = prefixed(boxes.drop("extra"), "r_").withColumn("band", band(F.col("r_y0")))
    met = left.join(right, (left["band"] == right["band"]) & theta).groupBy("l_page", "l_ln").agg(F.min(F.col("r_y0") - 1.5).alias("limit"))
    own = boxes.select("page", "ln", (F.col("y1") + F.col("extra")).alias("most"))
    out = own.join(met, (F.col("page") == F.col("l_page")) & (F.col("ln") == F.col("l_ln")), "left")
    return out.select("page", "ln", F.bround(F.least("most", F.coalesce("limit", "most")), 4).alias("bottom"))


def row_neighbours(boxes: DataFrame) -> DataFrame:
    """Nearest right edge to the left and left edge to the right of a box among boxes of its row."""
    theta = (F.col("l_ln") != F.col("r_ln")) & (F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0") > 0)
    met = box_join(prefixed(boxes, "l_"), prefixed(boxes, "r_"), theta)
    per = met.groupBy("l_page", "l_ln").agg(F.max(F.when(F.col("r_x1") <= F.col("l_x0") + 1, F.col("r_x1"))).alias("left"), F.min(F.when(F.col("r_x0") >= F.col("l_x1") - 1, F.col("r_x0"))).alias("right"))
    return per.select(F.col("l_page").alias("page"), F.col("l_ln").alias("ln"), "left", "right")


def baselines(combos: DataFrame, measured: DataFrame) -> DataFrame:
    """Baseline of each distinct (size, ratio): measured where known, else by formula."""
    rows = combos.select("size", F.bround("ratio", 4).alias("ratio")).distinct()
    found = rows.join(measured, ["size", "ratio"], "left")
    return found.select("size", "ratio", F.bround(G.baseline(F.col("size"), F.col("ratio"), F.col("k")), 6).alias("k"))


def nearest_sharing(boxes: DataFrame, share: float = 0.5, cell: float = 60.0) -> DataFrame:
    """For each box the vertical distance to the nearest other box of its page that shares so much of the narrower width.

    Boxes meet in columns of the page, and each pair in the first column that both touch.
    """
    column = lambda c: F.floor(F.col(c) / cell)
    spread = lambda df, p: df.withColumn(f"{p}cell", F.explode(F.sequence(column(f"{p}x0"), F.greatest(column(f"{p}x0"), column(f"{p}x1")))))
    left, right = spread(prefixed(boxes, "l_"), "l_"), spread(prefixed(boxes, "r_"), "r_")
    first = F.col("l_cell") == F.greatest(column("l_x0"), column("r_x0"))
    met = left.join(right, (F.col("l_page") == F.col("r_page")) & (F.col("l_cell") == F.col("r_cell")) & first & (F.col("l_ln") != F.col("r_ln")))
    met = met.where(G.x_overlap_ratio(G.box("l_"), G.box("r_")) >= share)
    return met.groupBy(F.col("l_page").alias("page"), F.col("l_ln").alias("ln")).agg(F.min(G.vgap(G.box("l_"), G.box("r_"))).cast("double").alias("gap"))
