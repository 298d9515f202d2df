"""Joins on a page: of boxes, by cells of a grid, and of texts within each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.geom import Box

CELL = 60.0


def _cells(df: DataFrame, name: str, prefix: str, cell: float) -> DataFrame:
    """Every row once for each row of cells that its box touches."""
    low, high = (F.floor(F.col(f"{prefix}{y}") / cell) for y in ("y0", "y1"))
    return df.withColumn(name, F.explode(F.sequence(low, F.greatest(low, high))))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def box_join(left: DataFrame, right: DataFrame, theta: Column, how: str = "inner", cell: float = CELL) -> DataFrame:
    """Join l_* and r_* rows of one page whose boxes meet and for which theta holds; inner, left_semi or left_anti.

    Boxes meet only if they share a band of the page; a pair is taken in the first band that both touch, so none comes
    twice. Bands spread a crowded page over many tasks.
    """
    l_low, r_low = F.floor(F.col("l_y0") / cell), F.floor(F.col("r_y0") / cell)
    first = F.col("l_band") == F.greatest(l_low, r_low)
    on = (F.col("l_page") == F.col("r_page")) & (F.col("l_band") == F.col("r_band")) & first & theta
    banded_right = _cells(right, "r_band", "r_", cell)
    if how == "inner":
        return _cells(left, "l_band", "l_", cell).join(banded_right, on).drop("l_band", "r_band")
    hit = _cells(left, "l_band", "l_", cell).join(banded_right, on, "left_semi").select("l_page", "l_ln").distinct()
    return left.join(hit, ["l_page", "l_ln"], how)


def left_box() -> Box:
    return Box(*[F.col(f"l_{k}") for k in ("x0", "y0", "x1", "y1")])


def right_box() -> Box:
    return Box(*[F.col(f"r_{k}") for k in ("x0", "y0", "x1", "y1")])


def _key_grams(c: Column) -> Column:
    """All runs of three characters, each once."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - 2)), lambda i: F.substring(c, i, F.lit(3))))


def contained(asked: DataFrame, seen: DataFrame) -> DataFrame:
    """(page, norm) rows of which some norm of the page's `seen` contains, equals or is contained in theirs.

    They meet by the first three characters of the shorter one among all runs of three of the longer.
    """
    parts = []
    for short, long, keep in ((asked, seen, "l_norm"), (seen, asked, "r_norm")):
        heads = short.select(F.col("page").alias("l_page"), F.col("norm").alias("l_norm"), F.substring("norm", 1, 3).alias("g"))
        grams = long.select(F.col("page").alias("r_page"), F.col("norm").alias("r_norm"), F.explode(_key_grams(F.col("norm"))).alias("g"))
        met = heads.join(grams, (F.col("l_page") == F.col("r_page")) & (heads["g"] == grams["g"]) & F.contains("r_norm", "l_norm"))
        parts.append(met.select(F.col("l_page").alias("page"), F.col(keep).alias("norm")))
    return parts[0].unionByName(parts[1]).distinct()
