"""Greedy folds in a fixed order: each row is kept or not by what was kept before it on its page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.geom import Box, overlap_min


def greedy(df: DataFrame, page: str, order: list[Column], fields: list[str], clash: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows of each page that clash with none accepted before them, in the given order; pages fold in parallel."""
    item = F.struct(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("k"), F.struct(*fields).alias("v"))
    sorted_rows = F.transform(F.array_sort(F.collect_list(item)), lambda s: s["v"])
    grouped = df.groupBy(page).agg(sorted_rows.alias("rows"))
    empty = F.filter(F.col("rows"), lambda r: F.lit(False))
    kept = F.aggregate("rows", empty, lambda acc, x: F.when(F.exists(acc, lambda a: clash(a, x)), acc).otherwise(F.array_append(acc, x)))
    return grouped.select(page, F.explode(kept).alias("row")).select(page, "row.*")


def _box(s: Column) -> Box:
    return Box(*[s[k] for k in ("x0", "y0", "x1", "y1")])


def dedup_overlaps(df: DataFrame, threshold: float = 0.55, more: tuple[str, ...] = ()) -> DataFrame:
    """Longest texts first; boxes that overlap an accepted one by more than threshold go."""
    return greedy(df, "page", [-F.length("text"), F.col("ln")], ["ln", "text", "x0", "y0", "x1", "y1", *more], lambda a, x: overlap_min(_box(a), _box(x)) > threshold)


def dedup_contained(df: DataFrame) -> DataFrame:
    """In reading order, longer ones first at one place; texts that stand within an accepted one go."""
    return greedy(df, "page", [F.col("y0"), F.col("x0"), -F.length("text"), F.col("ln")], ["ln", "text", "x0", "y0"], lambda a, x: F.contains(a["text"], x["text"]))


def merge_variants(variants: Column) -> Column:
    """Longest first, each variant joins the first kept one that contains it; gives the kept ones."""
    ordered = F.transform(F.array_sort(F.transform(variants, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))), lambda s: s["v"])
    empty = F.filter(ordered, lambda v: F.lit(False))
    return F.aggregate(ordered, empty, lambda acc, x: F.when(F.exists(acc, lambda a: F.contains(a, x)), acc).otherwise(F.array_append(acc, x)))
