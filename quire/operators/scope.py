"""Scope of image text: what the text layer holds already, classes, summaries and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.config import DEFAULT, Config
from quire.functions import text as T
from quire.functions.geom import area, overlap_self
from quire.operators.spatial import box_join, left_box, prefixed, right_box

# Borders of the height bands.
BANDS = (0, 4, 5, 6, 8, 12, 20, 1000)


def outside_text_layer(found: DataFrame, text_layer: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Blocks of area 1 and more that no text block of their page covers by more than the threshold."""
    left, right = prefixed(found, "l_"), prefixed(text_layer.select("page", "x0", "y0", "x1", "y1"), "r_")
    left = left.where(area(left_box()) >= 1)
    kept = box_join(left, right, overlap_self(left_box(), right_box()) > cfg.text_layer_overlap, "left_anti")
    return kept.select(*[F.col(f"l_{c}").alias(c) for c in found.columns])


def classified(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("cls", T.classify(F.col("text")))


def scope_summary(blocks: DataFrame) -> DataFrame:
    """By class: blocks, characters, distinct texts and their characters, pages."""
    per_text = classified(blocks).groupBy("cls", "text").agg(F.count(F.lit(1)).alias("n"))
    by_class = per_text.groupBy("cls").agg(F.sum("n").alias("n_blocks"), F.sum(F.col("n") * F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("text")).alias("n_text_chars"))
    pages = classified(blocks).groupBy("cls").agg(F.countDistinct("page").alias("n_pages"))
    return by_class.join(pages, "cls")


def top(df: DataFrame, key: str, k: int, *ties: Column) -> DataFrame:
    """The k most frequent keys; ties in the order given."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *(ties or (F.col(key),))).limit(k)


def conf_histogram(blocks: DataFrame, k: int = 8) -> DataFrame:
    return top(blocks.withColumn("conf", F.bround("conf", 2)), "conf", k)


def height_bands(blocks: DataFrame) -> DataFrame:
    """Distinct texts other than numbers by their greatest height: count, share, characters, mean confidence."""
    per = classified(blocks).where("cls <> 'skip_numeric'").groupBy("text").agg(F.max(F.col("y1") - F.col("y0")).alias("h"), F.avg(F.col("conf").cast("decimal(10,4)")).cast("double").alias("conf"))
    band = F.lit(None).cast("int")
    for i in reversed(range(len(BANDS) - 1)):
        band = F.when((F.col("h") >= BANDS[i]) & (F.col("h") < BANDS[i + 1]), BANDS[i]).otherwise(band)
    rows = per.withColumn("band", band).where("band IS NOT NULL")
    out = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("text")).alias("n_chars"), F.sum(F.bround("conf", 6).cast("decimal(18,6)")).alias("confs"), F.count_if(F.col("conf") < 0.5).alias("n_low"))
    whole = rows.agg(F.count(F.lit(1)).alias("whole"))
    return out.crossJoin(F.broadcast(whole)).select("band", "n_texts", "n_chars", "n_low", F.bround((F.col("confs") / F.col("n_texts")).cast("double"), 4).alias("mean_conf"), F.bround(100 * F.col("n_texts") / F.col("whole"), 1).alias("share"))


def cumulative_heights(blocks: DataFrame) -> DataFrame:
    per = classified(blocks).where("cls <> 'skip_numeric'").groupBy("text").agg(F.max(F.col("y1") - F.col("y0")).alias("h"))
    return per.agg(*[F.count_if(F.col("h") >= t).alias(f"at_least_{t}") for t in (5, 6, 8)])


def route(pages: DataFrame) -> DataFrame:
    """By document: pages, characters, images and the route they call for. pages: document, chars, images."""
    per = pages.groupBy("document").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("chars").alias("n_chars"), F.sum("images").alias("n_images"))
    mean = F.col("n_chars") / F.col("n_pages")
    way = F.when(mean < 50, "ocr").when(F.col("n_images") > 0, "ocr_plus_text_layer").otherwise("text_layer")
    return per.withColumn("mean_chars", F.bround(mean, 3)).withColumn("route", way)


def page_range(specs: DataFrame, pages: int) -> DataFrame:
    """Pages of specs such as 1-5,12; a page outside of 1 to pages is an error."""
    part = specs.select("spec", F.explode(F.split("spec", r"\s*,\s*")).alias("part")).select("spec", F.split("part", "-").alias("ends"))
    ends = part.select("spec", F.get("ends", F.lit(0)).cast("int").alias("a"), F.coalesce(F.get("ends", F.lit(1)), F.get("ends", F.lit(0))).cast("int").alias("b"))
    checked = F.when((F.col("a") < 1) | (F.col("b") > pages) | (F.col("a") > F.col("b")), F.raise_error(F.lit("page out of range"))).otherwise(F.sequence("a", "b"))
    return ends.select("spec", F.explode(checked).alias("page")).distinct()


def background(colors: DataFrame) -> DataFrame:
    """By page: blocks, uniform ones, light ones and turned ones. colors: page, lum, ratio, w, h, n."""
    uniform = F.col("ratio") >= 0.55
    return colors.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.count_if(uniform).alias("n_uniform"),
        F.count_if(F.col("lum") >= 200).alias("n_light"),
        F.count_if((F.col("h") > 2 * F.col("w")) & (F.col("n") > 3)).alias("n_turned"),
    )


def probe(pages: DataFrame, images: DataFrame, least: float = 0.8) -> DataFrame:
    """By document: pages, characters and their mean, images and pages that an image fills, and the route.

    pages: document, page, chars, area; images: document, page, area.
    """
    per_page = images.groupBy("document", "page").agg(F.count(F.lit(1)).alias("images"), F.max("area").alias("largest"))
    both = pages.join(per_page, ["document", "page"], "left").withColumn("images", F.coalesce("images", F.lit(0)))
    full = both.groupBy("document").agg(F.count_if(F.col("largest") >= least * F.col("area")).alias("n_full"))
    return route(both.select("document", "chars", "images")).join(full, "document")


def character_histogram(spans: DataFrame, column: str, k: int) -> DataFrame:
    """The k values of a column that most characters of (text, ...) spans have."""
    per = spans.groupBy(column).agg(F.sum(F.length("text")).alias("n_chars"))
    return per.orderBy(F.desc("n_chars"), column).limit(k)


def worst_backgrounds(colors: DataFrame, k: int = 30) -> DataFrame:
    """The k blocks of the least uniform backgrounds."""
    return colors.where("ratio < 0.55").orderBy("ratio", "page", "ln").limit(k).select("page", "ln", "ratio")
